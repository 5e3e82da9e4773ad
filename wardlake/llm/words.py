"""Whole texts encoded by way of their distinct words.

A text is cut where a byte-level vocabulary always begins a new word, so the ids of the text are the ids of its parts in
a row: before a single space between two characters that are not white space, on both sides of such a line feed, and
between a Latin letter and the mark of a sentence or one of ``#$%&*`` that follows it. The cut and the search for distinct
parts run in Arrow, ids are gathered with numpy; the encoder sees each distinct part of a slice once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Distinct words that a worker remembers; further ones are encoded once a slice.
REMEMBERED = 400_000
# Bytes of text worked on at a time.
SLICE_BYTES = 8_000_000
# New words that the library encodes as one text.
JOINED = 512
# Stands between parts while a text is cut; a text that holds it is cut at spaces only.
_CUT = "\x01"
# White space as ranges of a character class, the space itself left out.
_WHITE = r"\t-\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# White space other than a lone space between two other characters.
_ODD_SPACE = rf"  |^ | $|[{_WHITE}] | [{_WHITE}]"
_LONE_SPACE = re.compile(r"(?<=\S)(?= \S)")
_LONE_LINE_FEED = rf"([^ {_WHITE}{_CUT}])\n([^ {_WHITE}{_CUT}])"
_ONE_WORD = rf"^ ?[^ {_WHITE}]+$"
_LATIN = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}"
_LETTER_AND_MARK = rf"([{_LATIN}])([.,;:!?#$%&*])"
_LATIN_WORD = rf"^ ?[{_LATIN}]+$"

Ragged = tuple[np.ndarray, np.ndarray]  # values of all rows in one array, and the number of each row's values


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` bytes each; a longer text is a range of its own."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(size):
        yield begin, len(size)


def gathered(store: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """store[start : start + length] of each row, in a row."""
    stop = np.cumsum(length)
    total = int(stop[-1]) if len(stop) else 0
    kind = np.int32 if max(total, len(store)) < 1 << 31 else np.int64
    return store[np.repeat((start - (stop - length)).astype(kind), length) + np.arange(total, dtype=kind)]


def split_rows(flat: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []


def parts_of(texts: pa.Array) -> pa.ListArray:
    """Parts of each text with the space that leads them; an empty text is one empty part."""
    odd = pc.match_substring_regex(texts, f"{_ODD_SPACE}|{_CUT}")
    plain = pc.replace_substring(texts.filter(pc.invert(odd)), " ", _CUT + " ")
    plain = pc.replace_substring_regex(plain, _LONE_LINE_FEED, f"\\1{_CUT}\n{_CUT}\\2")
    plain = pc.split_pattern(pc.replace_substring_regex(plain, _LETTER_AND_MARK, rf"\1{_CUT}\2"), _CUT)
    if not pc.any(odd).as_py():
        return plain
    rows = np.arange(len(texts))
    is_odd = odd.to_numpy(zero_copy_only=False)
    careful = pa.array([_LONE_SPACE.split(t) for t in texts.filter(odd).to_pylist()], plain.type)
    order = np.argsort(np.concatenate([rows[~is_odd], rows[is_odd]]))
    return pa.concat_arrays([plain, careful]).take(pa.array(order))


class WordMemory:
    """Ids of texts from the ids of their distinct parts; ``encode_new`` encodes parts it has not seen."""

    def __init__(self, encode_new: Callable[[list[str]], Ragged], dtype: str):
        self.encode_new, self.dtype = encode_new, dtype
        self.known: dict[str, int] = {}
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(0, dtype)

    def encode(self, column: pa.Array) -> Ragged:
        """Ids of all texts in a row, and the number of ids of each text; a null text counts as empty."""
        parts = [self._encode(column.slice(a, b - a)) for a, b in text_slices(column)]
        if not parts:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _encode(self, column: pa.Array) -> Ragged:
        lists = parts_of(pc.fill_null(column, ""))
        per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        store, start, length = self.store, self.start, self.length
        new = np.flatnonzero(place < 0)
        if len(new):
            unknown = [words[i] for i in new.tolist()]
            flat, counts = self.encode_new(unknown)
            place[new] = len(start) + np.arange(len(new))
            start = np.concatenate([start, len(store) + np.cumsum(counts) - counts])
            store = np.concatenate([store, flat.astype(self.dtype)])
            length = np.concatenate([length, counts.astype(np.int64)])
            if len(start) <= REMEMBERED:
                self.known.update(zip(unknown, place[new].tolist(), strict=True))
                self.store, self.start, self.length = store, start, length
        place = place[coded.indices.to_numpy()]
        n = length[place]
        return gathered(store, start[place], n), np.add.reduceat(n, np.cumsum(per_text) - per_text)


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


@lru_cache(maxsize=4)
def _library(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def vocabulary_size(vocabulary: str) -> int:
    """One more than the largest id."""
    return max(_library(vocabulary).get_vocab(with_added_tokens=True).values()) + 1


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def letter_words_encoder(tokenizer) -> Callable[[list[str]], Ragged | None] | None:
    """The library's model alone, for words of Latin letters that a space may lead; None if the vocabulary cuts otherwise.

    The pattern of a byte-level vocabulary keeps such a word whole and no special token lies in it, so only its merges are
    left to do. Words are given in the letters of their bytes, many in one text, and cut by their bytes again. The answer
    is None if an id crosses the end of a word or a byte has none.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    cuts, specials = tokenizer.pre_tokenizer, tokenizer.get_added_tokens_decoder().values()
    if not isinstance(cuts, pre_tokenizers.ByteLevel) or cuts.add_prefix_space or not cuts.use_regex:
        return None
    if tokenizer.normalizer or any(re.fullmatch("[^\\W\\d_]*", special.content.strip()) for special in specials):
        return None
    model = Tokenizer(tokenizer.model)
    model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    letters = {byte: letter for letter, byte in byte_letters().items()} | {ord("\n"): "\n"}
    entries = model.get_vocab()
    size = np.zeros(max(entries.values()) + 1, np.int64)
    size[list(entries.values())] = list(map(len, entries))

    def encode(words: list[str]) -> Ragged | None:
        text = "\n".join(words).encode().decode("latin-1").translate(letters)
        flat = np.array(model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        ends, stops = np.cumsum(size[flat]), np.cumsum(list(map(len, text.split("\n"))))
        at = np.searchsorted(ends, stops)
        if not len(ends) or ends[-1] != stops[-1] or (ends[at] != stops).any():
            return None
        return flat, np.diff(at, prepend=-1)

    return encode


@lru_cache(maxsize=2)
def library_encoder(vocabulary: str) -> WordMemory:
    """The tokenizers library, over distinct words; ids are 16 bits wide where the vocabulary allows, else 32.

    New words of Latin letters go to the library's model at once, many in one text. Other new words without white space,
    but for a space that leads them, are encoded many in one text with a line feed between two, which is an id of its own
    and where the ids are cut; the rest is encoded one by one.
    """
    tokenizer, dtype = _library(vocabulary), id_type(vocabulary_size(vocabulary))
    between = tokenizer.encode("\n", add_special_tokens=False).ids
    letter_words = letter_words_encoder(tokenizer)

    def one_by_one(words: list[str]) -> Ragged:
        ids = [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype, int(counts.sum())), counts

    def together(words: list[str]) -> Ragged:
        flat = np.array(tokenizer.encode_batch_fast(["\n".join(words)], add_special_tokens=False)[0].ids, dtype)
        at = np.flatnonzero(flat == between[0])
        if len(between) != 1 or len(at) != len(words) - 1:
            return one_by_one(words)
        return np.delete(flat, at), np.diff(at, prepend=-1, append=len(flat)) - 1

    def merged(words: list[str]) -> Ragged:
        return (letter_words and letter_words(words)) or together(words)

    def encode_new(words: list[str]) -> Ragged:
        column = pa.array(words, pa.string())
        plain, latin = (
            pc.match_substring_regex(column, pattern).to_numpy(zero_copy_only=False) for pattern in (_ONE_WORD, _LATIN_WORD)
        )
        kind = np.where(latin, 0, np.where(plain, 1, 2))
        alike, others, odd = ([words[i] for i in np.flatnonzero(kind == k).tolist()] for k in range(3))
        parts = [merged(alike[k : k + JOINED]) for k in range(0, len(alike), JOINED)]
        parts += [together(others[k : k + JOINED]) for k in range(0, len(others), JOINED)] + [one_by_one(odd)]
        flat, counts = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
        back = np.argsort(np.argsort(kind, kind="stable"))
        return gathered(flat, (np.cumsum(counts) - counts)[back], counts[back]), counts[back]

    return WordMemory(encode_new, dtype)
