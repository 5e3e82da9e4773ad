"""Token counts by a finite-state transducer compiled from a piece vocabulary.

Pair merging by score is turned into a deterministic transducer over characters. The encoding of every prefix is kept
implicitly: its last token is the one entry that ends there and fits the last token of the prefix before it (two
tokens fit when merging their characters side by side gives exactly these two again). A state therefore only has to
know, for the few positions where a token could still begin, the last token and the count relative to now. A transition
carries the change of the count. States are numbered as they are first met; the transition table is shared by all texts
of a worker and bounded.

No piece spans a border between another character and the mark of a space. A chunk from one such border to the next
therefore starts in the same state whatever precedes it: its state map is constant, so composing the maps of a text
reduces to a segmented sum of the counts of its chunks, taken over all chunks of a batch at once with numpy; texts with
spaces in a row or at the end are summed one by one. No map is stored and no scan is run.

A null or empty text has no tokens. A text of any length is processed whole; a chunk without a border walks the same
transducer character by character.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wardlake.llm.common import map_batches
from wardlake.llm.words import text_slices

SPACE = "▁"
_CHUNK = re.compile(" +[^ ]*")
# Bounds of what a worker remembers: transitions, fits and counted chunks. Beyond a bound the table begins anew.
TRANSITIONS = 600_000
FITS = 600_000
CHUNKS = 400_000

# Fixed values of the model file: field numbers and piece types.
PIECES, PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 1, 2, 3
NORMAL_PIECE, USER_PIECE, BYTE_PIECE = 1, 4, 6
NORMALIZER, NORMALIZER_NAME, DUMMY_PREFIX, STRIP_SPACES = 3, 1, 3, 4


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value: object = number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class CountingTransducer:
    """Token counts of texts for one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = list(fields(file.read()))
        rule = dict(fields(next((v for k, v in model if k == NORMALIZER), b"")))
        if rule.get(NORMALIZER_NAME) != b"identity" or rule.get(STRIP_SPACES, 1):
            raise ValueError("only models that keep texts as they are can be compiled")
        self.lead = " " if rule.get(DUMMY_PREFIX, 1) else ""
        self.score: dict[str, float] = {}
        for key, value in model:
            if key != PIECES:
                continue
            piece = dict(fields(value))
            kind, text = piece.get(PIECE_TYPE, NORMAL_PIECE), piece[PIECE_TEXT].decode()
            if kind == USER_PIECE:
                raise ValueError("pieces set by a user are not merged and can't be compiled")
            if kind == NORMAL_PIECE:
                self.score[text] = struct.unpack("<f", piece[PIECE_SCORE])[0]
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a piece spans the border of a word")
        self.starts = {p[:n] for p in self.score for n in range(1, len(p) + 1)}
        self.own: dict[str, bool] = {}
        self._restart()
        self.chunks: dict[str, int] = {}

    def _restart(self) -> None:
        # A state: pending characters, and for each place before, inside and after them the last token and the count
        # relative to the end. Place 0 of the first state has no token before it.
        first = ("", ((None, 0),))
        self.states, self.number = [first], {first: 0}
        self.step: dict[tuple[int, str], tuple[int, int]] = {}
        self.fit: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Exact merging: best score first, leftmost on ties."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def reachable(self, piece: str) -> bool:
        """True if merging the characters of a piece gives the piece."""
        got = self.own.get(piece)
        if got is None:
            got = self.own[piece] = len(piece) == 1 or self.merged(piece) == [piece]
        return got

    def fits(self, left: str | None, right: str) -> bool:
        if left is None:
            return True
        got = self.fit.get((left, right))
        if got is None:
            if len(self.fit) > FITS:
                self.fit.clear()
            got = self.fit[left, right] = self.merged(left + right) == [left, right]
        return got

    def weight(self, token: str) -> int:
        """Tokens that stand for a piece: its bytes where the vocabulary lacks it."""
        return 1 if token in self.score else len(token.encode())

    def follow(self, state: int, letter: str) -> tuple[int, int]:
        """Next state and change of the count; computed when first met."""
        pending, places = self.states[state]
        text = pending + letter
        begin = len(text) - 1
        for k in range(len(text)):
            token = text[k:]
            if (k == begin or token in self.score) and self.reachable(token) and self.fits(places[k][0], token):
                break
        else:
            raise AssertionError(f"no token ends {text!r}")
        change = places[k][1] + self.weight(token)
        kept = 0
        while kept < len(text) and text[kept:] not in self.starts:
            kept += 1
        following = [(t, n - change) for t, n in places[kept:]] + [(token, 0)]
        if kept == len(text):
            # No piece begins with any end of the text so far, so whatever follows fits.
            following = [(None, 0)]
        key = (text[kept:], tuple(following))
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
        self.step[state, letter] = number, change
        return number, change

    def count_chunk(self, chunk: str) -> int:
        state = total = 0
        step = self.step
        for letter in chunk:
            got = step.get((state, letter))
            state, change = got if got else self.follow(state, letter)
            total += change
        return total

    def count_chunks(self, chunks: list[str]) -> np.ndarray:
        """Tokens of each chunk; a chunk lacks the mark of the space it begins with."""
        counts = np.fromiter((self.chunks.get(c, -1) for c in chunks), np.int64, len(chunks))
        for i in np.flatnonzero(counts < 0).tolist():
            if len(self.step) > TRANSITIONS:
                self._restart()
            counts[i] = self.count_chunk(SPACE + chunks[i])
            if len(self.chunks) < CHUNKS and len(chunks[i]) < 64:
                self.chunks[chunks[i]] = int(counts[i])
        return counts

    def count(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text of a column."""
        parts = [self._count(column.slice(a, b - a)) for a, b in text_slices(column)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _count(self, column: pa.Array) -> np.ndarray:
        texts = pc.fill_null(column, "")
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        texts = pc.replace_substring(texts, SPACE, " ")
        if self.lead:
            texts = pc.binary_join_element_wise(pa.scalar(""), texts, " ")
        # Spaces in a row, or at the end, begin one chunk together; the others begin a chunk each.
        lists = pc.split_pattern(texts, " ")
        per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        first = np.cumsum(per_text) - per_text
        blank = pc.equal(flat, "").to_numpy(zero_copy_only=False).copy()
        coded = flat.dictionary_encode()
        counts = self.count_chunks(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        counts[first] = 0
        blank[first] = False
        # A blank part is a space before another one or at the end: such texts are cut at runs of spaces instead.
        odd = np.zeros(len(per_text), bool)
        odd[np.repeat(np.arange(len(per_text)), per_text)[blank]] = True
        totals = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
        for i in np.flatnonzero(odd).tolist():
            totals[i] = sum(self.count_chunk(c.replace(" ", SPACE)) for c in _CHUNK.findall(texts[i].as_py()))
        if not self.lead:
            totals += np.array([self.count_chunk(t) for t in flat.take(pa.array(first)).to_pylist()], np.int64)
        totals[empty] = 0
        return totals


@lru_cache(maxsize=2)
def transducer(model: str) -> CountingTransducer:
    """One transducer a worker, kept over its tasks."""
    return CountingTransducer(model)


def token_counts(
    docs: DataFrame, model: str, limit: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: ``n_bytes`` of the text in UTF-8, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``).

    Rows with equal or null ids stay apart; a null text counts as empty.
    """

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column(1)
        tokens = transducer(model).count(texts)
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        return {
            id_column: batch.column(0),
            "n_bytes": size,
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": pa.array(tokens > limit, pa.bool_()),
        }

    chosen = docs.select(id_column, text_column)
    kind = chosen.schema[0].dataType.simpleString()
    return map_batches(chosen, run, f"{id_column} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
