"""Byte-pair encoding by speculation: greedy longest matches, verified pair by pair, merged only where they fail.

A word is encoded by proposing the longest vocabulary entry at each position. By the nature of pair merging the
proposal is the true encoding exactly when every entry encodes to itself and no merge ever crosses the border of two
adjacent entries. The second condition depends on the two entries alone and is tested for all pairs of a batch at once
with numpy. Words with a failing pair are merged exactly.

Texts are cut into words by the vocabulary's pattern first, and each distinct word of a batch is encoded once.
Null texts count as empty, special tokens inside a text are cut out before anything else, and a text of any length is
processed whole; a word without a border (a long run of letters) is one word and merges in n log n steps.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wardlake.llm.common import map_batches
from wardlake.llm.words import Ragged, WordMemory, byte_letters, gathered, split_rows

# Fixed values of byte-level vocabularies: the pattern that cuts a text into words.
WORD_CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class SpeculativeCodec:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.specials.values()]) + 1
        self.entries: list[bytes] = [b""] * self.size
        for entry, i in vocab.items():
            if entry not in self.specials:
                self.entries[i] = bytes(letters[c] for c in entry)
        for text, i in self.specials.items():
            self.entries[i] = text.encode()
        self.byte_id = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_id[byte] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # Rank at which an entry is made, and the two entries it is made from; single bytes have rank -1.
        self.rank = np.full(self.size, -1, np.int64)
        self.left, self.right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.rank[made], self.left[made], self.right[made] = np.arange(len(made)), left, right
        keys = left * self.size + right
        order = np.argsort(keys)
        self.pair_keys, self.pair_rank, self.pair_made = keys[order], order, made[order]
        self.merge = {k: (r, m) for k, r, m in zip(keys.tolist(), range(len(made)), made.tolist(), strict=True)}
        self.never = len(made) + 1
        self._build_trie([i for i in vocab.values() if self.entries[i] and vocab.get("") != i])
        self.cut = regex.compile(WORD_CUTS)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.memory = WordMemory(self.encode_new, "<u4")
        self.lengths = np.array([len(e) for e in self.entries], np.int64)

    def _build_trie(self, ids: list[int]) -> None:
        """Sorted edges (node * 256 + byte) of the vocabulary's trie, and the entry that ends at each node."""
        node_of, ends, edges = {b"": 0}, {}, []
        for i in ids:
            entry = self.entries[i]
            for n in range(1, len(entry) + 1):
                if entry[:n] not in node_of:
                    node_of[entry[:n]] = len(node_of)
                    edges.append((node_of[entry[: n - 1]] * 256 + entry[n - 1], node_of[entry[:n]]))
            ends[node_of[entry]] = i
        edges.sort()
        self.edge_keys = np.array([k for k, _ in edges], np.int64)
        self.edge_to = np.array([v for _, v in edges], np.int64)
        self.node_entry = np.full(len(node_of), -1, np.int64)
        self.node_entry[list(ends)] = list(ends.values())

    def propose(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words together: (word number, entry) in order of word and position."""
        words, picks, steps = [], [], []
        live, at, step = np.arange(len(start)), start.copy(), 0
        while len(live):
            node, pos = np.zeros(len(live), np.int64), at[live].copy()
            best, best_end = np.full(len(live), -1, np.int64), pos.copy()
            walking = np.arange(len(live))
            while len(walking):
                walking = walking[pos[walking] < stop[live[walking]]]
                key = node[walking] * 256 + data[pos[walking]]
                found = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
                hit = self.edge_keys[found] == key
                walking, found = walking[hit], found[hit]
                node[walking] = self.edge_to[found]
                pos[walking] += 1
                entry = self.node_entry[node[walking]]
                ending = walking[entry >= 0]
                best[ending], best_end[ending] = entry[entry >= 0], pos[ending]
            words.append(live)
            picks.append(best)
            steps.append(np.full(len(live), step))
            at[live] = best_end
            live = live[at[live] < stop[live]]
            step += 1
        word, pick, order = np.concatenate(words), np.concatenate(picks), np.concatenate(steps)
        sort = np.lexsort((order, word))
        return word[sort], pick[sort]

    def crossed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """True where, in the bytes of entries a and b side by side, some merge crosses the border.

        While entries grow, the border always lies between a suffix x of ``a`` on its right spine and a prefix y of
        ``b`` on its left spine. x lasts until the merge that makes its parent, y likewise. The pairs (x, y) that stand
        beside each other are walked from the whole entries down to single bytes; the merge of x and y happens if its
        rank comes before the ranks that end x and end y.
        """
        bad = np.zeros(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        end_x, end_y = np.full(len(a), self.never), np.full(len(a), self.never)
        while len(live):
            key = x * self.size + y
            found = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[found] == key, self.pair_rank[found], self.never)
            # Equal ranks go left to right: a merge inside a comes before the border, one inside b after it.
            hit = (rank < end_x) & (rank <= end_y) & (rank < self.never)
            bad[live[hit]] = True
            # The later made of the two was preceded by its own part beside the same neighbour.
            rx, ry = self.rank[x], self.rank[y]
            go = ~hit & ((rx >= 0) | (ry >= 0))
            back_x = rx > ry
            # Equal entries: the left one was made first, so the right one steps back first.
            nx, ny = np.where(back_x, self.right[x], x), np.where(back_x, y, self.left[y])
            nex, ney = np.where(back_x, rx, end_x), np.where(back_x, end_y, ry)
            live, x, y, end_x, end_y = live[go], nx[go], ny[go], nex[go], ney[go]
        return bad

    def merged(self, word: bytes) -> list[int]:
        """Exact merging of one word, lowest rank first and leftmost on ties."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := self.merge.get(ids[i] * self.size + ids[j])):
                heapq.heappush(heap, (m[0], i, ids[i], ids[j], m[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [t for t in ids if t >= 0]

    def merged_together(self, words: list[bytes]) -> list[np.ndarray]:
        """Exact merging of many words of similar length, one merge of every word at a time."""
        size = np.array([len(w) for w in words])
        wide = int(size.max())
        ids = np.full((len(words), wide + 1), -1, np.int64)
        inside = np.arange(wide + 1) < size[:, None]
        ids[inside] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]

        def ranks(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key = np.where((x >= 0) & (y >= 0), x * self.size + y, -1)
            found = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            hit = self.pair_keys[found] == key
            return np.where(hit, self.pair_rank[found], self.never), self.pair_made[found]

        out: list[np.ndarray] = [np.zeros(0)] * len(words)
        live = np.arange(len(words))
        rank, made = ranks(ids[:, :-1], ids[:, 1:])
        columns = np.arange(wide + 1)
        while len(live):
            at = rank.argmin(axis=1)
            rows = np.arange(len(live))
            done = rank[rows, at] >= self.never
            for i in np.flatnonzero(done).tolist():
                out[live[i]] = ids[i][ids[i] >= 0]
            live, ids, rank, made, at = live[~done], ids[~done], rank[~done], made[~done], at[~done]
            rows = np.arange(len(live))
            ids[rows, at] = made[rows, at]
            # What stands right of the merged pair moves one place to the left.
            source = np.minimum(columns + (columns > at[:, None]), wide)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            rank = np.take_along_axis(rank, np.minimum(source[:, :-1], wide - 1), axis=1)
            made = np.take_along_axis(made, np.minimum(source[:, :-1], wide - 1), axis=1)
            rank[:, -1] = self.never
            for side in (np.maximum(at - 1, 0), at):
                rank[rows, side], made[rows, side] = ranks(ids[rows, side], ids[rows, side + 1])
        return out

    def encode_words(self, words: list[bytes]) -> Ragged:
        """Ids of all words in a row, and the number of ids of each word; ``words`` are not empty."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        stop = np.cumsum(size)
        word, pick = self.propose(data, stop - size, stop)
        beside = np.flatnonzero(word[1:] == word[:-1])
        keys, back = np.unique(pick[beside] * self.size + pick[beside + 1], return_inverse=True)
        failing = self.crossed(keys // self.size, keys % self.size)[back]
        wrong = np.unique(word[beside[failing]])
        if not len(wrong):
            return pick, np.bincount(word, minlength=len(words))
        right = np.ones(len(words), bool)
        right[wrong] = False
        fixed: dict[int, np.ndarray] = {}
        for low, high in ((0, 8), (8, 16), (16, 32), (32, 64)):
            some = wrong[(size[wrong] > low) & (size[wrong] <= high)]
            for k in range(0, len(some), 20_000):
                part = some[k : k + 20_000].tolist()
                fixed.update(zip(part, self.merged_together([words[i] for i in part]), strict=True))
        for i in wrong[size[wrong] > 64].tolist():
            fixed[i] = np.array(self.merged(words[i]))
        wrong_rows = [fixed[i] for i in wrong.tolist()]
        keep = right[word]
        owner = np.concatenate([word[keep], np.repeat(wrong, [len(r) for r in wrong_rows])])
        flat = np.concatenate([pick[keep], *wrong_rows])
        return flat[np.argsort(owner, kind="stable")].astype(np.int64), np.bincount(owner, minlength=len(words))

    def encode_new(self, texts: list[str]) -> Ragged:
        """Ids of short texts: cut at special tokens, then by the pattern; each distinct word is encoded once."""
        place: dict[str, int] = {}
        order, per_text = [], []
        for text in texts:
            n = len(order)
            for k, part in enumerate(self.special_cut.split(text) if self.special_cut else [text]):
                for piece in [part] if k % 2 else self.cut.findall(part):
                    order.append(place.setdefault(piece, len(place)))
            per_text.append(len(order) - n)
        words = [w.encode() for w in place]
        special = {place[s]: i for s, i in self.specials.items() if s in place}
        flat, counts = self.encode_words([w for i, w in enumerate(words) if i not in special])
        if special:
            rows = split_rows(flat, counts)
            for i in sorted(special):
                rows.insert(i, np.array([special[i]]))
            flat, counts = np.concatenate(rows), np.array([len(r) for r in rows])
        owner = np.array(order, np.int64)
        n = counts[owner] if len(owner) else np.zeros(0, np.int64)
        start = np.cumsum(counts) - counts
        totals = np.bincount(np.repeat(np.arange(len(texts)), per_text), weights=n, minlength=len(texts))
        return gathered(flat, start[owner], n) if len(owner) else flat, totals.astype(np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        return split_rows(*self.memory.encode(pa.array(texts, pa.string())))

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are no UTF-8 become the replacement character."""
        entries = self.entries
        return b"".join([entries[i] for i in ids.tolist()]).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> SpeculativeCodec:
    """One codec a worker, kept over its tasks."""
    return SpeculativeCodec(path)


def encode_and_decode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's ids (array of int) and the text they decode to: columns id, ``ids``, ``decoded``.

    A null text gives no ids and an empty text; rows with equal or null ids stay apart.
    """

    def run(batch: pa.RecordBatch) -> dict:
        own = codec(vocabulary)
        ids = split_rows(*own.memory.encode(batch.column(1)))
        return {
            id_column: batch.column(0),
            "ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
            "decoded": pa.array([own.decode(i) for i in ids], pa.string()),
        }

    chosen = docs.select(id_column, text_column)
    kind = chosen.schema[0].dataType.simpleString()
    return map_batches(chosen, run, f"{id_column} {kind}, ids array<int>, decoded string")


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: number of ids, and the sha256 of its ids and of the decoded text, made where the ids are made."""

    def run(batch: pa.RecordBatch) -> dict:
        own = codec(vocabulary)
        ids = split_rows(*own.memory.encode(batch.column(1)))
        return {
            "doc_id": batch.column(0),
            "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(own.decode(i).encode()).hexdigest() for i in ids], pa.string()),
        }

    return map_batches(
        docs.select("doc_id", "text"), run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
