"""Sequences of a fixed window, each filled with documents that fit its seed by lexical search.

Documents are tokenized once and staged. Their ids are also the terms of the search: how many documents hold a term and
the mean length are counted over all documents (one row a term, so what is broadcast is bounded by the vocabulary).
Documents are dealt in the order of several signatures, each a term of the document drawn in proportion to its BM25
weight, so documents that share telling terms come together, and where very many share the first signature the next
ones decide. The order is cut into as few ranges as memory allows, and a range into shards by the same bound, counted in
postings; a table below the bound is searched whole. A shard holds an inverted index weighted by BM25. The first unused
document is the seed of a window; all its terms return the unused documents of the shard by score, and these fill the
window in turn. All documents of the shard are scored in whole units of 16 bits first, for all terms of the seed; those
that rounding leaves a chance are scored exactly, which leaves the result exact. Used documents leave the index. A
document that does not fit is cut, and its rest seeds the next window. If no unused document shares a term with the
seed, the next one in order follows. What is left at the end of a shard is cut into powers of two, so no sequence needs
padding.

Each id lies in exactly one piece whatever the data. A null or empty text is its end id only; equal or null ids of
documents stay apart; a very long text fills many windows; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import crc32_of_ids, staged
from wardlake.llm.words import id_type, library_encoder, split_rows, vocabulary_size

# A shard is closed at this many postings (a term of a document) or ids: what one worker holds in memory.
SHARD_POSTINGS, SHARD_IDS = 4_000_000, 16_000_000
# Signatures that order the documents.
SIGNATURES = 4
# Ids whose terms are counted at a time.
RUN_IDS = 1 << 20
# A term that at least this share of a shard's documents hold has a weight for each document instead of postings.
DENSE_SHARE = 0.04
# The units of all terms of a document; what is rounded down stays within 16 bits.
MOST_UNITS = 65_000
# A seed asks for so many neighbours, then for more, at last for all; the highest score of each block of places is taken.
NEIGHBOURS, BLOCK = (8, 64, 512, None), 32
# BM25 weights: saturation of repeats and share of length normalization.
K1, B = 1.2, 0.75

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint,"
    " offset bigint, ids binary"
)


def tokenized(docs: DataFrame, vocabulary: str, end_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """Staged documents (doc_id, n, ids) and the number of documents that hold each term (term, docs).

    Each task writes its documents and one row with its part of the counts.
    """
    size = max(vocabulary_size(vocabulary), end_id + 1)
    dtype = id_type(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        held = np.zeros(size, np.int64)
        for batch in batches:
            ids = [np.append(r, np.array(end_id, r.dtype)) for r in split_rows(*encoder.encode(batch.column(1)))]
            for some in runs_of(ids):
                held += np.bincount(terms_of(some)[0], minlength=size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(r) for r in ids], pa.int64()),
                    pa.array([r.astype(dtype).tobytes() for r in ids], pa.binary()),
                    pa.nulls(len(ids), pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "ids", "held"],
            )
        none = pa.array([None], pa.int64())
        counts = pa.array([held.tolist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [none, none, pa.array([None], pa.binary()), counts], ["doc_id", "n", "ids", "held"]
        )

    schema = "doc_id bigint, n bigint, ids binary, held array<bigint>"
    rows = staged(docs.select("doc_id", "text").mapInArrow(run, schema), "tokens")
    terms = rows.where("held is not null").select(F.posexplode("held").alias("term", "docs"))
    return rows.where("held is null").drop("held"), terms.groupBy("term").agg(F.sum("docs").alias("docs"))


def runs_of(rows: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Documents in order, cut where they hold about ``RUN_IDS`` ids or 65,536 of them; a longer one is alone."""
    begin, held = 0, 0
    for i, row in enumerate(rows):
        if i > begin and (held + len(row) > RUN_IDS or i - begin == 1 << 16):
            yield rows[begin:i]
            begin, held = i, 0
        held += len(row)
    if rows:
        yield rows[begin:]


def terms_of(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each document in a row (its end id is none), their repeats, and each document's number of them."""
    bits = 8 * rows[0].itemsize
    kind = np.uint32 if bits == 16 and len(rows) <= 1 << 16 else np.uint64
    sizes = np.array([len(row) - 1 for row in rows])
    key = np.repeat(np.arange(len(rows), dtype=kind) << kind(bits), sizes)
    key |= np.concatenate([row[:-1] for row in rows])
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    repeats = np.diff(first, append=len(key))
    key = key[first]
    return key.astype(rows[0].dtype), repeats, np.bincount((key >> kind(bits)).astype(np.int64), minlength=len(rows))


def weighted(rows: list[np.ndarray], idf: np.ndarray, mean_length: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each document in a row, their BM25 weights, and each document's number of them."""
    term, repeats, held = terms_of(rows)
    norm = np.repeat([K1 * (1 - B + B * len(row) / mean_length) for row in rows], held)
    return term, (idf[term] * repeats * (K1 + 1) / (repeats + norm)).astype(np.float32), held


def bm25(row: np.ndarray, idf: np.ndarray, mean_length: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of one document and their weights."""
    return weighted([row], idf, mean_length)[:2]


def signatures(rows: list[np.ndarray], waits: np.ndarray, idf: np.ndarray, mean_length: float) -> list[np.ndarray]:
    """The first term of each document in each race, -1 for none, and last each document's number of distinct terms."""
    term, weight, held = weighted(rows, idf, mean_length)
    some = np.flatnonzero(held)
    begin, owner = (np.cumsum(held) - held)[some], np.repeat(np.arange(len(rows)), held)
    signs = []
    for race in waits:
        sign = np.full(len(rows), -1, np.int64)
        if len(some):
            time = race[term] / weight
            ahead = np.flatnonzero(time == np.repeat(np.minimum.reduceat(time, begin), held[some]))
            winner, at = np.unique(owner[ahead], return_index=True)
            sign[winner] = term[ahead[at]]
        signs.append(sign)
    return [*signs, held]


def signed(rows: DataFrame, shared, mean_length: float, dtype: np.dtype) -> DataFrame:
    """The documents with their number of terms and their signatures: for each, the term that comes first in a race run
    at the terms' weights.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = shared.value
        waits = np.random.default_rng(7).exponential(size=(SIGNATURES, len(idf))).astype(np.float32)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [np.frombuffer(data, dtype) for data in batch.column(1).to_pylist()]
            parts = [signatures(some, waits, idf, mean_length) for some in runs_of(ids)]
            columns = [pa.array(np.concatenate(column), pa.int64()) for column in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["doc_id", "ids", *names])

    names = [*(f"sign{k}" for k in range(SIGNATURES)), "terms"]
    schema = "doc_id bigint, ids binary, " + ", ".join(f"{x} bigint" for x in names)
    return rows.select("doc_id", "ids").mapInArrow(run, schema)


class ShardIndex:
    """Inverted index of one shard with BM25 weights; documents are numbered in the order they are given.

    The index holds weights in whole units of 16 bits, rounded down, so a score in units is short of the true one by less
    than a unit a term; documents keep their own weights for exact scores. Seeds that follow each other are neighbours, so
    their scores for common terms differ by few rows. Used documents leave the index whenever a quarter of those inside is
    used.
    """

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean_length: float):
        parts = [weighted(some, idf, mean_length) for some in runs_of(ids)]
        self.term, self.weight, self.held = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
        self.size, self.first = len(ids), np.cumsum(self.held) - self.held
        self.unused = np.ones(self.size, bool)
        # Numbers of the documents inside; owners are places among them.
        self.inside = np.arange(self.size)
        # A term that one document holds finds nothing.
        count = np.bincount(self.term, minlength=len(idf))
        found = np.flatnonzero(count[self.term] > 1)
        owner = np.repeat(np.arange(self.size, dtype=np.int32), self.held)[found]
        self.unit = (np.bincount(owner, self.weight[found], self.size).max(initial=0) or 1.0) / MOST_UNITS
        order = np.argsort(self.term[found], kind="stable")
        owner, units = owner[order], (self.weight[found] / self.unit).astype(np.uint16)[order]
        present = np.flatnonzero(count > 1)
        count = count[present]
        common = count >= max(DENSE_SHARE * self.size, 64)
        self.row, self.place = present[common], present[~common]
        # Where a term is found: its row, or behind the rows its place among the postings.
        self.at = np.full(len(idf), -1, np.int64)
        self.at[self.row] = np.arange(len(self.row))
        self.at[self.place] = len(self.row) + np.arange(len(self.place))
        self.dense = np.zeros((len(self.row), self.size), np.uint16)
        begin = np.cumsum(count) - count
        for i, (low, n) in enumerate(zip(begin[common].tolist(), count[common].tolist(), strict=True)):
            self.dense[i, owner[low : low + n]] = units[low : low + n]
        # The common terms of the last seed, and the scores of the documents inside for them.
        self.asked, self.common = np.zeros(len(self.row), bool), np.zeros(self.size, np.uint16)
        rare = np.repeat(~common, count)
        self.owner, self.units = owner[rare].astype(np.int64), units[rare]
        self.limits = np.concatenate([[0], np.cumsum(count[~common])])

    def _leave(self) -> None:
        staying = self.unused[self.inside]
        if 4 * np.count_nonzero(staying) > 3 * len(staying):
            return
        kept = staying[self.owner]
        self.limits = np.concatenate([[0], np.cumsum(kept)])[self.limits]
        self.owner, self.units = (np.cumsum(staying) - 1)[self.owner[kept]], self.units[kept]
        self.dense, self.common = np.compress(staying, self.dense, axis=1), self.common[staying]
        self.inside = self.inside[staying]

    def _terms(self, doc: int) -> np.ndarray:
        return self.term[self.first[doc] : self.first[doc] + self.held[doc]]

    def _scores(self, seed: int, docs: np.ndarray) -> np.ndarray:
        """Exact scores of documents from their own weights."""
        asked = np.zeros(len(self.at), bool)
        asked[self._terms(seed)] = True
        held = self.held[docs]
        stop = np.cumsum(held)
        at = np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.first[docs] - (stop - held), held)
        return np.bincount(np.repeat(np.arange(len(docs)), held), self.weight[at] * asked[self.term[at]], len(docs))

    def _common(self, rows: np.ndarray) -> np.ndarray:
        """Scores in units for common terms, from those of the last seed where the two differ by fewer terms."""
        asked = np.zeros(len(self.row), bool)
        asked[rows] = True
        if np.count_nonzero(asked ^ self.asked) >= len(rows):
            self.asked, self.common = np.zeros(len(self.row), bool), np.zeros(len(self.inside), np.uint16)
        for row in np.flatnonzero(asked & ~self.asked).tolist():
            self.common += self.dense[row]
        for row in np.flatnonzero(self.asked & ~asked).tolist():
            self.common -= self.dense[row]
        self.asked = asked
        return self.common.copy()

    def _best(self, seed: int, want: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers, in order, and exact scores of the unused documents that score best, at least ``want`` of them, or all.

        The ``want``-th of the highest scores in blocks of places bounds the ``want``-th score from below. Documents short
        of it by a unit a term or more can't be among the best; the others are scored exactly.
        """
        unused = self.unused[self.inside]
        if want is None or len(unused) <= BLOCK * want:
            docs = self.inside[unused]
            return docs, self._scores(seed, docs)
        at = self.at[self._terms(seed)]
        rare = at[at >= len(self.row)] - len(self.row)
        score = self._common(at[(at >= 0) & (at < len(self.row))])
        for low, high in zip(self.limits[rare].tolist(), self.limits[rare + 1].tolist(), strict=True):
            score[self.owner[low:high]] += self.units[low:high]  # a document is once in the postings of a term
        score *= unused
        tops = np.maximum.reduceat(score, np.arange(0, len(score), BLOCK))
        least = int(np.partition(tops, len(tops) - want)[-want])
        docs = self.inside[np.flatnonzero((score >= max(least - np.count_nonzero(at >= 0) - 1, 0)) & unused)]
        score = self._scores(seed, docs)
        if len(docs) > want:
            good = score >= np.partition(score, len(score) - want)[-want]
            docs, score = docs[good], score[good]
        return docs, score

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused documents by falling score for all terms of the seed, then the rest in order."""
        self._leave()
        given: set[int] = set()
        for want in NEIGHBOURS:
            docs, score = self._best(seed, want)
            for doc in docs[np.argsort(-score, kind="stable")].tolist():
                if doc not in given:
                    given.add(doc)
                    yield doc


def filled(ids: list[np.ndarray], index: ShardIndex, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of a shard as lists of (document, start, length); full windows, then powers of two."""
    held: list[tuple[int, int, int]] = []
    room, rest, cursor = window, None, 0
    while True:
        if rest is None:
            while cursor < index.size and not index.unused[cursor]:
                cursor += 1
            if cursor == index.size:
                break
            rest = (cursor, 0)
            index.unused[cursor] = False
        seed, choices = rest[0], None
        while room:
            if rest is None:
                choices = choices or index.neighbours(seed)
                follower = next(choices, None)
                if follower is None:
                    break
                index.unused[follower] = False
                rest = (follower, 0)
            doc, start = rest
            take = min(room, len(ids[doc]) - start)
            held.append((doc, start, take))
            room -= take
            rest = (doc, start + take) if start + take < len(ids[doc]) else None
        if not room:
            yield held
            held, room = [], window
    left = window - room
    while left:
        want = 1 << (left.bit_length() - 1)
        left -= want
        short: list[tuple[int, int, int]] = []
        while want:
            doc, start, length = held.pop(0)
            take = min(want, length)
            short.append((doc, start, take))
            if take < length:
                held.insert(0, (doc, start + take, length - take))
            want -= take
        yield short


def packed_pieces(docs: DataFrame, vocabulary: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Every piece of every document with its sequence, place there and ids (16 or 32 bits each)."""
    rows, terms = tokenized(docs, vocabulary, end_id)
    size = max(vocabulary_size(vocabulary), end_id + 1)
    dtype = id_type(size)
    total, length = rows.agg(F.count("*"), F.sum("n")).first()
    counts = np.zeros(size, np.int64)
    for term, held in terms.toLocalIterator():  # one row a term of the vocabulary at most
        counts[term] = held
    idf = np.log1p((total - counts + 0.5) / (counts + 0.5)).astype(np.float32)
    mean_length = (length or 1) / max(total, 1)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(idf)
    # No more ranges than the bounds of a shard ask for: each further one would part documents that could be neighbours.
    tasks = max(math.ceil(counts.sum() / SHARD_POSTINGS), math.ceil((length or 0) / SHARD_IDS), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sequence = shared.value, TaskContext.get().partitionId() << 32
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        held = postings = 0
        kinds = [pa.int64()] * 7 + [pa.binary()]
        titles = [part.split()[0] for part in PIECES.split(",")]

        def emit(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], titles)

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out: list[tuple] = []
            for pieces in filled(ids, ShardIndex(ids, weights, mean_length), window):
                at = 0
                for doc, start, n in pieces:
                    part = ids[doc][start : start + n]
                    out.append((names[doc], start, n, crc32_of_ids(part), len(ids[doc]), sequence, at, part.tobytes()))
                    at += n
                sequence += 1
                if len(out) >= 4096:
                    yield emit(out)
                    out = []
            if out:
                yield emit(out)

        for batch in batches:
            for name, data, terms in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                row = np.frombuffer(data, dtype)
                if ids and (held + len(row) > SHARD_IDS or postings + terms > SHARD_POSTINGS):
                    yield from packed()
                    names, ids, held, postings = [], [], 0, 0
                names.append(name)
                ids.append(row)
                held += len(row)
                postings += terms
        if ids:
            yield from packed()

    order = [f"sign{k}" for k in range(SIGNATURES)] + ["doc_id", F.crc32("ids")]
    near = signed(rows, shared, mean_length, dtype).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return near.select("doc_id", "ids", "terms").mapInArrow(run, PIECES)
