"""Spelling variants of the words of a corpus, found by blocked Gram matrices.

Words are counted in Spark. Two words are near when they differ by exactly one inserted, deleted or replaced code
point. Such words have lengths ``m`` and ``m`` or ``m + 1``, and agree in their first ``m // 2`` code points or in what
follows them (without the extra one): an edit lies in one of the two halves. So words meet in blocks by length, half and
its text, each word beside those of its own length and of the next one. For every block NumPy multiplies the matrix of
letter counts with itself; squared distances come from that Gram matrix, and only pairs at most two apart (one letter
more, less or exchanged) are compared letter by letter. A block of more than ``TILE`` words is cut into tiles and every pair of tiles
is a task's work of its own, so a common half of a word is spread, and nothing is capped: the result is exact.

The form of a word is its near word of largest count, if that is at least ``RATIO`` times the word's own count; the
root is where following the forms ends. Counts grow tenfold at each step, so the chain is short.

A null text has no words. A null id counts as an empty one where damage is drawn. Repeated rows count again, ties
go to the smaller word in code-point order, very long words are handled whole, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import drop_staged, staged

# Runs of letters, capitals that are lowered, and the share of runs that lose a letter.
RUN_PATTERN = "[A-Za-z\\u00C0-\\u00FF]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DAMAGE = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
# Words of a block that are multiplied at once.
TILE = 4096
# Rows of neighbouring small blocks that share one product.
PACKED = 256
# Letters are counted in this many classes; letters that share one only bring words nearer.
LETTERS = 32
NEAR_SCHEMA = "word string, near string, near_n bigint"


def damaged_words(docs: DataFrame) -> DataFrame:
    """Runs of letters of all texts, one row each: ``word``, with the letter taken out that the contract's hash names."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate("text", CAPITALS, CAPITALS.lower()), F.lit(RUN_PATTERN), F.lit(0))).alias("run"),
    )
    drawn = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    cut = (F.col("h") % F.char_length("run")).cast("int")
    without = F.concat(F.expr("substr(run, 1, cast(h % char_length(run) as int))"), F.substring("run", cut + 2, F.lit(2**31 - 1)))
    return drawn.select(F.when(F.col("h") % DAMAGE == 0, without).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of words long and frequent enough; counted before the shuffle."""
    long = words.where(F.char_length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def blocked(words: DataFrame, tile: int = TILE) -> DataFrame:
    """Each word in its blocks, ``block, word, n``: by own length and as the longer one, by first half and by second.

    A block's name has the shorter length, the side and the common text. Blocks of one word are left out; a large one
    is cut into tiles, and a word goes to each pair of tiles its own is part of.
    """
    length = F.char_length("word")
    halves = []
    for longer in (0, 1):
        m = (length - longer).cast("int")
        first = (m / 2).cast("int")
        halves += [
            F.concat_ws(":", m.cast("string"), F.lit("P"), F.substring("word", F.lit(1), first)),
            F.concat_ws(":", m.cast("string"), F.lit("S"), F.substring("word", first + longer + 1, F.lit(2**31 - 1))),
        ]
    rows = words.select("word", "n", F.explode(F.array(*halves)).alias("name"))
    sizes = rows.groupBy("name").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    tiles = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    placed = rows.join(sizes, "name").withColumn("tiles", tiles).withColumn("own", own)
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pair = F.concat_ws(":", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
    return paired.select(F.when(F.col("tiles") == 1, F.col("name")).otherwise(F.concat_ws(":", "name", pair)).alias("block"), "own", "word", "n")


class _Words:
    """Words of a few blocks as matrices of codes and of letter counts."""

    def __init__(self, words: list[str]):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        row = np.repeat(np.arange(len(words)), self.length)
        flat = np.bincount(row * LETTERS + self.letters % LETTERS, minlength=len(words) * LETTERS)
        self.counts = flat.reshape(-1, LETTERS).astype(np.float32)
        self.norm = (self.counts**2).sum(axis=1)

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of rows, ``a`` not longer than ``b`` and at most one shorter: exactly one edit apart?"""
        near = np.zeros(len(a), bool)
        for m in np.unique(self.length[a]):
            some = np.flatnonzero(self.length[a] == m)
            for k in range(0, len(some), max(1, (1 << 22) // int(m + 1))):
                part = some[k : k + max(1, (1 << 22) // int(m + 1))]
                at = np.arange(m)
                left = self.letters[self.start[a[part]][:, None] + at]
                same = left == self.letters[self.start[b[part]][:, None] + at]
                extra = self.length[b[part]] - m
                # Equal letters from the front, and from the back where the other word is one letter longer.
                front = np.where(same.all(axis=1), m, same.argmin(axis=1))
                shifted = left == self.letters[self.start[b[part]][:, None] + at + extra[:, None]]
                back = np.where(shifted.all(axis=1), m, shifted[:, ::-1].argmin(axis=1))
                near[part] = np.where(extra == 1, front + back >= m, front + back == m - 1)
        return near


def near_in_blocks(block: np.ndarray, own: np.ndarray, side: np.ndarray, short: np.ndarray, words: list[str]):
    """Pairs of rows one edit apart that share a block; rows of a block lie together.

    In a block between two tiles only pairs across them count, and in one of second halves only pairs whose first
    halves differ, as the others meet elsewhere: every pair comes out once.
    """
    table = _Words(words)
    found_a, found_b = [], []
    border = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    ends = np.append(border[1:], len(block))
    k = 0
    while k < len(border):
        low = border[k]
        # Whole small blocks share a product; a large one is taken in strips.
        while k + 1 < len(border) and ends[k + 1] - low <= PACKED:
            k += 1
        high = ends[k]
        k += 1
        for strip in range(low, high, PACKED):
            top = min(strip + PACKED, high)
            gram = table.counts[strip:top] @ table.counts[low:high].T
            apart = table.norm[strip:top, None] + table.norm[None, low:high] - 2 * gram
            a, b = np.nonzero(apart < 2.5)
            a, b = a + strip, b + low
            la, lb = table.length[a], table.length[b]
            # The shorter word first; of two of one length the earlier row.
            ordered = (block[a] == block[b]) & ((la < lb) | ((la == lb) & (a < b) & (la == short[a])))
            ordered &= (own[a] != own[b]) | (side[a] < 2)
            a, b = a[ordered], b[ordered]
            close = table.one_edit(a, b)
            a, b = a[close], b[close]
            second = side[a] % 2 == 1
            if second.any():
                keep = np.ones(len(a), bool)
                for i in np.flatnonzero(second):
                    half = int(short[a[i]]) // 2
                    keep[i] = words[a[i]][:half] != words[b[i]][:half]
                a, b = a[keep], b[keep]
            found_a.append(a)
            found_b.append(b)
    return np.concatenate(found_a), np.concatenate(found_b)


def near_pairs(blocks: DataFrame) -> DataFrame:
    """Every pair of near words, in both directions: ``word, near, near_n``."""

    def pairs(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        whole = pa.Table.from_batches(rows).combine_chunks()
        names, words = whole.column(0).to_pylist(), whole.column(2).to_pylist()
        own, n = whole.column(1).to_numpy(), whole.column(3).to_numpy()
        block = np.cumsum(np.fromiter((x != y for x, y in zip(names, [None, *names], strict=False)), bool, len(names)))
        split = {name: name.split(":") for name in set(names)}
        short = np.array([int(split[x][0]) for x in names], np.int64)
        # Whether the block is of second halves, and whether it lies between two different tiles.
        kind = {x: (p[1] == "S") + 2 * (len(p) == 5 and p[3] != p[4]) for x, p in split.items()}
        a, b = near_in_blocks(block, own, np.array([kind[x] for x in names]), short, words)
        if not len(a):
            return None
        left, right = np.concatenate([a, b]), np.concatenate([b, a])
        return pa.RecordBatch.from_pydict(
            {"word": pa.array([words[i] for i in left]), "near": pa.array([words[i] for i in right]), "near_n": pa.array(n[right])}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole blocks at a time: the last block of a batch waits for its next rows.
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch.column(0)[batch.num_rows - 1]
            names = batch.column(0)
            if waiting and waiting[-1].column(0)[waiting[-1].num_rows - 1] == last:
                waiting.append(batch)
                continue
            low, high = 0, batch.num_rows - 1
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if names[middle] == last else (middle + 1, high)
            waiting.append(batch.slice(0, low))
            if (got := pairs([w for w in waiting if w.num_rows] or [batch.slice(0, 0)])) is not None:
                yield got
            waiting = [batch.slice(low)]
        if waiting and (got := pairs(waiting)) is not None:
            yield got

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, NEAR_SCHEMA)


def rooted(forms: DataFrame) -> DataFrame:
    """``word, form, form_n, root`` from ``word, form, form_n``: follow the forms to the end, one join a step."""
    current = staged(forms.withColumn("root", F.col("form")), "roots")
    step = forms.select(F.col("word").alias("_at"), F.col("form").alias("_next"))
    while True:
        moved = current.join(step, F.col("root") == F.col("_at"), "left")
        later = staged(
            moved.select("word", "form", "form_n", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "roots",
        )
        drop_staged(current)
        current = later.drop("_moved")
        if later.where("_moved").isEmpty():
            return current


def spelling_groups(counts: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` from ``word, n`` (one row a word)."""
    counts = staged(counts.select("word", "n"), "words")
    near = near_pairs(blocked(counts, tile)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    judged = counts.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best")
    strong = -F.col("best.less") >= ratio * F.col("n")
    judged = staged(judged.select("word", "n", "n_near", F.when(strong, F.col("best")).alias("best")), "near")
    forms = judged.where("best is not null").select("word", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
    found = rooted(staged(forms, "forms"))
    return judged.select("word", "n", "n_near").join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("bigint").alias("n_near"), "form_n"
    )
