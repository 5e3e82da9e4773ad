"""Quality scores learned from trusted positives and unlabelled text: non-negative unbiased risk.

Every document, labelled or not, becomes a fixed row of measures of its whole text (lengths, shares of kinds of
characters, repetition, lines, sentences). Rows are standardised and bent at ``KNOTS``, so that a linear score can
follow a measure that is bad at both ends. With ``p`` for the trusted positives and ``u`` for all rows to learn from,
the risk of a score ``g`` under the class prior ``prior`` is

    prior * E_p[loss(g)] + max(0, E_u[loss(-g)] - prior * E_p[loss(-g)])

with the logistic loss. Newton steps lower it; a step that would make the second term negative, the mark of a score
that has begun to memorise, is shortened until it does not. The prior is estimated from the scores themselves: above a
threshold that only positives pass, the share of unlabelled rows over the share of positives is the prior, and it is
nowhere less. A first fit under an even prior gives the scores for that, the second fit uses the estimate.

Nothing is sampled. Means, prior, risk, gradient and curvature are sums over all rows, added up in Spark; a fixed
number of sums reaches the driver, whatever the size. Negative labels are never read.

A null or empty text is scored by its (zero) measures. A document counts as positive if all its labels say 1; rows with
equal ids share the label, and a null id has none and is learned from as unlabelled. Without any positive or any row to
learn from every score is 0.5. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import map_batches, staged

# Places, in standard deviations, where a measure may change its effect.
KNOTS = (-1.0, 0.0, 1.0, 2.0)
# Standardised measures are kept inside this range.
RANGE = 5.0
RIDGE = 1e-2
STEPS = 40
SHORTER = (1.0, 0.5, 0.25, 0.125, 0.0625, 0.03125)
BINS = 2000
# Partial sums are added up in this many tasks before they reach the driver.
SUM_TASKS = 8

KINDS = ("upper", "digit", "line", "mark", "comma", "quote", "symbol", "other", "wide")


def _kind_table() -> np.ndarray:
    table = np.full(256, KINDS.index("other") + 1, np.uint8)
    table[ord("a") : ord("z") + 1] = 0
    table[ord(" ")] = 0
    table[ord("A") : ord("Z") + 1] = KINDS.index("upper") + 1
    table[ord("0") : ord("9") + 1] = KINDS.index("digit") + 1
    table[list(b"\n\r\t\x0b\x0c")] = KINDS.index("line") + 1
    table[list(b".!?")] = KINDS.index("mark") + 1
    table[list(b",;:")] = KINDS.index("comma") + 1
    table[list(b"'\"()-")] = KINDS.index("quote") + 1
    table[list(b"#*$%&|<>")] = KINDS.index("symbol") + 1
    table[128:] = KINDS.index("wide") + 1
    return table


KIND_OF = _kind_table()
MEASURES = len(KINDS) + 19


def measures(data: bytes) -> np.ndarray:
    """The measures of a text in UTF-8."""
    out = np.zeros(MEASURES, np.float32)
    words = data.split()
    if not words:
        return out
    size, count = len(data), len(words)
    kinds = np.bincount(KIND_OF[np.frombuffer(data, np.uint8)], minlength=len(KINDS) + 1)
    lengths = np.fromiter(map(len, words), np.int64, count)
    often = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    ended = sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines)
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    marks = int(kinds[KINDS.index("mark") + 1])
    out[: len(KINDS)] = np.sqrt(kinds[1:] / size)
    out[len(KINDS) :] = (
        math.log1p(count),
        math.log1p(len(lines)),
        math.sqrt((data.count(b"!") + data.count(b"?")) / size),
        math.sqrt(data.count(b"|") / size),
        lengths.mean(),
        lengths.std(),
        math.log1p(lengths.max()),
        math.log1p(len(often)) / math.log1p(count),
        math.sqrt(max(often.values()) / count),
        math.sqrt(sum(map(eq, words, words[1:])) / count),
        triples / max(count - 2, 1),
        sum(map(bytes.isupper, words)) / count,
        sum(map(bytes.istitle, words)) / count,
        sum(map(bytes.islower, words)) / count,
        np.count_nonzero(lengths == 1) / count,
        math.log1p(count / len(lines)),
        ended / len(lines),
        1 - len(set(lines)) / len(lines),
        math.log1p(count / (marks + 1)),
    )
    return out


@dataclass
class QualityModel:
    """Means and spreads of the measures, weights of the bent measures, and the estimated class prior."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return logistic(bent(rows, self.mean, self.spread) @ self.weights)


def logistic(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def loss(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -g)


def bent(rows: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((rows - mean) / spread, -RANGE, RANGE)
    return np.hstack([np.ones((len(z), 1)), z, *[np.maximum(z - k, 0) for k in KNOTS]])


def measured(docs: DataFrame, learnable: Column, labels: DataFrame) -> DataFrame:
    """Staged rows ``doc_id, held_out, positive, data``; labels join the measures, so no text is shuffled."""

    def run(batch: pa.RecordBatch) -> dict:
        rows = [measures((t or "").encode("utf-8", errors="replace")).tobytes() for t in batch.column(2).to_pylist()]
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "data": pa.array(rows, pa.binary())}

    chosen = docs.select("doc_id", (~learnable).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_batches(chosen, run, f"doc_id {kind}, held_out boolean, data binary")
    # Only positives travel on: a negative label is no more than a missing one.
    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    marks = marks.where("good").select("doc_id", F.lit(True).alias("good"))
    joined = rows.join(marks, "doc_id", "left")
    positive = F.coalesce("good", F.lit(False)) & ~F.col("held_out")
    return staged(joined.select("doc_id", "held_out", positive.alias("positive"), "data"), "measures")


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, MEASURES).astype(np.float64)


def summed(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of ``of(measures, positive)``, a vector of ``width``; one vector a task, then a few."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += of(matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for sums in batch.column(0).to_pylist():
                total += np.frombuffer(sums)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("data", "positive").mapInArrow(partial, "sums binary").repartition(SUM_TASKS)
    found = parts.mapInArrow(added, "sums binary").collect()  # SUM_TASKS rows of fixed width
    return np.sum([np.frombuffer(r["sums"]) for r in found] or [np.zeros(width)], axis=0)


def minimised(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, prior: float, n_u: float, n_p: float) -> np.ndarray:
    """Weights of least non-negative risk by Newton steps over all rows."""
    width = 1 + MEASURES * (1 + len(KNOTS))
    ridge = np.full(width, RIDGE)
    ridge[0] = 0

    def slopes(w: np.ndarray):
        def run(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            b = bent(x, mean, spread)
            s = logistic(b @ w)
            curve = (b * (s * (1 - s))[:, None]).T @ b
            return np.concatenate([b[positive].sum(axis=0), s @ b, curve.ravel()])

        return run

    def risks(tries: np.ndarray):
        def run(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            g = bent(x, mean, spread) @ tries.T
            of_p = g[positive]
            return np.concatenate([loss(of_p).sum(axis=0), loss(-of_p).sum(axis=0), loss(-g).sum(axis=0)])

        return run

    def risk(tries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        good, bad, of_u = summed(rows, risks(tries), 3 * len(tries)).reshape(3, -1)
        negative = of_u / n_u - prior * bad / n_p
        return prior * good / n_p + np.maximum(negative, 0) + (tries**2 @ ridge) / 2, negative

    w = np.zeros(width)
    now = risk(w[None])[0][0]
    for _ in range(STEPS):
        sums = summed(rows, slopes(w), 2 * width + width * width)
        gradient = sums[width : 2 * width] / n_u - prior * sums[:width] / n_p + ridge * w
        curve = sums[2 * width :].reshape(width, width) / n_u + np.diag(ridge + 1e-9)
        tries = w - np.outer(SHORTER, np.linalg.solve(curve, gradient))
        value, negative = risk(tries)
        allowed = (negative >= 0) & (value < now)
        if not allowed.any():
            break
        best = int(np.argmin(np.where(allowed, value, np.inf)))
        settled = now - value[best] < 1e-6
        w, now = tries[best], value[best]
        if settled:
            break
    return w


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Class prior from counts of both sides in ascending bins of the score.

    Above each threshold, the share of unlabelled rows over that of positives; the least of them, taken where its
    margin of error is smallest with it.
    """
    n_p, n_u = positive.sum(), unlabelled.sum()
    above_p = np.cumsum(positive[::-1]) / n_p
    above_u = np.cumsum(unlabelled[::-1]) / n_u
    margin = math.sqrt(math.log(40) / (2 * n_u)) + math.sqrt(math.log(40) / (2 * n_p))
    seen = above_p > 0
    bound = np.where(seen, (above_u + margin) / np.where(seen, above_p, 1), np.inf)
    at = int(np.argmin(bound))
    return float(np.clip(above_u[at] / above_p[at], 0.02, 0.98))


def fit(rows: DataFrame) -> QualityModel | None:
    """Model from staged rows of :func:`measured`; None where there is nothing to learn from."""
    open_rows = rows.where(~F.col("held_out"))

    def moments(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x), positive.sum()], x.sum(axis=0), (x**2).sum(axis=0)])

    sums = summed(open_rows, moments, 2 + 2 * MEASURES)
    n_u, n_p = sums[0], sums[1]
    if not n_u or not n_p:
        return None
    mean = sums[2 : 2 + MEASURES] / n_u
    spread = np.sqrt(np.maximum(sums[2 + MEASURES :] / n_u - mean**2, 1e-6))
    model = QualityModel(mean, spread, minimised(open_rows, mean, spread, 0.5, n_u, n_p), 0.5)

    def histogram(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        place = np.minimum((model.score(x) * BINS).astype(np.int64), BINS - 1)
        return np.concatenate([np.bincount(p, minlength=BINS) for p in (place[positive], place)]).astype(np.float64)

    counts = summed(open_rows, histogram, 2 * BINS)
    prior = prior_of(counts[:BINS], counts[BINS:])
    return QualityModel(mean, spread, minimised(open_rows, mean, spread, prior, n_u, n_p), prior)


def scored(rows: DataFrame, model: QualityModel | None) -> DataFrame:
    """``doc_id, held_out, score`` of staged rows."""
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        scores = np.round(shared.value.score(matrix(batch.column(2))), 9)
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "score": pa.array(scores, pa.float64())}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows.select("doc_id", "held_out", "data"), run, f"doc_id {kind}, held_out boolean, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, learnable: Column) -> DataFrame:
    """Every document with ``held_out`` and ``score``; labels count only where ``learnable`` holds."""
    rows = measured(docs, learnable, labels)
    return scored(rows, fit(rows))
