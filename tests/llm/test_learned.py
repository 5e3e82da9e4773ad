"""Positive-unlabelled quality scores."""

import random
import zlib

import numpy as np
import pytest
from helpers import awkward_texts, documents
from pyspark.sql import functions as F

from wardlake.llm import queries, unlabelled_risk
from wardlake.llm.common import table

LABELS = "doc_id bigint, quality int, toxic int, text string, score string"


def learnable():
    return ~F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def scores(spark, docs, labels):
    marks = spark.createDataFrame([(*row, 0, "x", "y") for row in labels], LABELS)
    return unlabelled_risk.quality_scores(docs, marks, learnable())


def mixed_texts(count=900):
    """Prose and, one in three, lines of repeats or symbols."""
    rng = random.Random(5)
    words = ["harbour", "winter", "carried", "the", "of", "letters", "and", "slowly", "a", "bridge", "over"]
    texts, good = [], []
    for k in range(count):
        some = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        good.append(k % 3 != 0)
        if good[-1]:
            texts.append(" ".join(some).capitalize() + ".")
        else:
            texts.append("### ".join(some[:9] * 3) if k % 2 else " | ".join(w.upper() for w in some))
    return texts, good


def test_negatives_are_told_apart_without_negative_labels(spark):
    texts, good = mixed_texts()
    labels = [(i, 1) for i, g in enumerate(good) if g and i % 2]
    got = {r.doc_id: r for r in scores(spark, documents(spark, texts), labels).collect()}
    assert set(got) == set(range(len(texts)))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    right = [(got[i].score >= 0.3) == g for i, g in enumerate(good) if got[i].held_out]
    assert np.mean(right) > 0.97


def test_held_out_and_negative_labels_change_nothing(spark):
    texts, good = mixed_texts(300)
    docs = documents(spark, texts)
    labels = [(i, 1) for i, g in enumerate(good) if g and zlib.crc32(str(i).encode()) % 5]
    more = labels + [(i, 1) for i in range(len(texts)) if not zlib.crc32(str(i).encode()) % 5]
    more += [(i, 0) for i, g in enumerate(good) if not g]
    plain = {r.doc_id: r.score for r in scores(spark, docs, labels).collect()}
    assert {r.doc_id: r.score for r in scores(spark, docs, more).collect()} == pytest.approx(plain, abs=1e-6)


def test_risk_and_prior_against_plain_numpy(spark):
    texts, good = mixed_texts(300)
    docs, marks = documents(spark, texts), spark.createDataFrame([(i, 1, 0, "", "") for i, g in enumerate(good) if g and i % 2], LABELS)
    rows = unlabelled_risk.measured(docs, learnable(), marks)
    model = unlabelled_risk.fit(rows)
    got = rows.where("not held_out").toPandas()
    x = np.array([np.frombuffer(d, np.float32) for d in got.data], float)
    positive = got.positive.to_numpy(bool)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.spread**2, np.maximum(x.var(axis=0), 1e-6), rtol=1e-4)
    bent = unlabelled_risk.bent(x, model.mean, model.spread)
    penalty = np.full(bent.shape[1], unlabelled_risk.RIDGE)
    penalty[0] = 0

    def risk(w):
        g, p = bent @ w, model.prior
        negative = np.logaddexp(0, g).mean() - p * np.logaddexp(0, g[positive]).mean()
        return p * np.logaddexp(0, -g[positive]).mean() + max(0, negative) + penalty @ w**2 / 2, negative

    value, negative = risk(model.weights)
    rng = np.random.default_rng(1)
    assert negative >= 0
    assert all(value <= risk(model.weights + 0.05 * rng.normal(size=len(penalty)))[0] for _ in range(50))
    assert abs(model.prior - np.mean(good)) < 0.15


def test_odd_inputs(spark):
    texts = awkward_texts()
    docs = documents(spark, [*texts, *texts, "x"], [*range(len(texts)), *range(len(texts)), None])
    got = scores(spark, docs, [(k, 1) for k in range(8, 40)] + [(9, 0), (None, 1), (7, None)]).collect()
    assert len(got) == 2 * len(texts) + 1 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert {r.score for r in scores(spark, docs, []).collect()} == {0.5}
    assert scores(spark, docs.limit(0), [(1, 1)]).count() == 0


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    got = queries.op11_unlabelled_risk(spark, path).join(table(spark, path, "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9
