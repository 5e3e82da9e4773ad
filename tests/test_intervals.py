import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardlake.operators.intervals import days_over_returns, returns_within
from wardlake.operators.keys import with_contiguous_key
from wardlake.operators.pairs import paired_counts
from wardlake.operators import skew
from wardlake.operators.skew import hot_keys, sequence_within

DAY = 86_400_000_000
SCHEMA = "patient bigint, visit bigint, start_at bigint, end_at bigint, is_index boolean, is_return boolean"


def brute(visits, horizon, exclude_self):
    out = {}
    for p, v, s, e, index, _ in visits:
        if e is None or not index:
            continue
        others = [x for x in visits if x[0] == p and not (exclude_self and x[1] == v)]
        starts = sorted(x[2] for x in others if x[5] and x[2] is not None and e < x[2] <= e + horizon)
        back = any(x[4] and x[3] is not None and s is not None and x[3] < s <= x[3] + horizon for x in others)
        days = sum((t - e) // DAY for t in starts)
        out[v] = (len(starts), starts[0] if starts else None, back, days)
    return out


def random_visits(seed, patients, count, span_days):
    rng = random.Random(seed)
    rows = []
    for v in range(count):
        start = rng.randrange(0, span_days * 24) * DAY // 24 + rng.choice([0, 0, 1, -1])
        stay = rng.choice([None, 0, 1, 5, 24, 30 * 24, -3, -24])
        end = None if stay is None else start + stay * DAY // 24
        rows.append((rng.randrange(patients), v, start, end, rng.random() < 0.7, rng.random() < 0.7))
    return rows


@pytest.mark.parametrize("exclude_self", [True, False])
@pytest.mark.parametrize("hot", [[], [0], [0, 1, 2]])
@pytest.mark.parametrize("seed, patients, count, span", [(1, 3, 120, 200), (2, 1, 90, 60), (3, 40, 200, 400)])
def test_returns_match_brute_force(spark, exclude_self, hot, seed, patients, count, span):
    visits = random_visits(seed, patients, count, span)
    df = spark.createDataFrame(visits, SCHEMA)
    measured = returns_within(df, 30 * DAY, hot, exclude_self=exclude_self)
    got = {r.visit: (r.returns, r.first_return, r.is_return_visit) for r in measured.collect()}
    expected = brute(visits, 30 * DAY, exclude_self)
    assert got == {v: x[:3] for v, x in expected.items()}
    if not exclude_self:
        days = {r.visit: r.day_sum for r in days_over_returns(df, measured, 30, hot).collect()}
        assert days == {v: x[3] for v, x in expected.items() if x[0]}


def test_bounds_of_the_horizon(spark):
    end = 100 * DAY
    visits = [
        (1, 1, 0, end, True, True),
        (1, 2, end, None, True, True),  # at the very discharge: no return
        (1, 3, end + 30 * DAY, None, True, True),  # exactly 30 days: a return
        (1, 4, end + 30 * DAY + 1, None, True, True),  # a microsecond later: none
    ]
    row = returns_within(spark.createDataFrame(visits, SCHEMA), 30 * DAY, []).first()
    assert (row.visit, row.returns, row.first_return) == (1, 1, end + 30 * DAY)


@pytest.mark.parametrize("hot", [[], [7], [7, 8]])
def test_sequence_in_sliced_groups(spark, hot):
    rng = random.Random(5)
    rows = [(rng.choice([7, 7, 7, 8, 9]), rng.randrange(20), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g bigint, day int, id bigint")
    got = sequence_within(df, "g", ["day", "id"], "n", F.col("day").cast("bigint"), hot).collect()
    expected, seen = {}, Counter()
    for g, day, i in sorted(rows):
        seen[g] += 1
        expected[i] = seen[g]
    assert {r.id: r.n for r in got} == expected and len(got) == len(rows)


def test_hot_keys_lists_large_groups_only(spark):
    rows = [(1,)] * 600 + [(i,) for i in range(2, 402)] + [(None,)] * 50
    df = spark.createDataFrame(rows, "k bigint")
    assert hot_keys(df, "k", group_rows=100) == [1]
    assert hot_keys(df, "k", group_rows=5000) == []


def test_hot_keys_are_exact_where_keys_share_a_lane(spark, monkeypatch):
    monkeypatch.setattr(skew, "LANES", 2)
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 30).alias("k"))
    df = df.unionByName(spark.range(150).select(F.lit(7).cast("bigint").alias("k")))
    assert hot_keys(df, "k", group_rows=200) == [7]
    assert hot_keys(df, "k", group_rows=99) == [k for k in range(30) if k % 3]
    assert hot_keys(df, "k", group_rows=3000) == []


def test_contiguous_keys(spark):
    rows = [(i * 7 % 101, f"r{i}") for i in range(101)]
    keyed = with_contiguous_key(spark.createDataFrame(rows, "id bigint, t string"), ["id"], "k", partitions=5)
    assert [(r.id, r.k) for r in keyed.orderBy("id").collect()] == [(i, i + 1) for i in range(101)]


@pytest.mark.parametrize("hot", [[], [3]])
def test_pair_counts_equal_the_plain_join(spark, hot):
    rng = random.Random(9)
    left = spark.createDataFrame([(rng.randrange(10), rng.randrange(4)) for _ in range(80)], "e bigint, d int")
    right = spark.createDataFrame([(rng.randrange(12), rng.randrange(5)) for _ in range(90)], "e bigint, p int")
    plain = Counter((r.d, r.p) for r in left.join(right, "e").collect())
    counted = Counter()
    for r in paired_counts(left, right, "e", "d", "p", hot).collect():
        counted[(r.d, r.p)] += r.pairs
    assert counted == plain
