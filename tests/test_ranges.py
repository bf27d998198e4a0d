"""As-of joins, sweeps over overlapping ranges and lookups in them, each against a plain version."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowloom.operators import asof, intervals
from tests.test_flows import at


def plain_as_of(left, right):
    out = []
    for k, t, i in left:
        hits = [(rt, o, v) for rk, rt, o, v in right if rk is not None and rt is not None and rk == k and t is not None and rt <= t]
        out.append((i, max(hits)[2] if hits else None))
    return sorted(out)


@pytest.mark.parametrize("per_range", [10**6, 60, 7])
def test_as_of(spark, per_range):
    rng = random.Random(per_range)
    pick = lambda: rng.choice(["hot", "hot", "a", "b", f"n{rng.randrange(40)}", None])
    left = [(pick(), rng.choice([None, *range(0, 500, 3)]), i) for i in range(400)]
    right = [(pick(), rng.choice([None, *range(0, 500, 7)]), o, f"v{o}") for o in range(150)]
    a = spark.createDataFrame(left, "k string, t long, held int").repartition(3)
    b = spark.createDataFrame(right, "key string, t long, o int, v string").withColumnRenamed("key", "k")
    got = asof.as_of(a, b, ["k"], "t", "t", {"v": "v", "when": "t"}, ["o"], per_range)
    assert got.columns == ["k", "t", "held", "v", "when"]
    assert sorted((r["held"], r["v"]) for r in got.collect()) == plain_as_of(left, right)
    assert all(r["when"] is None or r["when"] <= r["t"] for r in got.collect())


def test_as_of_without_keys_and_with_timestamps(spark):
    a = spark.createDataFrame([(at(i), i) for i in range(50)], "t timestamp, i int")
    b = spark.createDataFrame([(at(i), i) for i in range(5, 50, 10)], "t timestamp, v int")
    for per_range in (1000, 4):
        got = {r["i"]: r["v"] for r in asof.as_of(a, b, [], "t", "t", {"v": "v"}, rows_per_range=per_range).collect()}
        assert got == {i: None if i < 5 else (i - 5) // 10 * 10 + 5 for i in range(50)}
    assert {r["v"] for r in asof.as_of(a, b.limit(0), [], "t", "t", {"v": "v"}, rows_per_range=4).collect()} == {None}
    assert asof.as_of(a.limit(0), b, [], "t", "t", {"i": "v"}).collect() == []


def test_a_hot_key_is_split(spark):
    a = spark.range(9000).select(F.lit("one").alias("k"), F.col("id").alias("t"))
    b = spark.createDataFrame([("one", 5, "x")], "k string, t long, v string")
    got = asof.as_of(a, b, ["k"], "t", "t", {"v": "v"}, rows_per_range=1000)
    assert got.filter("v = 'x'").count() == 8995
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k0" in plan and "part" in plan.split("hashpartitioning(k0", 1)[1][:60]


def points(ranges, low, high):
    """The value at each point, tried one by one."""
    return [min(((o, n, v) for n, (a, b, o, v) in enumerate(ranges) if a <= x < b), default=(0, 0, None))[2] for x in range(low, high)]


@pytest.mark.parametrize("seed", range(6))
def test_sweep(seed):
    rng = random.Random(seed)
    ranges = sorted((a, a + rng.choice([-1, 0, 1, 5, 40]), (rng.randrange(4),), f"v{i}") for i in range(rng.choice([0, 1, 30])) for a in [rng.randrange(60)])
    out = list(intervals.swept(ranges))
    assert all(a < b for a, b, _ in out) and all(x[1] <= y[0] for x, y in zip(out, out[1:]))
    got = [next((v for a, b, v in out if a <= x < b), None) for x in range(-2, 110)]
    orders = {v: o for _, _, o, v in ranges}
    want = points(ranges, -2, 110)
    assert [orders.get(v) for v in got] == [orders.get(v) for v in want] and [v is None for v in got] == [v is None for v in want]
    assert len(out) <= 2 * len(ranges)


@pytest.mark.parametrize("part_rows", [10**6, 50, 5])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_disjoint_ranges(spark, keys, part_rows):
    rng = random.Random(part_rows)
    rows = [(rng.choice(["hot", "hot", "a", "b"]) if keys else "x", a, a + rng.choice([0, 1, 5, 60, 900]), i) for i in range(200) for a in [rng.randrange(1000)]] + [("hot" if keys else "x", None, 5, 900)]
    df = spark.createDataFrame(rows, "k string, low long, high long, o int").withColumn("v", F.struct(F.col("o").alias("n"), F.create_map(F.lit("a"), F.col("o")).alias("m")))
    out = intervals.disjoint(df, keys, ["o"], "v", part_rows)
    assert out.columns == [*keys, "low", "high", "v"]
    got: dict = {}
    for r in out.collect():
        got.setdefault(r["k"] if keys else "x", []).append((r["low"], r["high"], r["v"]["n"]))
        assert r["v"]["m"] == {"a": r["v"]["n"]}
    for k in {r[0] for r in rows}:
        own = sorted((a, b, (o,), o) for x, a, b, o in rows if x == k and a is not None)
        segments = sorted(got.get(k, []))
        assert all(x[1] <= y[0] for x, y in zip(segments, segments[1:]))
        assert [next((v for a, b, v in segments if a <= x < b), None) for x in range(0, 1900, 3)] == points(own, 0, 1900)[::3]


def test_a_batch_of_values_is_held_once(spark):
    """Values of a batch are not copied once for each of its ranges: 2,000 times these are more than an Arrow string array holds."""
    rows = spark.range(2000).select((F.col("id") * 10).alias("low"), (F.col("id") * 10 + 5).alias("high"), F.concat(F.lpad(F.col("id").cast("string"), 4, "0"), F.repeat(F.lit("x"), 1200)).alias("v"))
    out = intervals.disjoint(rows.coalesce(1), [], ["low"], "v").orderBy("low").collect()
    assert [(r["low"], r["high"], r["v"][:4], len(r["v"])) for r in out] == [(i * 10, i * 10 + 5, f"{i:04d}", 1204) for i in range(2000)]


def test_values_are_gathered_by_place():
    a, b = pa.array([{"n": i} for i in range(5)]), pa.array([{"n": i} for i in range(10, 15)])
    assert intervals.gathered([(a, 3), (b, 0), (a, 0), (b, 4), (a, 3)]).to_pylist() == [{"n": n} for n in (3, 10, 0, 14, 3)]
    assert intervals.gathered([(b, 2), (b, 1)]).to_pylist() == [{"n": 12}, {"n": 11}]


@pytest.mark.parametrize("most", [10**6, 0])
def test_locate(spark, most):
    segments = spark.createDataFrame([(0, 10, "a"), (10, 11, "b"), (500, 2**32, "c")], "low long, high long, v string")
    df = spark.createDataFrame([(x, i, 7) for i, x in enumerate([0, 9, 10, 11, 499, 500, 2**32 - 1, 2**32, -1, None])], "n long, i int, _at int")
    out = intervals.locate(df, F.col("n"), segments, "v", most)
    assert out.columns == [*df.columns, "v"]
    assert {r["i"]: r["v"] for r in out.collect()} == dict(enumerate(["a", "a", "b", None, None, "c", "c", None, None, None]))
    assert {r["v"] for r in intervals.locate(df, F.col("n"), segments.limit(0), "v", most).collect()} == {None}


def test_texts_are_searched(spark):
    lows = np.array(["00", "0a", "f0"], "S2")
    highs = np.array(["02", "0b", "ff"], "S2")
    df = spark.createDataFrame([(x,) for x in ["00", "01", "02", "0a", "0b", "f1", "ff", None]], "x string")
    assert [r["y"] for r in df.select(intervals.searched(F.col("x"), lows, highs, spark).alias("y")).collect()] == ["00", "00", None, "0a", None, "f0", None, None]
