"""Metrics and aggregates on streams: equal to the batch operators, with expiry, caps and reports."""

import random

import pytest
from pyspark.sql import functions as F

from flowloom.operators import aggregate as agg
from flowloom.operators import metrics as M
from flowloom.streaming import totals
from tests.test_flows import at
from tests.test_streaming import parts

SAMPLE = "ns string, app array<string>, bytes double, t timestamp, id int"


@pytest.fixture(autouse=True)
def store(spark):
    totals.changelog(spark)


def rows_of(n, seed=1, step=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", "c", None, "hot", "hot", "hot"]), rng.choice([["x"], ["x", "y"], [], None]), rng.choice([None, float(rng.randrange(30))]), at(i * step), i) for i in range(n)]


def run(stream, tmp_path, name):
    """All rows of a stream, with the number of their batch."""
    out = []

    def each(df, number):
        out.extend((number, r) for r in df.collect())

    stream.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", str(tmp_path / f"ck-{name}")).trigger(availableNow=True).start().awaitTermination(240)
    return out


def last_of(found, key):
    out = {}
    for _, r in found:
        if r["live"] is not None and key(r) is not None:
            out[key(r)] = r
    return out


@pytest.mark.parametrize("kind", ["counter", "gauge", "histogram"])
def test_metrics_over_batches_equal_the_batch_form(spark, tmp_path, kind):
    rows = rows_of(90)
    stream = parts(spark, tmp_path, rows, SAMPLE, [40, 44], "in")
    metric = {"name": "m", "prefix": "p_", "labels": ["ns", "app"], "flatten": ["app"], "remap": {"ns": "Namespace"}, "value_key": "bytes", "value_scale": 2, "filters": [{"key": "ns", "type": "not_equal", "value": "b"}], "buckets": [1, 5, 10]}
    found = run(totals.stream_metric(stream, metric, "t", kind, ttl=1000, order=["id"], buckets=8), tmp_path, "m")
    got = last_of(found, lambda r: r["labels"] and tuple(sorted(r["labels"].items())))
    df, key = spark.createDataFrame(rows, SAMPLE), lambda r: tuple(sorted(r["labels"].items()))
    if kind == "histogram":
        want: dict = {}
        for r in M.histogram(df, metric).collect():
            want.setdefault(key(r), {})[r["le"]] = (r["cumulative_count"], r["sum"], r["count"])
        assert {k: {**{f"{b:g}": (c, r["sum"], r["count"]) for b, c in zip(r["bounds"], r["cumulative_counts"])}, "+Inf": (r["count"], r["sum"], r["count"])} for k, r in got.items()} == want
    else:
        batch = M.counter(df, metric) if kind == "counter" else M.gauge(df, metric, "t", ["id"])
        assert {k: r["value"] for k, r in got.items()} == {key(r): r["value"] for r in batch.collect()} and len(got) >= 8
        assert {r["metric"] for r in got.values()} == {"p_m"}
    assert {n for n, _ in found} >= {0, 1, 2}  # and only what a batch touched is written
    assert sum(n == 1 for n, _ in found) <= 6


def test_label_sets_expire_and_start_anew(spark, tmp_path):
    rows = [("a", None, 1.0, at(0), 0), ("b", None, 2.0, at(50), 1), ("b", None, 3.0, at(300), 2), ("c", None, 1.0, at(301), 3), ("a", None, 5.0, at(302), 4)]
    metric = {"name": "m", "labels": ["ns"], "value_key": "bytes"}
    found = run(totals.stream_metric(parts(spark, tmp_path, rows, SAMPLE, [2, 3], "in"), metric, "t", ttl=100, late="0 seconds", buckets=3), tmp_path, "e")
    said = [(r["labels"]["ns"], r["live"], r["value"]) for _, r in found]
    assert [x for x in said if x[0] == "a"] == [("a", True, 1.0), ("a", False, 1.0), ("a", True, 5.0)]
    assert [x for x in said if x[0] == "b"][:3] == [("b", True, 2.0), ("b", False, 2.0), ("b", True, 3.0)]  # the old one was gone when its next row came


def test_cap_admits_by_first_row_and_counts_what_it_drops(spark, tmp_path):
    ns = lambda k, t, i: (f"n{k}", None, 1.0, at(t), i)
    rows = [ns(3, 2, 0), ns(1, 0, 1), ns(2, 1, 2), ns(1, 3, 3), ns(3, 4, 4)] + [ns(2, 5, 5), ns(4, 6, 6)] + [ns(9, 400, 7)] + [ns(4, 401, 8), ns(5, 402, 9), ns(6, 403, 10)]
    metric = {"name": "m", "labels": ["ns"], "value_key": "bytes"}
    found = run(totals.stream_metric(parts(spark, tmp_path, rows, SAMPLE, [5, 7, 8], "in"), metric, "t", ttl=100, late="0 seconds", most=2, buckets=1), tmp_path, "c")
    live = [(n, r["labels"]["ns"], r["value"]) for n, r in found if r["labels"] and r["live"]]
    assert [x for x in live if x[0] == 0] == [(0, "n1", 2.0), (0, "n2", 1.0)] and (1, "n2", 2.0) in live
    assert not any(x[1] == "n3" for x in live) and {x[1] for x in live} <= {"n1", "n2", "n9", "n4", "n5"}
    dropped = [r["dropped"] for _, r in found if r["labels"] is None]
    assert dropped[:2] == [2, 3] and dropped == sorted(dropped)
    admitted = sum(r["value"] for k, r in {(r["labels"]["ns"], r["last"]): r for _, r in found if r["labels"] and r["live"]}.items() if k[0] in ("n9", "n4", "n5"))
    assert {x[1] for x in live} >= {"n9", "n4"} and admitted >= 2


def test_totals_of_rules(spark, tmp_path):
    rows = rows_of(60, seed=5)
    stream = lambda name: parts(spark, tmp_path, rows, SAMPLE, [25], name)
    df = spark.createDataFrame(rows, SAMPLE)
    for op in ("avg", "min", "raw_values"):
        rule = {"name": "r", "by": ["ns"], "operation": op, "key": "bytes"}
        found = run(totals.stream_totals(stream(op), rule, "t", expiry=1000, buckets=4), tmp_path, op)
        got = last_of(found, lambda r: r["ns"])
        some = df if op in ("count", "raw_values") else df.filter("bytes IS NOT NULL")
        want = {r["ns"]: r for r in agg.aggregate(some, rule).collect()}
        assert {k: (r["total_value"], r["total_count"], r["aggregate"]) for k, r in got.items()} == {k: (r["total_value"], r["total_count"], r["aggregate"]) for k, r in want.items()}
        second = spark.createDataFrame(rows[25:], SAMPLE)
        recent = {r["ns"]: (r["total_value"], r["total_count"]) for r in agg.aggregate(second if op in ("count", "raw_values") else second.filter("bytes IS NOT NULL"), rule).collect()}
        assert {r["ns"]: (r["recent_op_value"], r["recent_count"]) for n, r in found if n == 1} == recent
        assert dict(totals.stream_totals(stream(op), rule, "t").dtypes)["total_count"] == "bigint"


def test_live_groups_are_reported(spark, tmp_path):
    rows = [("a", None, 1.0, at(0), 0), ("b", None, 2.0, at(1), 1), ("c", None, 3.0, at(70), 2), ("c", None, 3.0, at(75), 3)]
    rule = {"name": "r", "by": ["ns"], "operation": "sum", "key": "bytes"}
    found = run(totals.stream_totals(parts(spark, tmp_path, rows, SAMPLE, [2, 3], "in"), rule, "t", late="0 seconds", expiry=500, report=60, buckets=2), tmp_path, "r")
    quiet = {(r["ns"], r["total_value"]) for _, r in found if r["recent_count"] == 0 and r["live"]}
    assert {("a", 1.0), ("b", 2.0)} <= quiet


def test_hot_label_set_is_folded_before_the_shuffle(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 50)).alias("ns"), F.lit(1.0).alias("v"), F.timestamp_seconds("id").alias("t"))
    made = totals.partials(df, [F.col("ns")], F.col("v"), F.col("t"))
    assert made.count() < 2000 and made.agg(F.sum("n")).first()[0] == 40_000
