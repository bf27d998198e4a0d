"""Streams with keyed state: sliding top-K by panes, object batches by size and timeout, several sinks of one batch, side counts."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from flowloom.operators import conntrack, metrics, topk, walk
from flowloom.operators.counts import Counts, StreamCounts
from flowloom.plans.pipeline import Pipeline
from flowloom.streaming import fan_out, objects, panes, totals
from tests.test_flows import CONF, FLOW, at, conversation
from tests.test_streaming import parts


@pytest.fixture(autouse=True)
def store(spark):
    totals.changelog(spark)


VALUES = "k string, s string, v double, t timestamp"


def run(writer):
    writer.trigger(availableNow=True).start().awaitTermination(240)


@pytest.mark.parametrize("op,k,reversed_", [("sum", 2, False), ("diff", 1, True), ("avg", 0, False)])
def test_sliding_topk_equals_the_batch_form(spark, tmp_path, op, k, reversed_):
    rng = random.Random(k)
    rows = [(rng.choice(["a", "b", "c", "d", "", None]), rng.choice("xy"), rng.choice([None, float(rng.randrange(20))]), at(i * 3 + (400 if i > 50 else 0))) for i in range(70)]
    rows.append(("z", "x", 1.0, at(5000)))  # moves the watermark past all windows before it
    rows.append(("z", "x", 1.0, at(5001)))
    rule = {"name": "r", "index_keys": ["k", "s"], "operation": op, "key": "v", "top_k": k, "reversed": reversed_, "interval": "60 seconds", "slide": "20 seconds"}
    seen = []
    stream = parts(spark, tmp_path, rows, VALUES, [25, 60, 71], "in")
    run(panes.stream_sliding_topk(stream, rule, "t", lambda df: seen.extend(df.collect()), str(tmp_path / "ck"), late="5 seconds", buckets=3))
    batch = topk.timebased(spark.createDataFrame(rows, VALUES).filter("v IS NOT NULL"), rule, "t").filter(F.col("window_start") < F.lit(at(4000)))
    shown = lambda rs: sorted((r["window_start"], r["k"], r["s"], round(r["v"], 9), r["index_key"], r["operation"]) for r in rs)
    assert shown(r for r in seen if r["k"] != "z") == shown(batch.collect()) and len(seen) >= 15
    assert panes.ranked(spark.createDataFrame([], panes.CANDIDATES), rule).columns == batch.columns


def test_panes_are_what_the_state_holds():
    """A thousand rows of one key in one pane are one partial aggregate, and old panes go."""
    a = None
    for i in range(1000):
        a = panes.merged(a, (1, float(i), float(i), float(i), i, float(i), i, float(i)))
    assert a == (1000, 499500.0, 0.0, 999.0, 0, 0.0, 999, 999.0)
    assert [panes.value_of(op, a) for op in topk.OPERATIONS] == [499500.0, 499.5, 0.0, 999.0, 1000.0, 999.0, 999.0]


def test_topk_rules_are_checked(spark, tmp_path):
    stream = parts(spark, tmp_path, [("a", "x", 1.0, at(0))], VALUES, [], "in")
    for change in ({"operation": "median"}, {"slide": "7 seconds"}):
        with pytest.raises(ValueError):
            panes.candidates(stream, {"name": "r", "index_keys": ["k"], "operation": "sum", "key": "v", "top_k": 1, "interval": "20 seconds", "slide": "5 seconds"} | change, "t")


def test_objects_close_by_size_or_timeout(spark, tmp_path):
    rows = [(f"r{i}", "s", float(i), at(i)) for i in range(7)] + [("late", "s", 1.0, at(200)), ("r9", "s", 2.0, at(201))] + [("end", "s", 0.0, at(900))] + [("x", "s", 0.0, at(901))]
    stream = parts(spark, tmp_path, rows, VALUES, [4, 7, 9, 10], "in")
    made = objects.stream_object_batches(stream, "t", size=3, timeout=60, lanes=1, account="acc", stream_id="s", header={"vendor": "ü"}, event_time=True, late="0 seconds")
    got: list = []
    write = lambda: run(made.writeStream.foreachBatch(lambda df, n: got.extend(df.collect())).option("checkpointLocation", str(tmp_path / "ck")))
    write()
    first = len(got)
    # more rows after a restart: numbers go on where they were
    time.sleep(1.1)
    spark.createDataFrame([(f"n{i}", "s", 0.0, at(1000 + i)) for i in range(6)], VALUES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    write()
    numbers = sorted(int(r["path"].rsplit("/", 1)[1]) for r in got)
    assert numbers == list(range(len(got))) and len(got) > first
    assert {r["cause"] for r in got} == {"size", "timeout"} and all(r["n"] == 3 for r in got if r["cause"] == "size")
    bodies = [json.loads(r["object"]) for r in sorted(got, key=lambda r: r["path"].rsplit("/", 1)[1])]
    assert [x["k"] for b in bodies[:3] for x in b["flow_logs"]] == [f"r{i}" for i in range(7)]
    assert bodies[0]["number_of_flow_logs"] == 3 and bodies[0]["vendor"] == "ü" and bodies[0]["version"] == "v0.1" and bodies[0]["capture_start_time"] == "2024-01-01T00:00:00.000Z"[:10] + bodies[0]["capture_start_time"][10:]
    assert got[0]["path"].startswith("acc/year=") and "/stream-id=s-0/" in got[0]["path"]


def test_objects_in_processing_time(spark, tmp_path):
    rows = [(f"r{i}", "s", float(i), at(i)) for i in range(25)]
    made = objects.stream_object_batches(parts(spark, tmp_path, rows, VALUES, [11], "in"), "t", size=4, timeout=1, lanes=2)
    got: list = []
    q = made.writeStream.foreachBatch(lambda df, n: got.extend(df.collect())).option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="1 second").start()
    began = time.time()
    while sum(r["n"] for r in got) < 25 and time.time() - began < 90:
        time.sleep(1)
    q.stop()
    assert sum(r["n"] for r in got) == 25 and {"size", "timeout"} == {r["cause"] for r in got}
    by_lane: dict = {}
    for r in got:
        lane, number = r["path"].split("stream-id=")[1].split("/")
        by_lane.setdefault(lane, []).append(int(number))
    assert all(sorted(n) == list(range(len(n))) for n in by_lane.values())


def test_a_failure_between_two_sinks_writes_nothing_twice(spark, tmp_path):
    rows = [(f"r{i}", "s", float(i), at(i)) for i in range(6)]
    stream = parts(spark, tmp_path, rows, VALUES, [2, 4], "in")
    calls, broken = [], [True]
    pipeline = Pipeline([{"name": "double", "type": lambda df: df.withColumn("v", F.col("v") * 2)}, {"name": "all", "type": "none", "follows": "double", "sink": True}, {"name": "odd", "type": lambda df: df.filter("v % 4 = 2"), "follows": "double", "sink": True}])

    def first(df, n):
        calls.append(("all", n))
        fan_out.files(str(tmp_path / "all"))(df, n)

    def second(df, n):
        calls.append(("odd", n))
        if n == 1 and broken[0]:
            raise RuntimeError("lost")
        fan_out.files(str(tmp_path / "odd"), "json")(df, n)

    write = lambda: run(fan_out.fan_out(stream, {"all": first, "odd": second}, str(tmp_path / "ledger"), str(tmp_path / "ck"), pipeline))
    with pytest.raises(Exception, match="lost"):
        write()
    broken[0] = False
    write()
    assert calls == [("all", 0), ("odd", 0), ("all", 1), ("odd", 1), ("odd", 1), ("all", 2), ("odd", 2)]
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "all")).collect()) == [0.0, 2.0, 4.0, 6.0, 8.0, 10.0]
    assert sorted(r["v"] for r in spark.read.json(str(tmp_path / "odd")).collect()) == [2.0, 6.0, 10.0]
    with pytest.raises(ValueError):
        fan_out.fan_out(stream, {"all": first}, "x", "y", pipeline)


SAMPLE = "ns string, bytes string, t timestamp"


def test_counts_come_with_the_rows(spark):
    df = spark.createDataFrame([("a", "1", at(0)), ("b", "x", at(1)), ("b", "2", at(2)), ("c", None, at(3)), ("c", "5", at(4)), ("d", "7", at(5)), ("d", "7", at(6))], SAMPLE)
    metric, counts = {"name": "m", "labels": ["ns"], "value_key": "bytes"}, Counts()
    rows = metrics.capped(df, metric, "t", 2, counts).collect()
    assert {r["labels"]["ns"]: r["value"] for r in rows} == {"a": 1.0, "b": 2.0}
    assert counts.read() == {"m": {"rows": 7, "ValueConversionError": 1}, "m.all": {"rows": 4, "samples": 5}, "m.kept": {"rows": 2, "samples": 2}}
    with pytest.raises(ValueError):
        counts.watch(df, "m", {})


def test_aggregate_errors_are_counted(spark):
    rows = conversation([(0, "AB", 5, False, 0), (1, "BA", None, False, 0), (2, "AB", 7, False, 0), (3, "AB", 7, True, 0)])
    df = spark.createDataFrame(rows, FLOW).withColumn("text", F.when(F.col("id") == 0, "3").when(F.col("id") == 2, "no").otherwise(F.col("id").cast("string")))
    conf = CONF | {"aggregates": [{"name": "Bytes", "operation": "sum", "report_missing": True}, {"name": "text", "operation": "sum"}, {"name": "least", "operation": "min", "input": "text"}]}
    want = {"rows": 4, "MissingFieldError:Bytes": 1, "Float64ConversionError:Bytes": 0, "Float64ConversionError:text": 1, "Float64ConversionError:least": 1}
    for part_rows in (None, 1):
        counts = Counts()
        (r,) = walk.track(df, conf, ("endConnection",), part_rows, counts).collect()
        assert (r["Bytes"], r["text"], r["least"]) == (12.0, 4.0, 1.0) and counts.read() == {"aggregates": want}
    (r,) = conntrack.connections(df, conf).collect()
    assert (r["Bytes"], r["text"], r["least"]) == (12.0, 4.0, 1.0)


def test_counts_of_streams(spark, tmp_path):
    seen = StreamCounts()
    spark.streams.addListener(seen)
    rows = [("a", "1", at(0)), ("b", "x", at(1)), ("b", "y", at(2)), ("c", None, at(3))]
    metric = {"name": "streamed", "labels": ["ns"], "value_key": "bytes"}
    df = metrics._sampled(parts(spark, tmp_path, rows, SAMPLE, [2], "in"), metric, None, Counts())[0]
    run(df.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")))
    began = time.time()
    while seen.totals.get("streamed", {}).get("rows", 0) < 4 and time.time() - began < 30:
        time.sleep(0.5)
    spark.streams.removeListener(seen)
    assert seen.totals["streamed"] == {"rows": 4, "ValueConversionError": 2}
