"""Streams give what the batch operators give."""

import random
import time

from pyspark.sql import functions as F

from flowloom.operators import aggregate as agg
from flowloom.operators import conntrack, topk, walk
from flowloom.streaming import stateful
from tests.test_flows import CONF, FLOW, at


def parts(spark, tmp_path, rows, schema, cuts, name):
    """Files of consecutive rows, read as a stream of one file a batch, in order."""
    path = tmp_path / name
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(1.1)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_totals_over_batches(spark, tmp_path):
    rows = [("http", 10.0), ("http", 20.0), ("tcp", 1.0), ("tcp", 2.0), ("http", 30.0), ("tcp", 4.0), ("tcp", 5.0)]
    stream = parts(spark, tmp_path, rows, "service string, bytes double", [4], "in")
    rule, seen = {"name": "b", "by": ["service"], "operation": "sum", "key": "bytes"}, []
    run = stateful.stream_aggregates(stream, rule, str(tmp_path / "totals"), lambda df: seen.append({r["service"]: (r["total_value"], r["recent_op_value"], r["recent_count"]) for r in df.collect()}), str(tmp_path / "ck"))
    run.trigger(availableNow=True).start().awaitTermination(120)
    assert seen == [{"http": (30.0, 30.0, 2), "tcp": (3.0, 3.0, 2)}, {"http": (60.0, 30.0, 1), "tcp": (12.0, 9.0, 2)}]
    assert agg.aggregate(spark.createDataFrame(rows, "service string, bytes double"), rule).filter("service = 'tcp'").first()["total_value"] == 12.0


def test_totals_expire(spark, tmp_path):
    """A group goes 100 seconds after its last row, and tables of earlier batches are deleted."""
    rows = [("old", 1.0, at(0)), ("kept", 2.0, at(10)), ("kept", 3.0, at(90)), ("new", 4.0, at(95)), ("new", 5.0, at(150)), ("kept", 6.0, at(160)), ("old", 7.0, at(165))]
    stream = parts(spark, tmp_path, rows, "k string, v double, t timestamp", [2, 4, 6], "in")
    rule, seen = {"name": "b", "by": ["k"], "operation": "sum", "key": "v"}, []
    run = stateful.stream_aggregates(stream, rule, str(tmp_path / "totals"), lambda df: seen.append({r["k"]: r["total_value"] for r in df.collect()}), str(tmp_path / "ck"), "t", 100)
    run.trigger(availableNow=True).start().awaitTermination(120)
    assert seen == [{"old": 1.0, "kept": 2.0}, {"old": 1.0, "kept": 5.0, "new": 4.0}, {"kept": 11.0, "new": 9.0}, {"kept": 11.0, "new": 9.0, "old": 7.0}]
    assert sorted(p.name for p in (tmp_path / "totals").iterdir()) == ["batch=2", "batch=3"]


def test_windowed_aggregate(spark, tmp_path):
    rows = [("a", 1.0, at(0)), ("a", 2.0, at(30)), ("b", 5.0, at(70)), ("a", 9.0, at(400))]
    stream = parts(spark, tmp_path, rows, "k string, v double, t timestamp", [3], "in")
    out = stateful.windowed_aggregate(stream, {"by": ["k"], "operation": "sum", "key": "v"}, "t", "1 minute", "10 seconds")
    q = out.writeStream.format("memory").queryName("windowed").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r["k"], r["value"]) for r in spark.table("windowed").collect()} >= {("a", 3.0), ("b", 5.0)}


def test_stream_topk(spark, tmp_path):
    """Rows of earlier batches count while they are inside the interval; each batch equals the batch operator."""
    rows = [("a", 1, at(0)), ("b", 5, at(10)), ("c", 3, at(11)), ("c", 3, at(13)), ("a", 4, at(14)), ("b", 1, at(19)), ("a", 1, at(40))]
    cuts = [3, 5, 6]
    stream = parts(spark, tmp_path, rows, "k string, v long, t timestamp", cuts, "in")
    rule, seen = {"name": "x", "index_keys": ["k"], "operation": "sum", "key": "v", "top_k": 2, "interval": "5 seconds"}, []
    shown = lambda df: [(r["k"], r["v"]) for r in df.collect()]
    stateful.stream_topk(stream, rule, "t", lambda df: seen.append(shown(df)), str(tmp_path / "ck"), str(tmp_path / "rows")).trigger(availableNow=True).start().awaitTermination(120)
    want = []
    for n in (*cuts, len(rows)):
        so_far = spark.createDataFrame(rows[:n], "k string, v long, t timestamp")
        want.append(shown(topk.timebased(so_far, rule, "t", F.lit(rows[n - 1][2]))))
    assert seen == want and want[1] == [("c", 6.0), ("b", 5.0)]


def test_tracking_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rng = random.Random(3)
    conf = CONF | {"detect_end": True, "groups": [{"selector": {}, "end_timeout": 30, "terminating_timeout": 5, "heartbeat": 20}]}
    rows, t = [], 0
    for i in range(120):
        t += rng.randrange(0, 9)
        side, host = rng.random() < 0.5, f"10.0.0.{rng.randrange(4)}"
        a, b = (host, 1), ("20.0.0.1", 443)
        rows.append((*(a if side else b), *(b if side else a), 6, rng.randrange(1, 99), 1, False, rng.choice([16, 16, 16, 1]), at(t), i))
    rows.append(("9.9.9.9", 1, "8.8.8.8", 2, 6, 1, 1, False, 16, at(t + 5000), 999))  # its batch fires the timers up to the watermark before it
    stream = parts(spark, tmp_path, rows, FLOW, [40, 80, 120], "in")
    q = stateful.stream_track(stream, conf).writeStream.format("memory").queryName("tracked").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    shown = ["_RecordType", "_IsFirst", "SrcAddr", "DstAddr", "Bytes_AB", "Bytes_BA", "numFlowLogs", "time"]
    want = walk.track(spark.createDataFrame(rows, FLOW), conf).filter(F.col("time") < at(t - 10).timestamp())
    got = spark.table("tracked").filter(F.col("time") < at(t - 10).timestamp())
    got, want = ({tuple(r) for r in x.select(*shown).collect()} for x in (got, want))
    assert (got - want, want - got) == (set(), set())
