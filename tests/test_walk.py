"""The walk over connections: absent flags, values of any type, and hot connections in ranges of time against the plain walk."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from flowloom.functions.ranges import bucket_of
from flowloom.operators import conntrack, walk, walk_batches
from tests.test_flows import CONF, FLOW, T0, at, conversation

AGGREGATES = [
    {"name": "Bytes", "operation": "sum", "split": True}, {"name": "n", "operation": "count", "split": True}, {"name": "all", "operation": "count"}, {"name": "low", "operation": "min", "input": "Packets", "split": True, "report_missing": True},
    {"name": "high", "operation": "max", "input": "Packets"}, {"name": "opened", "operation": "first", "input": "note"}, {"name": "closed", "operation": "last", "input": "note"}, {"name": "Packets", "operation": "last"},
]
NOTED = FLOW + ", note string"


def groups(*rows):
    return [{"selector": s, "end_timeout": e, "terminating_timeout": t, "heartbeat": h} for s, e, t, h in rows]


def stream(seed, n, fin, hosts=1, step=6.0, silent=0.02):
    rng, rows, t = random.Random(seed), [], 0.0
    for i in range(n):
        t += rng.choice([0, 0, rng.uniform(0, step), rng.uniform(0, step)]) + (60 if rng.random() < silent else 0)
        a, b = (f"10.0.0.{rng.randrange(hosts)}", 1), ("20.0.0.1", 443)
        if rng.random() < 0.5:
            a, b = b, a
        flags = None if rng.random() < 0.2 else 1 if rng.random() < fin else rng.choice([0, 16, 256])
        rows.append((*a, *b, rng.choice([6, 6, 17]) if hosts > 1 else 6, rng.choice([None, rng.randrange(99)]), rng.choice([None, 0, rng.randrange(9)]), rng.random() < 0.05, flags, at(round(t, 3)), i, rng.choice([None, f"x{i}"])))
    rng.shuffle(rows)
    return rows


def records(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("seed,fin,part_rows,changes", [
    (1, 0.1, 40, {}), (2, 0.5, 25, {"swap_ab": True}), (3, 0.02, 60, {"swap_ab": True}), (4, 0.0, 30, {"detect_end": False}), (5, 0.2, 20, {"groups": groups(({"SrcAddr": "20.0.0.1"}, 9, 1, 4), ({"DstPort": 443}, 3, 2, 5), ({}, 30, 5, 7))}),
    (6, 0.9, 33, {"groups": groups(({}, 100, 0, 1000))}), (7, 0.3, 1, {"groups": groups(({}, 4, 1, 2.5))}),
])
def test_ranges_equal_the_plain_walk(spark, seed, fin, part_rows, changes):
    conf = CONF | {"detect_end": True, "aggregates": AGGREGATES, "groups": groups(({}, 20, 1, 15))} | changes
    df = spark.createDataFrame(stream(seed, 600, fin) + stream(seed + 50, 100, fin, hosts=60), NOTED).repartition(2)
    for kinds in (walk.KINDS, ("endConnection",))[: 1 + seed % 2]:
        whole, parted = walk.track(df, conf, kinds, None), walk.track(df, conf, kinds, part_rows)
        assert parted.schema == whole.schema
        got, want = records(parted), records(whole)
        assert got == want and len(want) > 50


@pytest.mark.parametrize("seed,part_rows,changes", [(11, 30, {}), (12, 7, {"swap_ab": True}), (13, 60, {"groups": groups(({"Proto": 17}, 3, 1, 4), ({}, 12, 2, 5))}), (14, 20, {"groups": groups(({"SrcPort": 443}, 3, 1, 4), ({}, 12, 2, 5))})])
def test_sessions_in_ranges_equal_the_plain_ones(spark, seed, part_rows, changes):
    conf = CONF | {"aggregates": AGGREGATES, "groups": groups(({}, 9, 1, 15))} | changes
    df = spark.createDataFrame(stream(seed, 500, 0.1) + stream(seed + 50, 100, 0.1, hosts=40), NOTED).repartition(2)
    for made in (conntrack.connections, conntrack.new_connections):
        whole, parted = made(df, conf, part_rows=None), made(df, conf, part_rows=part_rows)
        assert parted.dtypes == whole.dtypes
        got, want = records(parted), records(whole)
        assert got == want and len(want) > 50


def test_a_hot_connection_is_split(spark):
    """A connection with a third of all flows is dealt over tasks, about evenly."""
    rows = stream(8, 4000, 0.01, step=3.0, silent=0.001) + stream(9, 8000, 0.01, hosts=4000)
    conf = conntrack.normal(CONF | {"detect_end": True, "groups": groups(({}, 20, 1, 15))})
    timed = walk.timed(spark.createDataFrame(rows, NOTED), conf)
    one = timed.filter(F.col("_low").contains("10.0.0.0") | F.col("_high").contains("10.0.0.0"))
    parts = walk._parts(one, conf, one.count(), 400)
    sizes = [r["n"] for r in parts.filter("_state IS NULL").groupBy("_part").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 9 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert parts.filter("_state IS NOT NULL").count() >= len(sizes)


def test_summaries_do_not_grow_with_flows():
    """Flows without gap or FIN leave steps of the first terminating timeout alone, and those with FINs few states."""
    conf = conntrack.normal(CONF | {"detect_end": True, "groups": groups(({}, 20, 1, 15))})
    t = np.arange(20_000) * 0.25
    flags = np.arange(20_000) % 50 == 7
    part = walk.Part(conf, t, flags, t >= 0, t < 0, np.zeros(20_000, int), {0: np.ones(20_000)}, {})
    s = part.summary()
    assert len(s["steps"]) <= 6 and len(s["states"]) <= 6
    quiet = walk.Part(conf, t, t < 0, t >= 0, t < 0, np.zeros(20_000, int), {0: np.ones(20_000)}, {}).summary()
    assert len(quiet["steps"]) <= 6 and quiet["cases"] == [(None, None, t[-1])] and quiet["held"] == [[20_000.0, 0.0], [20_000.0]]


def test_flags_may_be_absent(spark):
    df = spark.createDataFrame(conversation([(0, "AB", 1, False, None), (2, "BA", 2, False, None), (9, "AB", 3, False, 1), (20, "AB", 4, False, None)]), FLOW)
    for change in ({"detect_end": True}, {"swap_ab": True, "detect_end": True}, {"max_tracked": 5, "detect_end": True}):
        kinds = [r["_RecordType"] for r in walk.track(df, CONF | change).orderBy("time", F.desc("_RecordType")).collect()]
        assert kinds == ["newConnection", "endConnection", "newConnection", "endConnection"]
    text = df.withColumn("Flags", F.when(F.col("id") == 2, "1").otherwise("no number"))
    assert walk.track(text, CONF | {"detect_end": True}, ("endConnection",)).count() == 2


def test_first_and_last_of_any_type(spark):
    rows = [(*r, {"id": i}, 0.0 if i else 5.0) for i, r in enumerate(conversation([(0, "AB", 0, False, 0), (2, "BA", None, False, 0), (9, "AB", 2**60 + 1, False, 0), (10, "AB", 0, False, 0)]))]
    df = spark.createDataFrame(rows, FLOW + ", m map<string,int>, d double").withColumn("seen", F.col("event_time").cast("date"))
    aggs = [{"name": n, "operation": o, "input": i} for n, o, i in (("a", "first", "SrcAddr"), ("b", "last", "Bytes"), ("c", "first", "Bytes"), ("d", "last", "d"), ("e", "first", "d"), ("seen", "first", "seen"))]
    aggs.append({"name": "Packets", "operation": "sum"})
    for out in (walk.track(df, CONF | {"aggregates": aggs}, ("endConnection",)), conntrack.connections(df, CONF | {"aggregates": aggs})):
        (r,) = out.collect()
        # an integer zero is a value; only zeros of floating point are left out
        assert (r["a"], r["b"], r["c"], r["d"], r["e"], r["seen"], r["Packets"]) == (rows[0][0], 0, 0, None, 5.0, T0.date(), 4.0)
    assert dict(walk.track(df, CONF | {"aggregates": aggs}).dtypes)["b"] == "bigint"


def test_columns_of_any_name(spark):
    rows = conversation([(0, "AB", 7, False, 0), (3, "BA", 8, True, 0)])
    names = ["_a", "_low", "_high", "_dup", "_t", "_k", "_part", "_state", "k0", "v0", "o0", "_HashId2", "x.y"]
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], FLOW + ", " + ", ".join(f"`{n}` int" for n in names))
    logs = conntrack.flow_logs(df, CONF)
    assert logs.columns == [*df.columns, "_HashId", "_RecordType"] and [r["_a"] for r in logs.collect()] == [0, 0] and [r["_dup"] for r in logs.collect()] == [3, 3]
    dotted = CONF | {"aggregates": [{"name": "x.y", "operation": "sum"}, {"name": "_low", "operation": "last"}]}
    for out in (conntrack.connections(df, CONF), walk.track(df, CONF, ("endConnection",)), conntrack.new_connections(df, CONF)):
        assert [(r["Bytes_AB"], r["numFlowLogs"]) for r in out.collect()] == [(7, 1)]
    for out in (conntrack.connections(df, dotted), walk.track(df, dotted, ("endConnection",), 1)):
        assert [(r["x.y"], r["_low"]) for r in out.collect()] == [(12, 1)]


def test_bucket_of(spark):
    for cuts in ([], [5.0], [1.0, 2.0, 3.5], [float(x) for x in range(0, 200, 3)]):
        values = [-1.0, 0.0, 0.5, 1.0, 3.5, 3.6, 5.0, 197.0, 198.0, 199.0, 1e9]
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        assert [r["b"] for r in df.select(bucket_of(F.col("v"), cuts).alias("b")).collect()] == [*[sum(c < v for c in cuts) for v in values], None]


def test_merged_values():
    conf = conntrack.normal(CONF | {"aggregates": AGGREGATES})
    x = [[1.0, 2.0], [1.0, 0.0], [3.0], [4.0, math.inf], [-math.inf], ["a"], [None], [7]]
    y = [[1.0, 1.0], [1.0, 1.0], [2.0], [5.0, 6.0], [8.0], ["b"], ["c"], [None]]
    assert walk.merged(conf, x, y) == [[2.0, 3.0], [2.0, 1.0], [5.0], [4.0, 6.0], [8.0], ["a"], ["c"], [7]]


@pytest.mark.parametrize("seed,fin,changes", [
    (21, 0.1, {}), (22, 0.5, {"swap_ab": True}), (23, 0.02, {"swap_ab": True}), (24, 0.0, {"detect_end": False}), (25, 0.2, {"groups": groups(({"SrcAddr": "20.0.0.1"}, 9, 1, 4), ({"DstPort": 443}, 3, 2, 5), ({}, 30, 5, 0.7))}),
    (26, 0.9, {"groups": groups(({}, 100, 0, 1000))}),
])
def test_batches_equal_the_walk_row_by_row(spark, seed, fin, changes):
    """Records by arrays, in batches of any size and with connections that go on from a range, against one flow at a time."""
    conf = conntrack.normal(CONF | {"detect_end": True, "aggregates": AGGREGATES, "groups": groups(({}, 20, 1, 15)), "order": ["id"]} | changes)
    # a host that talks to itself, too
    rows = stream(seed, 300, fin) + stream(seed + 50, 200, fin, hosts=40) + [("9.9.9.9", 5, "9.9.9.9", 5, 6, i, None, False, 256 * (i % 2), at(4.0 * i), i, f"y{i}") for i in range(9)]
    df = spark.createDataFrame(rows, NOTED)
    made, plain = to_arrow_schema(walk.record_schema(df, conf)), walk.timed(df, conf)
    for given in (plain.coalesce(1).sortWithinPartitions(*walk.KEY, "_t", "o0"), walk._parts(plain, conf, len(rows), 30).coalesce(1).sortWithinPartitions(*walk.KEY, "_part", F.col("_state").isNull(), "_t", "o0")):
        table = given.toArrow().combine_chunks()
        for kinds in (walk.KINDS, ("endConnection",), ("heartbeat", "endConnection"), ("newConnection",)):
            want = sorted(repr({f: r[f] for f in made.names}) for r in walk.walk(conf, iter(table.to_pylist()), kinds) if r["_RecordType"] in kinds)
            assert len(want) > 50
            for size in (5, 10_000):
                got = [r for b in walk_batches.Walk(conf, kinds, made).run(table.to_batches(size)) for r in b.to_pylist()]
                assert sorted(map(repr, got)) == want


def test_rows_together_are_fewer_where_heartbeats_are_many():
    conf = conntrack.normal(CONF | {"groups": groups(({}, 14_400, 1, 1))})
    assert walk_batches.Walk(conf, walk.KINDS, None).rows <= 10 and walk_batches.Walk(conf, ("endConnection",), None).rows > 1000
