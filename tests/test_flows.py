"""Golden cases of the flow operators."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from flowloom.functions import net
from flowloom.functions.coerce import go_str, to_bool, to_int
from flowloom.operators import aggregate as agg
from flowloom.operators import conntrack, enrich, filters, generic, inventory, metrics, topk, walk
from flowloom.plans.pipeline import Flow, Pipeline
from flowloom.plans.query_text import filter_query
from flowloom.sources import flows as src
from flowloom.sources import sinks

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_coercion(spark):
    df = spark.createDataFrame([(100.0, 1.1, "5.7", "12", [1.0, 2.5], "T")], "a double, b double, c string, d string, e array<double>, f string")
    r = df.select(go_str(df, "a"), go_str(df, "b"), to_int(df, "b"), to_int(df, "c"), to_int(df, "d"), go_str(df, "e"), to_bool(df, "f"), go_str(df, "none")).first()
    assert tuple(r) == ("100", "1.1", 1, None, 12, "[1 2.5]", True, None)
    big = spark.createDataFrame([(1e16,), (0.00001,)], "a double")
    assert [x[0] for x in big.select(go_str(big, "a")).collect()] == ["10000000000000000", "0.00001"]


def test_query_text(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, "y", None), (3, None, 4)], "id int, a string, c int")
    ids = lambda q: sorted(r["id"] for r in filter_query(df, q).collect())
    assert ids('a = "x"') == [1] and ids('a != "x"') == [2, 3] and ids("c != 5") == [3] and ids("without(c)") == [2]
    assert ids('a="x" and c=9 or with(c)') == [1]  # OR binds tighter
    assert ids('(a="x" AND c=9) or with(c)') == [1, 3] and ids("a !~ `^x`") == [2, 3] and ids('a="$(a)"') == [1, 2]
    for bad in ("a = 1.5", "a =", "(a=1", 'a > "x"', "a=1 b=2", "a ~ 3"):
        with pytest.raises(ValueError):
            filter_query(df, bad)


def test_generic(spark):
    df = spark.createDataFrame([("s", "d", 3, None)], "a string, b string, n int, z string")
    assert generic.generic(df, [{"input": "a", "output": "b"}, {"input": "b", "output": "a"}]).first()[:2] == ("d", "s")
    out = generic.generic(df, [{"input": "n", "output": "n", "multiplier": 8}, {"input": "z", "output": "a"}, {"input": "a", "output": "q", "multiplier": 2}])
    assert tuple(out.first()) == ("s", "d", 24, None, None)
    with pytest.raises(ValueError):
        generic.generic(df, [], "other")


def test_sampling_field(spark):
    df = spark.createDataFrame([(i, 50) for i in range(400)] + [(1000, 0)], "id int, s int")
    out = filters.transform_filter(df, [{"type": "keep_entry_query", "query": "id >= 0", "sampling": 10}], ["id"], "s").collect()
    assert {r["s"] for r in out if r["id"] < 1000} == {500} and 15 < len(out) < 80


def test_network_functions(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("",), ("300.1.1.1",), ("2001:db8::1",), (None,)], "ip string")
    rows = df.select(net.subnet(F.col("ip"), 16), net.subnet(F.col("ip"), 24), net.subnet(F.col("ip"), 26), net.subnet(F.col("ip"), 48, v6=True)).collect()
    assert tuple(rows[0][:3]) == ("10.0.0.0/16", "10.0.0.0/24", "10.0.0.0/26") and rows[1][0] is None and rows[2][0] is None and rows[3][3] == "2001:db8::/48" and rows[4][0] is None
    flags = spark.createDataFrame([(17,), (18,), (0,), (None,)], "f int").select(net.decode_tcp_flags(F.col("f")).alias("n"))
    assert [r["n"] for r in flags.collect()] == [["FIN", "ACK"], ["SYN", "ACK"], [], None]
    assert [r[0] for r in flags.select(net.encode_tcp_flags(F.col("n"))).collect()] == [17, 18, 0, None]


def test_subnet_label_first_match(spark):
    df = spark.createDataFrame([("10.1.2.3",), ("100.1.2.3",), ("100.2.3.4",), ("101.1.0.0",), (None,)], "ip string")
    labels = [{"name": "Pods overlay", "cidrs": ["10.0.0.0/8"]}, {"name": "MySite.com", "cidrs": ["101.1.0.0/16", "100.1.0.0/16"]}, {"name": "late", "cidrs": ["10.1.2.0/24"]}]
    got = {r["ip"]: r["label"] for r in enrich.add_subnet_label(df, "ip", "label", labels).collect()}
    assert got == {"10.1.2.3": "Pods overlay", "100.1.2.3": "MySite.com", "100.2.3.4": None, "101.1.0.0": "MySite.com", None: None}


def test_subnet_label_of_both_families(spark):
    addresses = ["10.1.1.1", "1.2.3.4", "2001:db8::9", "2001:0DB8:0:0::1", "::1", "::ffff:10.1.1.1", "11.1.1.1", "x", "1::2::3", None]
    df = spark.createDataFrame([(a, 1, 2) for a in addresses], "ip string, _label int, _number int")
    labels = [{"name": "v6", "cidrs": ["2001:db8::/32"]}, {"name": "a", "cidrs": ["10.0.0.0/8"]}, {"name": "b", "cidrs": ["10.1.0.0/16", "1.2.0.0/16"]}, {"name": "all", "cidrs": ["::/0"]}]
    want = ["a", "b", "v6", "v6", "all", "a", None, None, None, None]
    for few in (200, 0):
        out = enrich.add_subnet_label(df, "ip", "label", labels, few)
        assert out.columns == [*df.columns, "label"] and [r["label"] for r in out.collect()] == want
    plan = enrich.add_subnet_label(df, "ip", "label", labels)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_range_lookup_without_broadcast(spark):
    ranges = spark.createDataFrame([(0, 2**32 - 1, "world"), (10 << 24, (11 << 24) - 1, "ten"), ((10 << 24) + 65536, (10 << 24) + 131071, "ten.one")], "ip_from long, ip_to long, place string")
    df = spark.createDataFrame([("10.1.2.3", 1), ("10.2.2.3", 2), ("9.9.9.9", 3), ("10.1.2.3", 4), ("::1", 5), (None, 6)], "ip string, _row int")
    for most in (10**6, 1):
        out = enrich.range_lookup(df, ranges, "ip", ["place"], F.col("ip_to") - F.col("ip_from"), most)
        assert {r["_row"]: r["place"] for r in out.collect()} == {1: "ten.one", 2: "ten", 3: "world", 4: "ten.one", 5: None, 6: None}


def test_dimension_size_is_checked_in_bytes(spark):
    df = spark.createDataFrame([("x" * 500,)] * 3, "a string")
    assert enrich.fits(df, 3, 10_000) and not enrich.fits(df, 2, 10_000) and not enrich.fits(df, 3, 1000)


def test_ipv6_text(spark):
    import ipaddress

    cases = ["::", "::1", "1::", "2001:0DB8:0:0:0:0:0:1", "::ffff:1.2.3.4", "64:ff9b::1.2.3.4", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1::2::3", ":1", "1:", ":::", "12345::", "g::", "1.2.3.4", "999.1.1.1", "host:80", "", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8::", "fe80::1%eth0"]
    for r in spark.createDataFrame([(c,) for c in cases], "ip string").select("ip", net.ip_to_hex(F.col("ip")).alias("h"), net.is_ip(F.col("ip")).alias("i")).collect():
        try:
            want = None if "%" in r["ip"] else f"{int(ipaddress.IPv6Address(r['ip'])):032x}"
        except ValueError:
            want = None
        assert r["h"] == want and r["i"] == (want is not None or r["ip"] == "1.2.3.4")


def test_ipv6_subnets(spark):
    import ipaddress

    cases = ["::", "::1", "1::", "2001:db8::1:0:0:1", "1:0:0:2:0:0:0:3", "0:0:1:0:0:1:0:0", "1:2:3:4:5:6:7:8", "1:0:2:0:3:0:4:0", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "::ffff:1.2.3.4", "64:ff9b::1.2.3.4", "fe80::1", "a::b::c", "x", None]
    for prefix in (0, 1, 10, 22, 48, 63, 64, 97, 126, 128):
        for r in spark.createDataFrame([(c,) for c in cases], "ip string").select("ip", net.subnet(F.col("ip"), prefix, v6=True).alias("n")).collect():
            try:
                want = str(ipaddress.ip_network(f"{r['ip']}/{prefix}", strict=False))
            except ValueError:
                want = None
            assert r["n"] == want


def test_services(spark):
    lines = lambda xs: spark.createDataFrame([(x,) for x in xs], "value string").coalesce(1)
    protocols, services = enrich.parse_protocols(lines(["tcp 6 TCP # x", "udp 17 UDP"])), enrich.parse_services(lines(["netbios-dgm 138/tcp", "ms-sql-s 1433/tcp"]))
    df = spark.createDataFrame([("138", "tcp"), ("1433", "unknown"), ("138", "17"), ("9", "TCP"), ("138", "6")], "port string, proto string")
    got = {(r["port"], r["proto"]): r["service"] for r in enrich.add_service(df, "port", "proto", "service", protocols, services).collect()}
    assert got == {("138", "tcp"): "netbios-dgm", ("1433", "unknown"): "ms-sql-s", ("138", "17"): "", ("9", "TCP"): None, ("138", "6"): "netbios-dgm"}


def test_owner_chain(spark):
    owners = spark.createDataFrame([("ReplicaSet", "ns", "rs1", "Deployment", "deploy1"), ("Deployment", "ns", "deploy1", "Gateway", "gateway1")], "kind string, namespace string, name string, owner_kind string, owner_name string")
    pod = spark.createDataFrame([("ns", "pod", "ReplicaSet", "rs1")], "namespace string, name string, owner_kind string, owner_name string")
    top = lambda tracked: inventory.climb_owners(pod, owners, tracked).first()["owner_name"]
    assert (top(["Deployment", "Gateway"]), top(["Deployment"]), top([])) == ("gateway1", "deploy1", "deploy1")


def test_inventory_build(spark):
    node = spark.createDataFrame([("n1", ["host.example", "10.0.0.9"], {"k8s.ovn.org/node-subnets": '{"default":["10.128.0.0/23"]}'}), ("n2", ["10.0.0.8"], {"k8s.ovn.org/node-subnets": '{"default":"10.129.0.0/23"}'}), ("n3", ["10.0.0.7"], {})], "name string, addresses array<string>, annotations map<string,string>")
    got = {r["name"]: (r["ips"], r["host_ip"]) for r in inventory.nodes(node).collect()}
    assert got == {"n1": (["10.0.0.9", "10.128.0.2"], "10.0.0.9"), "n2": (["10.0.0.8", "10.129.0.2"], "10.0.0.8"), "n3": (["10.0.0.7"], "10.0.0.7")}
    changes = spark.createDataFrame([("Pod", "a", "x", 1, "add"), ("Pod", "a", "y", 2, "add"), ("Pod", "a", "x", 3, "delete"), ("Pod", "a", "old", 0, "add"), ("Pod", "a", "z", 1, "snapshot")], "kind string, namespace string, name string, version int, op string")
    assert sorted(r["name"] for r in inventory.latest(changes).collect()) == ["y", "z"]


def test_label_truncation(spark):
    df = spark.createDataFrame([({"app": "abcdef", "b": "xy"},)], "m map<string,string>")
    cut = lambda n: df.select(enrich.filter_labels(F.col("m"), most=n)).first()[0]
    assert cut(5) == {"app": "ab...", "b": "xy"} and cut(2)["app"] == ".." and cut(0)["app"] == ""
    assert df.select(enrich.filter_labels(F.col("m"), ["app", "b"], ["b"], "k")).first()[0] == {"k_app": "abcdef"}


def test_aggregates_over_two_batches(spark):
    batch = lambda rows: spark.createDataFrame(rows, "service string, bytes double")
    one, two = batch([("http", 10.0), ("http", 20.0), ("tcp", 1.0), ("tcp", 2.0)]), batch([("http", 30.0), ("tcp", 4.0), ("tcp", 5.0)])
    rule = {"name": "b", "by": ["service"], "operation": "sum", "key": "bytes"}
    got = {r["service"]: (r["total_value"], r["total_count"], r["recent_op_value"], r["recent_count"]) for r in agg.merge_totals(agg.aggregate(one, rule), agg.aggregate(two, rule), rule).collect()}
    assert got == {"http": (60.0, 3, 30.0, 1), "tcp": (12.0, 4, 9.0, 2)}


TOP = [("10.0.0.1", 100), ("10.0.0.2", 200), ("10.0.0.3", 300), ("10.0.0.1", 400), ("10.0.0.2", 500), ("10.0.0.3", 600), ("10.0.0.1", 700), ("10.0.0.2", 800), ("10.0.0.3", 900), ("10.0.0.4", 1000)]


@pytest.mark.parametrize("op,k,reverse,want", [
    ("last", 3, False, [("10.0.0.4", 1000), ("10.0.0.3", 900), ("10.0.0.2", 800)]), ("avg", 2, True, [("10.0.0.1", 400), ("10.0.0.2", 500)]), ("sum", 1, False, [("10.0.0.3", 1800)]),
    ("diff", 1, True, [("10.0.0.4", 0)]), ("max", 1, False, [("10.0.0.4", 1000)]), ("min", 1, True, [("10.0.0.1", 100)]),
])
def test_topk(spark, op, k, reverse, want):
    df = spark.createDataFrame([(a, b, at(i)) for i, (a, b) in enumerate(TOP)], "SrcAddr string, Bytes long, t timestamp")
    out = topk.timebased(df, {"name": "x", "index_keys": ["SrcAddr"], "operation": op, "key": "Bytes", "top_k": k, "reversed": reverse}, "t").collect()
    assert [(r["SrcAddr"], r["Bytes"]) for r in out] == want


def test_flatten_and_filters(spark):
    rows = [("A", ["eth0", "123456"], 7), ("A", ["eth0", "abcdef"], 1), ("A", ["eth0", "xyz"], 10), ("B", None, 2), ("C", [], 3)]
    df = spark.createDataFrame(rows, "namespace string, interfaces array<string>, bytes int")
    m = {"name": "m", "value_key": "bytes", "labels": ["interfaces", "namespace"], "flatten": ["interfaces"], "filters": [{"key": "interfaces", "type": "not_equal", "value": "xyz"}]}
    got = {(r["labels"]["interfaces"], r["labels"]["namespace"]): r["value"] for r in metrics.counter(df, m).collect()}
    assert got == {("eth0", "A"): 18, ("123456", "A"): 7, ("abcdef", "A"): 1, ("", "B"): 2, ("", "C"): 3}
    events = spark.createDataFrame([("A", [{"type": "p", "name": "my_policy"}], 11)], "namespace string, events array<map<string,string>>, bytes int")
    e = metrics.counter(events, {"name": "m", "value_key": "bytes", "labels": ["events>name", "namespace"], "remap": {"events>name": "name"}, "flatten": ["events"]}).first()
    assert e["labels"] == {"name": "my_policy", "namespace": "A"} and e["value"] == 11
    assert metrics.exposition(metrics.counter(df.limit(1), {"name": "c", "prefix": "p_", "labels": ["namespace"]})).first()["line"] == 'p_c{namespace="A"} 1'


def test_histogram_defaults(spark):
    df = spark.createDataFrame([("http", 10.0), ("http", 20.0), ("tcp", 1.0), ("tcp", 2.0)], "service string, v double")
    got = {(r["labels"]["service"], r["le"]): r["cumulative_count"] for r in metrics.histogram(df, {"name": "h", "value_key": "v", "labels": ["service"]}).collect()}
    assert (got["http", "10"], got["http", "+Inf"], got["tcp", "1"], got["tcp", "2.5"]) == (1, 2, 1, 2)


FLOW = "SrcAddr string, SrcPort int, DstAddr string, DstPort int, Proto int, Bytes long, Packets long, Duplicate boolean, Flags int, event_time timestamp, id int"
A, B = ("10.0.0.1", 9001), ("10.0.0.2", 9002)


def conversation(rows, proto=6):
    return [(*(A if side == "AB" else B), *(B if side == "AB" else A), proto, b, 1, dup, flags, at(t), i) for i, (t, side, b, dup, flags) in enumerate(rows)]


CONF = conntrack.DEFAULT | {"order": ["id"], "flags": "Flags", "groups": [{"selector": {}, "end_timeout": 30, "terminating_timeout": 5, "heartbeat": 10_000}]}


def test_conntrack_both_directions(spark):
    df = spark.createDataFrame(conversation([(0, "AB", 111, False, 0), (10, "BA", 777, False, 0), (15, "AB", 222, False, 0), (20, "AB", 5, True, 0)]), FLOW)
    for out in (conntrack.connections(df, CONF), walk.track(df, CONF, ("endConnection",))):
        (r,) = out.collect()
        assert (r["Bytes_AB"], r["Bytes_BA"], r["numFlowLogs"], r["SrcAddr"]) == (333, 777, 3, A[0])
    assert conntrack.flow_logs(df, CONF).count() == 4
    assert {r["classification"]: r["n"] for r in conntrack.classify(df, CONF).collect()} == {"duplicate": 1, "update": 2, "newConnection": 1}


def test_conntrack_fin_ends_early(spark):
    df = spark.createDataFrame(conversation([(0, "AB", 111, False, 0), (1, "BA", 222, False, 0), (2, "AB", 333, False, 1), (20, "AB", 9, False, 0)]), FLOW)
    records = walk.track(df, CONF | {"detect_end": True}).orderBy("time", F.desc("_RecordType")).collect()
    assert [(r["_RecordType"], r["Bytes_AB"], r["Bytes_BA"]) for r in records] == [("newConnection", 111, None), ("endConnection", 444, 222), ("newConnection", 9, None), ("endConnection", 9, None)]
    assert [r["_IsFirst"] for r in records] == [True, False, True, False]


def test_conntrack_swap_and_heartbeat(spark):
    df = spark.createDataFrame(conversation([(0, "AB", 111, False, 256), (25, "AB", 1, False, 0), (45, "BA", 2, False, 0)]), FLOW)
    conf = CONF | {"swap_ab": True, "groups": [{"selector": {"Proto": 17}, "end_timeout": 20, "terminating_timeout": 5, "heartbeat": 10}, {"selector": {}, "end_timeout": 30, "terminating_timeout": 5, "heartbeat": 20}]}
    records = walk.track(df, conf).orderBy("time").collect()
    assert [(r["_RecordType"], (r["time"] - T0.timestamp())) for r in records] == [("newConnection", 0), ("heartbeat", 20), ("heartbeat", 40), ("heartbeat", 60), ("endConnection", 75)]
    assert records[0]["SrcAddr"] == B[0] and records[0]["Bytes_BA"] == 111 and records[-1]["Bytes_AB"] == 2
    assert conntrack.connections(df, conf).first()["SrcAddr"] == B[0]


def test_conntrack_conserves_bytes(spark):
    import random

    rng = random.Random(1)
    rows = [(*(a if s else b), *(b if s else a), rng.choice([6, 17, 1]), rng.randrange(1, 99), 1, rng.random() < 0.1, 16, at(rng.randrange(3000)), i) for i in range(600) for s, a, b in [(rng.random() < 0.5, ("10.0.0.%d" % rng.randrange(5), 1), ("20.0.0.1", 443))]]
    df = spark.createDataFrame(rows, FLOW)
    want = sum(r[5] for r in rows if r[4] != 1 and not r[7])
    for out in (conntrack.connections(df, CONF), walk.track(df, CONF, ("endConnection",)), walk.track(df, CONF | {"detect_end": True}, ("endConnection",))):
        assert out.agg(F.sum(F.coalesce("Bytes_AB", F.lit(0)) + F.coalesce("Bytes_BA", F.lit(0)))).first()[0] == want


@pytest.mark.parametrize("change", [{"groups": [{"selector": {"Proto": 6}}]}, {"detect_end": True, "flags": None}, {"key": {"common": [], "a": ["x"], "b": []}}, {"aggregates": [{"name": "a", "operation": "count"}] * 2}, {"aggregates": [{"name": "a", "operation": "median"}]}])
def test_conntrack_validation(change):
    with pytest.raises(ValueError):
        conntrack.validate(CONF | change)


def test_conntrack_keys_not_hashes(spark, monkeypatch):
    """Two connections with one hash stay two."""
    rows = conversation([(0, "AB", 1, False, 0), (1, "AB", 2, False, 0)])
    rows += [("10.0.0.9", *r[1:]) for r in rows]
    df = spark.createDataFrame(rows, FLOW)
    whole = conntrack.keyed
    for module in (conntrack, walk):
        monkeypatch.setattr(module, "keyed", lambda df, conf: whole(df, conf).withColumn("_HashId", F.lit("same")))
    for out in (conntrack.connections(df, CONF), walk.track(df, CONF, ("endConnection",))):
        assert [r["numFlowLogs"] for r in out.collect()] == [2, 2]


def test_conntrack_rejects_and_caps(spark):
    rows = conversation([(0, "AB", 1, False, 0)]) + [(None, *conversation([(0, "AB", 1, False, 0)])[0][1:])]
    df = spark.createDataFrame(rows, FLOW)
    assert {r["classification"]: r["n"] for r in conntrack.classify(df, CONF).collect()} == {"rejected": 1, "newConnection": 1}
    assert conntrack.flow_logs(df, CONF).count() == 1
    # three at once, two of which are tracked; the third is tracked once the first has ended
    flow = lambda host, t, i: (f"10.0.0.{host}", 1, "20.0.0.1", 443, 6, 1, 1, False, 0, at(t), i)
    rows = [flow(1, 0, 0), flow(2, 1, 1), flow(3, 2, 2), flow(2, 10, 3), flow(3, 11, 4), flow(3, 45, 5), flow(2, 46, 6)]
    out = walk.track(spark.createDataFrame(rows, FLOW), CONF | {"max_tracked": 2, "buckets": 1}).collect()
    got = sorted((r["time"] - T0.timestamp(), r["_RecordType"], r["SrcAddr"][-1], r["numFlowLogs"]) for r in out)
    assert got == [(0, "newConnection", "1", 1), (1, "newConnection", "2", 1), (30, "endConnection", "1", 1), (40, "endConnection", "2", 2), (45, "newConnection", "3", 1), (46, "newConnection", "2", 1), (75, "endConnection", "3", 1), (76, "endConnection", "2", 1)]
    shown = ["SrcAddr", "_RecordType", "_IsFirst", "Bytes_AB", "numFlowLogs", "time"]
    free = CONF | {"detect_end": True, "groups": [{"selector": {}, "end_timeout": 9, "terminating_timeout": 5, "heartbeat": 4}]}
    every = spark.createDataFrame([flow(i % 5, 3 * i, i)[:8] + (i % 4 == 0, at(3 * i), i) for i in range(60)], FLOW.replace("Flags int", "Flags boolean")).withColumn("Flags", F.col("Flags").cast("int"))
    a, b = (sorted(map(tuple, walk.track(every, c).select(*shown).collect())) for c in (free, free | {"max_tracked": 100, "buckets": 3}))
    assert a == b
    reasons = {r["reason"]: r["n"] for r in conntrack.end_reasons(walk.track(every, free), free).collect()}
    assert reasons["FIN_flag"] + reasons.get("timeout", 0) == sum(r[1] == "endConnection" for r in a)


def test_new_connections_equal_the_walk(spark):
    rows = conversation([(0, "AB", 111, False, 256), (31, "BA", 5, False, 0), (30, "BA", 7, False, 0), (100, "BA", None, False, 0), (200, "AB", 9, True, 0)])
    df = spark.createDataFrame(rows, FLOW)
    aggregates = [*CONF["aggregates"], {"name": "low", "operation": "min", "input": "Bytes", "split": True}, {"name": "first", "operation": "first", "input": "Packets"}]
    for swap in (False, True):
        conf = CONF | {"swap_ab": swap, "aggregates": aggregates}
        shown = ["SrcAddr", "DstAddr", "Bytes_AB", "Bytes_BA", "numFlowLogs", "low_AB", "low_BA", "first", "_IsFirst"]
        a, b = (sorted(map(repr, x.select(*[F.col(c).cast("string") for c in shown]).collect())) for x in (conntrack.new_connections(df, conf), walk.track(df, conf, ("newConnection",))))
        assert a == b


def test_label_lines_and_lines(spark):
    df = spark.createDataFrame([(123456, "fooLabel", "barLabel", "x", 1234, None)], "ts long, foo string, bar string, ignored string, value int, other string")
    r = sinks.to_label_lines(df, ["foo", "bar", "missing"], "ts", static={"static": "label"}, ignore=["ignored"]).first()
    assert r["labels"] == {"foo": "fooLabel", "bar": "barLabel", "static": "label"} and r["time"].timestamp() == 123456 and r["line"] == '{"ts":123456,"value":1234}'
    small = df.select("foo", "value", "other")
    assert sinks.text_lines(small, "printf").first()[0] == "map[foo:fooLabel value:1234]" and sinks.text_lines(small, "fields").first()[0] == "foo = fooLabel\nvalue = 1234"
    stamps = [spark.createDataFrame([(123456789,)], "t long").select(sinks.timestamp_of(spark.createDataFrame([(1,)], "t long"), "t", s).cast("double")).first()[0] for s in ("1s", "1ms")]
    assert stamps == [123456789.0, 123456.789]


def test_kafka_options(monkeypatch):
    """The reader's options; the connector itself is not on the class path here."""
    seen: dict = {}

    class Reader:
        def format(self, kind):
            seen["format"] = kind
            return self

        def option(self, k, v):
            seen[k] = v
            return self

        def load(self):
            raise StopIteration

    class Session:
        readStream = Reader()  # noqa: N815

    with pytest.raises(StopIteration):
        src.read_flows_kafka(Session(), "host:9092", "flows", "a int", start="latest", group="g", most=500, options={"kafka.security.protocol": "SSL"})
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "flows", "startingOffsets": "latest", "groupIdPrefix": "g", "maxOffsetsPerTrigger": 500, "kafka.security.protocol": "SSL"}


def test_sinks_without_a_service(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c int")
    assert [r["value"] for r in sinks.to_kafka_rows(df).collect()] == ['{"a":1,"b":"x"}']
    sinks.sink_none(df)
    with pytest.raises(ValueError):
        metrics.otel_metrics(df, [{"name": "x", "type": "agg_histogram", "value_key": "a"}])


def test_json_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"Bytes": 1}\nnot json\n{"Bytes": 3}\n')
    assert sorted(r["Bytes"] for r in src.read_flows_json(spark, str(tmp_path), "Bytes long").collect()) == [1, 3]
    df = spark.createDataFrame([(b'{"a": 1, "TimeReceived": 5}',), (b"{bad",), (b'{"a": null}',)], "value binary")
    assert sorted(tuple(r) for r in src.decode_json(df, "value", "a long, TimeReceived long", now=9).select(F.coalesce("a", F.lit(0)), "TimeReceived").collect()) == [(0, 9), (1, 5)]


def test_pipeline_checks(spark):
    ok = [{"name": "in", "type": "none"}, {"name": "out", "follows": "in", "type": "none", "sink": True}]
    df = spark.createDataFrame([(1,)], "a int")
    assert Pipeline(ok).run(df)["out"].count() == 1 and Flow(df).generic([{"input": "a", "output": "b"}]).df.columns == ["a", "b"]
    for bad in (ok[:1], ok + [ok[0]], [ok[0], {"name": "out", "follows": "nowhere", "type": "none", "sink": True}], ok + [{"name": "x", "follows": "out", "type": "none", "sink": True}], [{"name": "a", "type": "none", "sink": True, "odd": 1}], [{"name": "a", "type": "teleport", "sink": True}]):
        with pytest.raises(ValueError):
            Pipeline(bad)


def test_empty_tables(spark):
    df = spark.createDataFrame([], FLOW)
    assert conntrack.connections(df, CONF).collect() == [] and walk.track(df, CONF).collect() == []
    assert agg.aggregate(df, {"name": "x", "by": ["Proto"], "operation": "sum", "key": "Bytes"}).collect() == []
    assert metrics.histogram(df, {"name": "h", "value_key": "Bytes", "labels": ["Proto"]}).collect() == []


def test_object_batches_number_whole_hours(spark):
    rows = [(i, at((i * 37) % 9000 // 7 * 7), i % 3) for i in range(500)] + [(1000 + i, at(30), 9) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t timestamp, k int").repartition(3)
    hours: dict = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        hours.setdefault(r[1].replace(minute=0, second=0), []).append(r[0])
    want = {f"a/year=2024/month=01/day=01/hour={h.hour:02}/stream-id=0/{b // 10:08}": ids[b : b + 10] for h, ids in hours.items() for b in range(0, len(ids), 10)}
    for most in (25, 200_000):
        got = sinks.object_batches(df, "t", 10, "a", order=["id"], range_rows=most).collect()
        assert len(got) == len(want) and {r["path"]: [x["id"] for x in json.loads(r["object"])["flow_logs"]] for r in got} == want
        assert all(r["n"] == len(want[r["path"]]) for r in got)
    big = spark.createDataFrame([(7,), (100_000_000,)], "b long").select(sinks.padded(F.col("b"))).collect()
    assert [r[0] for r in big] == ["00000007", "100000000"]
