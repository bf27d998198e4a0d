"""Lookups in many ranges, in lists of keys, and in an inventory as it was at a flow's time."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from flowloom.operators import enrich, inventory


def test_many_nested_labels(spark):
    """100,000 ranges of both families around and in each other, a /0 among them; no list is looked through for each flow."""
    rng = random.Random(2)
    labels = [{"name": f"r{i}", "cidrs": [f"{rng.randrange(1, 224)}.{rng.randrange(256)}.{rng.randrange(256)}.0/{rng.choice([8, 12, 16, 20, 24])}"]} for i in range(50_000)]
    labels += [{"name": f"s{i}", "cidrs": [f"2001:db8:{rng.randrange(4096):x}::/{rng.choice([36, 40, 48, 64])}"]} for i in range(50_000)]
    rng.shuffle(labels)
    labels += [{"name": "rest", "cidrs": ["0.0.0.0/0"]}, {"name": "six", "cidrs": ["::/0"]}]
    addresses = [f"{rng.randrange(1, 240)}.{rng.randrange(256)}.1.1" for _ in range(60)] + [f"2001:db8:{rng.randrange(5000):x}::{i:x}" for i in range(60)] + ["::ffff:9.9.9.9", "255.255.255.255", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "0.0.0.0", "::", "x", None]
    nets = [(ipaddress.ip_network(x["cidrs"][0], strict=False), x["name"]) for x in labels]

    def plain(a):
        try:
            ip = ipaddress.ip_address(a)
        except ValueError:
            return None
        ip = getattr(ip, "ipv4_mapped", None) or ip
        return next((n for net, n in nets if ip.version == net.version and ip in net), None)

    df = spark.createDataFrame([(a,) for a in addresses], "ip string").repartition(2)
    out = enrich.add_subnet_label(df, "ip", "label", labels)
    assert {r["ip"]: r["label"] for r in out.collect()} == {a: plain(a) for a in addresses}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and len(plan) < 50_000


INVENTORY = "kind string, namespace string, name string, ips array<string>, secondary_net_keys array<string>, secondary_net_names map<string,string>, version long, network_name string"


def test_a_flow_with_many_keys_adds_no_join(spark, monkeypatch):
    objects = [("Pod", "ns", f"p{i}", [f"10.0.0.{i}"], [f"k{i}"], {f"k{i}": f"net{i}"}, i, "primary") for i in range(50)]
    held = spark.createDataFrame(objects, INVENTORY)
    flows = [(1, "10.0.0.1", [f"x{i}" for i in range(500)] + ["k7", "k3"], "k2"), (2, "10.0.0.1", [], None), (3, "10.0.0.1", None, "k5"), (4, "10.0.0.1", ["zz", None, "k9"], None), (5, None, ["k1"], None), (6, "9.9.9.9", ["zz"], "k4")]
    df = spark.createDataFrame(flows, "id int, ip string, keys array<string>, one string")
    want = {1: ("p7", "net7"), 2: ("p1", "primary"), 3: ("p5", "net5"), 4: ("p9", "net9"), 5: (None, None), 6: ("p4", "net4")}
    for most in (10**6, 0):
        monkeypatch.setattr(enrich.first_known, "__defaults__", (most,))
        out = enrich.add_kubernetes(df, "ip", "Src", held, ["keys", "one"])
        assert {r["id"]: (r["Src_Name"], r["Src_NetworkName"]) for r in out.collect()} == want
        if most:
            assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 3


def test_columns_of_any_name(spark):
    names = ["_at", "_p", "_k", "_key", "_object", "_by", "_any", "_one0", "_names", "_number", "_digits", "_range", "_found", "_until"]
    df = spark.createDataFrame([("10.0.0.1", 80, 6, ["k1"], *range(len(names)))], "ip string, port int, proto int, keys array<string>, " + ", ".join(f"{n} int" for n in names))
    held = spark.createDataFrame([("Pod", "ns", "p", ["10.0.0.1"], ["k1"], {"k1": "n"}, 1, "x")], INVENTORY)
    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    ranges = spark.createDataFrame([(0, 2**32 - 1, "w")], "ip_from long, ip_to long, place string")
    out = enrich.add_kubernetes(df, "ip", "Src", held, ["keys"])
    out = enrich.add_service(out, "port", "proto", "service", enrich.parse_protocols(lines("tcp 6 TCP")), enrich.parse_services(lines("http 80/tcp", "www 80/udp")))
    out = enrich.range_lookup(out, ranges, "ip", ["place"], F.lit(0))
    (r,) = out.collect()
    assert (r["Src_Name"], r["service"], r["place"]) == ("p", "http", "w") and [r[n] for n in names] == list(range(len(names)))


CHANGES = "kind string, namespace string, name string, ips array<string>, version long, op string, owner_name string"


def plain_as_of(changes, ip, t):
    """add_kubernetes over latest, of the changes up to t, in plain Python."""
    past = [c for c in changes if c[4] is not None and c[4] <= t]
    since = max((c[4] for c in past if c[5] == "snapshot"), default=None)
    last: dict = {}
    for c in sorted((c for c in past if since is None or c[4] >= since), key=lambda c: (c[4], c[5])):
        last[c[0], c[1] or "", c[2]] = c
    here = [c for c in last.values() if c[5] != "delete" and ip in (c[3] or [])]
    rank = {"Pod": 0, "Node": 1}
    return min(here, key=lambda c: (rank.get(c[0], 2), c[4], c[2]), default=(None,) * 7)


@pytest.mark.parametrize("seed,per_range", [(1, 10**6), (2, 60)])
def test_inventory_as_of(spark, seed, per_range):
    rng = random.Random(seed)
    changes = []
    for v in range(0, 400, 2):
        kind, name = rng.choice(["Pod", "Pod", "Node", "Service"]), f"o{rng.randrange(12)}"
        op = "snapshot" if v in (120, 300) else rng.choice(["add", "update", "update", "delete"])
        changes.append((kind, rng.choice(["ns", None]), name, rng.choice([None, [], ["a", "a"], ["a", "b"], ["b"], ["c", None]]), v, op, f"w{v}"))
        if op == "snapshot":  # of three objects at once
            changes += [("Pod", "ns", f"s{i}", [rng.choice("abc")], v, op, f"x{v}-{i}") for i in range(2)]
    changes += [("Pod", "ns", None, ["a"], 5, "add", "no name"), ("Pod", "ns", "late", ["a"], None, "add", "no version"), ("Pod", "ns", "twice", ["c"], 50, "add", "first"), ("Pod", "ns", "twice", ["c"], 50, "update", "second")]
    flows = [(i, rng.choice(["a", "a", "b", "c", "d", None]), rng.choice([None, -5, *range(0, 410)])) for i in range(250)]
    df = spark.createDataFrame(flows, "id int, ip string, t long").repartition(3)
    out = enrich.add_kubernetes_as_of(df, "ip", "t", "Src", spark.createDataFrame(changes, CHANGES).repartition(2), rows_per_range=per_range)
    assert out.columns[:3] == df.columns and "Src_Name" in out.columns
    known = [c for c in changes if c[2] is not None]
    want = {i: (None, None) if ip is None or t is None else plain_as_of(known, ip, t)[2:7:4] for i, ip, t in flows}
    assert {r["id"]: (r["Src_Name"], r["Src_OwnerName"]) for r in out.collect()} == want
    assert len({w for w in want.values()}) >= 15


def test_as_of_equals_the_latest_inventory(spark):
    """After all changes it says what add_kubernetes says of the current objects."""
    rng = random.Random(7)
    changes = spark.createDataFrame([(rng.choice(["Pod", "Node"]), "ns", f"o{rng.randrange(9)}", [rng.choice("abcd")], v, rng.choice(["update", "update", "delete"]), f"w{v}") for v in range(60)], CHANGES)
    df = spark.createDataFrame([(x, 1000) for x in "abcde"], "ip string, t long")
    shown = lambda out: sorted(map(repr, out.select("ip", "Src_Name", "Src_Type", "Src_OwnerName").collect()))
    assert shown(enrich.add_kubernetes_as_of(df, "ip", "t", "Src", changes)) == shown(enrich.add_kubernetes(df, "ip", "Src", inventory.latest(changes)))
    assert {r["Src_Name"] for r in enrich.add_kubernetes_as_of(df, "ip", "t", "Src", changes.limit(0)).collect()} == {None}
