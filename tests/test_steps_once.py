"""What a query derives is made once: networks of a record, text of an address, tables from the flows."""

import ipaddress
import random

from pyspark.sql import functions as F

from flowloom.functions import net
from flowloom.operators import enrich, inventory
from flowloom.operators.intervals import disjoint
from flowloom.plans import queries as q
from flowloom.sources import flows as src

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ip6_text_without_patterns(spark):
    rng = random.Random(3)
    digits = ["".join(rng.choice(["0000", "0000", "00a0", "1fff"]) for _ in range(8)) for _ in range(400)] + ["0" * 32, "f" * 32, "0" * 31 + "1"]
    df = spark.createDataFrame([(d,) for d in digits], "d string").select("d", net.hex_to_ip6(F.col("d")).alias("t"))
    # Python also shortens one lone group never, and the first of the longest runs
    assert all(r["t"] == str(ipaddress.IPv6Address(int(r["d"], 16))) for r in df.collect())
    assert "RLIKE" not in plan(df)


def test_secondary_keys_parse_once(spark):
    df = spark.createDataFrame([('[{"name":"n","interface":"e","ips":["1.1.1.1","1.1.1.1"],"mac":"A"}]',)], "s string")
    df = df.select(inventory.multus_networks(F.col("s"), [["interface", "ip"], ["mac"]]).alias("m"))
    assert df.first()["m"] == {"e~1.1.1.1~": "n", "~~a": "n"}
    assert plan(df.select("m")).count("from_json") + plan(df).count("jsontostructs") <= 1


def test_tables_from_flows_do_not_run_them_again(spark):
    flows = src.flows(spark, SF)
    for made in (q._inventory(flows), q._nested(flows)):
        assert "l_orderkey" not in plan(made)


def test_swept_values_of_any_type(spark):
    """Maps within structs, over several batches, with a range that lies around all of them."""
    rows = spark.range(25_000).select((F.col("id") * 10).alias("low"), (F.col("id") * 10 + 5).alias("high"), F.lit(1).alias("by"), F.struct(F.create_map(F.lit("k"), F.col("id").cast("string")).alias("m")).alias("v"))
    rows = rows.unionByName(spark.range(1).select(F.lit(0).cast("long").alias("low"), F.lit(250_000).cast("long").alias("high"), F.lit(2).alias("by"), F.struct(F.create_map(F.lit("k"), F.lit("all")).alias("m")).alias("v")))
    got = disjoint(rows, [], ["by"], "v").select("low", "high", F.col("v.m")["k"].alias("k")).collect()
    assert len(got) == 50_000 and all(r["k"] == (str(r["low"] // 10) if r["low"] % 10 == 0 else "all") for r in got)


def test_addresses_are_split_once(spark):
    """The text is taken apart outside the CASE, where Spark shares it; what is no address is NULL, also beyond any number."""
    texts = ["1.2.3.4", "255.255.255.255", "0.0.0.0", "256.1.1.1", "1.2.3", "1.2.3.4.5", "9" * 20 + ".1.1.1", "2147483648.1.1.1", "", None, "a.b.c.d", "01.2.3.4", "1..2.3", "::1", " 1.2.3.4", "+1.2.3.4"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", net.ip_to_long(F.col("t")).alias("n"))
    want = {"1.2.3.4": 16909060, "255.255.255.255": 2**32 - 1, "0.0.0.0": 0}
    assert {r["t"]: r["n"] for r in df.collect()} == {t: want.get(t) for t in texts}
    assert "THEN 0 END" in plan(df) and "split" not in plan(df).split("CASE")[1].split("END")[0]


def test_inventory_as_of_is_swept_once(spark):
    """The join in ranges of time reads the segments several times; they are written, not swept again. A column without a type is NULL."""
    changes = spark.createDataFrame([("Pod", "ns", "a", 5, "update", ["1.1.1.1"]), ("Pod", "ns", "a", 9, "delete", ["1.1.1.1"])], "kind string, namespace string, name string, version long, op string, ips array<string>").withColumn("host_ip", F.lit(None))
    flows = spark.createDataFrame([(i, "1.1.1.1") for i in range(4, 11)], "t long, ip string")
    out = enrich.add_kubernetes_as_of(flows, "ip", "t", "Src", changes)
    assert "MapInArrow" not in plan(out)
    assert sorted((r["t"], r["Src_Name"], r["Src_HostIP"]) for r in out.collect()) == [(t, "a" if 5 <= t < 9 else None, None) for t in range(4, 11)]
