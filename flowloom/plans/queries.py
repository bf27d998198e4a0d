"""The registered queries of the flow operators, each with its DuckDB SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import net
from flowloom.functions import predicates as P
from flowloom.functions.coerce import go_str, to_bool, to_double, to_int
from flowloom.functions.storage import shared_dir, staged
from flowloom.operators import aggregate as agg
from flowloom.operators import conntrack, enrich, filters, generic, inventory, metrics, topk, walk
from flowloom.operators.counts import Counts
from flowloom.plans import library, query_text
from flowloom.plans.pipeline import Flow, Pipeline
from flowloom.sources import flows as src
from flowloom.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_FLOWS = f"WITH flows AS ({src.FLOWS_SQL})"
_SESSIONS = f"WITH flows AS ({src.SESSIONS_SQL})"
_ID = "flow_id, line, SrcPort"  # rows of flows are shown by these


def query(name: str, sql: str | None = None, sessions: bool = False):
    """Register fn(flows) under name; {flows} stands first in its SQL."""

    def register(fn):
        source = src.session_flows if sessions else src.flows
        QUERIES[name] = lambda spark, sf_dir: fn(source(spark, sf_dir))
        if sql:
            SQL[name] = (_SESSIONS if sessions else _FLOWS) + ("" if sql.lstrip().startswith(",") else " ") + sql
        return fn

    return register


def _quad(v: str) -> str:
    """DuckDB: the parts of a dotted address as number."""
    return f"(split_part({v},'.',1)::BIGINT*16777216+split_part({v},'.',2)::BIGINT*65536+split_part({v},'.',3)::BIGINT*256+split_part({v},'.',4)::BIGINT)"


# ---- flagship, projections, coercion


@query("l3_bandwidth_per_src_subnet", "SELECT SrcSubnet, sum(Bytes)::DOUBLE AS total_value, count(*) AS total_count FROM (SELECT Bytes, concat(split_part(SrcAddr,'.',1),'.',split_part(SrcAddr,'.',2),'.0.0/16') AS SrcSubnet FROM flows) GROUP BY 1 ORDER BY total_value DESC, SrcSubnet LIMIT 10")
def bandwidth_top(f):
    renamed = generic.generic(f, [{"input": "SrcAddr", "output": "Src"}, {"input": "Bytes", "output": "Bytes"}], "replace_keys")
    found = library.by_subnets(renamed.withColumnRenamed("Src", "SrcAddr"), {"SrcAddr": 16}, "sum", "Bytes")
    return found.orderBy(F.desc("total_value"), "SrcAddrSubnet").limit(10).select(F.col("SrcAddrSubnet").alias("SrcSubnet"), "total_value", "total_count")


@query("p1_replace_keys", f"SELECT {_ID}, SrcAddr AS source, Bytes AS size, NULL::INTEGER AS nothing FROM flows")
def p1(f):
    rules = [{"input": c, "output": o} for c, o in (("flow_id", "flow_id"), ("line", "line"), ("SrcPort", "SrcPort"), ("SrcAddr", "source"), ("Bytes", "size"))]
    return generic.generic(f, rules, "replace_keys").withColumn("nothing", F.lit(None).cast("int"))


@query("p2_swap_and_scale", f"SELECT {_ID}, DstAddr AS SrcAddr, SrcAddr AS DstAddr, coalesce(Flags, DstPort) AS DstPort, Bytes*8 AS Bits FROM flows")
def p2(f):
    rules = [{"input": "SrcAddr", "output": "DstAddr"}, {"input": "DstAddr", "output": "SrcAddr"}, {"input": "Flags", "output": "DstPort"}, {"input": "Bytes", "output": "Bits", "multiplier": 8}, {"input": "SrcAddr", "output": "none", "multiplier": 3}]
    return generic.generic(f, rules).select("flow_id", "line", "SrcPort", "SrcAddr", "DstAddr", "DstPort", "Bits")


@query("d_coercions", f"SELECT {_ID}, (Bytes/4)::VARCHAR AS ignored, CASE WHEN Bytes%4=0 THEN (Bytes//4)::VARCHAR ELSE rtrim(printf('%.6f', Bytes/4.0),'0') END AS as_text, trunc(Bytes/4.0)::BIGINT AS as_int, NULL::BIGINT AS text_int, Duplicate AS as_bool, Bytes::DOUBLE AS as_double FROM flows")
def coercions(f):
    f = f.withColumn("q", F.col("Bytes") / 4)
    return f.select("flow_id", "line", "SrcPort", F.col("q").cast("string").alias("ignored"), go_str(f, "q").alias("as_text"), to_int(f, "q").alias("as_int"), to_int(f, "SrcAddr").alias("text_int"), to_bool(f, "Duplicate").alias("as_bool"), to_double(f, "Bytes").alias("as_double"))


SQL["d_coercions"] = SQL["d_coercions"].replace("(Bytes/4)::VARCHAR AS ignored", "CASE WHEN Bytes%4=0 THEN concat((Bytes//4)::VARCHAR,'.0') ELSE rtrim(printf('%.6f', Bytes/4.0),'0') END AS ignored")


# ---- predicates and filters


@query("q1_q9_predicates", f"""SELECT {_ID}, SrcAddr='10.1.1.1' AS q1, false AS q1_typed, Proto::VARCHAR='6' AS q2, SrcAddr<>'10.1.1.1' AS q3, concat(SrcAddr,':',DstPort::VARCHAR)=concat('10.1.1.7:',DstPort::VARCHAR) AS q4,
 coalesce(Flags=16,false) AS q5, coalesce(Flags<>16,false) AS q5_not, coalesce(Flags>=17,false) AS q6, SrcAddr LIKE '%1.1%' AND regexp_matches(SrcAddr,'\\.1\\.1') AS q7, NOT regexp_matches(SrcAddr,'\\.1\\.1') AS q8, Flags IS NOT NULL AS q9, true AS q9_missing FROM flows""")
def predicates(f):
    g = f.withColumn("pair", F.concat_ws(":", "SrcAddr", "DstPort"))
    return g.select(
        "flow_id", "line", "SrcPort", P.equal(g, "SrcAddr", "10.1.1.1").alias("q1"), P.equal(g, "Proto", "6").alias("q1_typed"), P.equal(g, "Proto", "6", as_text=True).alias("q2"), P.not_equal(g, "SrcAddr", "10.1.1.1").alias("q3"),
        P.equal(g, "pair", "10.1.1.7:$(DstPort)").alias("q4"), P.compare(g, "Flags", "=", 16).alias("q5"), P.compare(g, "Flags", "!=", 16).alias("q5_not"), P.compare(g, "Flags", ">=", 17).alias("q6"),
        P.matches(g, "SrcAddr", r"\.1\.1").alias("q7"), P.not_matches(g, "SrcAddr", r"\.1\.1").alias("q8"), P.present(g, "Flags").alias("q9"), P.absent(g, "nowhere").alias("q9_missing"),
    )


@query("q10_filter_query", f"SELECT {_ID}, Bytes FROM flows WHERE (regexp_matches(SrcAddr,'^10\\.1\\.') OR Flags IS NULL) AND (Bytes>2000 OR DstPort=53) AND (Proto<>17 OR NOT regexp_matches(DstAddr,'^20\\.0'))")
def q10(f):
    return query_text.filter_query(f, '(SrcAddr =~ `^10\\.1\\.` or without(Flags)) and Bytes > 2000 or DstPort = 53 AND Proto != 17 OR DstAddr !~ "^20\\\\.0"').select("flow_id", "line", "SrcPort", "Bytes")


@query("f1_keep_and_remove", f"SELECT {_ID}, DstPort, Bytes, Packets FROM flows WHERE (Proto=6 OR DstPort=53) AND Flags IS NOT NULL AND DstPort<>22 AND (Packets=10 OR Packets<20 OR Packets>30 OR Packets IS NULL OR true) AND NOT (DstPort=80 AND Proto=6)")
def f1(f):
    rules = [
        {"type": "remove_entry_if_doesnt_exist", "input": "Flags"}, {"type": "remove_entry_if_equal", "input": "DstPort", "value": 22}, {"type": "remove_entry_if_exists", "input": "nowhere"},
        {"type": "remove_entry_all_satisfied", "rules": [{"type": "remove_entry_if_equal", "input": "DstPort", "value": 80}, {"type": "remove_entry_if_equal", "input": "Proto", "value": 6}]},
        {"type": "keep_entry_query", "query": "Proto = 6"}, {"type": "keep_entry_query", "query": "DstPort = 53"}, {"type": "remove_field", "input": "SrcAddr"},
    ]
    return filters.transform_filter(f, rules).select("flow_id", "line", "SrcPort", "DstPort", "Bytes", "Packets")


@query("f6_remove_not_equal", f"SELECT {_ID}, Flags FROM flows WHERE Flags=16 OR Flags IS NULL")
def f6(f):
    return filters.transform_filter(f, [{"type": "remove_entry_if_not_equal", "input": "Flags", "value": 16.0, "cast_int": True}]).select("flow_id", "line", "SrcPort", "Flags")


@query("f2_keep_sampling", f", x AS (SELECT *, flow_id*10+line AS k FROM flows), y AS (SELECT *, CASE WHEN Proto=6 AND k%10=0 THEN 1 WHEN Flags IS NOT NULL AND (k+1)%5=0 THEN 2 WHEN DstPort=53 THEN 3 END AS r FROM x) SELECT {_ID}, CASE r WHEN 1 THEN 10 WHEN 2 THEN 5 END::BIGINT AS Sampling FROM y WHERE r IS NOT NULL")
def f2(f):
    rules = [{"type": "keep_entry_query", "query": "Proto = 6", "sampling": 10}, {"type": "keep_entry_query", "query": "with(Flags)", "sampling": 5}, {"type": "keep_entry_query", "query": "DstPort = 53"}]
    return filters.transform_filter(f, rules, F.col("flow_id") * 10 + F.col("line"), "Sampling").select("flow_id", "line", "SrcPort", "Sampling")


@query("f8_conditional_sampling", f"SELECT {_ID}, Proto FROM flows WHERE Proto<>17 OR (flow_id*10+line)%4=0")
def f8(f):
    rules = [{"rules": [{"type": "remove_entry_if_equal", "input": "Proto", "value": 17}], "value": 4}, {"rules": [{"type": "remove_entry_if_exists", "input": "Flags"}], "value": 1}]
    return filters.transform_filter(f, [{"type": "conditional_sampling", "rules": rules}], F.col("flow_id") * 10 + F.col("line")).select("flow_id", "line", "SrcPort", "Proto")


@query("f9_f12_derive", f"""SELECT {_ID}, 'edge' AS site, coalesce(Flags,0) AS Flags, CASE WHEN regexp_matches(SrcAddr,'^10\\.[01]\\.') THEN SrcAddr END AS near, CASE WHEN regexp_matches(SrcAddr,'^10\\.[01]\\.') THEN true END AS near_Matched,
 CASE WHEN Bytes>=4000 THEN 'large' WHEN Bytes>2000 THEN 'medium' END AS size, CASE WHEN Bytes>2000 THEN true END AS size_Evaluate, CASE WHEN DstPort=53 THEN 'app=dns,tier=1' ELSE 'tier=1' END AS labels FROM flows""")
def f9(f):
    rules = [
        {"type": "add_field", "input": "site", "value": "edge"}, {"type": "add_field_if_doesnt_exist", "input": "Flags", "value": 0}, {"type": "add_regex_if", "input": "SrcAddr", "parameters": r"^10\.[01]\.", "output": "near"},
        {"type": "add_field_if", "input": "Bytes", "parameters": ">2000", "output": "size", "assignee": "medium"}, {"type": "add_field_if", "input": "Bytes", "parameters": ">=4000", "output": "size", "assignee": "large"},
        {"type": "add_label", "input": "tier", "value": 1}, {"type": "add_label_if", "input": "DstPort", "parameters": "==53", "output": "app", "assignee": "dns"},
    ]
    return filters.transform_filter(f, rules).select("flow_id", "line", "SrcPort", "site", "Flags", "near", "near_Matched", "size", "size_Evaluate", "labels")


# ---- enrichment

LABELS = [{"name": "edge", "cidrs": ["10.1.0.0/18", "20.1.7.0/24"]}, {"name": "lab", "cidrs": ["10.1.0.0/16"]}, {"name": "all", "cidrs": ["10.0.0.0/7"]}]
#: The protocols and services that the queries know.
PROTOCOLS = ["icmp 1 ICMP # control", "tcp 6 TCP", "udp 17 UDP", "# nothing"]
SERVICES = ["ssh 22/tcp", "http 80/tcp www", "https 443/tcp", "https 443/udp", "domain 53/tcp", "domain 53/udp", "ms-sql-s 1433/tcp", "ms-sql-m 1433/udp"]


def _dimensions(f: DataFrame) -> tuple[DataFrame, DataFrame]:
    lines = lambda xs: f.sparkSession.createDataFrame([(x,) for x in xs], "value string").coalesce(1)
    return enrich.parse_protocols(lines(PROTOCOLS)), enrich.parse_services(lines(SERVICES))


_SERVICE = """CASE WHEN Proto=1 THEN '' WHEN DstPort=22 THEN CASE WHEN Proto=6 THEN 'ssh' ELSE '' END WHEN DstPort=80 THEN CASE WHEN Proto=6 THEN 'http' ELSE '' END WHEN DstPort=443 THEN 'https' WHEN DstPort=53 THEN 'domain'
 WHEN DstPort=1433 THEN CASE WHEN Proto=6 THEN 'ms-sql-s' ELSE 'ms-sql-m' END ELSE '' END"""


@query("n1_add_subnet", f"SELECT {_ID}, concat(regexp_extract(SrcAddr,'^\\d+\\.\\d+'),'.0.0/16') AS s16, concat(regexp_extract(SrcAddr,'^\\d+\\.\\d+\\.\\d+'),'.0/24') AS s24, concat(regexp_extract(SrcAddr,'^\\d+\\.\\d+\\.\\d+'),'.',(split_part(SrcAddr,'.',4)::BIGINT//64*64)::VARCHAR,'/26') AS s26, NULL::VARCHAR AS none FROM flows")
def n1(f):
    a = F.col("SrcAddr")
    return f.select("flow_id", "line", "SrcPort", net.subnet(a, 16).alias("s16"), net.subnet(a, 24).alias("s24"), net.subnet(a, 26).alias("s26"), net.subnet(F.concat(a, F.lit(".1")), 16).alias("none"))


@query("n2_subnet_label", f"SELECT {_ID}, CASE WHEN SrcAddr LIKE '10.1.%' AND split_part(SrcAddr,'.',3)::INT<64 THEN 'edge' WHEN SrcAddr LIKE '10.1.%' THEN 'lab' ELSE 'all' END AS SrcLabel, CASE WHEN DstAddr LIKE '20.1.7.%' THEN 'edge' END AS DstLabel FROM flows")
def n2(f):
    out = enrich.add_subnet_label(f, "SrcAddr", "SrcLabel", LABELS)
    return enrich.add_subnet_label(out, "DstAddr", "DstLabel", LABELS).select("flow_id", "line", "SrcPort", "SrcLabel", "DstLabel")


#: Addresses of both families from the flows' own: IPv6, IPv4 within IPv6, broken text.
_SIX = """CASE line%4 WHEN 0 THEN concat('2001:DB8:',lower(to_hex(split_part(SrcAddr,'.',2)::INT)),'::',lower(to_hex(split_part(SrcAddr,'.',4)::INT))) WHEN 1 THEN concat('::ffff:',SrcAddr) WHEN 2 THEN concat(SrcAddr,':80') ELSE 'fe80::1' END"""


def _six(f: DataFrame):
    part = lambda i: F.lower(F.hex(F.split_part("SrcAddr", F.lit("."), F.lit(i)).cast("int")))
    line = F.col("line") % 4
    return F.when(line == 0, F.concat(F.lit("2001:DB8:"), part(2), F.lit("::"), part(4))).when(line == 1, F.concat(F.lit("::ffff:"), "SrcAddr")).when(line == 2, F.concat("SrcAddr", F.lit(":80"))).otherwise("fe80::1")


@query("n2_subnet_label_v6", f"""SELECT {_ID}, {_SIX} AS addr, CASE line%4 WHEN 0 THEN CASE WHEN SrcAddr LIKE '10.1.%' THEN 'site-1' ELSE 'site' END WHEN 1 THEN CASE WHEN SrcAddr LIKE '10.1.%' THEN 'lab' ELSE 'rest' END WHEN 3 THEN 'link' END AS label FROM flows""")
def n2_v6(f):
    addr = _six(f)
    labels = [{"name": "site-1", "cidrs": ["2001:db8:1::/48"]}, {"name": "site", "cidrs": ["2001:db8::/32"]}, {"name": "lab", "cidrs": ["10.1.0.0/16"]}, {"name": "link", "cidrs": ["fe80::/10"]}, {"name": "rest", "cidrs": ["0.0.0.0/0"]}]
    return enrich.add_subnet_label(f.withColumn("addr", addr), "addr", "label", labels).select("flow_id", "line", "SrcPort", "addr", "label")


@query("n1_subnet_v6", f"""SELECT {_ID}, CASE line%4 WHEN 0 THEN concat('2001:db8:', CASE WHEN SrcAddr LIKE '10.0.%' THEN '' ELSE lower(to_hex(split_part(SrcAddr,'.',2)::INT)) END, CASE WHEN SrcAddr LIKE '10.0.%' THEN ':/48' ELSE '::/48' END) WHEN 1 THEN '::/48' WHEN 3 THEN 'fe80::/48' END AS s48,
 CASE line%4 WHEN 0 THEN '2001:c00::/22' WHEN 1 THEN '::/22' WHEN 3 THEN 'fe80::/22' END AS s22 FROM flows""")
def n1_v6(f):
    addr = _six(f)
    return f.select("flow_id", "line", "SrcPort", net.subnet(addr, 48, v6=True).alias("s48"), net.subnet(addr, 22, v6=True).alias("s22"))


@query("n3_add_service", f"SELECT {_ID}, {_SERVICE} AS service FROM flows")
def n3(f):
    return enrich.add_service(f, "DstPort", "Proto", "service", *_dimensions(f)).select("flow_id", "line", "SrcPort", "service")


def _ranges(f: DataFrame) -> DataFrame:
    """A location for each /18 that has flows, from their own addresses."""
    n = net.ip_to_long(F.col("DstAddr"))
    low = n - F.pmod(n, F.lit(16384))
    return f.select("DstAddr").distinct().select(low.alias("ip_from")).distinct().select(
        "ip_from", (F.col("ip_from") + 16383).alias("ip_to"), F.concat(F.lit("C"), F.shiftright("ip_from", 14) % 7).alias("country_short"), F.lit("Country").alias("country_long"), F.lit("R").alias("region"),
        F.concat(F.lit("City"), F.shiftright("ip_from", 14) % 5).alias("city"), (F.shiftright("ip_from", 14) % 90).cast("double").alias("latitude"), F.lit(1.5).alias("longitude"),
    )


_BLOCK = f"({_quad('DstAddr')} // 16384)"


@query("n4_add_location", f"SELECT {_ID}, concat('C',({_BLOCK}%7)::VARCHAR) AS Dst_CountryName, 'Country' AS Dst_CountryLongName, 'R' AS Dst_RegionName, concat('City',({_BLOCK}%5)::VARCHAR) AS Dst_CityName, printf('%.6f',({_BLOCK}%90)::DOUBLE) AS Dst_Latitude, '1.500000' AS Dst_Longitude FROM flows")
def n4(f):
    names = [f"Dst_{c}" for c in ("CountryName", "CountryLongName", "RegionName", "CityName", "Latitude", "Longitude")]
    return enrich.add_location(f, "DstAddr", "Dst", _ranges(f)).select("flow_id", "line", "SrcPort", *names)


def _nested(f: DataFrame) -> DataFrame:
    """Ranges in each other: all addresses, the /16s with an even second octet, /24s of a third one, and lone addresses."""
    n, part = net.ip_to_long(F.col("SrcAddr")), lambda i: F.split_part("SrcAddr", F.lit("."), F.lit(i)).cast("int")
    at = staged(f.select("SrcAddr").distinct(), "addresses")
    wide = lambda bits, name, rows: rows.select(F.shiftleft(F.shiftright(n, bits), bits).alias("ip_from"), (F.shiftleft(F.shiftright(n, bits), bits) + (1 << bits) - 1).alias("ip_to"), F.concat(F.lit(name), F.shiftright(n, bits).cast("string")).alias("place")).distinct()
    rows = [wide(32, "all-", at), wide(16, "b-", at.filter(part(2) % 2 == 0)), wide(8, "c-", at.filter(part(3) % 3 == 0)), wide(0, "d-", at.filter(part(4) % 5 == 0))]
    return reduce(DataFrame.unionByName, rows)


@query("n4_nested_ranges", f""", x AS (SELECT *, {_quad('SrcAddr')} AS n FROM flows) SELECT {_ID}, CASE WHEN split_part(SrcAddr,'.',4)::INT%5=0 THEN concat('d-',n::VARCHAR) WHEN split_part(SrcAddr,'.',3)::INT%3=0 THEN concat('c-',(n//256)::VARCHAR) WHEN split_part(SrcAddr,'.',2)::INT%2=0 THEN concat('b-',(n//65536)::VARCHAR) ELSE 'all-0' END AS place FROM x""")
def n4_nested(f):
    """Of ranges around an address the narrowest counts; a range over all addresses costs no more than any other."""
    return enrich.range_lookup(f, _nested(f), "SrcAddr", ["place"], F.col("ip_to") - F.col("ip_from")).select("flow_id", "line", "SrcPort", "place")


def _inventory(f: DataFrame) -> DataFrame:
    """Objects at the flows' own source addresses: pods, nodes and services by the last octet. Flows are run once for them."""
    at = staged(f.select("SrcAddr").distinct(), "addresses")
    part = lambda i: F.split_part("SrcAddr", F.lit("."), F.lit(i)).cast("int")
    kind = F.when(part(4) % 5 == 0, "Node").when(part(4) % 5 == 1, "Service").otherwise("Pod")
    node = F.concat(F.lit("node-"), part(2).cast("string"))
    rows = at.filter(part(4) % 7 != 0).select(
        kind.alias("kind"), F.concat(F.lit("ns-"), (part(3) % 10).cast("string")).alias("namespace"), F.when(kind == "Node", node).otherwise(F.concat(F.lit("obj-"), F.replace("SrcAddr", F.lit("."), F.lit("-")))).alias("name"),
        F.array("SrcAddr").alias("ips"), F.lit("Deployment").alias("owner_kind"), F.concat(F.lit("dep-"), (part(4) % 3).cast("string")).alias("owner_name"),
        F.concat(F.lit("192.168.0."), part(2).cast("string")).alias("host_ip"), F.when(kind == "Node", node).otherwise("").alias("host_name"), F.lit("primary").alias("network_name"),
        F.create_map(F.lit(inventory.ZONE), F.concat(F.lit("zone-"), part(2).cast("string")), F.lit("app"), F.concat(F.lit("application-"), part(3).cast("string"))).alias("labels"),
    )
    hosts = at.select(part(2).alias("n")).distinct().select(
        F.lit("Node").alias("kind"), F.lit("").alias("namespace"), F.concat(F.lit("node-"), F.col("n").cast("string")).alias("name"), F.array(F.concat(F.lit("192.168.0."), F.col("n").cast("string"))).alias("ips"),
        F.lit("Node").alias("owner_kind"), F.concat(F.lit("node-"), F.col("n").cast("string")).alias("owner_name"), F.concat(F.lit("192.168.0."), F.col("n").cast("string")).alias("host_ip"),
        F.concat(F.lit("node-"), F.col("n").cast("string")).alias("host_name"), F.lit("primary").alias("network_name"),
        F.create_map(F.lit(inventory.ZONE), F.concat(F.lit("zone-"), F.col("n").cast("string")), F.lit("app"), F.lit("host")).alias("labels"),
    )
    return inventory.with_hosts(rows.unionByName(hosts))


_K8S = """SELECT *, split_part(SrcAddr,'.',2)::INT AS o2, split_part(SrcAddr,'.',3)::INT AS o3, split_part(SrcAddr,'.',4)::INT AS o4 FROM flows"""


@query("n5_add_kubernetes", f""", x AS ({_K8S}) SELECT {_ID}, CASE WHEN o4%7<>0 THEN concat('ns-',(o3%10)::VARCHAR) END AS Src_Namespace,
 CASE WHEN o4%7<>0 THEN CASE WHEN o4%5=0 THEN concat('node-',o2::VARCHAR) ELSE concat('obj-',replace(SrcAddr,'.','-')) END END AS Src_Name,
 CASE WHEN o4%7<>0 THEN CASE o4%5 WHEN 0 THEN 'Node' WHEN 1 THEN 'Service' ELSE 'Pod' END END AS Src_Type, CASE WHEN o4%7<>0 THEN concat('dep-',(o4%3)::VARCHAR) END AS Src_OwnerName,
 CASE WHEN o4%7<>0 AND o4%5<>1 THEN concat('node-',o2::VARCHAR) END AS Src_HostName, CASE WHEN o4%7<>0 AND o4%5<>1 THEN concat('zone-',o2::VARCHAR) END AS Src_Zone FROM x""")
def n5(f):
    return enrich.add_kubernetes(f, "SrcAddr", "Src", _inventory(f), zone=True).select("flow_id", "line", "SrcPort", "Src_Namespace", "Src_Name", "Src_Type", "Src_OwnerName", "Src_HostName", "Src_Zone")


#: Two pods and a node at each address, and two objects for each secondary key; versions decide.
_SHARED = """, x AS (SELECT *, split_part(SrcAddr,'.',3)::INT AS o3, split_part(SrcAddr,'.',4)::INT AS o4 FROM flows)"""


@query("n5_shared_addresses", _SHARED + f""" SELECT {_ID}, CASE WHEN line%3=0 AND o4%2=0 THEN concat('key-late-',SrcAddr) ELSE concat('zz-',SrcAddr) END AS Src_Name, CASE WHEN line%3=0 AND o4%2=0 THEN 'blue' ELSE 'primary' END AS Src_NetworkName,
 CASE WHEN line%3=0 AND o4%2=0 THEN NULL ELSE concat('a_note=n',o3::VARCHAR) END AS notes FROM x""")
def n5_shared(f):
    part = lambda i: F.split_part("SrcAddr", F.lit("."), F.lit(i)).cast("int")
    at = staged(f.select("SrcAddr").distinct(), "addresses")
    none = F.create_map().cast("map<string,string>")
    key = F.concat(F.lit("blue~"), "SrcAddr")

    def objects(kind: str, name: str, version: int, ips, keys, names, notes):
        return at.select(
            F.lit(kind).alias("kind"), F.lit("ns").alias("namespace"), F.concat(F.lit(name), "SrcAddr").alias("name"), ips.alias("ips"), F.lit("primary").alias("network_name"), F.lit("h").alias("host_name"),
            F.lit("192.168.0.1").alias("host_ip"), F.lit(None).cast("string").alias("owner_kind"), F.lit(None).cast("string").alias("owner_name"), F.lit(version).alias("version"), keys.alias("secondary_net_keys"),
            names.alias("secondary_net_names"), notes.alias("annotations"),
        )

    here, no_keys, no_ips = F.array("SrcAddr"), F.array().cast("array<string>"), F.array().cast("array<string>")
    note = F.create_map(F.lit("note"), F.concat(F.lit("n"), part(3).cast("string")), F.lit("secret"), F.lit("s"))
    rows = [
        objects("Pod", "zz-", 1, here, no_keys, none, note), objects("Pod", "aa-", 2, here, no_keys, none, none), objects("Node", "node-", 0, here, no_keys, none, none),
        objects("Pod", "key-early-", 1, no_ips, F.array(key), F.create_map(key, F.lit("red")), none), objects("Pod", "key-late-", 5, no_ips, F.array(key), F.create_map(key, F.lit("blue")), none),
    ]
    held = reduce(DataFrame.unionByName, rows)
    keys = F.when((F.col("line") % 3 == 0) & (part(4) % 2 == 0), F.array(F.lit("none~0"), key))
    out = enrich.add_kubernetes(f.withColumn("keys", keys), "SrcAddr", "Src", held, ["keys"], annotations_prefix="a", annotation_rules={"exclude": ["secret"]})
    notes = F.nullif(F.array_join(F.transform(F.map_entries("Src_annotations"), lambda e: F.concat_ws("=", e["key"], e["value"])), ","), F.lit(""))
    return out.select("flow_id", "line", "SrcPort", "Src_Name", "Src_NetworkName", notes.alias("notes"))


@query("n8_labels", f", x AS ({_K8S}) SELECT {_ID}, CASE WHEN o4%7<>0 THEN concat('k_app=appl...') END AS labels FROM x")
def n8(f):
    out = enrich.add_kubernetes(f, "SrcAddr", "Src", _inventory(f), labels_prefix="k")
    short = enrich.filter_labels(F.col("Src_labels"), exclude=[f"k_{inventory.ZONE}"], most=7)
    return out.select("flow_id", "line", "SrcPort", F.array_join(F.transform(F.map_entries(short), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("labels"))


@query("n9_otel_names", f""", x AS ({_K8S}) SELECT {_ID}, CASE WHEN o4%7<>0 THEN concat('ns-',(o3%10)::VARCHAR) END AS source_namespace, CASE WHEN o4%7<>0 AND o4%5>1 THEN concat('obj-',replace(SrcAddr,'.','-')) END AS source_pod FROM x""")
def n9(f):
    out = enrich.otel_names(enrich.add_kubernetes(f, "SrcAddr", "Src", _inventory(f)), "Src", "source.")
    return out.select("flow_id", "line", "SrcPort", F.col("`source.k8s.namespace.name`").alias("source_namespace"), F.col("`source.k8s.pod.name`").alias("source_pod"))


@query("n10_owner_chain", "SELECT DISTINCT DstAddr AS name, 'Deployment' AS owner_kind, concat('dep-',split_part(DstAddr,'.',3)) AS owner_name, CASE WHEN split_part(DstAddr,'.',3)::INT%2=0 THEN 'Gateway' ELSE 'Deployment' END AS top_kind FROM flows")
def n10(f):
    app = F.split_part("DstAddr", F.lit("."), F.lit(3))
    pods = f.select("DstAddr").distinct().select(F.lit("ns").alias("namespace"), F.col("DstAddr").alias("name"), F.lit("ReplicaSet").alias("owner_kind"), F.concat(F.lit("rs-"), app).alias("owner_name"))
    apps = f.select(app.alias("app")).distinct()
    one = lambda k, n, pk, pn: apps.select(F.lit(k).alias("kind"), F.lit("ns").alias("namespace"), F.concat(F.lit(n), "app").alias("name"), F.lit(pk).alias("owner_kind"), F.concat(F.lit(pn), "app").alias("owner_name"))
    owners = one("ReplicaSet", "rs-", "Deployment", "dep-").unionByName(one("Deployment", "dep-", "Gateway", "gw-").filter(F.regexp_extract("name", r"\d+", 0).cast("int") % 2 == 0))
    top = inventory.climb_owners(pods, owners, ["Deployment", "Gateway"]).select("name", F.col("owner_kind").alias("top_kind"))
    return inventory.climb_owners(pods, owners).join(top, "name").select("name", "owner_kind", "owner_name", "top_kind")


@query("n11_n13_inventory_build", """, p AS (SELECT DISTINCT SrcAddr, split_part(SrcAddr,'.',3)::INT AS o3, split_part(SrcAddr,'.',4)::INT AS o4 FROM flows)
 SELECT 'Pod' AS kind, SrcAddr AS name, CASE WHEN o4%2=0 THEN SrcAddr ELSE concat(SrcAddr,',9.9.9.9') END AS ips, CASE WHEN o4%3=0 THEN concat('rs-',o3::VARCHAR) ELSE SrcAddr END AS owner, NULL::VARCHAR AS host FROM p
 UNION ALL SELECT 'Node', SrcAddr, concat(SrcAddr,',2001:db8::1',CASE WHEN o4%4=0 THEN '' ELSE concat(',10.128.',o3::VARCHAR,'.2') END), NULL, SrcAddr FROM p
 UNION ALL SELECT 'Service', SrcAddr, CASE WHEN o4%2=0 THEN '' ELSE SrcAddr END, NULL, NULL FROM p""")
def inventory_build(f):
    part = lambda i: F.split_part("SrcAddr", F.lit("."), F.lit(i)).cast("int")
    at, text = f.select("SrcAddr").distinct(), lambda i: part(i).cast("string")
    none, joined = F.lit(None).cast("string"), F.array_join("ips", ",")
    refs = F.when(part(4) % 3 == 0, F.array(F.struct(F.lit("ReplicaSet").alias("kind"), F.concat(F.lit("rs-"), text(3)).alias("name")))).otherwise(F.array().cast("array<struct<kind:string,name:string>>"))
    pods = inventory.pods(at.select(F.col("SrcAddr").alias("name"), F.array("SrcAddr", F.lit("9.9.9.9")).alias("pod_ips"), F.when(part(4) % 2 == 0, "9.9.9.9").alias("host_ip"), refs.alias("owner_refs")))
    subnet = F.when(part(4) % 4 == 1, F.format_string('{"default":["10.128.%d.0/23"]}', part(3))).when(part(4) % 4 > 1, F.format_string('{"default":"10.128.%d.0/23"}', part(3)))
    notes = F.create_map(F.lit("k8s.ovn.org/node-subnets"), subnet)
    nodes = inventory.nodes(at.select(F.col("SrcAddr").alias("name"), F.array(F.lit("host:80"), F.lit("999.1.1.1"), "SrcAddr", F.lit("2001:db8::1")).alias("addresses"), notes.alias("annotations")))
    services = inventory.services(at.select(F.col("SrcAddr").alias("name"), F.array(F.when(part(4) % 2 == 0, "None").otherwise(F.col("SrcAddr")), F.lit("")).alias("cluster_ips")))
    return (
        pods.select(F.lit("Pod").alias("kind"), "name", joined.alias("ips"), F.col("owner_name").alias("owner"), none.alias("host"))
        .unionByName(nodes.select(F.lit("Node").alias("kind"), "name", joined.alias("ips"), none.alias("owner"), F.col("host_ip").alias("host")))
        .unionByName(services.select(F.lit("Service").alias("kind"), "name", joined.alias("ips"), none.alias("owner"), none.alias("host")))
    )


@query("n14_n15_secondary_keys", f"SELECT {_ID}, concat('eth1~',SrcAddr,'~aa:bb') AS multus, concat('eth1~',SrcAddr,'~aa:bb=net1,~~aa:bb=net1') AS networks, CASE WHEN line=1 THEN NULL ELSE concat('eth0~',DstAddr,'~,eth9~',DstAddr,'~') END AS multus_flow, concat('blue~',SrcAddr,',ns/own~2.2.2.2') AS udn, concat('blue~',DstAddr) AS flow_side FROM flows")
def n14(f):
    status = F.format_string('[{"interface":"eth0","ips":["1.1.1.1"],"default":true},{"name":"net1","interface":"eth1","ips":["%s"],"mac":"AA:BB"},{"name":"net2","interface":"eth2"}]', "SrcAddr")
    nets = F.format_string('{"default":{"ip_address":"1.1.1.1/24","role":"primary"},"ns/blue":{"ip_address":"%s/24","role":"secondary"},"ns/own":{"ip_address":"2.2.2.2/24"}}', "SrcAddr")
    networks = F.transform(F.map_entries(inventory.multus_networks(status, [["interface", "ip", "mac"], ["mac"]])), lambda e: F.concat_ws("=", e["key"], e["value"]))
    flow_side = inventory.multus_flow_keys(["interface", "ip"], F.when(F.col("line") != 1, F.col("DstAddr")), None, F.array(F.lit("eth0"), F.lit("eth9")))
    return f.select("flow_id", "line", "SrcPort", F.get(inventory.multus_keys(status, ["interface", "ip", "mac"]), F.lit(0)).alias("multus"), F.array_join(F.array_sort(networks), ",").alias("networks"), F.array_join(flow_side, ",").alias("multus_flow"),
                    F.array_join(F.array_sort(inventory.udn_keys(nets, ["ns/own"], ["blue", "own"])), ",").alias("udn"),
                    F.array_join(inventory.flow_keys(F.array(F.lit(""), F.lit("default"), F.lit("blue")), F.col("DstAddr")), "").alias("flow_side"))


#: Pods that move between addresses while flows come: each flow is also a change of one pod, snapshots hold one pod alone.
_MOVES = """, c AS (SELECT flow_id, concat('pod-',(flow_id%61)::VARCHAR) AS name, CASE WHEN flow_id%61%4=0 THEN 'Node' ELSE 'Pod' END AS kind, concat('10.9.0.',(flow_id*7%50)::VARCHAR) AS ip, event_time AS v, CASE WHEN flow_id%997=0 THEN 'snapshot' WHEN Proto=17 THEN 'delete' ELSE 'update' END AS op, Bytes FROM flows),
 s AS (SELECT c.*, shots.v AS shot FROM c ASOF LEFT JOIN (SELECT v FROM c WHERE op='snapshot') shots ON c.v < shots.v),
 w AS (SELECT *, least(coalesce(lead(v) OVER (PARTITION BY kind, name ORDER BY v), TIMESTAMP '9999-01-01'), coalesce(shot, TIMESTAMP '9999-01-01')) AS high FROM s),
 t AS (SELECT flow_id, concat('10.9.0.',(flow_id*11%53)::VARCHAR) AS ip, event_time AS v FROM flows),
 h AS (SELECT t.flow_id, arg_min(w.kind, (CASE WHEN w.kind='Pod' THEN 0 ELSE 1 END, w.v, w.name)) AS kind, arg_min(w.name, (CASE WHEN w.kind='Pod' THEN 0 ELSE 1 END, w.v, w.name)) AS name, arg_min(concat('b-',w.Bytes::VARCHAR), (CASE WHEN w.kind='Pod' THEN 0 ELSE 1 END, w.v, w.name)) AS owner
   FROM t JOIN w ON t.ip=w.ip AND t.v>=w.v AND t.v<w.high AND w.op<>'delete' GROUP BY 1)"""


@query("n16_inventory_as_of", _MOVES + """ SELECT t.flow_id, t.ip, h.kind AS "Src_Type", h.name AS "Src_Name", h.owner AS "Src_OwnerName" FROM t LEFT JOIN h USING (flow_id)""", sessions=True)
def n16_as_of(f):
    """The object at a flow's address as it was at the flow's time."""
    n = F.col("flow_id")
    changes = f.select(
        F.when(n % 61 % 4 == 0, "Node").otherwise("Pod").alias("kind"), F.lit("ns").alias("namespace"), F.concat(F.lit("pod-"), (n % 61).cast("string")).alias("name"), F.array(F.concat(F.lit("10.9.0."), (n * 7 % 50).cast("string"))).alias("ips"),
        F.col("event_time").alias("version"), F.when(n % 997 == 0, "snapshot").when(F.col("Proto") == 17, "delete").otherwise("update").alias("op"), F.lit("Deployment").alias("owner_kind"), F.concat(F.lit("b-"), F.col("Bytes").cast("string")).alias("owner_name"),
    )
    flows = f.select("flow_id", F.concat(F.lit("10.9.0."), (n * 11 % 53).cast("string")).alias("ip"), "event_time")
    return enrich.add_kubernetes_as_of(flows, "ip", "event_time", "Src", changes).select("flow_id", "ip", "Src_Type", "Src_Name", "Src_OwnerName")


@query("n16_inventory", """, c AS (SELECT 'Pod' AS kind, 'ns' AS namespace, SrcAddr AS name, flow_id*10+line AS version, CASE WHEN DstPort=22 THEN 'delete' ELSE 'update' END AS op, DstAddr AS host FROM flows),
 s AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC, op DESC, host DESC) AS r FROM (SELECT name, version, max(op) AS op, max(host) AS host FROM c GROUP BY name, version)) SELECT name, version FROM s WHERE r=1 AND op<>'delete'""")
def n16(f):
    changes = f.select(F.lit("Pod").alias("kind"), F.lit("ns").alias("namespace"), F.col("SrcAddr").alias("name"), (F.col("flow_id") * 10 + F.col("line")).alias("version"), F.when(F.col("DstPort") == 22, "delete").otherwise("update").alias("op"), F.col("DstAddr").alias("host"))
    changes = changes.groupBy("kind", "namespace", "name", "version").agg(F.max("op").alias("op"), F.max("host").alias("host"))
    return inventory.latest(changes).select("name", "version")


@query("n17_infra", f", x AS ({_K8S}) SELECT {_ID}, CASE WHEN (o3%10) IN (1,2) OR (o3%10=3 AND o4=9) THEN 'infra' ELSE 'app' END AS layer FROM x")
def n17(f):
    part = lambda i: F.split_part("SrcAddr", F.lit("."), F.lit(i)).cast("int")
    ns, name = F.concat(F.lit("ns-"), (part(3) % 10).cast("string")), F.concat(F.lit("n"), part(4).cast("string"))
    return f.select("flow_id", "line", "SrcPort", net.infra_or_app([(ns, name)], ["ns-1", "ns-2"], [("ns-3", "n9")]).alias("layer"))


@query("n18_direction", f"SELECT {_ID}, CASE WHEN line=7 THEN 1 WHEN line%3=0 OR line%12=4 THEN 2 WHEN line%3=1 THEN 1 WHEN line%4=0 THEN 0 ELSE line%2 END AS direction FROM flows")
def n18(f):
    line = F.col("line")
    source = F.when(line % 3 == 0, "h").when(line % 3 == 1, "r").otherwise("x")
    target = F.when(line % 3 == 0, "h").when(line % 4 == 0, "r").otherwise("y")
    return f.select("flow_id", "line", "SrcPort", net.reinterpret_direction(F.when(line == 7, "").otherwise("r"), source, target, line % 2).alias("direction"))



@query("n19_n20_tcp_flags", f"""SELECT {_ID}, CASE Flags WHEN 2 THEN 'SYN' WHEN 256 THEN 'SYN_ACK' WHEN 16 THEN 'ACK' WHEN 24 THEN 'PSH,ACK' WHEN 17 THEN 'FIN,ACK' WHEN 512 THEN 'FIN_ACK' END AS names, Flags::BIGINT AS back FROM flows""")
def n19(f):
    names = net.decode_tcp_flags(F.col("Flags"))
    return f.select("flow_id", "line", "SrcPort", F.array_join(names, ",").alias("names"), net.encode_tcp_flags(names).alias("back"))


# ---- aggregates and top-K


@query("a1_a10_aggregates", """SELECT 'bytes' AS name, 'sum' AS op, concat(DstAddr,',',Proto::VARCHAR) AS aggregate, sum(Bytes)::DOUBLE AS total_value, count(*) AS total_count FROM flows GROUP BY 3
 UNION ALL SELECT 'flags_max','max', Proto::VARCHAR, greatest(0.0,max(Flags)), count(*) FROM flows GROUP BY 3 UNION ALL SELECT 'flags_min','min', Proto::VARCHAR, coalesce(min(Flags),1.7976931348623157e308), count(*) FROM flows GROUP BY 3
 UNION ALL SELECT 'avg','avg', Proto::VARCHAR, avg(Bytes), count(*) FROM flows GROUP BY 3 UNION ALL SELECT 'count','count', Flags::VARCHAR, count(*)::DOUBLE, count(*) FROM flows WHERE Flags IS NOT NULL GROUP BY 3""")
def aggregates(f):
    rules = [
        {"name": "bytes", "by": ["Proto", "DstAddr"], "operation": "sum", "key": "Bytes"}, {"name": "flags_max", "by": ["Proto"], "operation": "max", "key": "Flags"}, {"name": "flags_min", "by": ["Proto"], "operation": "min", "key": "Flags"},
        {"name": "avg", "by": ["Proto"], "operation": "avg", "key": "Bytes"}, {"name": "count", "by": ["Flags"], "operation": "count"},
    ]
    return agg.aggregates(f, rules).select("name", F.col("operation_type").alias("op"), "aggregate", "total_value", "total_count")


def _daily(f: DataFrame) -> DataFrame:
    """Values gathered by address and day, so that no list grows with the table."""
    rows = f.withColumn("day", F.date_format("event_time", "yyyy-MM-dd"))
    return agg.aggregate(rows, {"name": "raw", "by": ["DstAddr"], "operation": "raw_values", "key": "Bytes", "batch": "day"})


@query("a7_raw_values", "SELECT DstAddr, strftime(event_time,'%Y-%m-%d') AS day, list_sort(list(Bytes::DOUBLE))::VARCHAR AS vals, count(*) AS total_count FROM flows GROUP BY 1, 2")
def raw_values(f):
    out = _daily(f)
    return out.select("DstAddr", "day", F.concat(F.lit("["), F.array_join(F.sort_array("recent_raw_values"), ", "), F.lit("]")).alias("vals"), "total_count")


@query("a8_totals_and_recents", "SELECT DstAddr, sum(Bytes)::DOUBLE AS total_value, count(*) AS total_count, coalesce(sum(Bytes) FILTER (line>3),0)::DOUBLE AS recent_op_value, count(*) FILTER (line>3) AS recent_count FROM flows GROUP BY 1")
def totals(f):
    rule = {"name": "bytes", "by": ["DstAddr"], "operation": "sum", "key": "Bytes"}
    return agg.merge_totals(agg.aggregate(f.filter("line <= 3"), rule), agg.aggregate(f.filter("line > 3"), rule), rule).select("DstAddr", "total_value", "total_count", "recent_op_value", "recent_count")


@query("a9_expiry", "SELECT DstAddr, count(*) AS n FROM flows WHERE DstAddr IN (SELECT DstAddr FROM flows GROUP BY 1 HAVING max(event_time) >= TIMESTAMP '1998-10-01' - INTERVAL 90 DAY) GROUP BY 1")
def expiry(f):
    return agg.expire(f, ["DstAddr"], "event_time", F.lit("1998-10-01").cast("timestamp"), 90 * 86400).groupBy("DstAddr").agg(F.count("*").alias("n"))


def _top(op: str, value: str, where: str = "", order: str = "DESC", k: int = 10) -> str:
    return f"SELECT 'top' AS name, SrcAddr AS index_key, '{op}' AS operation, ({value})::DOUBLE AS Bytes, SrcAddr FROM flows {where} GROUP BY SrcAddr ORDER BY Bytes {order}, SrcAddr LIMIT {k}"


for _op, _value, _reversed in (("sum", "sum(Bytes)", False), ("avg", "avg(Bytes)", True), ("min", "min(Bytes)", False), ("max", "max(Bytes)", True), ("count", "count(Bytes)", False)):
    query(f"t7_topk_{_op}", _top(_op, _value, order="ASC" if _reversed else "DESC"))(
        lambda f, op=_op, r=_reversed: topk.timebased(f, {"name": "top", "index_keys": ["SrcAddr"], "operation": op, "key": "Bytes", "top_k": 10, "reversed": r}, "event_time")
    )


@query("t1_window_topk", _top("sum", "sum(Bytes)", "WHERE event_time >= TIMESTAMP '1998-06-01' - INTERVAL 180 DAY"))
def t1(f):
    return topk.timebased(f, {"name": "top", "index_keys": ["SrcAddr"], "operation": "sum", "key": "Bytes", "top_k": 10, "interval": "180 days"}, "event_time", F.lit("1998-06-01").cast("timestamp"))


@query("t5_last_and_diff", """, g AS (SELECT SrcAddr, SrcPort, arg_max(Bytes,(event_time,flow_id)) AS l, arg_max(Bytes,(event_time,flow_id))-arg_min(Bytes,(event_time,flow_id)) AS d FROM flows GROUP BY 1,2)
 SELECT concat(SrcAddr,',',SrcPort::VARCHAR) AS index_key, l::DOUBLE AS last, d::DOUBLE AS diff FROM g""", sessions=True)
def t5(f):
    rule = {"name": "x", "index_keys": ["SrcAddr", "SrcPort"], "key": "Bytes"}
    found = [topk.timebased(f, rule | {"operation": op}, "event_time", order=["flow_id"]).select("index_key", F.col("Bytes").alias(op)) for op in ("last", "diff")]
    return found[0].join(found[1], "index_key")


@query("t7_sliding_topk", """, w AS (SELECT *, unnest([time_bucket(INTERVAL 6 HOUR, event_time), time_bucket(INTERVAL 6 HOUR, event_time) - INTERVAL 6 HOUR]) AS window_start FROM flows), g AS (SELECT window_start, SrcAddr, sum(Bytes)::DOUBLE AS Bytes FROM w GROUP BY 1,2),
 r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY Bytes DESC, SrcAddr) AS n FROM g) SELECT window_start::VARCHAR AS window_start, SrcAddr, Bytes FROM r WHERE n<=3""", sessions=True)
def t7_sliding(f):
    rule = {"name": "x", "index_keys": ["SrcAddr"], "operation": "sum", "key": "Bytes", "top_k": 3, "interval": "12 hours", "slide": "6 hours"}
    return topk.timebased(f, rule, "event_time").select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "SrcAddr", "Bytes")


# ---- connections

TRACK = conntrack.DEFAULT | {
    "order": ["flow_id"], "groups": [{"selector": {"Proto": 17}, "end_timeout": 7200, "terminating_timeout": 600, "heartbeat": 3600}, {"selector": {}, "end_timeout": 14400, "terminating_timeout": 600, "heartbeat": 7200}], "flags": "Flags",
}
_TRACKED = """, g AS (SELECT *, least(concat(SrcAddr,':',SrcPort),concat(DstAddr,':',DstPort)) AS lo, greatest(concat(SrcAddr,':',SrcPort),concat(DstAddr,':',DstPort)) AS hi, concat(SrcAddr,':',SrcPort) AS a, CASE WHEN Proto=17 THEN 7200 ELSE 14400 END AS gap FROM flows WHERE Proto IN (6,17,132) AND NOT Duplicate),
 b AS (SELECT *, CASE WHEN epoch_us(event_time) - lag(epoch_us(event_time)) OVER (PARTITION BY Proto,lo,hi ORDER BY event_time,flow_id) <= gap::BIGINT*1000000 THEN 0 ELSE 1 END AS n FROM g),
 s AS (SELECT *, sum(n) OVER (PARTITION BY Proto,lo,hi ORDER BY event_time,flow_id) AS sid FROM b),
 e AS (SELECT Proto, lo, hi, sid, arg_min(a,(event_time,flow_id)) AS fa, arg_min(SrcAddr,(event_time,flow_id)) AS SrcAddr, arg_min(SrcPort,(event_time,flow_id)) AS SrcPort, arg_min(DstAddr,(event_time,flow_id)) AS DstAddr, sum(CASE WHEN a=lo THEN Bytes ELSE 0 END) AS bl, sum(CASE WHEN a<>lo THEN Bytes ELSE 0 END) AS bh, count(*) AS k, min(event_time) AS t0, max(event_time) AS t1,
   arg_min(Bytes,(event_time,flow_id)) AS b0 FROM s GROUP BY 1,2,3,4)"""


@query("c10_end_connection", _TRACKED + " SELECT Proto, SrcAddr, SrcPort::BIGINT AS SrcPort, DstAddr, nullif(CASE WHEN fa=lo THEN bl ELSE bh END,0)::DOUBLE AS Bytes_AB, nullif(CASE WHEN fa=lo THEN bh ELSE bl END,0)::DOUBLE AS Bytes_BA, k::DOUBLE AS numFlowLogs FROM e", sessions=True)
def c10(f):
    return conntrack.connections(f, TRACK).select("Proto", "SrcAddr", F.col("SrcPort").cast("bigint").alias("SrcPort"), "DstAddr", "Bytes_AB", "Bytes_BA", "numFlowLogs")


@query("c8_new_connection", _TRACKED + " SELECT Proto, SrcAddr, SrcPort::BIGINT AS SrcPort, DstAddr, nullif(b0,0)::DOUBLE AS Bytes_AB, true AS is_first FROM e", sessions=True)
def c8(f):
    return conntrack.new_connections(f, TRACK).select("Proto", "SrcAddr", F.col("SrcPort").cast("bigint").alias("SrcPort"), "DstAddr", "Bytes_AB", F.col("_IsFirst").alias("is_first"))


@query("c9_flow_logs", "SELECT flow_id, Proto, 'flowLog' AS kind FROM flows WHERE Proto IN (6,17,132)", sessions=True)
def c9(f):
    return conntrack.flow_logs(f, TRACK).select("flow_id", "Proto", F.col("_RecordType").alias("kind"))


#: The walk as recursion over each connection's flows: until is when it ends, fin the time of its first FIN.
_WALK = """, g AS (SELECT *, epoch_us(event_time)/1e6 AS t, least(concat(SrcAddr,':',SrcPort),concat(DstAddr,':',DstPort)) AS lo, greatest(concat(SrcAddr,':',SrcPort),concat(DstAddr,':',DstPort)) AS hi, concat(SrcAddr,':',SrcPort) AS a,
   CASE WHEN Proto=17 THEN 7200 ELSE 14400 END AS gap, CASE WHEN Proto=17 THEN 3600 ELSE 7200 END AS beat, (Flags & 1)=1 AS f FROM flows WHERE Proto IN (6,17,132) AND NOT Duplicate),
 k AS (SELECT *, row_number() OVER (PARTITION BY Proto,lo,hi ORDER BY t,flow_id) AS rn FROM g),
 w AS (SELECT Proto, lo, hi, rn, flow_id, t, 1 AS sid, CASE WHEN f THEN t+600 ELSE t+gap END AS till, CASE WHEN f THEN t END AS fin FROM k WHERE rn=1
   UNION ALL SELECT k.Proto, k.lo, k.hi, k.rn, k.flow_id, k.t, CASE WHEN k.t>w.till THEN w.sid+1 ELSE w.sid END,
     CASE WHEN k.t<=w.till AND w.fin IS NOT NULL THEN w.till WHEN k.f THEN k.t+600 ELSE k.t+k.gap END, CASE WHEN k.t<=w.till AND w.fin IS NOT NULL THEN w.fin WHEN k.f THEN k.t END
   FROM w JOIN k ON k.Proto=w.Proto AND k.lo=w.lo AND k.hi=w.hi AND k.rn=w.rn+1),
 r AS (SELECT k.*, w.sid, w.till, w.fin FROM k JOIN w USING (Proto, lo, hi, rn)),
 s AS (SELECT Proto, lo, hi, sid, arg_min(a,rn) AS fa, arg_min(SrcAddr,rn) AS SrcAddr, arg_min(SrcPort,rn)::BIGINT AS SrcPort, arg_min(DstAddr,rn) AS DstAddr, min(t) AS t0, arg_max(till,rn) AS till, max(fin) AS fin, max(beat) AS beat FROM r GROUP BY 1,2,3,4),
 d AS (SELECT *, 'newConnection' AS kind, t0 AS at FROM s UNION ALL SELECT *, 'heartbeat', unnest(list_transform(range(1, 1 + greatest(0, ceil((least(coalesce(fin, till), till) - t0)/beat)::BIGINT - 1)), lambda n: t0 + n*beat)) FROM s UNION ALL SELECT *, 'endConnection', till FROM s),
 e AS (SELECT d.kind, d.SrcAddr, d.SrcPort, d.DstAddr, d.Proto, d.at, d.fin, d.t0, d.till, sum(CASE WHEN r.a=d.fa THEN r.Bytes ELSE 0 END) AS ab, sum(CASE WHEN r.a<>d.fa THEN r.Bytes ELSE 0 END) AS ba, count(*) AS n
   FROM d JOIN r ON r.Proto=d.Proto AND r.lo=d.lo AND r.hi=d.hi AND r.sid=d.sid AND (r.t<=d.at AND (d.kind<>'newConnection' OR r.rn=(SELECT min(q.rn) FROM r q WHERE q.Proto=d.Proto AND q.lo=d.lo AND q.hi=d.hi AND q.sid=d.sid))) GROUP BY ALL)"""


@query("c11_c12_fin_and_heartbeat", _WALK.replace("WITH", "WITH RECURSIVE") + """ SELECT kind AS "_RecordType", kind='newConnection' AS "_IsFirst", SrcAddr, SrcPort, DstAddr, Proto, nullif(ab,0)::DOUBLE AS "Bytes_AB", nullif(ba,0)::DOUBLE AS "Bytes_BA", n::DOUBLE AS "numFlowLogs", e.at AS time FROM e""", sessions=True)
def c11(f):
    return walk.track(f, TRACK | {"detect_end": True}).select("_RecordType", "_IsFirst", "SrcAddr", F.col("SrcPort").cast("bigint").alias("SrcPort"), "DstAddr", "Proto", "Bytes_AB", "Bytes_BA", "numFlowLogs", "time")


@query("c16_end_reasons", _WALK + """ SELECT CASE WHEN Proto=17 THEN 0 ELSE 1 END AS "group", CASE WHEN fin IS NULL THEN 'timeout' ELSE 'FIN_flag' END AS reason, count(*) AS n FROM s GROUP BY 1, 2""", sessions=True)
def c16_ends(f):
    return conntrack.end_reasons(walk.track(f, TRACK | {"detect_end": True}, ("endConnection",)), TRACK)


#: A third of all flows in one connection, and flows without flags.
_HOT = f"""WITH RECURSIVE flows AS (SELECT * REPLACE (CASE WHEN flow_id%3<>0 THEN SrcAddr WHEN flow_id%2=0 THEN '10.9.9.9' ELSE '20.0.0.1' END AS SrcAddr, CASE WHEN flow_id%3<>0 THEN DstAddr WHEN flow_id%2=0 THEN '20.0.0.1' ELSE '10.9.9.9' END AS DstAddr,
   CASE WHEN flow_id%3<>0 THEN SrcPort WHEN flow_id%2=0 THEN 30000 ELSE 443 END AS SrcPort, CASE WHEN flow_id%3<>0 THEN DstPort WHEN flow_id%2=0 THEN 443 ELSE 30000 END AS DstPort, CASE WHEN flow_id%3<>0 THEN Proto ELSE 6 END AS Proto, CASE WHEN flow_id%5=0 THEN NULL ELSE Flags END AS Flags) FROM ({src.SESSIONS_SQL}))"""
HOT_PART_ROWS = 1000


def _hot_flows(f):
    hot, even = F.col("flow_id") % 3 == 0, F.col("flow_id") % 2 == 0
    pick = lambda c, a, b: F.when(~hot, F.col(c)).when(even, F.lit(a)).otherwise(F.lit(b)).cast(f.schema[c].dataType)
    return f.withColumns({
        "SrcAddr": pick("SrcAddr", "10.9.9.9", "20.0.0.1"), "DstAddr": pick("DstAddr", "20.0.0.1", "10.9.9.9"), "SrcPort": pick("SrcPort", 30000, 443), "DstPort": pick("DstPort", 443, 30000),
        "Proto": F.when(hot, F.lit(6)).otherwise(F.col("Proto")), "Flags": F.when(F.col("flow_id") % 5 != 0, F.col("Flags")),
    })


@query("c10_hot_connection", _WALK.replace("(Flags & 1)=1", "coalesce((Flags & 1)=1, false)") + """ SELECT kind AS "_RecordType", kind='newConnection' AS "_IsFirst", SrcAddr, SrcPort, DstAddr, Proto, nullif(ab,0)::DOUBLE AS "Bytes_AB", nullif(ba,0)::DOUBLE AS "Bytes_BA", n::DOUBLE AS "numFlowLogs", e.at AS time FROM e""", sessions=True)
def c10_hot(f):
    """A connection with a third of all flows is walked in ranges of time, by several tasks."""
    out = walk.track(_hot_flows(f), TRACK | {"detect_end": True}, part_rows=HOT_PART_ROWS)
    return out.select("_RecordType", "_IsFirst", "SrcAddr", F.col("SrcPort").cast("bigint").alias("SrcPort"), "DstAddr", "Proto", "Bytes_AB", "Bytes_BA", "numFlowLogs", "time")


SQL["c10_hot_connection"] = _HOT + SQL["c10_hot_connection"].removeprefix(_SESSIONS)


for _name in ("c11_c12_fin_and_heartbeat", "c16_end_reasons"):
    SQL[_name] = SQL[_name].replace("WITH flows", "WITH RECURSIVE flows", 1)


_AGGREGATED = """, g AS (SELECT *, least(concat(SrcAddr,':',SrcPort),concat(DstAddr,':',DstPort)) AS lo, greatest(concat(SrcAddr,':',SrcPort),concat(DstAddr,':',DstPort)) AS hi, concat(SrcAddr,':',SrcPort) AS a, CASE WHEN Proto=17 THEN 7200 ELSE 14400 END AS gap,
   CASE WHEN flow_id%3=0 THEN NULL ELSE Bytes END AS v, CASE WHEN flow_id%2=0 THEN Flags|256 ELSE Flags END AS tf FROM flows WHERE Proto IN (6,17,132) AND NOT Duplicate),
 b AS (SELECT *, CASE WHEN epoch_us(event_time) - lag(epoch_us(event_time)) OVER (PARTITION BY Proto,lo,hi ORDER BY event_time,flow_id) <= gap::BIGINT*1000000 THEN 0 ELSE 1 END AS n FROM g),
 s AS (SELECT *, sum(n) OVER (PARTITION BY Proto,lo,hi ORDER BY event_time,flow_id) AS sid FROM b),
 e AS (SELECT Proto, lo, hi, sid, (arg_min(tf,(event_time,flow_id)) & 256)<>0 AS swap, arg_min(a,(event_time,flow_id)) AS fa, arg_min(SrcAddr,(event_time,flow_id)) AS sa, arg_min(SrcPort,(event_time,flow_id)) AS sp, arg_min(DstAddr,(event_time,flow_id)) AS da, arg_min(DstPort,(event_time,flow_id)) AS dp FROM s GROUP BY 1,2,3,4),
 j AS (SELECT s.*, e.swap, e.sa, e.sp, e.da, e.dp, (s.a=e.fa)<>e.swap AS ab FROM s JOIN e USING (Proto, lo, hi, sid))"""


@query("c4_c5_swap_and_aggregates", _AGGREGATED + """ SELECT Proto, any_value(CASE WHEN swap THEN da ELSE sa END) AS SrcAddr, any_value(CASE WHEN swap THEN dp ELSE sp END)::BIGINT AS SrcPort, any_value(CASE WHEN swap THEN sa ELSE da END) AS DstAddr,
 min(coalesce(v,0)) FILTER (ab)::DOUBLE AS low_AB, min(coalesce(v,0)) FILTER (NOT ab)::DOUBLE AS low_BA, max(v) FILTER (ab)::DOUBLE AS high_AB, max(v) FILTER (NOT ab)::DOUBLE AS high_BA, min(v)::DOUBLE AS seen, arg_min(coalesce(v,-1),(event_time,flow_id))::BIGINT AS opened, arg_max(v,(event_time,flow_id)) FILTER (v IS NOT NULL)::BIGINT AS closed, count(*) FILTER (ab)::DOUBLE AS n_AB, count(*) FILTER (NOT ab)::DOUBLE AS n_BA
 FROM j GROUP BY Proto, lo, hi, sid""", sessions=True)
def c4_c5(f):
    """All operations, with missing values, and sides that the first flow's flags swap."""
    rows = f.withColumn("v", F.when(F.col("flow_id") % 3 != 0, F.col("Bytes"))).withColumn("tf", F.when(F.col("flow_id") % 2 == 0, F.col("Flags").bitwiseOR(256)).otherwise(F.col("Flags")))
    aggregates = [
        {"name": "low", "operation": "min", "input": "v", "split": True}, {"name": "high", "operation": "max", "input": "v", "split": True, "report_missing": True}, {"name": "seen", "operation": "min", "input": "v", "report_missing": True},
        {"name": "opened", "operation": "first", "input": "v"}, {"name": "closed", "operation": "last", "input": "v"}, {"name": "n", "operation": "count", "split": True},
    ]
    out = conntrack.connections(rows, TRACK | {"aggregates": aggregates, "flags": "tf", "swap_ab": True}, zero_suppression=False)
    n = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return out.select("Proto", "SrcAddr", F.col("SrcPort").cast("bigint").alias("SrcPort"), "DstAddr", "low_AB", "low_BA", "high_AB", "high_BA", "seen", F.coalesce("opened", F.lit(-1)).cast("bigint").alias("opened"), F.col("closed").cast("bigint").alias("closed"), n("n_AB"), n("n_BA"))


@query("c16_classification", _TRACKED.replace("AND NOT Duplicate)", "AND NOT Duplicate AND flow_id%7<>0)") + """ SELECT 'discarded' AS classification, count(*) AS n FROM flows WHERE Proto NOT IN (6,17,132) UNION ALL SELECT 'rejected', count(*) FROM flows WHERE Proto IN (6,17,132) AND flow_id%7=0 UNION ALL SELECT 'duplicate', count(*) FROM flows WHERE Proto IN (6,17,132) AND Duplicate AND flow_id%7<>0
 UNION ALL SELECT 'newConnection', count(*) FROM e UNION ALL SELECT 'update', (SELECT count(*) FROM g) - (SELECT count(*) FROM e)""", sessions=True)
def c16(f):
    return conntrack.classify(f.withColumn("SrcAddr", F.when(F.col("flow_id") % 7 != 0, F.col("SrcAddr"))), TRACK)


@query("l13_counter_rate", """, p AS (SELECT concat(Proto::VARCHAR,'-',(flow_id%7)::VARCHAR) AS series, event_time AS t, Bytes AS v, lag(Bytes) OVER (PARTITION BY Proto, flow_id%7 ORDER BY event_time) AS before FROM flows)
 SELECT strftime(date_trunc('hour', t), '%Y-%m-%d %H:%M:%S') AS window_start, series, sum(CASE WHEN before IS NULL THEN 0 WHEN v>=before THEN v-before ELSE v END)::DOUBLE/3600 AS rate FROM p GROUP BY 1, 2""", sessions=True)
def counter_rate(f):
    rows = f.select(F.concat_ws("-", F.col("Proto").cast("string"), (F.col("flow_id") % 7).cast("string")).alias("series"), "event_time", F.col("Bytes").alias("v"))
    return library.counter_rate(rows, ["series"], "v", "event_time", "1 hour", 3600).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "series", "rate")


@query("l13_sum_over_time", """, s AS (SELECT Proto, Bytes, unnest([date_trunc('hour', event_time) - to_hours(k) FOR k IN range(0, 3)]) AS w FROM flows) SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, Proto, sum(Bytes)::DOUBLE AS total, count(*) AS n FROM s GROUP BY 1, 2""", sessions=True)
def sum_over_time(f):
    return library.sum_over_time(f, ["Proto"], F.col("Bytes"), "event_time", "3 hours", "1 hour").select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "Proto", "total", "n")


@query("c5_m2_m11_side_counts", """, r AS (SELECT *, CASE WHEN line%3=0 THEN concat(Bytes::VARCHAR,' B') WHEN line%5=0 THEN NULL ELSE Bytes::VARCHAR END AS text FROM flows),
 k AS (SELECT SrcAddr, min(event_time) AS t0, count(*) AS n FROM r WHERE Proto<>17 AND line%3<>0 AND line%5<>0 GROUP BY 1), o AS (SELECT n, row_number() OVER (ORDER BY t0, SrcAddr) AS place FROM k),
 g AS (SELECT * FROM r WHERE Proto IN (6,17,132))
 SELECT 'bytes' AS name, 'rows' AS count, count(*) AS n FROM r WHERE Proto<>17 UNION ALL SELECT 'bytes', 'ValueConversionError', count(*) FROM r WHERE Proto<>17 AND line%3=0
 UNION ALL SELECT 'bytes.all', 'rows', count(*) FROM o UNION ALL SELECT 'bytes.all', 'samples', sum(n)::BIGINT FROM o UNION ALL SELECT 'bytes.kept', 'rows', count(*) FROM o WHERE place<=40 UNION ALL SELECT 'bytes.kept', 'samples', sum(n)::BIGINT FROM o WHERE place<=40
 UNION ALL SELECT 'aggregates', 'rows', count(*) FROM g UNION ALL SELECT 'aggregates', 'Float64ConversionError:text', count(*) FROM g WHERE NOT Duplicate AND line%3=0 UNION ALL SELECT 'aggregates', 'MissingFieldError:text', count(*) FROM g WHERE NOT Duplicate AND line%3<>0 AND line%5=0""")
def side_counts(f):
    """What a metric, its cap and a connection's aggregates skip, counted in the pass that skips it."""
    rows = f.withColumn("text", F.when(F.col("line") % 3 == 0, F.concat(F.col("Bytes").cast("string"), F.lit(" B"))).when(F.col("line") % 5 != 0, F.col("Bytes").cast("string")))
    counts = Counts()
    metric = {"name": "bytes", "labels": ["SrcAddr"], "value_key": "text", "filters": [{"key": "Proto", "type": "not_equal", "value": "17"}]}
    sinks.sink_none(metrics.capped(rows, metric, "event_time", 40, counts))
    conf = TRACK | {"aggregates": [{"name": "text", "operation": "sum", "report_missing": True}]}
    sinks.sink_none(walk.track(rows, conf, ("endConnection",), counts=counts))
    return counts.table(f.sparkSession)


# ---- metrics


@query("m6_counter", "SELECT concat('flow_bytes_total{dst=\"',DstPort::VARCHAR,'\",flags=\"',coalesce(Flags::VARCHAR,''),'\"} ',sum(Bytes)::BIGINT::VARCHAR) AS line FROM flows WHERE (Proto=6 OR Proto=17) AND NOT Duplicate GROUP BY DstPort, Flags")
def counter(f):
    m = {"prefix": "flow_", "name": "bytes_total", "value_key": "Bytes", "labels": ["DstPort", "Flags"], "remap": {"DstPort": "dst", "Flags": "flags"}, "filters": [{"key": "Proto", "value": "6"}, {"key": "Proto", "value": "17"}, {"key": "Duplicate", "type": "not_equal", "value": "true"}]}
    return metrics.exposition(metrics.counter(f, m))


@query("m7_gauge", "SELECT 'last' AS metric, SrcAddr AS src, arg_max(Bytes,(event_time,flow_id))/10.0 AS value FROM flows GROUP BY SrcAddr", sessions=True)
def gauge(f):
    g = metrics.gauge(f, {"name": "last", "value_key": "Bytes", "value_scale": 10, "labels": ["SrcAddr"]}, "event_time", ["flow_id"])
    return g.select("metric", F.col("labels")["SrcAddr"].alias("src"), "value")


@query("m8_histogram", """, b(le, x) AS (VALUES ('500',500.0),('1000',1000.0),('2500',2500.0),('+Inf',1e300)), g AS (SELECT Proto::VARCHAR AS proto, sum(Bytes)::DOUBLE AS sum, count(*) AS count FROM flows GROUP BY 1)
 SELECT g.proto, b.le, (SELECT count(*) FROM flows WHERE Proto::VARCHAR=g.proto AND Bytes<=b.x) AS cumulative_count, g.sum, g.count FROM g, b""")
def histogram(f):
    h = metrics.histogram(f, {"name": "h", "value_key": "Bytes", "labels": ["Proto"]}, [500.0, 1000.0, 2500.0])
    return h.select(F.col("labels")["Proto"].alias("proto"), "le", "cumulative_count", "sum", "count")


@query("m4_flatten", """, p AS (SELECT Bytes, DstPort, unnest(CASE WHEN line%3=0 THEN [''] WHEN line%3=1 THEN ['eth0'] ELSE ['eth0',SrcAddr] END) AS itf FROM flows), q AS (SELECT Bytes, itf, unnest(['a','b']) AS dir FROM p)
 SELECT itf, dir, sum(Bytes)::DOUBLE AS value FROM q WHERE itf <> '10.1.1.1' GROUP BY 1,2""")
def flatten(f):
    line = F.col("line")
    rows = f.withColumn("Interfaces", F.when(line % 3 == 0, F.array().cast("array<string>")).when(line % 3 == 1, F.array(F.lit("eth0"))).otherwise(F.array(F.lit("eth0"), "SrcAddr"))).withColumn("Dirs", F.array(F.lit("a"), F.lit("b")))
    m = {"name": "x", "value_key": "Bytes", "labels": ["Interfaces", "Dirs"], "flatten": ["Interfaces", "Dirs"], "filters": [{"key": "Interfaces", "type": "not_equal", "value": "10.1.1.1"}]}
    return metrics.counter(rows, m).select(F.col("labels")["Interfaces"].alias("itf"), F.col("labels")["Dirs"].alias("dir"), "value")


@query("m9_agg_histogram", """, b(le, x) AS (VALUES ('1000',1000.0),('3000',3000.0),('+Inf',1e300)) SELECT b.le, (SELECT count(*) FROM flows WHERE Bytes<=b.x) AS cumulative_count, (SELECT sum(Bytes)::DOUBLE FROM flows) AS sum FROM b""")
def agg_histogram(f):
    return metrics.histogram(_daily(f), {"name": "h", "value_key": "recent_raw_values", "labels": []}, [1000.0, 3000.0]).select("le", "cumulative_count", "sum")


@query("m10_ttl", "SELECT DstAddr AS dst FROM flows GROUP BY 1 HAVING max(event_time) >= TIMESTAMP '1998-10-01' - INTERVAL 60 DAY")
def ttl(f):
    return metrics.live(f, {"name": "x", "labels": ["DstAddr"]}, "event_time", F.lit("1998-10-01").cast("timestamp"), 60 * 86400).select(F.col("labels")["DstAddr"].alias("dst"))


@query("m11_max_metrics", "SELECT SrcAddr AS src, sum(Bytes)::DOUBLE AS value FROM flows GROUP BY 1 ORDER BY min(event_time), SrcAddr LIMIT 25", sessions=True)
def max_metrics(f):
    return metrics.capped(f, {"name": "x", "value_key": "Bytes", "labels": ["SrcAddr"]}, "event_time", 25).select(F.col("labels")["SrcAddr"].alias("src"), "value")


# ---- sources and sinks


@query("s1_read_flows_json", f"SELECT {_ID}, SrcAddr, Bytes, Flags FROM flows")
def read_json(f):
    """The flows as JSON lines in files, broken lines among them, read back."""
    rows = f.select("flow_id", "line", "SrcPort", "SrcAddr", "Bytes", "Flags")
    broken = f.filter("line = 1").select(F.concat(F.lit('{"flow_id": '), F.col("SrcAddr")).alias("value"))
    path = f"{shared_dir(f.sparkSession)}/flow-lines-{uuid.uuid4().hex}"
    sinks.text_lines(rows).unionByName(broken).write.text(path)
    return src.read_flows_json(f.sparkSession, path, rows.schema)


@query("s2_decode_json", "SELECT flow_id, json_extract(props,'$.k')::BIGINT AS k, 1700000000::BIGINT AS TimeReceived FROM flows WHERE flow_id%10<>3", sessions=True)
def decode(f):
    rows = f.select(F.when(F.col("flow_id") % 10 == 3, F.lit("{broken")).otherwise(F.concat(F.lit('{"flow_id": '), F.col("flow_id").cast("string"), F.lit(', "p": '), "props", F.lit("}"))).alias("value"))
    return src.decode_json(rows, "value", "flow_id long, p struct<k:long>", now=1_700_000_000).select("flow_id", F.col("p.k").alias("k"), "TimeReceived")


@query("s5_render_netflow", f"SELECT {_ID}, SrcAddr, concat('00:00:',regexp_replace(lpad(lower(to_hex(Bytes)),8,'0'),'(..)(..)(..)(..)','\\1:\\2:\\3:\\4')) AS mac FROM flows")
def render(f):
    rows = f.withColumn("SrcAddr", net.ip_to_long(F.col("SrcAddr"))).withColumn("mac", F.col("Bytes"))
    return src.render_netflow(rows, ["SrcAddr"], ["mac"]).select("flow_id", "line", "SrcPort", "SrcAddr", "mac")


@query("s6_ingest_latency", """, x AS (SELECT (904608000000 - epoch_ms(event_time))/1000.0 AS s FROM flows), b(le, v) AS (VALUES ('0.001',0.001),('1',1.0),('1e+06',1e6),('1e+08',1e8),('+Inf',1e300)) SELECT le, (SELECT count(*) FROM x WHERE s<=v) AS n FROM b UNION ALL SELECT 'error', 0""")
def latency(f):
    return src.ingest_latency(f.withColumn("TimeFlowEndMs", F.unix_millis("event_time")), now_ms=904608000000, buckets=(0.001, 1.0, 1e6, 1e8))


@query("w1_text_lines", "SELECT concat('map[Bytes:',Bytes::VARCHAR,' ',CASE WHEN Flags IS NULL THEN '' ELSE concat('Flags:',Flags::VARCHAR,' ') END,'SrcAddr:',SrcAddr,']') AS value FROM flows")
def lines(f):
    return sinks.text_lines(f.select("SrcAddr", "Bytes", "Flags"), "printf")


@query("w2_label_lines", f"SELECT {_ID}, DstAddr AS dst, 'edge' AS site, (epoch_us(event_time)//1000000) AS seconds, concat('{{\"flow_id\":',flow_id::VARCHAR,',\"Bytes\":',Bytes::VARCHAR,',\"ts\":',(epoch_us(event_time)//1000000)::VARCHAR,'}}') AS line_text FROM flows")
def label_lines(f):
    rows = f.select("flow_id", "Bytes", F.unix_seconds("event_time").alias("ts"), F.col("DstAddr").alias("dst.addr"), F.struct("line", "SrcPort").alias("kept"))
    out = sinks.to_label_lines(rows.withColumn("k", F.to_json("kept")).drop("kept"), ["dst.addr", "k"], "ts", static={"site": "edge"})
    key = F.from_json(F.col("labels")["k"], "line int, SrcPort long")
    return out.select(F.get_json_object("line", "$.flow_id").cast("bigint").alias("flow_id"), key["line"].alias("line"), key["SrcPort"].alias("SrcPort"), F.col("labels")["dst_addr"].alias("dst"), F.col("labels")["site"].alias("site"), F.unix_seconds("time").alias("seconds"), F.col("line").alias("line_text"))


@query("w4_object_batches", """, r AS (SELECT date_trunc('hour',event_time) AS h, (row_number() OVER (PARTITION BY date_trunc('hour',event_time) ORDER BY event_time, flow_id, line, SrcPort)-1)//10 AS b, flow_id, line, SrcPort, Bytes, event_time FROM flows)
 SELECT concat(strftime(h,'account/year=%Y/month=%m/day=%d/hour=%H'),'/stream-id=0/',lpad(b::VARCHAR,8,'0')) AS path, count(*)::INT AS n, 'x' AS vendor, count(*)::BIGINT AS listed, string_agg(concat(flow_id::VARCHAR,':',line::VARCHAR,':',Bytes::VARCHAR), ',' ORDER BY event_time, flow_id, line, SrcPort) AS flows,
 epoch_us(min(event_time))//1000000 AS started, epoch_us(max(event_time))//1000000 AS ended FROM r GROUP BY h, b""")
def objects(f):
    out = sinks.object_batches(f.select("flow_id", "line", "SrcPort", "Bytes", "event_time"), "event_time", 10, order=["flow_id", "line", "SrcPort"], header={"vendor": "x"})
    o = F.from_json("object", "vendor string, number_of_flow_logs long, capture_start_time timestamp, capture_end_time timestamp, flow_logs array<struct<flow_id:long,line:int,Bytes:long>>")
    return out.select("path", "n", o.alias("o")).select(
        "path", "n", "o.vendor", F.col("o.number_of_flow_logs").alias("listed"), F.array_join(F.transform("o.flow_logs", lambda x: F.concat_ws(":", x["flow_id"], x["line"], x["Bytes"])), ",").alias("flows"),
        F.unix_seconds("o.capture_start_time").alias("started"), F.unix_seconds("o.capture_end_time").alias("ended"),
    )


@query("w5_kafka_rows", "SELECT concat('{\"flow_id\":',flow_id::VARCHAR,',\"SrcAddr\":\"',SrcAddr,'\"',CASE WHEN Flags IS NULL THEN '' ELSE concat(',\"Flags\":',Flags::VARCHAR) END,'}') AS value FROM flows")
def kafka_rows(f):
    return sinks.to_kafka_rows(f.select("flow_id", "SrcAddr", "Flags"))


@query("w6_otel_logs", f"SELECT {_ID}, 9 AS severity_number, 'INFO' AS severity_text, Flags::VARCHAR AS flags, CASE WHEN Flags IS NULL THEN 3 ELSE 4 END AS n, concat('{{\"flow_id\":',flow_id::VARCHAR,',\"line\":',line::VARCHAR,',\"SrcPort\":',SrcPort::VARCHAR,CASE WHEN Flags IS NULL THEN '' ELSE concat(',\"Flags\":',Flags::VARCHAR) END,'}}') AS body FROM flows")
def otel_logs(f):
    out = sinks.to_otel_logs(f.select("flow_id", "line", "SrcPort", "Flags"))
    a = F.col("attributes")
    return out.select(a["flow_id"].cast("bigint").alias("flow_id"), a["line"].cast("int").alias("line"), a["SrcPort"].cast("bigint").alias("SrcPort"), "severity_number", "severity_text", F.try_element_at(a, F.lit("Flags")).alias("flags"), F.size(a).alias("n"), "body")


@query("w8_otel_metrics", """ SELECT 'net_bytes' AS name, 'counter' AS type, DstPort::VARCHAR AS port, sum(Bytes)::DOUBLE AS value, NULL::VARCHAR AS counts, NULL::DOUBLE AS sum, NULL::BIGINT AS count FROM flows GROUP BY DstPort
 UNION ALL SELECT 'net_last', 'gauge', DstPort::VARCHAR, arg_max(Bytes,(event_time,flow_id,line,SrcPort,SrcAddr,DstAddr))::DOUBLE, NULL, NULL, NULL FROM flows GROUP BY DstPort
 UNION ALL SELECT 'net_sizes', 'histogram', DstPort::VARCHAR, NULL, concat(count(*) FILTER (Bytes<=1000),',',count(*) FILTER (Bytes>1000 AND Bytes<=2500),',',count(*) FILTER (Bytes>2500)), sum(Bytes)::DOUBLE, count(*) FROM flows GROUP BY DstPort
 UNION ALL SELECT 'net_all', 'histogram', NULL, NULL, concat(count(*) FILTER (Bytes<=0),',',count(*) FILTER (Bytes>0 AND Bytes<=5),',0,0,0,0,',count(*) FILTER (Bytes>75 AND Bytes<=100),',',count(*) FILTER (Bytes>100 AND Bytes<=250),',',count(*) FILTER (Bytes>250 AND Bytes<=500),',',count(*) FILTER (Bytes>500 AND Bytes<=750),',',count(*) FILTER (Bytes>750 AND Bytes<=1000),',',count(*) FILTER (Bytes>1000 AND Bytes<=2500),',',count(*) FILTER (Bytes>2500 AND Bytes<=5000),',0,0,0'), sum(Bytes)::DOUBLE, count(*) FROM flows""")
def otel_metrics(f):
    kept = [
        {"name": "bytes", "type": "counter", "value_key": "Bytes", "labels": ["DstPort"]}, {"name": "last", "type": "gauge", "value_key": "Bytes", "labels": ["DstPort"]},
        {"name": "sizes", "type": "histogram", "value_key": "Bytes", "labels": ["DstPort"], "buckets": [1000, 2500]}, {"name": "all", "type": "histogram", "value_key": "Bytes"},
    ]
    out = metrics.otel_metrics(f, kept, "net_", "event_time", ["flow_id", "line", "SrcPort", "SrcAddr", "DstAddr"])
    return out.select("name", "type", F.try_element_at("attributes", F.lit("DstPort")).alias("port"), "value", F.array_join("bucket_counts", ",").alias("counts"), "sum", "count")


@query("w7_otel_spans", """SELECT flow_id AS trace, 'flow' AS name, NULL::VARCHAR AS parent, SrcAddr AS addr FROM flows UNION ALL SELECT flow_id, 'Src', 'flow', SrcAddr FROM flows UNION ALL SELECT flow_id, 'Dst', 'flow', DstAddr FROM flows WHERE line<4""")
def otel_spans(f):
    rows = f.select("flow_id", "SrcAddr", F.when(F.col("line") < 4, F.col("DstAddr")).alias("DstAddr"), "Bytes")
    out = sinks.to_otel_spans(rows, ["Src", "Dst"], "flow_id")
    return out.select("trace", "name", "parent", F.coalesce(F.try_element_at("attributes", F.lit("Addr")), F.try_element_at("attributes", F.lit("SrcAddr"))).alias("addr"))


@query("w9_ipfix_v6", f"SELECT {_ID}, concat('2001:db8::',line::VARCHAR) AS src, '::' AS nat_src, CASE WHEN line=2 THEN 'fd00::1' ELSE '::' END AS nat_dst, CASE WHEN line=2 THEN 99 END::INT AS nat_port, Proto AS next_header, 0.25::DOUBLE AS probability FROM flows WHERE line%2=0")
def ipfix_v6(f):
    line = F.col("line")
    rows = f.withColumns({
        "Etype": F.when(line % 2 == 0, sinks.IPV6).otherwise(2048), "SrcAddr": F.concat(F.lit("2001:db8::"), line.cast("string")), "XlatDstAddr": F.when(line == 2, "fd00::1"), "XlatDstPort": F.when(line == 2, 99), "Sampling": F.lit(4),
        "SrcK8S_Name": F.to_json(F.struct("flow_id", "line", "SrcPort")),
    })
    key = F.from_json("sourcePodName", "flow_id long, line int, SrcPort long")
    return sinks.to_ipfix_columns(rows, v6=True).select(
        key["flow_id"].alias("flow_id"), key["line"].alias("line"), key["SrcPort"].alias("SrcPort"), F.col("sourceIPv6Address").alias("src"), F.col("postNATSourceIPv6Address").alias("nat_src"), F.col("postNATDestinationIPv6Address").alias("nat_dst"),
        F.col("postNAPTDestinationTransportPort").alias("nat_port"), F.col("nextHeaderIPv6").alias("next_header"), F.col("samplingProbability").alias("probability"),
    )


@query("s4_agent_records", f"SELECT {_ID}, SrcAddr, DstAddr, 'eth0,eth1' AS itf, CASE WHEN line=1 THEN 'TCP_ESTABLISHED' WHEN line=7 THEN 'TCP_CLOSE_WAIT' ELSE concat('TCP_',['ESTABLISHED','SYN_SENT','SYN_RECV','FIN_WAIT1','FIN_WAIT2','CLOSE'][line]) END AS state, CASE WHEN DstPort%2=0 THEN 'SKB_DROP_REASON_NETFILTER_DROP' ELSE '900' END AS cause, (line*3)::BIGINT AS dns_ms, CASE WHEN line=3 THEN 'NXDomain' ELSE 'NoError' END AS dns_code, (line*1000000)::BIGINT AS rtt FROM flows")
def agent_records(f):
    line = F.col("line")
    rows = f.select(
        F.struct(net.ip_to_long(F.col("SrcAddr")).alias("src_addr"), net.ip_to_long(F.col("DstAddr")).alias("dst_addr"), F.lit(0).alias("dscp")).alias("network"), F.struct(F.col("SrcPort").alias("src_port"), F.col("DstPort").alias("dst_port"), F.col("Proto").alias("protocol")).alias("transport"),
        F.struct(F.col("flow_id").alias("src_mac"), F.lit(1).alias("dst_mac")).alias("data_link"), F.lit(2048).alias("eth_protocol"), F.col("flow_id").alias("bytes"), line.alias("packets"),
        F.array(*[F.struct(F.lit(i).alias("interface"), F.lit(d).alias("direction"), F.lit("").alias("udn")) for i, d in (("eth0", 0), ("eth1", 1))]).alias("dup_list"), F.col("event_time").alias("start"), F.col("event_time").alias("end"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), line / 1000).alias("rtt"), F.lit(1).alias("agent_ip"), line.alias("pkt_drop_latest_state"), F.when(F.col("DstPort") % 2 == 0, 8).otherwise(900).alias("pkt_drop_latest_drop_cause"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), line * 3 / 1000).alias("dns_latency"), F.when(line == 3, 0x83).otherwise(0x80).alias("dns_flags"),
    )
    out = src.flatten_agent_records(rows)
    return out.select(F.col("Bytes").alias("flow_id"), F.col("Packets").alias("line"), "SrcPort", "SrcAddr", "DstAddr", F.array_join("Interfaces", ",").alias("itf"), F.col("PktDropLatestState").alias("state"), F.col("PktDropLatestDropCause").alias("cause"), F.col("DnsLatencyMs").alias("dns_ms"), F.col("DnsFlagsResponseCode").alias("dns_code"), F.col("TimeFlowRttNs").alias("rtt"))


@query("w9_ipfix_columns", f"SELECT SrcAddr AS \"sourceIPv4Address\", '0.0.0.0' AS \"postNATSourceIPv4Address\", Bytes AS \"octetDeltaCount\", Flags::BIGINT AS \"tcpControlBits\", 'eth0' AS \"interfaceName\", concat('eth0,',line::VARCHAR) AS \"interfaceNames\", 0.1::DOUBLE AS \"samplingProbability\" FROM flows")
def ipfix(f):
    rows = f.withColumn("Flags", net.decode_tcp_flags(F.col("Flags"))).withColumn("Interfaces", F.array(F.lit("eth0"), F.col("line").cast("string"))).withColumn("Sampling", F.lit(10))
    return sinks.to_ipfix_columns(rows).select("sourceIPv4Address", "postNATSourceIPv4Address", "octetDeltaCount", "tcpControlBits", "interfaceName", "interfaceNames", "samplingProbability")


# ---- library and composition


@query("l1_bandwidth_per_service", f"SELECT {_SERVICE} AS service, sum(Bytes)::DOUBLE AS total_value, count(*) AS total_count FROM flows GROUP BY 1")
def l1(f):
    return library.bandwidth_per_service(f, *_dimensions(f)).select("service", "total_value", "total_count")


_S24, _D24 = "concat(regexp_extract(SrcAddr,'^\\d+\\.\\d+\\.\\d+'),'.0/24')", "concat(regexp_extract(DstAddr,'^\\d+\\.\\d+\\.\\d+'),'.0/24')"


@query("l2_bandwidth_per_subnet_pair", f"SELECT {_S24} AS src, {_D24} AS dst, sum(Bytes)::DOUBLE AS total_value, count(*) AS total_count FROM flows GROUP BY 1,2")
def l2(f):
    return library.by_subnets(f, {"SrcAddr": 24, "DstAddr": 24}, "sum", "Bytes").select(F.col("SrcAddrSubnet").alias("src"), F.col("DstAddrSubnet").alias("dst"), "total_value", "total_count")


@query("l4_egress_per_dst_subnet", "SELECT concat(regexp_extract(DstAddr,'^\\d+\\.\\d+'),'.0.0/16') AS dst, sum(Bytes)::DOUBLE AS total_value FROM flows GROUP BY 1")
def l4(f):
    return library.by_subnets(f, {"DstAddr": 16}, "sum", "Bytes").select(F.col("DstAddrSubnet").alias("dst"), "total_value")


@query("l5_egress_per_namespace", f", x AS ({_K8S}) SELECT concat('ns-',(o3%10)::VARCHAR) AS namespace, sum(Bytes)::DOUBLE AS total_value FROM x WHERE o4%7<>0 GROUP BY 1")
def l5(f):
    out = enrich.add_kubernetes(f, "SrcAddr", "Src", _inventory(f))
    return agg.aggregate(out, {"name": "egress", "by": ["Src_Namespace"], "operation": "sum", "key": "Bytes"}).select(F.col("Src_Namespace").alias("namespace"), "total_value")


@query("l6_connections_per_subnet", _TRACKED + " SELECT concat(regexp_extract(SrcAddr,'^\\d+\\.\\d+'),'.0.0/16') AS src, count(*) AS n FROM e GROUP BY 1", sessions=True)
def l6(f):
    return library.by_subnets(conntrack.connections(f, TRACK), {"SrcAddr": 16}, "count").select(F.col("SrcAddrSubnet").alias("src"), F.col("total_count").alias("n"))


@query("l6_connections_per_dst_subnet", _TRACKED + " SELECT concat(regexp_extract(DstAddr,'^\\d+\\.\\d+'),'.0.0/16') AS dst, count(*) AS n FROM e GROUP BY 1", sessions=True)
def l6_dst(f):
    return library.by_subnets(conntrack.connections(f, TRACK), {"DstAddr": 16}, "count").select(F.col("DstAddrSubnet").alias("dst"), F.col("total_count").alias("n"))


@query("l7_connections_per_as", "SELECT 'src' AS side, (SrcPort%40)::VARCHAR AS asn, count(*) AS n FROM flows GROUP BY 2 UNION ALL SELECT 'dst', (DstPort%40)::VARCHAR, count(*) FROM flows GROUP BY 2")
def l7_as(f):
    rows = f.withColumns({"SrcAS": F.col("SrcPort") % 40, "DstAS": F.col("DstPort") % 40})
    one = lambda c, side: library.counts_by(rows, [c]).select(F.lit(side).alias("side"), F.col(c).alias("asn"), F.col("total_count").alias("n"))
    return one("SrcAS", "src").unionByName(one("DstAS", "dst"))


@query("l7_connections_per_flags", "SELECT Flags::VARCHAR AS flags, count(*) AS n FROM flows WHERE Flags IS NOT NULL GROUP BY 1")
def l7(f):
    return library.counts_by(f, ["Flags"]).select(F.col("Flags").alias("flags"), F.col("total_count").alias("n"))


@query("l8_subnet_pair_counts", f"SELECT {_S24} AS src, {_D24} AS dst, count(*) AS n FROM flows GROUP BY 1,2")
def l8(f):
    return library.by_subnets(f, {"SrcAddr": 24, "DstAddr": 24}, "count").select(F.col("SrcAddrSubnet").alias("src"), F.col("DstAddrSubnet").alias("dst"), F.col("total_count").alias("n"))


_BOUNDS = ",".join([f"('{2**i:g}',{2**i}.0)" if 2**i < 1_000_000 else f"('{float(2**i):g}',{2**i}.0)" for i in range(7, 21)] + ["('+Inf',1e300)"])


@query("l9_connection_size_histogram", _TRACKED + f""", bd(le, x) AS (VALUES {_BOUNDS}), v AS (SELECT 'Bytes_AB' AS c, nullif(CASE WHEN fa=lo THEN bl ELSE bh END,0) AS y FROM e UNION ALL SELECT 'Bytes_BA', nullif(CASE WHEN fa=lo THEN bh ELSE bl END,0) FROM e UNION ALL SELECT 'Bytes', nullif(bl+bh,0) FROM e)
 SELECT concat('size_',m.c) AS metric, bd.le, count(v.y) FILTER (v.y<=bd.x) AS cumulative_count FROM (SELECT DISTINCT c FROM v) m JOIN bd ON true JOIN v ON v.c=m.c GROUP BY 1,2""", sessions=True)
def l9(f):
    total = {"name": "Bytes", "operation": "sum", "input": "Bytes", "split": False}
    found = conntrack.connections(f, TRACK | {"aggregates": [TRACK["aggregates"][0] | {"name": "Side"}, total]}).withColumnsRenamed({"Side_AB": "Bytes_AB", "Side_BA": "Bytes_BA"})
    return library.size_histogram(found, ["Bytes_AB", "Bytes_BA", "Bytes"], "size").select("metric", "le", "cumulative_count")


@query("l10_flow_size_histogram", f", b(le, x) AS (VALUES {_BOUNDS}) SELECT le, (SELECT count(*) FROM flows WHERE Bytes<=x) AS cumulative_count FROM b")
def l10(f):
    return library.size_histogram(f, ["Bytes"], "flow").select("le", "cumulative_count")


@query("l11_geo_rate", f"SELECT concat('C',({_BLOCK}%7)::VARCHAR) AS country, count(*) AS n FROM flows GROUP BY 1")
def l11(f):
    return library.geo_rate(f, _ranges(f)).select(F.col("Dst_CountryName").alias("country"), F.col("total_count").alias("n"))


@query("l12_service_counts", f"SELECT {_SERVICE} AS service, count(*) AS n FROM flows GROUP BY 1")
def l12(f):
    return library.service_counts(f, *_dimensions(f)).select("service", F.col("total_count").alias("n"))


@query("l13_top_rates", """, g AS (SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS w, SrcAddr, sum(Bytes)/3600.0 AS rate FROM flows GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY rate DESC, SrcAddr) AS rank FROM g)
 SELECT strftime(w,'%Y-%m-%d %H:%M:%S') AS window_start, SrcAddr, rate::DOUBLE AS rate, rank::INT AS rank FROM r WHERE rank<=10""", sessions=True)
def l13(f):
    rates = library.rate(f, ["SrcAddr"], F.col("Bytes"), "event_time", "1 hour", 3600)
    return library.top_rates(rates, ["SrcAddr"]).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("l13_sum_and_count", """, g AS (SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS w, SrcAddr, sum(Bytes)/3600.0 AS rate FROM flows GROUP BY 1,2)
 SELECT strftime(w,'%Y-%m-%d %H:%M:%S') AS window_start, round(sum(rate),6)::DOUBLE AS total_rate, count(*) AS n FROM g GROUP BY 1""", sessions=True)
def l13_totals(f):
    rates = library.rate(f, ["SrcAddr"], F.col("Bytes"), "event_time", "1 hour", 3600)
    return library.rate_totals(rates).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), F.round("total_rate", 6).alias("total_rate"), "n")


@query("g1_pipeline", "SELECT 'tcp' AS branch, DstPort::VARCHAR AS aggregate, sum(Bytes)::DOUBLE AS total_value FROM flows WHERE Proto=6 GROUP BY 2 UNION ALL SELECT 'udp', DstPort::VARCHAR, count(*)::DOUBLE FROM flows WHERE Proto=17 GROUP BY 2")
def g1(f):
    rule = {"by": ["DstPort"], "key": "Bytes"}
    stages = [
        {"name": "read", "type": "none"},
        {"name": "tcp", "follows": "read", "type": "filter", "params": {"rules": [{"type": "keep_entry_query", "query": "Proto = 6"}]}},
        {"name": "udp", "follows": "read", "type": "filter", "params": {"rules": [{"type": "keep_entry_query", "query": "Proto = 17"}]}},
        {"name": "tcp_sum", "follows": "tcp", "type": "aggregates", "params": {"rules": [rule | {"name": "tcp", "operation": "sum"}]}},
        {"name": "udp_count", "follows": "udp", "type": "aggregates", "params": {"rules": [rule | {"name": "udp", "operation": "count"}]}},
        {"name": "out", "follows": ["tcp_sum", "udp_count"], "type": "none", "sink": True},
    ]
    return Pipeline(stages).run(f)["out"].select(F.col("name").alias("branch"), "aggregate", "total_value")


@query("g2_fluent", "SELECT DstPort::VARCHAR AS port, sum(Bytes)::DOUBLE AS value FROM flows WHERE Proto=6 GROUP BY 1")
def g2(f):
    out = Flow(f).filter([{"type": "keep_entry_query", "query": "Proto = 6"}]).counter({"name": "bytes", "value_key": "Bytes", "labels": ["DstPort"]}).df
    return out.select(F.col("labels")["DstPort"].alias("port"), "value")
