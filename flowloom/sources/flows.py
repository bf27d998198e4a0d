"""Flow tables: JSON readers, decoders, and the flow views over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.net import long_to_ip

#: Flows from order lines; the statement runs in Spark and DuckDB alike.
FLOWS_SQL = """
SELECT l_orderkey AS flow_id,
  concat('10.',cast(l_suppkey%4 AS string),'.',cast(l_suppkey%200 AS string),'.',cast(l_partkey%250+1 AS string)) AS SrcAddr,
  1024+l_partkey%30000 AS SrcPort,
  concat('20.',cast(o_custkey%3 AS string),'.',cast(o_custkey%100 AS string),'.',cast(o_custkey%250+1 AS string)) AS DstAddr,
  CASE l_linenumber%6 WHEN 0 THEN 22 WHEN 1 THEN 80 WHEN 2 THEN 443 WHEN 3 THEN 53 WHEN 4 THEN 1433 ELSE 36936 END AS DstPort,
  CASE WHEN l_returnflag='R' THEN 17 WHEN l_linenumber=7 THEN 1 ELSE 6 END AS Proto,
  cast(l_quantity*100 AS bigint) AS Bytes, cast(l_quantity AS bigint) AS Packets,
  CASE l_linenumber WHEN 1 THEN 2 WHEN 2 THEN 256 WHEN 3 THEN 16 WHEN 4 THEN 24 WHEN 5 THEN 17 WHEN 6 THEN 512 END AS Flags,
  l_partkey%20=0 AS Duplicate, l_shipdate AS event_time, l_linenumber AS line
FROM lineitem JOIN orders ON l_orderkey=o_orderkey"""
#: Flows of user sessions in both directions, from events.
SESSIONS_SQL = """
SELECT event_id AS flow_id,
  CASE WHEN event_id%2=0 THEN c ELSE s END AS SrcAddr, CASE WHEN event_id%2=0 THEN cp ELSE 443 END AS SrcPort,
  CASE WHEN event_id%2=0 THEN s ELSE c END AS DstAddr, CASE WHEN event_id%2=0 THEN 443 ELSE cp END AS DstPort,
  CASE WHEN event_type='view' THEN 17 WHEN event_type='signup' THEN 1 ELSE 6 END AS Proto,
  cast(round(value*100) AS bigint) AS Bytes, CASE WHEN event_type='error' THEN 1 ELSE 16 END AS Flags,
  event_id%25=0 AS Duplicate, ts AS event_time, props
FROM (SELECT *, concat('10.0.',cast(user_id%4 AS string),'.',cast(user_id%250+1 AS string)) AS c,
             30000+user_id AS cp, '20.0.0.1' AS s FROM events) e"""


def view(spark: SparkSession, sf_dir: str, sql: str, tables: list[str]) -> DataFrame:
    """The statement over the Parquet tables; names are replaced by paths, so that no view is left behind."""
    found = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    df = spark.sql(sql, **found)
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, FLOWS_SQL, ["lineitem", "orders"])


def session_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, SESSIONS_SQL, ["events"])


def read_flows_json(spark: SparkSession, path: str, schema, stream: bool = False, files_per_trigger: int = 100) -> DataFrame:
    """JSON lines, bad lines skipped; with ``stream`` as a stream of files."""
    if stream:
        return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_per_trigger).json(path)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def decode_json(df: DataFrame, value_col: str, schema: str, now=None) -> DataFrame:
    """Records in a text or binary column; broken ones are skipped, TimeReceived is now where absent."""
    parsed = F.from_json(F.col(value_col).cast("string"), f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = df.select(parsed.alias("_r")).filter(F.col("_r").isNotNull() & F.col("_r._corrupt").isNull()).select("_r.*").drop("_corrupt")
    received = F.col("TimeReceived").cast("bigint") if "TimeReceived" in rows.columns else F.lit(None).cast("bigint")
    return rows.withColumn("TimeReceived", F.coalesce(received, F.unix_timestamp() if now is None else F.lit(now)))


def read_flows_kafka(spark: SparkSession, servers: str, topic: str, schema: str, start: str = "earliest", group: str | None = None, most: int | None = None, options: dict | None = None) -> DataFrame:
    """A stream of JSON records from Kafka; empty values are skipped. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start)
    for k, v in {"groupIdPrefix": group, "maxOffsetsPerTrigger": most, **(options or {})}.items():
        reader = reader if v is None else reader.option(k, v)
    return decode_json(reader.load().filter("length(value) > 0"), "value", schema)


def mac_text(n):
    """The low six bytes of a number as aa:bb:cc:dd:ee:ff."""
    return F.lower(F.regexp_replace(F.right(F.lpad(F.hex(n), 12, "0"), F.lit(12)), r"(..)(?!$)", "$1:"))


def render_netflow(df: DataFrame, ip_cols: list[str], mac_cols: list[str]) -> DataFrame:
    """Numeric IPv4 addresses and MACs as text."""
    return df.withColumns({c: long_to_ip(F.col(c)) for c in ip_cols} | {c: mac_text(F.col(c)) for c in mac_cols})


#: Names of the TCP states by their kernel numbers, from 1.
TCP_STATES = ["ESTABLISHED", "SYN_SENT", "SYN_RECV", "FIN_WAIT1", "FIN_WAIT2", "CLOSE", "CLOSE_WAIT", "LAST_ACK", "LISTEN", "CLOSING", "NEW_SYN_RECV"]
#: The kernel's first reasons to drop a packet, by number; later ones differ from version to version.
DROP_REASONS = {
    2: "NOT_SPECIFIED", 3: "NO_SOCKET", 4: "PKT_TOO_SMALL", 5: "TCP_CSUM", 6: "SOCKET_FILTER", 7: "UDP_CSUM", 8: "NETFILTER_DROP", 9: "OTHERHOST", 10: "IP_CSUM", 11: "IP_INHDR", 12: "IP_RPFILTER",
    13: "UNICAST_IN_L2_MULTICAST", 14: "XFRM_POLICY", 15: "IP_NOPROTO", 16: "SOCKET_RCVBUFF", 17: "PROTO_MEM",
}
#: Response codes of DNS answers, from 0.
DNS_CODES = ["NoError", "FormErr", "ServFail", "NXDomain", "NotImp", "Refused", "YXDomain", "YXRRSet", "NXRRSet", "NotAuth", "NotZone"]


def _name_of(number, names: dict[int, str]):
    """The number's name, or the number as text."""
    known = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    return F.when(number.isNotNull(), F.coalesce(F.try_element_at(known, number.cast("int")), number.cast("string")))


def flatten_agent_records(df: DataFrame, drop_reasons: dict[int, str] | None = None) -> DataFrame:
    """A nested agent record (network, transport, data_link, bytes, packets, dup_list, times, and where it has them
    packet drops and DNS) as flat flow columns; ``drop_reasons`` adds names of the kernel's drop reasons."""
    each = lambda f: F.transform("dup_list", lambda x: x[f])
    micros = lambda c: F.unix_micros(F.lit(0).cast("timestamp") + F.col(c))  # noqa: E731  of an interval
    drop = {"pkt_drop_bytes": "PktDropBytes", "pkt_drop_packets": "PktDropPackets", "pkt_drop_latest_flags": "PktDropLatestFlags", "dns_id": "DnsId", "dns_flags": "DnsFlags", "dns_errno": "DnsErrno"}
    more = [F.col(c).alias(n) for c, n in drop.items() if c in df.columns]
    if "pkt_drop_latest_state" in df.columns:
        more.append(_name_of(F.col("pkt_drop_latest_state"), {i: f"TCP_{s}" for i, s in enumerate(TCP_STATES, 1)}).alias("PktDropLatestState"))
    if "pkt_drop_latest_drop_cause" in df.columns:
        named = {k: f"SKB_DROP_REASON_{v}" for k, v in DROP_REASONS.items()} | (drop_reasons or {})
        more.append(_name_of(F.col("pkt_drop_latest_drop_cause"), named).alias("PktDropLatestDropCause"))
    if "dns_latency" in df.columns:
        more.append((micros("dns_latency") / 1000).cast("bigint").alias("DnsLatencyMs"))
    if "dns_flags" in df.columns:
        more.append(_name_of(F.col("dns_flags").cast("int").bitwiseAND(F.lit(15)), dict(enumerate(DNS_CODES))).alias("DnsFlagsResponseCode"))
    return df.select(
        long_to_ip(F.col("network.src_addr")).alias("SrcAddr"), long_to_ip(F.col("network.dst_addr")).alias("DstAddr"), F.col("network.dscp").alias("Dscp"),
        F.col("transport.src_port").alias("SrcPort"), F.col("transport.dst_port").alias("DstPort"), F.col("transport.protocol").alias("Proto"),
        mac_text(F.col("data_link.src_mac")).alias("SrcMac"), mac_text(F.col("data_link.dst_mac")).alias("DstMac"), F.col("eth_protocol").alias("Etype"),
        F.col("bytes").alias("Bytes"), F.col("packets").alias("Packets"), each("interface").alias("Interfaces"), each("direction").alias("IfDirections"), each("udn").alias("Udns"),
        F.unix_millis("start").alias("TimeFlowStartMs"), F.unix_millis("end").alias("TimeFlowEndMs"), (micros("rtt") * 1000).alias("TimeFlowRttNs"), long_to_ip(F.col("agent_ip")).alias("AgentIP"), *more,
    )


def ingest_latency(df: DataFrame, end_col: str = "TimeFlowEndMs", now_ms=None, buckets=(0.001, 0.01, 0.1, 1, 10, 100, 1000, 10000)) -> DataFrame:
    """(le, n): cumulative histogram of seconds from the flow's end to now, and the rows without a time under 'error'."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else F.lit(now_ms)
    late = (now - F.col(end_col).cast("string").try_cast("bigint")) / 1000.0
    g = df.select(late.alias("s")).agg(*[F.count_if(F.col("s") <= b).alias(f"b{i}") for i, b in enumerate(buckets)], F.count("s").alias("all"), F.count_if(F.col("s").isNull()).alias("bad"))
    rows = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(buckets)]
    return g.select(F.explode(F.array(*rows, F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("n")), F.struct(F.lit("error").alias("le"), F.col("bad").alias("n")))).alias("r")).select("r.*")
