"""Output shapes: JSON lines, label lines, object batches, log and trace attributes, export columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.coerce import col_or_null, go_str, kind_of
from flowloom.functions.net import encode_tcp_flags
from flowloom.functions.storage import staged

#: Rows of a range of times that are numbered together.
RANGE_ROWS = 200_000
#: Fixed value: the version that objects name.
VERSION = "v0.1"
#: Microseconds of the timestamp scales.
SCALES = {"1m": 60_000_000, "1s": 1_000_000, "100ms": 100_000, "1ms": 1_000}


def text_lines(df: DataFrame, form: str = "json") -> DataFrame:
    """One column ``value``: JSON, ``fields`` (k = v by name) or ``printf`` (map[k:v ...], by name); absent fields are left out."""
    if form == "json":
        return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
    mark = {"fields": " = ", "printf": ":"}[form]
    pairs = F.filter(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(c + mark), go_str(df, c))) for c in sorted(df.columns)]), lambda x: x.isNotNull())
    joined = F.array_join(pairs, "\n" if form == "fields" else " ")
    return df.select((joined if form == "fields" else F.concat(F.lit("map["), joined, F.lit("]"))).alias("value"))


def write_text(df: DataFrame, path: str, form: str = "json") -> None:
    text_lines(df, form).write.text(path)


def sink_none(df: DataFrame) -> None:
    """Run the plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def timestamp_of(df: DataFrame, field: str, scale: str, now: Column | None = None) -> Column:
    """The field times the scale as timestamp; missing, zero or not a number gives now."""
    n = col_or_null(df, field).cast("string").try_cast("double")
    return F.coalesce(F.when(n != 0, F.timestamp_micros((n * SCALES[scale]).cast("bigint"))), F.current_timestamp() if now is None else now)


def to_label_lines(df: DataFrame, labels: list[str], time_field: str, scale: str = "1s", static: dict[str, str] | None = None, ignore: list[str] | None = None, now: Column | None = None) -> DataFrame:
    """(labels map, time, line): label columns leave the line, ignored ones leave both, static labels join; in label
    names '/', '.' and '-' become '_', and names that are still not valid are left out. A time field that is a label
    is not found in the line, so its rows are stamped with now."""
    clean = {c: c.translate(str.maketrans("/.-", "___")) for c in labels if c not in (ignore or [])}
    valid = {c: n for c, n in clean.items() if n and not n[0].isdigit() and all(x.isascii() and (x.isalnum() or x == "_") for x in n)}
    pairs = [F.when(col_or_null(df, c).isNotNull(), F.struct(F.lit(n).alias("key"), go_str(df, c).alias("value"))) for c, n in valid.items()]
    fixed = [F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (static or {}).items()]
    found = F.map_from_entries(F.filter(F.array(*pairs, *fixed), lambda x: x.isNotNull())) if pairs or fixed else F.create_map().cast("map<string,string>")
    rest = [c for c in df.columns if c not in labels and c not in (ignore or [])]
    time = timestamp_of(df.select(*[F.col(f"`{c}`") for c in rest]), time_field, scale, now) if time_field in rest else (F.current_timestamp() if now is None else now)
    return df.select(found.alias("labels"), time.alias("time"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("line"))


def padded(number: Column) -> Column:
    """The number as text of eight digits, or more where it has more."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(8), F.length(text)), F.lit("0"))


def object_batches(df: DataFrame, time_col: str, size: int = 10, account: str = "account", stream_id: str = "0", header: dict | None = None, order: list[str] | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(path, n, object): JSON objects of up to ``size`` rows of an hour, with the header, capture times and number of rows.

    Rows are numbered within their hour by time, then ``order``, then the other columns; each ``size`` rows are a batch,
    and only an hour's last one may be short. Ranges of ``RANGE_ROWS`` rows of about equal times are numbered apart, in
    ranges of time and order over the whole table, and each range's hour starts where the ranges before it end.
    """
    from pyspark.sql import Window

    hour = F.date_trunc("hour", F.col(time_col))
    rows = df.select(hour.alias("_hour"), F.col(time_col).alias("_t"), F.xxhash64(*df.columns).alias("_hash"), F.struct(*df.columns).alias("_row"))
    keys = ["_hour", "_t", *[F.col("_row")[c] for c in order or []], "_hash"]
    # sampled bounds differ from one evaluation to the next, so ranges are written once
    ranges = staged(rows.withColumn("_any", F.rand(0)).repartitionByRange(max(1, -(-df.count() // range_rows)), *keys, "_any").withColumn("_range", F.spark_partition_id()).drop("_any"), "object-ranges")
    counts = ranges.groupBy("_hour", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_hour").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_hour", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_hour", "_range").orderBy(*keys[1:])
    counts = counts.withColumnsRenamed({"_hour": "_h", "_range": "_r"})
    rows = ranges.withColumn("_at", F.row_number().over(w) - 1).join(counts, F.col("_hour").eqNullSafe(F.col("_h")) & (F.col("_range") == F.col("_r")))
    rows = rows.withColumn("_at", F.col("_before") + F.col("_at")).withColumn("_batch", F.floor(F.col("_at") / size))
    fixed = [F.lit(v).alias(k) for k, v in (header or {}).items()]
    group = rows.groupBy("_hour", "_batch").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_row"))), lambda x: x["_row"]).alias("flow_logs"), F.min("_t").alias("start"), F.max("_t").alias("end"))
    body = F.to_json(F.struct(*fixed, F.lit(VERSION).alias("version"), F.col("start").alias("capture_start_time"), F.col("end").alias("capture_end_time"), F.size("flow_logs").alias("number_of_flow_logs"), "flow_logs"))
    path = F.concat(
        F.lit(f"{account}/"), F.date_format("_hour", "'year='yyyy'/month='MM'/day='dd'/hour='HH"), F.lit(f"/stream-id={stream_id}/"),
        padded(F.col("_batch")),
    )
    return group.select(path.alias("path"), F.size("flow_logs").alias("n"), body.alias("object"))


def to_kafka_rows(df: DataFrame) -> DataFrame:
    """JSON values without a key, ready for ``write.format('kafka')``."""
    return text_lines(df)


def _attributes(df: DataFrame, columns: dict[str, str]) -> Column:
    """Map name to text of the columns that are not NULL."""
    pairs = [F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(n).alias("key"), go_str(df, c).alias("value"))) for c, n in columns.items()]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda x: x.isNotNull()))


def to_otel_logs(df: DataFrame) -> DataFrame:
    """(severity_number, severity_text, body, attributes)."""
    return df.select(F.lit(9).alias("severity_number"), F.lit("INFO").alias("severity_text"), text_lines_column(df).alias("body"), _attributes(df, {c: c for c in df.columns}).alias("attributes"))


def text_lines_column(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def to_otel_spans(df: DataFrame, splitters: list[str], id_col: str) -> DataFrame:
    """(trace, name, parent, attributes): a parent span with all fields, and a child for each prefix that a present field
    has, holding that prefix' fields without it and all fields without a listed prefix. The first matching prefix counts."""
    owner = {c: next((s for s in splitters if c.startswith(s)), None) for c in df.columns}
    spans = [F.struct(F.lit("flow").alias("name"), F.lit(None).cast("string").alias("parent"), _attributes(df, {c: c for c in df.columns}).alias("attributes"))]
    for s in splitters:
        mine = [c for c in df.columns if owner[c] == s]
        if mine:
            some = F.coalesce(*[F.col(f"`{c}`").cast("string") for c in mine]).isNotNull()
            columns = {c: c.removeprefix(s) if owner[c] == s else c for c in df.columns if owner[c] in (s, None)}
            spans.append(F.when(some, F.struct(F.lit(s).alias("name"), F.lit("flow").alias("parent"), _attributes(df, columns).alias("attributes"))))
    return df.select(F.col(id_col).alias("trace"), F.explode(F.filter(F.array(*spans), lambda x: x.isNotNull())).alias("s")).select("trace", "s.*")


#: Export element of each flow field that both address families have.
ELEMENTS = {
    "Bytes": "octetDeltaCount", "Packets": "packetDeltaCount", "SrcPort": "sourceTransportPort", "DstPort": "destinationTransportPort", "Proto": "protocolIdentifier",
    "TimeFlowStartMs": "flowStartMilliseconds", "TimeFlowEndMs": "flowEndMilliseconds", "SrcMac": "sourceMacAddress", "DstMac": "destinationMacAddress", "Etype": "ethernetType", "Flags": "tcpControlBits",
    "XlatSrcPort": "postNAPTSourceTransportPort", "XlatDstPort": "postNAPTDestinationTransportPort", "TimeFlowRttNs": "timeFlowRttNs", "SrcK8S_Namespace": "sourcePodNamespace", "SrcK8S_Name": "sourcePodName",
    "DstK8S_Namespace": "destinationPodNamespace", "DstK8S_Name": "destinationPodName", "SrcK8S_HostName": "sourceNodeName", "DstK8S_HostName": "destinationNodeName",
}
IPV6 = 0x86DD


def to_ipfix_columns(df: DataFrame, v6: bool = False) -> DataFrame:
    """The export columns of one address family; lists give their first entry and the joined rest, sampling a
    probability, and addresses after translation are the family's zero address where the flow has none."""
    family = F.coalesce(col_or_null(df, "Etype").cast("int") == IPV6, F.lit(False))
    rows = df.filter(family if v6 else ~family)
    end, zero = ("v6", "::") if v6 else ("v4", "0.0.0.0")
    out = [col_or_null(df, "SrcAddr").alias(f"sourceIP{end}Address"), col_or_null(df, "DstAddr").alias(f"destinationIP{end}Address")]
    out += [F.coalesce(col_or_null(df, f"Xlat{side}Addr").cast("string"), F.lit(zero)).alias(f"postNAT{name}IP{end}Address") for side, name in (("Src", "Source"), ("Dst", "Destination"))]
    if v6 and "Proto" in df.columns:
        out.append(F.col("Proto").alias("nextHeaderIPv6"))
    for c, n in (("IcmpType", "icmpType"), ("IcmpCode", "icmpCode")):
        if c in df.columns:
            out.append(F.col(c).alias(f"{n}IP{end}"))
    for c, n in ELEMENTS.items():
        if c in df.columns:
            v = F.col(c)
            out.append((encode_tcp_flags(v) if isinstance(kind_of(df, c), T.ArrayType) else v).alias(n))
    for c, one, joined in (("Interfaces", "interfaceName", "interfaceNames"), ("IfDirections", "flowDirection", "flowDirections")):
        if c in df.columns:
            out += [F.get(c, F.lit(0)).alias(one), F.array_join(F.col(c).cast("array<string>"), ",").alias(joined)]
    if "Sampling" in df.columns:
        out += [F.when(F.col("Sampling") > 0, 1.0 / F.col("Sampling")).alias("samplingProbability"), F.lit(4).alias("samplingAlgorithm")]
    return rows.select(*out)
