"""Ready-made queries over flows: transform, aggregate by keys, metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.coerce import free_names
from flowloom.functions.net import subnet
from flowloom.operators.aggregate import aggregate
from flowloom.operators.asof import as_of
from flowloom.operators.enrich import add_location, add_service
from flowloom.operators.metrics import histogram

#: The connection size histogram's bounds, 128 bytes to 1 MiB.
SIZES = [float(2**i) for i in range(7, 21)]


def by_subnets(df: DataFrame, sides: dict[str, int], operation: str, key: str = "", name: str = "bandwidth") -> DataFrame:
    """An aggregate by the subnets (column: prefix length) of the flows' addresses."""
    out = df.withColumns({f"{c}Subnet": subnet(F.col(c), p) for c, p in sides.items()})
    return aggregate(out, {"name": name, "by": [f"{c}Subnet" for c in sides], "operation": operation, "key": key})


def bandwidth_per_service(df: DataFrame, protocols: DataFrame, services: DataFrame) -> DataFrame:
    out = add_service(df, "DstPort", "Proto", "service", protocols, services)
    return aggregate(out, {"name": "bandwidth_per_service", "by": ["service"], "operation": "sum", "key": "Bytes"})


def service_counts(df: DataFrame, protocols: DataFrame, services: DataFrame) -> DataFrame:
    out = add_service(df, "DstPort", "Proto", "service", protocols, services)
    return aggregate(out, {"name": "service_count", "by": ["service"], "operation": "count"})


def counts_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Connections for each value of the keys (flags, autonomous systems)."""
    return aggregate(df, {"name": "connections", "by": keys, "operation": "count"})


def size_histogram(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Histogram of each column, labelled by the column's name; buckets are counted in place, no list is gathered."""
    found = None
    for c in columns:
        h = histogram(df, {"name": f"{name}_{c}", "value_key": c, "labels": []}, SIZES)
        found = h if found is None else found.unionByName(h)
    return found


def geo_rate(df: DataFrame, ranges: DataFrame) -> DataFrame:
    out = add_location(df, "DstAddr", "Dst", ranges)
    return aggregate(out, {"name": "geo_rate", "by": ["Dst_CountryName"], "operation": "count"})


def rate(df: DataFrame, keys: list[str], value: Column, time_col: str, window: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Per window and keys: the sum of value for each second."""
    return df.groupBy(F.window(time_col, window)["start"].alias("window_start"), *keys).agg((F.sum(value) / seconds).alias("rate"))


def counter_rate(df: DataFrame, keys: list[str], value_col: str, time_col: str, window: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Per window and keys: by how much a counter's samples grew for each second. A sample below the one before it starts
    from zero (the counter was reset); a series' first sample tells no growth. Samples meet the one before in an as-of join,
    so a series of any length is many tasks' work; of samples of one time the least counts as the earlier one."""
    value, number, before = F.col(f"`{value_col}`").cast("double"), *free_names(df, "_number", "_before")
    rows = df.select(*keys, F.col(f"`{time_col}`").alias("_t"), value.alias("_v")).dropna(subset=["_t", "_v"])
    rows = rows.groupBy(*keys, "_t").agg(F.min("_v").alias("_low"), F.max("_v").alias("_v"))  # within one time a counter only grows
    rows = rows.withColumn(number, F.unix_micros(F.col("_t").cast("timestamp")) - 1)
    found = as_of(rows, rows.select(*keys, "_t", F.col("_v").alias("_held")), keys, number, "_t", {before: "_held"})
    known = F.col(before).isNotNull()
    grown = F.when(known, F.when(F.col("_low") >= F.col(before), F.col("_low") - F.col(before)).otherwise(F.col("_low"))).otherwise(F.lit(0.0)) + F.col("_v") - F.col("_low")
    return found.groupBy(F.window("_t", window)["start"].alias("window_start"), *keys).agg((F.sum(grown) / seconds).alias("rate"))


def sum_over_time(df: DataFrame, keys: list[str], value: Column, time_col: str, length: str, step: str) -> DataFrame:
    """(window_start, keys, total, n): sums and numbers of samples over windows of a length that begin every step."""
    return df.groupBy(F.window(time_col, length, step)["start"].alias("window_start"), *keys).agg(F.sum(value).cast("double").alias("total"), F.count(value).alias("n"))


def top_rates(rates: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """The k largest of each window."""
    w = Window.partitionBy("window_start").orderBy(F.col("rate").desc(), *keys)
    return rates.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def rate_totals(rates: DataFrame) -> DataFrame:
    """(window_start, total_rate, n): the sum of each window's rates, and how many keys have one."""
    return rates.groupBy("window_start").agg(F.sum("rate").alias("total_rate"), F.count("*").alias("n"))
