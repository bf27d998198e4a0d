"""Keyed aggregates over a time window, and the K largest or smallest of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.coerce import go_str, to_double

OPERATIONS = ("sum", "avg", "min", "max", "count", "last", "diff")


def _value(op: str, order: list[str]) -> Column:
    at = F.struct(*order)
    return {
        "sum": F.coalesce(F.sum("_v"), F.lit(0.0)), "avg": F.coalesce(F.avg("_v"), F.lit(0.0)), "min": F.min("_v"), "max": F.max("_v"), "count": F.count("_v").cast("double"),
        "last": F.max_by("_v", at), "diff": F.max_by("_v", F.when(F.col("_v").isNotNull(), at)) - F.min_by("_v", F.when(F.col("_v").isNotNull(), at)),
    }[op]


def timebased(df: DataFrame, rule: dict, time_col: str, end: Column | None = None, order: list[str] | None = None) -> DataFrame:
    """rule: {name, index_keys, operation, key, top_k, reversed, interval, slide?}.

    Without ``slide`` the window is the ``interval`` up to ``end`` (inclusive; no end: all rows). With it,
    every sliding window gets its own ranking, in column window_start. Every index key must be present and
    not empty. ``order`` breaks ties of time for last and diff. Equal values rank by their keys.
    """
    op, keys, key = rule["operation"], rule["index_keys"], rule["key"]
    if op not in OPERATIONS:
        raise ValueError(f"unknown operation {op!r}")
    rows = df.select(*[go_str(df, k).alias(k) for k in keys], to_double(df, key).alias("_v"), F.col(time_col).alias("_t"), *[F.col(c).alias(f"_o_{c}") for c in order or []])
    for k in keys:
        rows = rows.filter(F.coalesce(F.col(k) != "", F.lit(False)))
    by, shown = list(keys), []
    if rule.get("slide"):
        rows = rows.withColumn("window_start", F.window("_t", rule["interval"], rule["slide"])["start"])
        by, shown = [*by, "window_start"], ["window_start"]
    elif end is not None:
        rows = rows.filter(F.col("_t") >= end - F.expr(f"INTERVAL {rule['interval']}"))
    found = rows.groupBy(*by).agg(_value(op, ["_t", *[f"_o_{c}" for c in order or []]]).alias("_value")).filter("_value is not null")
    k, ranked = rule.get("top_k", 0), F.col("_value").asc() if rule.get("reversed") else F.col("_value").desc()
    if k > 0 and shown:
        w = Window.partitionBy("window_start").orderBy(ranked, *keys)
        found = found.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    elif k > 0:
        found = found.orderBy(ranked, *keys).limit(k)
    return found.select(F.lit(rule["name"]).alias("name"), F.concat_ws(",", *keys).alias("index_key"), F.lit(op).alias("operation"), F.col("_value").alias(key), *keys, *shown)
