"""Keyed aggregates: totals so far and what this batch added, for each rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.coerce import go_str, to_double

OPERATIONS = ("sum", "avg", "min", "max", "count", "raw_values")
MOST = 1.7976931348623157e308


def _value(rule: dict, v: Column) -> Column:
    found = {
        "sum": F.coalesce(F.sum(v), F.lit(0.0)), "count": F.count(F.lit(1)).cast("double"), "avg": F.coalesce(F.avg(v), F.lit(0.0)),
        "max": F.greatest(F.lit(0.0), F.max(v)), "min": F.coalesce(F.min(v), F.lit(MOST)), "raw_values": F.lit(0.0),
    }
    return found[rule["operation"]]


def aggregate(df: DataFrame, rule: dict) -> DataFrame:
    """One row a group of rule {name, by, operation, key, batch?}: name, operation_type, operation_key, by, aggregate,
    total_value, total_count, recent_op_value, recent_count, recent_raw_values and the keys as text.

    Rows without all keys are left out. Over a table the whole is one batch, so recent equals total. A column that
    ``batch`` names (a window's start, say) cuts each group further and joins the result: the lists of raw_values are
    then bounded by a batch, however frequent the key.
    """
    if rule["operation"] not in OPERATIONS:
        raise ValueError(f"unknown operation {rule['operation']!r}")
    by, key = rule["by"], rule.get("key", "")
    v = to_double(df, key) if key else F.lit(None).cast("double")
    batch = [rule["batch"]] if rule.get("batch") else []
    keyed = df.select(*[go_str(df, k).alias(k) for k in by], *batch, v.alias("_v")).dropna(subset=by)
    value = _value(rule, F.col("_v"))
    raw = F.collect_list("_v") if rule["operation"] == "raw_values" else F.lit(None).cast("array<double>")
    out = keyed.groupBy(*by, *batch).agg(value.alias("total_value"), F.count(F.lit(1)).alias("total_count"), raw.alias("recent_raw_values"))
    return out.select(
        F.lit(rule["name"]).alias("name"), F.lit(rule["operation"]).alias("operation_type"), F.lit(key).alias("operation_key"), F.lit(",".join(by)).alias("by"),
        F.concat_ws(",", *sorted(by)).alias("aggregate"), "total_value", "total_count", F.col("total_value").alias("recent_op_value"), F.col("total_count").alias("recent_count"),
        "recent_raw_values", *by, *batch,
    )


def merge_totals(before: DataFrame, batch: DataFrame, rule: dict) -> DataFrame:
    """All groups after one more batch: recent from the batch (0 where it has none), totals from both.

    before: an earlier result of the same rule; batch: aggregate() of the new rows.
    """
    by, op = rule["by"], rule["operation"]
    a, b = before.alias("a"), batch.alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in by])
    old, new, n, m = F.col("a.total_value"), F.col("b.total_value"), F.coalesce("a.total_count", F.lit(0)), F.coalesce("b.total_count", F.lit(0))
    total = {
        "sum": F.coalesce(old, F.lit(0.0)) + F.coalesce(new, F.lit(0.0)), "count": (n + m).cast("double"), "max": F.greatest(old, new), "min": F.least(old, new),
        "avg": (F.coalesce(old, F.lit(0.0)) * n + F.coalesce(new, F.lit(0.0)) * m) / (n + m), "raw_values": F.lit(0.0),
    }[op]
    start = F.lit(MOST if op == "min" else 0.0)
    fixed = ["name", "operation_type", "operation_key", "by", "aggregate"]
    return a.join(b, same, "full").select(
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in fixed], total.alias("total_value"), (n + m).alias("total_count"),
        F.coalesce(new, start).alias("recent_op_value"), m.alias("recent_count"), F.col("b.recent_raw_values").alias("recent_raw_values"), *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in by],
    )


def expire(df: DataFrame, by: list[str], time_col: str, end: Column, seconds: int = 120) -> DataFrame:
    """Rows of the groups that had a row in the last ``seconds`` before end."""
    last = df.groupBy(*by).agg(F.max(time_col).alias("_last")).filter(F.col("_last") >= end - F.expr(f"INTERVAL {int(seconds)} SECONDS")).drop("_last")
    return df.join(last, by, "left_semi")


def aggregates(df: DataFrame, rules: list[dict]) -> DataFrame:
    """All rules' rows in one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [aggregate(df, r) for r in rules])
