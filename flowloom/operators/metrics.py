"""Labelled metrics: counters, gauges and histograms from flow rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.coerce import free_names, go_str, to_double
from flowloom.functions.predicates import injected
from flowloom.operators.counts import Counts

#: The default histogram bounds.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def _text(df: DataFrame, field: str) -> Column:
    """A field's text; ``list>key`` addresses the flattened part's entry."""
    if ">" in field:
        name, sub = field.split(">", 1)
        return F.try_element_at(F.col(f"`{name}`"), F.lit(sub)) if name in df.columns else F.lit(None).cast("string")
    return go_str(df, field)


def flatten(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row for each element of each list field (several: their cross product); an empty or absent list gives one NULL."""
    for f in fields:
        if f in df.columns and isinstance(df.schema[f].dataType, T.ArrayType):
            df = df.withColumn(f, F.explode_outer(f"`{f}`"))
    return df


def filtered(df: DataFrame, filters: list[dict]) -> DataFrame:
    """Filters {key, type, value}: those of one key are alternatives, different keys must all hold."""
    by_key: dict[str, list[Column]] = {}
    for f in filters:
        kind, value, text = f.get("type", "equal"), f.get("value", ""), _text(df, f["key"])
        same = F.coalesce(text == injected(df, value), F.lit(False))
        found = F.coalesce(text.rlike(value), F.lit(False)) if "match" in kind else None
        by_key.setdefault(f["key"], []).append({
            "equal": same, "not_equal": ~same, "presence": text.isNotNull(), "absence": text.isNull(),
            "match_regex": found, "not_match_regex": ~found if found is not None else None,
        }[kind])
    for alternatives in by_key.values():
        df = df.filter(reduce(lambda a, b: a | b, alternatives))
    return df


def _sampled(df: DataFrame, metric: dict, keep: list[str] | None = None, counts: Counts | None = None) -> tuple[DataFrame, list[str]]:
    """(_l0, _l1, ..., value and _<keep> columns of the rows that the metric takes; the labels' names). ``counts`` sees the
    metric's name: rows that passed its filters, and those whose value is no number (ValueConversionError)."""
    rows = filtered(flatten(df, metric.get("flatten", [])), metric.get("filters", []))
    key, scale, remap = metric.get("value_key", ""), metric.get("value_scale", 1) or 1, metric.get("remap", {})
    value = F.lit(1.0) if not key else to_double(rows, key) / F.lit(float(scale))
    named = {remap.get(name, name): F.coalesce(_text(rows, name), F.lit("")) for name in metric.get("labels", [])}
    if key in rows.columns and isinstance(rows.schema[key].dataType, T.ArrayType):  # agg_histogram: the value is a list and is never scaled
        (element,) = free_names(rows, "_element")
        rows = rows.withColumn(element, F.explode(f"`{key}`"))
        value = F.col(element).cast("double")
    if counts is not None:
        there = F.col(f"`{key}`").isNotNull() if key in rows.columns else F.lit(False)
        rows = counts.watch(rows, metric["name"], {"ValueConversionError": there & value.isNull()})
    shown = [c.alias(f"_l{i}") for i, c in enumerate(named.values())]
    return rows.select(*shown, *[F.col(f"`{k}`").alias(f"_{k}") for k in keep or []], value.alias("value")).filter("value is not null"), list(named)


def _labels(names: list[str]) -> Column:
    return (F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.col(f"_l{i}"))]) if names else F.create_map().cast("map<string,string>")).alias("labels")


def samples(df: DataFrame, metric: dict, keep: list[str] | None = None) -> DataFrame:
    """(labels map, value) of the rows that metric {filters, flatten, labels, remap, value_key, value_scale} takes;
    the full value counts for each flattened part. Absent labels are ''; rows without a number are skipped."""
    rows, names = _sampled(df, metric, keep)
    return rows.select(_labels(names), *[f"_{k}" for k in keep or []], "value")


def _grouped(df: DataFrame, metric: dict, aggs: list[Column], keep: list[str] | None = None, counts: Counts | None = None) -> DataFrame:
    """labels and the aggregates of each label set, in columns of label values until they are summed up."""
    rows, names = _sampled(df, metric, keep, counts)
    by = [F.col(f"_l{i}") for i in range(len(names))] or [F.lit(0).alias("_l0")]
    g = rows.groupBy(*by).agg(*aggs)
    return g.select(*g.columns, _labels(names))


def counter(df: DataFrame, metric: dict, counts: Counts | None = None) -> DataFrame:
    """(metric, type, labels, value): the sum for each label set."""
    return _named(_grouped(df, metric, [F.sum("value").alias("value")], counts=counts), metric, "counter")


def gauge(df: DataFrame, metric: dict, time_col: str, order: list[str] | None = None) -> DataFrame:
    """The last value of each label set."""
    keep = [time_col, *(order or [])]
    return _named(_grouped(df, metric, [F.max_by("value", F.struct(*[f"_{k}" for k in keep])).alias("value")], keep), metric, "gauge")


def _named(g: DataFrame, metric: dict, kind: str) -> DataFrame:
    return g.select(F.lit(metric.get("prefix", "") + metric["name"]).alias("metric"), F.lit(kind).alias("type"), "labels", "value")


def histogram(df: DataFrame, metric: dict, buckets=None) -> DataFrame:
    """(metric, labels, le, cumulative_count, sum, count): a row for each bound and label set, then +Inf."""
    bounds = list(buckets or metric.get("buckets") or BUCKETS)
    g = _grouped(df, metric, [F.sum("value").alias("sum"), F.count("*").alias("count"), *[F.count_if(F.col("value") <= b).alias(f"_b{i}") for i, b in enumerate(bounds)]])
    rows = F.array(*[F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"_b{i}").alias("n")) for i, b in enumerate(bounds)], F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("n")))
    return g.withColumn("_r", F.explode(rows)).select(F.lit(metric.get("prefix", "") + metric["name"]).alias("metric"), "labels", "_r.le", F.col("_r.n").alias("cumulative_count"), "sum", "count")


def live(df: DataFrame, metric: dict, time_col: str, end: Column, ttl: int = 120) -> DataFrame:
    """Label sets that had a sample in the last ``ttl`` seconds before end: labels and last time."""
    g = _grouped(df, metric, [F.max(f"_{time_col}").alias("last")], [time_col])
    return g.filter(F.col("last") >= end - F.expr(f"INTERVAL {int(ttl)} SECONDS")).select("labels", "last")


def capped(df: DataFrame, metric: dict, time_col: str, most: int, counts: Counts | None = None) -> DataFrame:
    """The counter of the ``most`` label sets that came first; later label sets are dropped, which is the feature. ``counts``
    sees label sets and samples before the cap (``<name>.all``) and after it (``<name>.kept``); the rest was dropped."""
    g = _grouped(df, metric, [F.sum("value").alias("value"), F.min(f"_{time_col}").alias("_first"), F.count(F.lit(1)).alias("_n")], [time_col], counts)
    by = [c for c in g.columns if c.startswith("_l")]
    if counts is None:
        return _named(g.orderBy("_first", *by).limit(most), metric, "counter")
    kept = counts.watch(g, f"{metric['name']}.all", {}, {"samples": F.col("_n")}).orderBy("_first", *by).limit(most)
    return _named(counts.watch(kept, f"{metric['name']}.kept", {}, {"samples": F.col("_n")}), metric, "counter")


def exposition(metrics: DataFrame) -> DataFrame:
    """``name{label="value",...} value`` lines, labels by name."""
    pairs = F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"')))
    whole = F.when((F.col("value") == F.floor("value")) & (F.abs("value") < 1e15), F.col("value").cast("bigint").cast("string")).otherwise(F.col("value").cast("string"))
    return metrics.select(F.concat(F.col("metric"), F.when(F.size("labels") > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise(F.lit("")), F.lit(" "), whole).alias("line"))


#: The bounds of a histogram without bounds of its own, as the telemetry kit sets them.
OTEL_BOUNDS = (0.0, 5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0, 500.0, 750.0, 1000.0, 2500.0, 5000.0, 7500.0, 10000.0)


def otel_metrics(df: DataFrame, metrics: list[dict], prefix: str = "", time_col: str | None = None, order: list[str] | None = None) -> DataFrame:
    """Data points of metrics {name, type, help?, buckets?, and what ``samples`` reads}: (name, description, type, attributes,
    value of counters and gauges; bounds, bucket_counts, sum and count of histograms). bucket_counts has the values of
    each bucket alone, the last those above all bounds. A gauge needs time_col; an agg_histogram is no export type."""
    found = None
    for m in metrics:
        kind = m["type"]
        if kind not in ("counter", "gauge", "histogram"):
            raise ValueError(f"metric type {kind!r} cannot be exported")
        named = [F.lit(prefix + m["name"]).alias("name"), F.lit(m.get("help", "")).alias("description"), F.lit(kind).alias("type"), F.col("labels").alias("attributes")]
        none = lambda n, t: F.lit(None).cast(t).alias(n)
        if kind == "histogram":
            bounds = [float(b) for b in m.get("buckets") or OTEL_BOUNDS]
            low = [None, *bounds]
            inside = [(F.lit(True) if a is None else F.col("value") > a) & (F.lit(True) if b is None else F.col("value") <= b) for a, b in zip(low, [*bounds, None])]
            g = _grouped(df, m, [F.sum("value").alias("sum"), F.count("*").alias("count"), *[F.count_if(c).alias(f"_b{i}") for i, c in enumerate(inside)]])
            points = g.select(*named, none("value", "double"), F.array(*[F.lit(b) for b in bounds]).alias("bounds"), F.array(*[f"_b{i}" for i in range(len(inside))]).alias("bucket_counts"), "sum", "count")
        else:
            g = counter(df, m) if kind == "counter" else gauge(df, m, time_col, order)
            points = g.select(*named, "value", none("bounds", "array<double>"), none("bucket_counts", "array<bigint>"), none("sum", "double"), none("count", "bigint"))
        found = points if found is None else found.unionByName(points)
    return found
