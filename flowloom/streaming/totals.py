"""Running totals of label sets on streams: metrics and keyed aggregates with expiry and a cap.

Rows are folded before they are shuffled: each Arrow batch gives one row a label set (count, sum, least, greatest, last
value, counts by bound). Those go by bucket of label sets to a stateful operator, whose state is a map from label set
to its totals in the RocksDB state store. A batch reads and writes the entries of its own label sets alone, so its cost
follows its rows, not the state's size; with changelog checkpoints (see ``changelog``) the store saves just those too.

Event time drives the rest: a label set goes once the watermark is more than ``ttl`` seconds past its last row (a row that comes
later than that starts it anew), and with ``report`` every so many seconds all live label sets are shown again. A bucket
admits ``most`` label sets at a time, in the order of their first rows; rows of further ones are counted as dropped until
one goes. (A cap over all label sets would need one task; ``most`` is a cap of each of ``buckets``.)

Edge cases: absent labels count as the empty text; rows without a number are counted as errors (``side_counts``) and
skipped; rows without a time are skipped; rows behind the watermark are dropped by Spark; an empty batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowloom.functions.coerce import go_str, to_double
from flowloom.operators import aggregate as agg
from flowloom.operators import metrics as M

#: Buckets of label sets; each is one key of the state store, with a map of its label sets.
BUCKETS = 1024
PARTIAL = "bucket int, labels array<string>, n long, sum double, low double, high double, first long, last long, first_value double, last_value double, counts array<long>, raw array<double>, seen timestamp"
TOTALS = "bucket int, labels array<string>, live boolean, n long, sum double, low double, high double, last_value double, counts array<long>, last long, batch_n long, batch_sum double, batch_low double, batch_high double, raw array<double>, dropped long"
_VALUE = "n bigint, sum double, low double, high double, last_value double, counts array<bigint>, last bigint"


def changelog(spark: SparkSession) -> None:
    """The RocksDB state store with changelog checkpoints: a batch uploads what it changed, not the whole state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def partials(rows: DataFrame, labels: list[Column], value: Column, time: Column, order: list[Column] | None = None, bounds: list[float] | None = None, raw: bool = False, buckets: int = BUCKETS, apart: int = 0) -> DataFrame:
    """One row for each Arrow batch and label set: what is shuffled instead of rows, however hot a label set is.
    The last ``apart`` labels have no part in the bucket."""
    named = {f"l{i}": F.coalesce(c.cast("string"), F.lit("")) for i, c in enumerate(labels)} or {"l0": F.lit("")}
    later = {f"o{i}": c for i, c in enumerate(order or [])}
    flat = rows.select(*[c.alias(n) for n, c in (named | later).items()], value.cast("double").alias("v"), F.unix_micros(time.cast("timestamp")).alias("t"))
    flat = flat.filter("v IS NOT NULL AND t IS NOT NULL").withColumn("bucket", F.pmod(F.xxhash64(*[*named][: len(named) - apart] or [F.lit(0)]), F.lit(buckets)).cast("int"))
    keys, sorting, limits = [*named], ["t", *later], [float(b) for b in bounds or []]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for b in batches:
            if not len(b):
                continue
            t = pa.Table.from_batches([b]).sort_by([(c, "ascending") for c in sorting])
            for i, x in enumerate(limits):
                t = t.append_column(f"c{i}", pc.cast(pc.less_equal(t["v"], x), pa.int64()))
            aggs = [("v", "count"), ("v", "sum"), ("v", "min"), ("v", "max"), ("v", "first"), ("v", "last"), ("t", "min"), ("t", "max"), *[(f"c{i}", "sum") for i in range(len(limits))], *([("v", "list")] if raw else [])]
            g = t.group_by(["bucket", *keys], use_threads=False).aggregate(aggs)
            made = {
                "bucket": g["bucket"], "labels": pa.array(list(zip(*[g[k].to_pylist() for k in keys])), pa.list_(pa.string())), "n": g["v_count"], "sum": g["v_sum"], "low": g["v_min"], "high": g["v_max"], "first": g["t_min"],
                "last": g["t_max"], "first_value": g["v_first"], "last_value": g["v_last"], "counts": pa.array(list(zip(*[g[f"c{i}_sum"].to_pylist() for i in range(len(limits))])) or [()] * len(g), pa.list_(pa.int64())),
                "raw": g["v_list"] if raw else pa.nulls(len(g), pa.list_(pa.float64())), "seen": pc.cast(g["t_max"], pa.timestamp("us", "UTC")),
            }
            yield from pa.table(made).combine_chunks().to_batches()

    return flat.mapInArrow(fold, PARTIAL)


class Sets(StatefulProcessor):
    """A bucket's label sets and their totals."""

    def __init__(self, ttl: float, most: int | None = None, report: float | None = None):
        self.ttl, self.most, self.report = int(ttl * 1_000_000), most, None if report is None else int(report * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sets = handle.getMapState("sets", "labels array<string>", _VALUE)
        self.counted = handle.getValueState("counted", "live bigint, dropped bigint, report bigint")

    @staticmethod
    def _row(bucket: int, labels, live: bool, v: tuple, batch: tuple = (0, 0.0, None, None, None), dropped: int = 0) -> tuple:
        return (bucket, labels, live, *v, *batch, dropped)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[c.split()[0] for c in TOTALS.split(", ")], dtype=object)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        live, dropped, due = self.counted.get() if self.counted.exists() else (0, 0, -1)
        given: dict[tuple, list] = {}
        for b in rows:
            for r in b.itertuples(index=False):
                given.setdefault(tuple(r.labels), []).append(r)
        out, before, earliest = [], dropped, None
        for labels, parts in sorted(given.items(), key=lambda x: min(r.first for r in x[1])):
            parts.sort(key=lambda r: (r.last, r.first))
            value = self.sets.getValue((list(labels),))
            first = min(r.first for r in parts)
            if value is not None and first > value[6] + self.ttl:  # it has gone since, though no timer said so yet
                out.append(self._row(key[0], list(labels), False, tuple(value)))
                value = (0, 0.0, None, None, None, None, value[6])
            if value is None:
                if self.most is not None and live >= self.most and due * 1000 <= first:  # some may have gone by now
                    gone, _ = self._expired(first)
                    out += [self._row(key[0], list(k), False, v) for k, v in gone]
                    live -= len(gone)
                if self.most is not None and live >= self.most:
                    dropped += sum(int(r.n) for r in parts)
                    continue
                live += 1
            own = None
            for r in parts:
                part = (int(r.n), float(r.sum), float(r.low), float(r.high), float(r.last_value), [int(c) for c in r.counts], int(r.last))
                own = self._add(own, part)
            value = self._add(value, own)
            self.sets.updateValue((list(labels),), value)
            raw = [x for r in parts for x in (r.raw if r.raw is not None else ())]
            out.append(self._row(key[0], list(labels), True, value, (own[0], own[1], own[2], own[3], raw)))
            earliest = min(value[6], earliest or value[6])
        if dropped > before:
            out.append(self._row(key[0], None, True, (0, 0.0, None, None, None, None, None), dropped=dropped))
        due = self._schedule(due, earliest)
        self.counted.update((live, dropped, due))
        yield self._frame(out)

    @staticmethod
    def _add(a: tuple | None, b: tuple) -> tuple:
        if a is None or a[0] == 0:
            return b
        newer = b if b[6] >= a[6] else a
        return (a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3]), newer[4], [x + y for x, y in zip(a[5], b[5])], newer[6])

    def _schedule(self, due: int, last: int | None) -> int:
        """The one timer of a bucket: the next report, or when the label set that was longest without rows may go."""
        if last is None:
            return due
        at = (last + self.ttl) // 1000 + 1
        if self.report is not None:
            at = min(at, (last // 1000 // self.report + 1) * self.report)
        if due < 0 or at < due:
            if due >= 0:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(at)
            return at
        return due

    def _expired(self, now: int) -> tuple[list[tuple], list[tuple]]:
        """(label sets that are gone by now, which are taken out; the rest), with their totals."""
        found = [(tuple(k)[0], tuple(v)) for k, v in self.sets.iterator()]
        gone = [x for x in found if x[1][6] + self.ttl < now]
        for labels, _ in gone:
            self.sets.removeKey((labels,))
        return gone, [x for x in found if x[1][6] + self.ttl >= now]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        live, dropped, _ = self.counted.get()
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        gone, rest = self._expired(now)
        out = [self._row(key[0], list(k), False, v) for k, v in gone]
        if self.report is not None:
            out += [self._row(key[0], list(k), True, v) for k, v in rest]
        oldest, at = min((v[6] for _, v in rest), default=None), -1
        if oldest is not None:
            at = (oldest + self.ttl) // 1000 + 1
            if self.report is not None:
                at = min(at, (now // 1000 // self.report + 1) * self.report)
            self.handle.registerTimer(at)
        self.counted.update((live - len(gone), dropped, at))
        yield self._frame(out)

    def close(self) -> None:
        pass


def totals(partial: DataFrame, late: str, ttl: float, most: int | None = None, report: float | None = None) -> DataFrame:
    """The changed label sets of each batch, in update mode (see TOTALS)."""
    return partial.withWatermark("seen", late).groupBy("bucket").transformWithStateInPandas(Sets(ttl, most, report), TOTALS, "Update", "EventTime")


def stream_metric(df: DataFrame, metric: dict, time_col: str, kind: str = "counter", late: str = "10 seconds", ttl: float = 120, most: int | None = None, report: float | None = None, order: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """A stream of (metric, type, labels, live, value, bounds, cumulative_counts, sum, count, dropped): the label sets of a
    counter, gauge or histogram that a batch changed, with their totals so far; live is false once when one expires.
    ``dropped`` counts the samples of a bucket that the cap ``most`` turned away so far, on rows of their own (labels NULL).
    The metric is that of operators.metrics; the last state of each label set equals the batch operators over the same rows.
    """
    if kind not in ("counter", "gauge", "histogram"):
        raise ValueError(f"unknown metric type {kind!r}")
    bounds = [float(b) for b in metric.get("buckets") or M.BUCKETS] if kind == "histogram" else []
    rows, names = M._sampled(df, metric, [time_col, *(order or [])])
    made = partials(rows, [F.col(f"_l{i}") for i in range(len(names))], F.col("value"), F.col(f"`_{time_col}`"), [F.col(f"`_{c}`") for c in order or []], bounds, buckets=buckets)
    t = totals(made, late, ttl, most, report)
    labels = F.map_from_arrays(F.array(*[F.lit(n) for n in names]).cast("array<string>"), F.when(F.lit(bool(names)), F.col("labels")).otherwise(F.array().cast("array<string>")))
    value = {"counter": F.col("sum"), "gauge": F.col("last_value"), "histogram": F.lit(None).cast("double")}[kind]
    return t.select(
        F.lit(metric.get("prefix", "") + metric["name"]).alias("metric"), F.lit(kind).alias("type"), F.when(F.col("labels").isNotNull(), labels).alias("labels"), "live", F.when(F.col("labels").isNotNull(), value).alias("value"),
        F.array(*[F.lit(b) for b in bounds]).cast("array<double>").alias("bounds"), F.col("counts").alias("cumulative_counts"), "sum", F.col("n").alias("count"), F.timestamp_micros("last").alias("last"), "bucket", "dropped",
    )


def stream_totals(df: DataFrame, rule: dict, time_col: str, late: str = "10 seconds", expiry: float = 120, report: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """A stream of the groups of an aggregate rule {name, by, operation, key} that a batch changed: totals so far and the
    batch's own values, as operators.aggregate has them, and whether the group is live. Groups expire; with ``report``
    every so many seconds all live ones are shown, with nothing recent."""
    op, by, key = rule["operation"], rule["by"], rule.get("key", "")
    if op not in agg.OPERATIONS:
        raise ValueError(f"unknown operation {op!r}")
    rows = df.select(*[go_str(df, k).alias(f"_k{i}") for i, k in enumerate(by)], F.coalesce(to_double(df, key) if key else F.lit(None).cast("double"), F.lit(float("nan")) if op in ("sum", "avg", "min", "max") and key else F.lit(0.0)).alias("_v"), F.col(f"`{time_col}`").alias("_t"))
    rows = rows.dropna(subset=[f"_k{i}" for i in range(len(by))])
    if op in ("sum", "avg", "min", "max"):
        rows = rows.filter(~F.isnan("_v"))
    t = totals(partials(rows, [F.col(f"_k{i}") for i in range(len(by))], F.col("_v"), F.col("_t"), raw=op == "raw_values", buckets=buckets), late, expiry, None, report)

    def value(n: str, total: str, low: str, high: str) -> Column:
        none = F.col(n) == 0
        return {
            "sum": F.col(total), "count": F.col(n).cast("double"), "avg": F.when(none, F.lit(0.0)).otherwise(F.col(total) / F.when(none, F.lit(1)).otherwise(F.col(n))), "max": F.greatest(F.lit(0.0), F.col(high)), "min": F.coalesce(F.col(low), F.lit(agg.MOST)), "raw_values": F.lit(0.0),
        }[op]

    keys = [F.get("labels", F.lit(i)).alias(k) for i, k in enumerate(by)]
    return t.select(
        F.lit(rule["name"]).alias("name"), F.lit(op).alias("operation_type"), F.lit(key).alias("operation_key"), F.lit(",".join(by)).alias("by"), F.concat_ws(",", *[F.get("labels", F.lit(by.index(k))) for k in sorted(by)]).alias("aggregate"),
        value("n", "sum", "low", "high").alias("total_value"), F.col("n").alias("total_count"), value("batch_n", "batch_sum", "batch_low", "batch_high").alias("recent_op_value"), F.col("batch_n").alias("recent_count"),
        F.col("raw").alias("recent_raw_values"), *keys, "live", F.timestamp_micros("last").alias("last"),
    )
