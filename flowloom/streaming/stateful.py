"""Streams: keyed totals with expiry, and connection tracking with event-time timers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowloom.functions.coerce import go_str
from flowloom.operators import conntrack, topk, walk
from flowloom.operators.aggregate import aggregate, merge_totals


def windowed_aggregate(df: DataFrame, rule: dict, time_col: str, window: str, late: str, slide: str | None = None) -> DataFrame:
    """Aggregate rule {by, operation, key} over event-time windows; rows later than ``late`` are dropped by the watermark."""
    value = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}.get(rule["operation"])
    agg = F.count(F.lit(1)).cast("double") if value is None else value(F.col(rule["key"]).cast("double"))
    rows = df.withWatermark(time_col, late)
    return rows.groupBy(F.window(time_col, window, slide), *rule["by"]).agg(agg.alias("value")).select(F.col("window.start").alias("window_start"), *rule["by"], "value")


def _kept(spark, path: str, number: int) -> DataFrame | None:
    """The state that the batch before this one left; states older than that go."""
    if number == 0:
        return None
    for old in range(max(0, number - 4), number - 1):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={old}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return spark.read.parquet(f"{path}/batch={number - 1}")


def _keep(df: DataFrame, path: str, number: int) -> DataFrame:
    at = f"{path}/batch={number}"
    df.write.mode("overwrite").parquet(at)
    return df.sparkSession.read.parquet(at)


def stream_aggregates(df: DataFrame, rule: dict, totals_path: str, each: Callable[[DataFrame], None], checkpoint: str, time_col: str | None = None, expiry: int = 120):
    """Per micro-batch, all groups with totals so far and this batch's values, handed to ``each``.

    The totals are a table that every batch rewrites under its own number, so a repeated batch starts from
    the same totals and a lost executor costs a task; tables of earlier batches are deleted. With ``time_col`` a group
    goes when its last row is more than ``expiry`` seconds older than the newest row of all.
    """
    by = rule["by"]

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        new = aggregate(rows, rule)
        seen = F.lit(None).cast("timestamp") if time_col is None else F.col(time_col)
        last = rows.select(*[go_str(rows, k).alias(k) for k in by], seen.alias("_last")).groupBy(*by).agg(F.max("_last").alias("_last"))
        before = _kept(spark, totals_path, number)
        if before is not None:
            new = merge_totals(before.drop("_last"), new, rule)
            last = last.unionByName(before.select(*by, "_last")).groupBy(*by).agg(F.max("_last").alias("_last"))
        new = new.join(last, by)
        if time_col is not None:
            newest = F.broadcast(last.agg(F.max("_last").alias("_newest")))
            new = new.crossJoin(newest).filter(F.col("_last") >= F.col("_newest") - F.expr(f"INTERVAL {int(expiry)} SECONDS")).drop("_newest")  # one row
        each(_keep(new, totals_path, number).drop("_last"))

    return df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def stream_topk(df: DataFrame, rule: dict, time_col: str, each: Callable[[DataFrame], None], checkpoint: str, rows_path: str):
    """Per micro-batch, the K largest of all rows so far within the rule's interval before the newest row.

    The rows of the interval are kept as a table of each batch's number, like the totals of stream_aggregates.
    """

    def batch(rows: DataFrame, number: int) -> None:
        before = _kept(rows.sparkSession, rows_path, number)
        rows = rows if before is None else before.unionByName(rows)
        newest = rows.agg(F.max(time_col).alias("t")).first()["t"]
        inside = rows if newest is None else rows.filter(F.col(time_col) >= F.lit(newest) - F.expr(f"INTERVAL {rule['interval']}"))
        kept = _keep(inside, rows_path, number)
        if newest is not None:
            each(topk.timebased(kept, rule, time_col, F.lit(newest)))

    return df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


class Tracker(StatefulProcessor):
    """Connections with event-time timers: a row joins its connection, a timer brings a heartbeat or the end."""

    def __init__(self, conf: dict, names: list[str], inputs: list[str], whole: list[str]):
        self.conf, self.names, self.inputs, self.whole = conf, names, inputs, whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        import pickle

        self.handle, self.pickle = handle, pickle
        self.state = handle.getValueState("connection", "data binary")

    def _load(self):
        return self.pickle.loads(bytes(self.state.get()[0])) if self.state.exists() else None

    def _save(self, live) -> None:
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        if live is None:
            self.state.clear()
            return
        self.state.update((self.pickle.dumps(live),))
        due = min(live.until, live.beat) if live.ends is None else live.ends
        self.handle.registerTimer(int(due * 1000) + 1)

    def _due(self, live, now: float, out: list):
        if live is not None:
            out += live.due(now)
            if now > live.until:
                out.append(live.record("endConnection", live.until))
                return None
        return live

    def _rows(self, batch: pd.DataFrame) -> list[dict]:
        """A batch's rows as values of their own types: pandas holds integers that may be NULL as floats, and no None."""
        columns = batch.set_axis(self.inputs, axis=1)  # Spark renames columns with a leading underscore on the way here
        out = []
        for r in columns.to_dict("records"):
            r = {k: None if v is None or v != v else v for k, v in r.items()}
            out.append({k: int(v) if v is not None and k in self.whole else v for k, v in r.items()})
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        live, out = self._load(), []
        later = [c for c in self.inputs if c[0] == "o"]
        given = sorted((r for b in rows for r in self._rows(b)), key=lambda r: (r["_t"], *[r[c] for c in later]))  # one key's rows of one micro-batch
        for r in given:
            live = self._due(live, r["_t"], out)
            if live is None:
                live = walk.Connection(self.conf, r)
                out.append(live.record("newConnection", r["_t"]))
            else:
                live.add(r)
        self._save(live)
        yield pd.DataFrame(out, columns=self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out: list = []
        self._save(self._due(self._load(), expiredTimerInfo.getExpiryTimeInMs() / 1000, out))
        yield pd.DataFrame(out, columns=self.names)

    def close(self) -> None:
        pass


def stream_track(df: DataFrame, conf: dict = conntrack.DEFAULT, late: str = "10 seconds") -> DataFrame:
    """A stream of connection records (see operators.walk.track). Needs the RocksDB state store."""
    conntrack.validate(conf)
    conf = conntrack.normal(conf)
    schema = walk.record_schema(df, conf)
    rows = walk.timed(df.withWatermark("event_time", late), conf, keep_time=True)
    whole = [f.name for f in rows.schema if f.dataType.typeName() in ("byte", "short", "integer", "long")]
    return rows.groupBy(*walk.KEY).transformWithStateInPandas(Tracker(conf, schema.names, rows.columns, whole), schema, "Append", "EventTime")
