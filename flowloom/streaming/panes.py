"""Sliding top-K on streams by panes.

A window slides by a pane's width. Rows are folded to one partial aggregate for each index key and pane, before the shuffle
and in the state, so the state grows with keys times the panes of one interval and not with rows. Buckets of keys hold
them; when the watermark passes a pane's end, each bucket merges its keys' panes of the interval that ends there, keeps
its K best in a heap, and drops the panes that no later window needs. All buckets do so in one micro-batch, in which the
candidates of all buckets are merged to the K best of each window: K rows a bucket, however many keys there are.

Each window is written once, when it is complete, and equals ``topk.timebased`` with ``slide`` over the same rows. Rows
behind the watermark are dropped by Spark; rows without a key, a number or a time are left out; equal values rank by key.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowloom.functions.coerce import go_str, to_double
from flowloom.operators import topk
from flowloom.streaming.totals import partials

BUCKETS = 256
_PANE = "n bigint, sum double, low double, high double, first_t bigint, first_v double, last_t bigint, last_v double"
CANDIDATES = "window_start long, keys array<string>, value double"


def merged(a: tuple | None, b: tuple) -> tuple:
    """Two partial aggregates of one key as one."""
    if a is None:
        return b
    first, last = (a, b)[b[4] < a[4]], (a, b)[b[6] >= a[6]]
    return (a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3]), first[4], first[5], last[6], last[7])


def value_of(op: str, v: tuple) -> float:
    n, total, low, high, _, first, _, last = v
    return {"sum": total, "avg": total / n, "min": low, "max": high, "count": float(n), "last": last, "diff": last - first}[op]


class Panes(StatefulProcessor):
    """A bucket of index keys and their panes; a timer at each pane's end."""

    def __init__(self, op: str, k: int, smallest: bool, pane: int, interval: int):
        self.op, self.k, self.smallest, self.pane, self.interval = op, k, smallest, pane, interval

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane bigint, keys array<string>", _PANE)
        self.next = handle.getValueState("next", "due bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        due = self.next.get()[0] if self.next.exists() else None
        for b in rows:
            for r in b.itertuples(index=False):
                *keys, start = r.labels
                at = (int(start), list(keys))
                part = (int(r.n), float(r.sum), float(r.low), float(r.high), int(r.first), float(r.first_value), int(r.last), float(r.last_value))
                self.panes.updateValue(at, merged(self.panes.getValue(at), part))
                end = (at[0] + self.pane) // 1000
                if due is None or end < due:
                    if due is not None:
                        self.handle.deleteTimer(due)
                    self.handle.registerTimer(end)
                    due = end
        if due is not None:
            self.next.update((due,))
        yield pd.DataFrame([], columns=["window_start", "keys", "value"], dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Every window whose end the watermark has passed, in order; then the timer of the next one that has rows."""
        done = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        held: dict[int, dict[tuple, tuple]] = {}
        for (start, keys), v in ((tuple(k), tuple(v)) for k, v in self.panes.iterator()):
            held.setdefault(start, {})[tuple(keys)] = v
        end, out = expiredTimerInfo.getExpiryTimeInMs() * 1000, []
        while held and end <= done:
            inside = [s for s in sorted(held) if end - self.interval <= s < end]
            found: dict[tuple, tuple] = {}
            for s in inside:
                for keys, v in held[s].items():
                    found[keys] = merged(found.get(keys), v)
            best = ((value_of(self.op, v), keys) for keys, v in found.items())
            if self.k > 0:
                sign = 1 if self.smallest else -1
                best = heapq.nsmallest(self.k, best, key=lambda x: (sign * x[0], x[1]))
            out += [(end - self.interval, list(keys), v) for v, keys in best]
            for s in [s for s in held if s < end - self.interval + self.pane]:  # no later window has them
                for keys in held.pop(s):
                    self.panes.removeKey((s, list(keys)))
            end += self.pane
            if held and not any(s < end for s in held):  # nothing until the next pane with rows
                end = min(held) + self.pane
        if held:
            self.handle.registerTimer(end // 1000)
            self.next.update((end // 1000,))
        else:
            self.next.clear()
        yield pd.DataFrame(out, columns=["window_start", "keys", "value"], dtype=object)

    def close(self) -> None:
        pass


def candidates(df: DataFrame, rule: dict, time_col: str, late: str = "10 seconds", buckets: int = BUCKETS) -> DataFrame:
    """A stream of (window_start in microseconds, keys, value): each bucket's K best of each complete window of the rule
    {index_keys, operation, key, top_k, reversed, interval, slide}, the interval a multiple of the slide, both in seconds or as text."""
    op, keys = rule["operation"], rule["index_keys"]
    if op not in topk.OPERATIONS:
        raise ValueError(f"unknown operation {op!r}")
    pane, interval = micros(df, rule["slide"]), micros(df, rule["interval"])
    if interval % pane or pane % 1000:
        raise ValueError("the interval must be a multiple of the slide, and that of a millisecond")
    rows = df.select(*[go_str(df, k).alias(f"k{i}") for i, k in enumerate(keys)], to_double(df, rule["key"]).alias("v"), F.col(f"`{time_col}`").alias("t"))
    for i in range(len(keys)):
        rows = rows.filter(F.coalesce(F.col(f"k{i}") != "", F.lit(False)))
    at = F.unix_micros(F.col("t").cast("timestamp"))
    made = partials(rows, [*[F.col(f"k{i}") for i in range(len(keys))], at - F.pmod(at, F.lit(pane))], F.col("v"), F.col("t"), buckets=buckets, apart=1)
    return made.withWatermark("seen", late).groupBy("bucket").transformWithStateInPandas(Panes(op, rule.get("top_k", 0), bool(rule.get("reversed")), pane, interval), CANDIDATES, "Append", "EventTime")


def micros(df: DataFrame, length) -> int:
    """A length of time in microseconds: a number of seconds, or text as Spark's intervals have it."""
    if isinstance(length, (int, float)):
        return int(length * 1_000_000)
    return df.sparkSession.sql(f"SELECT unix_micros(TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {length}) AS n").first()["n"]


def ranked(found: DataFrame, rule: dict) -> DataFrame:
    """The K best of each window among the buckets' candidates, in topk.timebased's columns."""
    keys, k = rule["index_keys"], rule.get("top_k", 0)
    if k > 0:
        value = F.col("value").asc() if rule.get("reversed") else F.col("value").desc()
        found = found.withColumn("_r", F.row_number().over(Window.partitionBy("window_start").orderBy(value, "keys"))).filter(F.col("_r") <= k)
    shown = [F.get("keys", F.lit(i)).alias(c) for i, c in enumerate(keys)]
    return found.select(F.lit(rule["name"]).alias("name"), F.array_join("keys", ",").alias("index_key"), F.lit(rule["operation"]).alias("operation"), F.col("value").alias(rule["key"]), *shown, F.timestamp_micros("window_start").alias("window_start"))


def stream_sliding_topk(df: DataFrame, rule: dict, time_col: str, each: Callable[[DataFrame], None], checkpoint: str, late: str = "10 seconds", buckets: int = BUCKETS):
    """Hand the K best of each window to ``each`` once the watermark has passed its end; the writer is to be started."""
    return candidates(df, rule, time_col, late, buckets).writeStream.foreachBatch(lambda found, _: each(ranked(found, rule))).option("checkpointLocation", checkpoint)
