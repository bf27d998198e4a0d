"""Object batches on streams: an object closes when it has ``size`` rows or when its first row has waited ``timeout``.

Rows are dealt to ``lanes`` that each write objects of their own, numbered without gaps; a lane is one stream id. Its open
rows are list state, its number and the time of its first open row value state, so after a restart a lane goes on where
it was. A timer closes what is open at the timeout, in processing time (as a writer does) or in event time.

Paths and bodies are those of ``sinks.object_batches``. An empty batch writes nothing; rows of any columns are kept as JSON.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowloom.sources.sinks import VERSION

OBJECTS = "path string, n int, object string, cause string"


class Lane(StatefulProcessor):
    """One writer of objects."""

    def __init__(self, size: int, timeout: float, account: str, stream_id: str, header: dict, event_time: bool):
        self.size, self.timeout, self.account, self.stream_id, self.header, self.event_time = size, int(timeout * 1000), account, stream_id, header, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "row string, at bigint")
        self.lane = handle.getValueState("lane", "number bigint, rows int, due bigint")

    def _object(self, lane: int, number: int, rows: list[tuple[str, int]], cause: str) -> tuple:
        begin, end = (dt.datetime.fromtimestamp(t / 1000, dt.timezone.utc) for t in (min(t for _, t in rows), max(t for _, t in rows)))
        fixed = self.header | {"version": VERSION, "capture_start_time": _time(begin), "capture_end_time": _time(end), "number_of_flow_logs": len(rows)}
        body = json.dumps(fixed, separators=(",", ":"), ensure_ascii=False)[:-1] + ',"flow_logs":[' + ",".join(r for r, _ in rows) + "]}"
        path = f"{self.account}/{end:year=%Y/month=%m/day=%d/hour=%H}/stream-id={self.stream_id}-{lane}/{number:08d}"
        return path, len(rows), body, cause

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        number, n, due = self.lane.get() if self.lane.exists() else (0, 0, -1)
        now = timerValues.getCurrentProcessingTimeInMs()
        given = sorted(((r.row, int(r.at) if self.event_time else now) for b in rows for r in b.itertuples(index=False)), key=lambda x: x[1])
        out: list[tuple] = []
        if n + len(given) < self.size and not (given and 0 <= due < given[-1][1]):  # nothing closes: the open rows need not be read
            self.open.appendList(given)
            if given and due < 0:
                due = given[0][1] + self.timeout
                self.handle.registerTimer(due)
            n += len(given)
        else:
            held = [(r, int(t)) for r, t in self.open.get()] if n else []
            if due >= 0:
                self.handle.deleteTimer(due)
            for row in given:
                if held and row[1] > held[0][1] + self.timeout:  # it had waited long enough before this row came
                    out.append(self._object(key[0], number, held, "timeout"))
                    held, number = [], number + 1
                held.append(row)
                if len(held) == self.size:
                    out.append(self._object(key[0], number, held, "size"))
                    held, number = [], number + 1
            self.open.clear()
            n, due = len(held), -1
            if held:
                self.open.put(held)
                due = held[0][1] + self.timeout
                self.handle.registerTimer(due)
        self.lane.update((number, n, due))
        yield pd.DataFrame(out, columns=["path", "n", "object", "cause"], dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        number, n, _ = self.lane.get()
        out = []
        if n:
            out.append(self._object(key[0], number, [(r, int(t)) for r, t in self.open.get()], "timeout"))
            self.open.clear()
            number += 1
        self.lane.update((number, 0, -1))
        yield pd.DataFrame(out, columns=["path", "n", "object", "cause"], dtype=object)

    def close(self) -> None:
        pass


def _time(t: dt.datetime) -> str:
    """As Spark's to_json writes a timestamp of a session in UTC."""
    return t.strftime("%Y-%m-%dT%H:%M:%S.") + f"{t.microsecond // 1000:03d}Z"


def stream_object_batches(df: DataFrame, time_col: str, size: int = 10, timeout: float = 60, lanes: int = 64, account: str = "account", stream_id: str = "0", header: dict | None = None, event_time: bool = False, late: str = "10 seconds") -> DataFrame:
    """A stream of (path, n, object, cause: size or timeout). With ``event_time`` rows and timeouts go by ``time_col``."""
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    rows = df.select(F.pmod(F.xxhash64(body), F.lit(lanes)).cast("int").alias("lane"), body.alias("row"), F.unix_millis(F.col(f"`{time_col}`").cast("timestamp")).alias("at"), F.col(f"`{time_col}`").cast("timestamp").alias("seen"))
    if event_time:
        rows = rows.filter("at IS NOT NULL").withWatermark("seen", late)
    lane = Lane(size, timeout, account, stream_id, header or {}, event_time)
    return rows.groupBy("lane").transformWithStateInPandas(lane, OBJECTS, "Append", "EventTime" if event_time else "ProcessingTime")
