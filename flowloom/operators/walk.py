"""The walk through each connection's flows in time order: newConnection, heartbeat and endConnection records.

Flows are dealt by connection and sorted within partitions; the walk streams through them in Arrow batches
(``walk_batches``), with the state of one connection from batch to batch. A connection with more than ``PART_ROWS`` flows would still be one task's work, so its flows are cut into
ranges of time that different tasks take (a segmented scan):

1. each (connection, range) part is folded to a summary: what it makes of whatever state the range before it leaves;
2. a connection's summaries, one row a range, are chained, which gives the state at the start of each range;
3. each part is walked alone from that state, and its last range brings the end.

A summary maps the state at its start to that at its end. A connection without a FIN so far goes on until the first gap
over its group's timeout, or the first FIN; that is one case a group. A connection that saw a FIN goes on until a known
time, at most the terminating timeout after the range's start; the cases are steps between flows of that stretch, and
steps of equal outcome are one. Ranges are not cut shorter than ten such timeouts.

Flows of one instant stay in one range, in the order that ``order`` gives. Sums of a connection over several ranges are
added range by range, which differs from one by one only in the last digits of fractions.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowloom.functions.ranges import bucket_of
from flowloom.functions.storage import staged
from flowloom.operators.conntrack import BUCKETS, DEFAULT, FIN, HOT_KEYS, KINDS, MOST_PARTS, PART_ROWS, SYN_ACK, _names, key_fields, keyed, normal, validate
from flowloom.operators.counts import Counts
from flowloom.operators.walk_batches import Walk

KEY = ["_common", "_low", "_high"]
NONE = {"min": math.inf, "max": -math.inf, "first": None, "last": None, "sum": 0.0, "count": 0.0}


class Connection:
    """The state of one live connection."""

    def __init__(self, conf: dict, row: dict):
        self.conf, self.group, self.number, self.start = conf, conf["groups"][row["_group"]], row["_group"], row["_t"]
        swap = bool(conf.get("swap_ab") and row["_flags"] & SYN_ACK)
        self._name(row, row["_b"] if swap else row["_a"])
        self.values = {n: NONE[a["operation"]] for a in conf["aggregates"] for n in shown_names(a)}
        self.emitted, self.ends, self.beats = False, None, 1
        self.add(row, True)

    def _name(self, row: dict, a: str) -> None:
        """Key, id and shown fields, from any flow of the connection; a is the A side's end."""
        self.a, self.key, self.hash = a, key_of(row), row["_HashId"]
        key, at = self.conf["key"], _names(self.conf)[0]
        self.keys = {f: row[at[f]] for f in key["common"]}
        for x, y in zip(key.get("a", []), key.get("b", [])):
            self.keys[x], self.keys[y] = (row[at[x]], row[at[y]]) if row["_a"] == a else (row[at[y]], row[at[x]])

    @classmethod
    def resumed(cls, conf: dict, state: tuple, row: dict, kinds: tuple[str, ...]) -> Connection:
        """The connection that an earlier range left open; row is its first flow in this one."""
        self = cls.__new__(cls)
        self.start, a_low, self.number, self.ends, self.last, held = state
        self.conf, self.group = conf, conf["groups"][self.number]
        self._name(row, row["_low"] if a_low else row["_high"])
        self.values = {}
        for a, v in zip(conf["aggregates"], held):
            self.values |= dict(zip(shown_names(a), v if a_low or not a.get("split") else v[::-1]))
        every = self.group["heartbeat"]
        self.beats = max(1, int((self.last - self.start) // every))
        while self.beat < self.last:  # those before the last flow were due by then
            self.beats += 1
        self.emitted = "newConnection" in kinds or self.beats > 1
        return self

    def add(self, row: dict, first: bool = False) -> None:
        inputs = _names(self.conf)[1]
        for i, a in enumerate(self.conf["aggregates"]):
            op, n = a["operation"], a["name"] + ((("_AB" if row["_a"] == self.a else "_BA")) if a.get("split") else "")
            if op == "count":
                self.values[n] += 1
                continue
            v = row[inputs[a["input"]]] if op in ("first", "last") else row[f"a{i}"]
            v = None if v is not None and v != v else v
            if op == "first":
                self.values[n] = v if first else self.values[n]
            elif v is not None:
                self.values[n] = v if op == "last" else {"sum": self.values[n] + v, "min": min(self.values[n], v), "max": max(self.values[n], v)}[op]
        if self.ends is None:  # a connection that saw a FIN does not live longer
            self.last = row["_t"]
            if self.conf.get("detect_end") and row["_flags"] & FIN:
                self.ends = row["_t"] + self.group["terminating_timeout"]

    @property
    def until(self) -> float:
        return self.last + self.group["end_timeout"] if self.ends is None else self.ends

    @property
    def beat(self) -> float:
        """When the next heartbeat is due."""
        return self.start + self.beats * self.group["heartbeat"]

    def record(self, kind: str, at: float) -> dict:
        first, self.emitted = not self.emitted, True
        reason = None if kind != "endConnection" else "timeout" if self.ends is None else "FIN_flag"
        shown = {k: None if isinstance(v, float) and (v == 0 or math.isinf(v)) else v for k, v in self.values.items()}
        return shown | self.keys | {"_HashId": self.hash, "_RecordType": kind, "_IsFirst": first, "_EndReason": reason, "time": at}

    def due(self, now: float) -> Iterator[dict]:
        """Heartbeats that are due before now."""
        while self.ends is None and self.beat < min(now, self.until):
            yield self.record("heartbeat", self.beat)
            self.beats += 1


def shown_names(a: dict) -> list[str]:
    return [f"{a['name']}_AB", f"{a['name']}_BA"] if a.get("split") else [a["name"]]


def key_of(row: dict) -> tuple[str, str, str]:
    return row["_common"], row["_low"], row["_high"]


def walk(conf: dict, rows: Iterator[dict], kinds: tuple[str, ...]) -> Iterator[dict]:
    """Records of rows that come sorted by connection (and range), then time. The first row of a range may bring ``_state``.
    The plain form of ``walk_batches.Walk``, which tasks run; tests hold one against the other."""
    live: Connection | None = None
    key, state, last = None, None, True

    def advance(now: float) -> Iterator[dict]:
        """Heartbeats and the end that are due before now."""
        nonlocal live
        if live is not None:
            yield from live.due(now)
            if now > live.until:
                yield live.record("endConnection", live.until)
                live = None

    for row in rows:
        at = (*key_of(row), row.get("_part"))
        if at != key:
            if last:
                yield from advance(math.inf)
            key, live, state, last = at, None, None, True
        if row.get("_state") is not None:
            state, last = pickle.loads(row["_state"])
            continue
        if state is not None:
            live, state = Connection.resumed(conf, state, row, kinds), None
        yield from advance(row["_t"])
        if live is None:
            live = Connection(conf, row)
            if "newConnection" in kinds:
                yield live.record("newConnection", row["_t"])
        else:
            live.add(row)
    if last:
        yield from advance(math.inf)


def walk_capped(conf: dict, rows: Iterator[dict], kinds: tuple[str, ...]) -> Iterator[dict]:
    """Records of rows that come sorted by bucket, then time. A bucket tracks max_tracked connections at a time; flows of
    further ones are not tracked until one of them ends. The state is one bucket's live connections."""
    live: dict[tuple, Connection] = {}
    due: list[tuple[float, tuple]] = []  # (when a connection's next heartbeat or end may be due, its key)
    bucket = None

    def next_of(c: Connection) -> float:
        return c.beat if c.ends is None and c.beat < c.until else c.until

    def advance(now: float) -> Iterator[dict]:
        while due and due[0][0] < now:
            at, key = heapq.heappop(due)
            c = live.get(key)
            if c is None:
                continue
            if at < next_of(c):  # it lived on since
                heapq.heappush(due, (next_of(c), key))
            elif c.ends is None and c.beat < c.until:
                yield c.record("heartbeat", c.beat)
                c.beats += 1
                heapq.heappush(due, (next_of(c), key))
            else:
                yield c.record("endConnection", c.until)
                del live[key]

    for row in rows:
        if row["_bucket"] != bucket:
            yield from advance(math.inf)
            bucket = row["_bucket"]
        yield from advance(row["_t"])
        key = key_of(row)
        c = live.get(key)
        if c is not None:
            c.add(row)
        elif len(live) < conf["max_tracked"]:
            c = live[key] = Connection(conf, row)
            if "newConnection" in kinds:
                yield c.record("newConnection", row["_t"])
        else:
            continue
        heapq.heappush(due, (next_of(c), key))
    yield from advance(math.inf)


# ---- ranges of hot connections


def merged(conf: dict, earlier: list, later: list) -> list:
    """Held values of flows, and of later flows, together."""
    out = []
    for a, x, y in zip(conf["aggregates"], earlier, later):
        op = a["operation"]
        both = {"sum": lambda p, q: p + q, "count": lambda p, q: p + q, "min": min, "max": max, "first": lambda p, q: p, "last": lambda p, q: p if q is None else q}[op]
        out.append([both(p, q) for p, q in zip(x, y)])
    return out


class Part:
    """One range's flows of one connection, sorted; what ``summary`` makes of them."""

    def __init__(self, conf: dict, t: np.ndarray, fin: np.ndarray, low: np.ndarray, swap: np.ndarray, group: np.ndarray, numbers: dict[int, np.ndarray], whole: dict[str, list]):
        self.conf, self.t, self.low, self.group, self.n = conf, t, low, group, len(t)
        self.a_low = low != swap
        self.numbers, self.whole = numbers, whole  # numbers by aggregate (NaN: none), and inputs as they are
        self.fins = np.flatnonzero(fin)
        gaps = np.diff(t)
        self.gaps = {g["end_timeout"]: np.flatnonzero(t[1:] > t[:-1] + g["end_timeout"]) + 1 for g in conf["groups"]} if len(gaps) else {g["end_timeout"]: np.empty(0, np.int64) for g in conf["groups"]}

    def _next(self, places: np.ndarray, i: int) -> int | None:
        k = np.searchsorted(places, i)
        return int(places[k]) if k < len(places) else None

    def after(self, i: int, number: int, started: bool) -> tuple[int | None, int | None]:
        """(the flow that opens the next connection, the FIN that ended this one) for a connection of this group that
        has no FIN yet and takes flow i; ``started``: i is its first flow."""
        g = self.conf["groups"][number]
        gap, fin = self._next(self.gaps[g["end_timeout"]], i + 1 if started else max(i, 1)), self._next(self.fins, i)
        if gap is not None and (fin is None or gap <= fin):
            return gap, None
        if fin is None:
            return None, None
        k = int(np.searchsorted(self.t, self.t[fin] + g["terminating_timeout"], side="right"))
        return (k if k < self.n else None), fin

    def held(self, i: int, j: int) -> list:
        """Held values of flows i to j; of aggregates by side those of the low and of the high end."""
        out, low = [], self.low[i:j]
        for k, a in enumerate(self.conf["aggregates"]):
            op = a["operation"]
            v = None if op == "count" else (self.whole[a["input"]] if op in ("first", "last") else self.numbers[k])[i:j]
            if op == "count":
                out.append([float(low.sum()), float((~low).sum())] if a.get("split") else [float(j - i)])
            elif op == "first":
                out.append([v[0]])
            elif op == "last":
                out.append([next((x for x in reversed(v) if x is not None), None)])
            else:
                ok = ~np.isnan(v)
                f = {"sum": np.sum, "min": np.min, "max": np.max}[op]
                out.append([float(f(v[s])) if s.any() else NONE[op] for s in ([ok & low, ok & ~low] if a.get("split") else [ok])])
        return out

    def summary(self) -> dict:
        n, t, finals = self.n, self.t, {}

        def final(i: int) -> int:
            """The flow that opened the connection which is open at the end, if one opens at flow i."""
            path = []
            while i not in finals:
                path.append(i)
                k = self.after(i, int(self.group[i]), True)[0]
                if k is None:
                    finals[i] = i
                else:
                    i = k
            for p in path:
                finals[p] = finals[i]
            return finals[i]

        most = max(g["terminating_timeout"] for g in self.conf["groups"])
        near = range(1, min(n, int(np.searchsorted(t, t[0] + most, side="right")) + 1)) if self.conf.get("detect_end") else ()
        steps: list[tuple[float, int]] = []  # (a FIN's connection that ends before this time, what is open at the end)
        for i in near:
            f = final(i)
            if steps and steps[-1][1] == f:
                steps[-1] = (float(t[i]), f)
            else:
                steps.append((float(t[i]), f))
        cases = []
        for number in range(len(self.conf["groups"])):
            k, fin = self.after(0, number, False)
            ends = None if fin is None else float(t[fin] + self.conf["groups"][number]["terminating_timeout"])
            cases.append((None if k is None else final(k), ends, float(t[n - 1 if fin is None else fin])))
        final(0)
        wanted = sorted({finals[0], *[f for _, f in steps], *[c[0] for c in cases if c[0] is not None]}, reverse=True)
        states, held, end = {}, None, n
        for i in wanted:
            own = self.held(i, end)
            held, end = own if held is None else merged(self.conf, own, held), i
            number = int(self.group[i])
            fin = self.after(i, number, True)[1]
            ends = None if fin is None else float(t[fin] + self.conf["groups"][number]["terminating_timeout"])
            states[i] = (float(t[i]), bool(self.a_low[i]), number, ends, float(t[n - 1 if fin is None else fin]), held)
        return {"first": float(t[0]), "last": float(t[-1]), "opened": finals[0], "cases": cases, "steps": steps, "states": states, "held": self.held(0, n)}


def step(conf: dict, state: tuple | None, s: dict) -> tuple:
    """The state after a range, from that before it and its summary."""
    if state is None:
        return s["states"][s["opened"]]
    start, a_low, number, ends, last, held = state
    if ends is None:
        if s["first"] > last + conf["groups"][number]["end_timeout"]:
            return s["states"][s["opened"]]
        opened, ends, last = s["cases"][number]
        if opened is not None:
            return s["states"][opened]
    else:
        if s["first"] > ends:
            return s["states"][s["opened"]]
        if s["last"] > ends:
            k = next(k for k, (t, _) in enumerate(s["steps"]) if t > ends)
            return s["states"][s["steps"][k][1]]
    return start, a_low, number, ends, last, merged(conf, held, s["held"])


def _fold(conf: dict):
    """Arrow group -> one summary."""
    _, inputs, order = _names(conf)
    summed = [i for i, a in enumerate(conf["aggregates"]) if a["operation"] in ("sum", "min", "max")]

    def fold(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ["_t", *order]])
        low = np.array(rows["_low"].to_pylist(), object) == np.array(rows["_a"].to_pylist(), object)
        flags = rows["_flags"].to_numpy()
        swap = flags & SYN_ACK > 0 if conf.get("swap_ab") else np.zeros(len(flags), bool)
        numbers = {i: rows[f"a{i}"].to_numpy() for i in summed}
        whole = {f: [None if x != x else x for x in rows[v].to_pylist()] for f, v in inputs.items()}
        part = Part(conf, rows["_t"].to_numpy(), (flags & FIN > 0) & bool(conf.get("detect_end")), low, swap, rows["_group"].to_numpy(), numbers, whole)
        return pa.table({c: pa.array([rows[c][0].as_py()], t) for c, t in ((*((k, pa.string()) for k in KEY), ("_part", pa.int32()))[i] for i in range(4))} | {"summary": pa.array([pickle.dumps(part.summary())], pa.binary())})

    return fold


def _chain(conf: dict):
    """Arrow group of one connection's summaries -> the state at the start of each range."""

    def chain(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_part")
        state, out, n = None, [], len(rows)
        for i, s in enumerate(rows["summary"]):
            out.append(pickle.dumps((state, i == n - 1)))
            state = step(conf, state, pickle.loads(s.as_py()))
        return rows.drop_columns("summary").append_column("_state", pa.array(out, pa.binary()))

    return chain


def _parts(rows: DataFrame, conf: dict, n: int, part_rows: int) -> DataFrame:
    """Rows of hot connections with _part, and before each part's rows a row with its _state."""
    k = min(MOST_PARTS, max(2, -(-n // part_rows)))
    found = rows.agg(F.percentile_approx("_t", [i / k for i in range(1, k)], max(10_000, 4 * k)).alias("q")).first()["q"] or []
    least = 10 * max(g["terminating_timeout"] for g in conf["groups"]) if conf.get("detect_end") else 0
    cuts: list[float] = []
    for c in sorted(set(found)):
        if not cuts or c - cuts[-1] > least:
            cuts.append(c)
    rows = rows.withColumn("_part", bucket_of(F.col("_t"), cuts))
    inputs = [*_names(conf)[1].values(), *_names(conf)[2], *[f"a{i}" for i, a in enumerate(conf["aggregates"]) if a["operation"] in ("sum", "min", "max")]]
    small = rows.select(*KEY, "_part", "_t", "_a", "_flags", "_group", *inputs)
    at = "_common string, _low string, _high string, _part int"
    summaries = small.groupBy(*KEY, "_part").applyInArrow(_fold(conf), f"{at}, summary binary")
    states = staged(summaries.groupBy(*KEY).applyInArrow(_chain(conf), f"{at}, _state binary"), "connection-states")
    return rows.unionByName(states, allowMissingColumns=True).repartition(*KEY, "_part").sortWithinPartitions(*KEY, "_part", F.col("_state").isNull(), "_t", *_names(conf)[2])


def record_schema(df: DataFrame, conf: dict) -> T.StructType:
    out = T.StructType()
    for a in conf["aggregates"]:
        for n in shown_names(a):
            out.add(n, df.schema[a["input"]].dataType if a["operation"] in ("first", "last") else T.DoubleType())
    for f in key_fields(conf):
        if f not in out.names:
            out.add(f, df.schema[f].dataType)
    return out.add("_HashId", "string").add("_RecordType", "string").add("_IsFirst", "boolean").add("_EndReason", "string").add("time", "double")


def timed(df: DataFrame, conf: dict, keep_time: bool = False, counts: Counts | None = None) -> DataFrame:
    """Keyed flows that are no duplicates, with their time in seconds; the walk reads nothing else."""
    rows = keyed(df, conf) if counts is None else keyed(df, conf, counts)
    rows = rows.withColumn("_t", F.unix_micros(F.col("event_time").cast("timestamp")) / 1e6).filter(~F.col("_dup"))
    return rows.drop("_dup") if keep_time else rows.drop("_dup", "event_time")


def _walked(rows: DataFrame, conf: dict, kinds: tuple[str, ...], schema: T.StructType) -> DataFrame:
    made, capped = to_arrow_schema(schema), conf.get("max_tracked")

    def batch(out: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in out], f.type) for f in made], schema=made)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not capped:
            yield from Walk(conf, kinds, made).run(batches)
            return
        given = (dict(zip(b.schema.names, r)) for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        out: list[dict] = []
        for r in walk_capped(conf, given, kinds):
            if r["_RecordType"] in kinds:
                out.append(r)
            if len(out) >= 10_000:
                yield batch(out)
                out = []
        yield batch(out)

    return rows.mapInArrow(work, schema)


def track(df: DataFrame, conf: dict = DEFAULT, kinds: tuple[str, ...] = KINDS, part_rows: int | None = PART_ROWS, counts: Counts | None = None) -> DataFrame:
    """newConnection, heartbeat and endConnection records of a table of flows; ``time`` in epoch seconds.

    Rows are dealt by connection and sorted within each partition, so the walk streams through them and holds one
    connection's state. Connections of more than ``part_rows`` flows are walked in ranges of time (None: never). With
    ``max_tracked`` in conf, rows are dealt to ``buckets`` by key, and each tracks so many connections at a time (a cap
    over all would need one task). Duplicates neither open nor prolong a connection. An empty table gives no record. ``counts`` sees what aggregates could not use (see ``keyed``).
    """
    validate(conf, kinds)
    conf = normal(conf)
    rows, schema, order = timed(df, conf, counts=counts), record_schema(df, conf), _names(conf)[2]
    if conf.get("max_tracked"):
        rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*KEY), F.lit(conf.get("buckets", BUCKETS))))
        return _walked(rows.repartition("_bucket").sortWithinPartitions("_bucket", "_t", *order), conf, kinds, schema)
    dealt = lambda r: r.repartition(*KEY).sortWithinPartitions(*KEY, "_t", *order)
    if part_rows is None:
        return _walked(dealt(rows), conf, kinds, schema)
    rows = rows.withColumn("_k", F.xxhash64(*KEY))
    hot = staged(rows.groupBy("_k").agg(F.count("*").alias("n")).filter(F.col("n") > part_rows), "hot-connections")
    found = hot.agg(F.count("*").alias("keys"), F.sum("n").alias("n")).first()
    if not found["keys"]:
        return _walked(dealt(rows.drop("_k")), conf, kinds, schema)
    hashes = hot.select("_k")
    hashes = F.broadcast(hashes) if found["keys"] <= HOT_KEYS else hashes
    cold, parts = rows.join(hashes, "_k", "left_anti").drop("_k"), _parts(rows.join(hashes, "_k", "left_semi").drop("_k"), conf, found["n"], part_rows)
    return _walked(dealt(cold), conf, kinds, schema).unionByName(_walked(parts, conf, kinds, schema))
