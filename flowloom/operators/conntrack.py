"""Connection tracking: flow logs of both directions become sessions with aggregates of each side.

Two forms. ``connections`` is the fast path: Spark's session windows with a gap for each scheduling group;
it knows no flags and no heartbeats. ``operators.walk.track`` walks each connection's flows in time order and emits
newConnection, heartbeat and endConnection records; a FIN ends a connection early. All times are event times. A
connection is its key's values; _HashId only shows it. Flows that lack a key field are rejected. Absent flags count as
none set, an aggregate without input reads the field of its own name, and columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.coerce import to_double
from flowloom.functions.ranges import bucket_of
from flowloom.functions.storage import staged
from flowloom.operators.counts import Counts

PROTOCOLS = (6, 17, 132)
FIN, SYN_ACK = 1, 256
KINDS = ("newConnection", "heartbeat", "endConnection")
#: Buckets of keys that a cap on tracked connections is counted in.
BUCKETS = 64
#: Flows of one connection that one task takes, and about what a range of time holds; the most ranges.
PART_ROWS, MOST_PARTS = 500_000, 10_000
#: Hot connections up to which their hashes are broadcast, eight bytes each.
HOT_KEYS = 1_000_000

#: The configuration that the queries and tests use: A and B sides, two aggregates, timeouts in seconds.
DEFAULT = {
    "key": {"common": ["Proto"], "a": ["SrcAddr", "SrcPort"], "b": ["DstAddr", "DstPort"]},
    "aggregates": [{"name": "Bytes", "operation": "sum", "input": "Bytes", "split": True}, {"name": "numFlowLogs", "operation": "count", "split": False}],
    "groups": [{"selector": {}, "end_timeout": 10, "terminating_timeout": 5, "heartbeat": 30}],
    "flags": None, "swap_ab": False, "detect_end": False,
}


def validate(conf: dict, kinds: tuple[str, ...] = KINDS) -> None:
    """Raise ValueError where the configuration does not hold together."""
    for k in kinds:
        if k not in KINDS:
            raise ValueError(f"unknown record type {k!r}")
    key, names = conf["key"], [a["name"] for a in conf["aggregates"]]
    if bool(key.get("a")) != bool(key.get("b")):
        raise ValueError("both sides of the key must be given, or neither")
    if len(key.get("a", [])) != len(key.get("b", [])):
        raise ValueError("both sides of the key must have as many fields")
    if not key.get("a") and any(a.get("split") for a in conf["aggregates"]):
        raise ValueError("aggregates can be split by direction only where the key has two sides")
    if len(set(names)) != len(names):
        raise ValueError("two aggregates have the same name")
    for a in conf["aggregates"]:
        if a["operation"] not in ("sum", "count", "min", "max", "first", "last"):
            raise ValueError(f"unknown operation {a['operation']!r}")
        if a.get("split") and a["operation"] in ("first", "last"):
            raise ValueError(f"{a['operation']} cannot be split")
    selectors = [g["selector"] for g in conf["groups"]]
    if not selectors or selectors[-1] or any(not s for s in selectors[:-1]):
        raise ValueError("exactly one scheduling group must have the empty selector, and it must come last")
    fields = set(key_fields(conf))
    if any(f not in fields for s in selectors for f in s):
        raise ValueError("selectors may only use key fields")
    if (conf.get("swap_ab") or conf.get("detect_end")) and not conf.get("flags"):
        raise ValueError("the field of TCP flags must be given")
    if conf.get("swap_ab") and not key.get("a"):
        raise ValueError("sides can be swapped only where the key has two")


def gated(df: DataFrame) -> DataFrame:
    """Flows of the protocols that have connections."""
    return df.filter(F.col("Proto").cast("double").isin(*[float(p) for p in PROTOCOLS]))


def key_fields(conf: dict) -> list[str]:
    return [*conf["key"]["common"], *conf["key"].get("a", []), *conf["key"].get("b", [])]


def normal(conf: dict) -> dict:
    """conf with an input for each aggregate: its name, where none is given."""
    return conf | {"aggregates": [{"input": a["name"]} | a for a in conf["aggregates"]]}


def _inputs(conf: dict) -> list[str]:
    """Inputs whose values are kept as they are."""
    return sorted({a["input"] for a in conf["aggregates"] if a["operation"] in ("first", "last")})


def _number(df: DataFrame, a: dict) -> Column:
    """The number that a sum, least or greatest takes from a flow; NaN where it takes none: an absent field counts as 0
    unless missing ones are reported, and what is no number counts nothing."""
    c = F.col(f"`{a['input']}`")
    return F.when(c.isNull(), F.lit(float("nan") if a.get("report_missing") else 0.0)).otherwise(F.coalesce(to_double(df, a["input"]), F.lit(float("nan"))))


def _has_key(conf: dict) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{f}`").isNotNull() for f in key_fields(conf)], F.lit(True))


def _group_value(conf: dict, what: str) -> Column:
    out = F.lit(conf["groups"][-1][what])
    for g in reversed(conf["groups"][:-1]):
        hit = F.lit(True)
        for f, v in g["selector"].items():
            hit = hit & F.coalesce(F.col(f"`{f}`") == F.lit(v), F.lit(False))
        out = F.when(hit, F.lit(g[what])).otherwise(out)
    return out.cast("double")


def _ends(conf: dict) -> tuple[Column, Column, Column]:
    """The common fields of the key, and a flow's two ends, each as one text."""
    key = conf["key"]
    text = lambda fs: F.to_json(F.struct(*[F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(fs)])) if fs else F.lit("")
    return text(key["common"]), text(key.get("a")), text(key.get("b"))


def _hash_id(common: Column, a: Column, b: Column) -> Column:
    return F.lower(F.hex(F.xxhash64(common, F.least(a, b), F.greatest(a, b))))


def keyed(df: DataFrame, conf: dict, counts: Counts | None = None) -> DataFrame:
    """Gated flows that have a key, under names of their own, so that df's columns may have any: _common, _low and _high
    (the two ends in order: equal for both directions), _a and _b (this flow's source and destination end), _HashId,
    _dup, _flags (0 where absent), _group (scheduling group), event_time, k0... (key fields), v0... (inputs of first and last), a0... (numbers of the aggregates), o0... (order).
    ``counts`` sees, as ``aggregates``, absent inputs that are reported (MissingFieldError) and those that are no number."""
    conf = normal(conf)
    common, a, b = _ends(conf)
    groups = conf | {"groups": [g | {"number": i} for i, g in enumerate(conf["groups"])]}
    flags = F.col(f"`{conf['flags']}`") if conf.get("flags") in df.columns else F.lit(None)
    out = {
        "_common": common, "_a": a, "_b": b, "_low": F.least(a, b), "_high": F.greatest(a, b), "_HashId": _hash_id(common, a, b),
        "_dup": F.coalesce(F.col("Duplicate").cast("boolean"), F.lit(False)) if "Duplicate" in df.columns else F.lit(False),
        "_flags": F.coalesce(flags.cast("string").try_cast("double").cast("bigint"), F.lit(0).cast("bigint")), "_group": _group_value(groups, "number").cast("int"), "event_time": F.col("event_time"),
    }
    out |= {f"k{i}": F.col(f"`{f}`") for i, f in enumerate(key_fields(conf))} | {f"v{i}": F.col(f"`{f}`") for i, f in enumerate(_inputs(conf))} | {f"o{i}": F.col(f"`{f}`") for i, f in enumerate(conf.get("order", []))}
    summed = [(i, a) for i, a in enumerate(conf["aggregates"]) if a["operation"] in ("sum", "min", "max")]
    out |= {f"a{i}": _number(df, a) for i, a in summed}
    rows = gated(df).filter(_has_key(conf))
    if counts is not None:
        errors: dict[str, Column] = {}
        for _, a in summed:
            c = F.col(f"`{a['input']}`")
            errors[f"Float64ConversionError:{a['name']}"] = ~out["_dup"] & c.isNotNull() & to_double(df, a["input"]).isNull()
            if a.get("report_missing"):
                errors[f"MissingFieldError:{a['name']}"] = ~out["_dup"] & c.isNull()
        rows = counts.watch(rows, "aggregates", errors)
    return rows.select(*[c.alias(n) for n, c in out.items()])


def _names(conf: dict) -> tuple[dict[str, str], dict[str, str], list[str]]:
    """What ``keyed`` calls key fields, inputs and the order."""
    return {f: f"k{i}" for i, f in enumerate(key_fields(conf))}, {f: f"v{i}" for i, f in enumerate(_inputs(conf))}, [f"o{i}" for i in range(len(conf.get("order", [])))]


def _values(conf: dict) -> dict[int, Column]:
    """What each aggregate but a count reads of ``keyed``'s columns."""
    whole = _names(conf)[1]
    return {i: F.col(whole[a["input"]] if a["operation"] in ("first", "last") else f"a{i}") for i, a in enumerate(conf["aggregates"]) if a["operation"] != "count"}


def _first_side(conf: dict) -> tuple[Column, dict[str, Column]]:
    """(order of flows, their key fields); the A side is the first flow's source."""
    keys, _, later = _names(conf)
    order = F.struct("event_time", *later)
    return order, {f: F.col(k) for f, k in keys.items()}


def _total(a: dict, v: Column | None, on: Column, order: Column) -> tuple:
    """(kind, value, order) of an aggregate over the flows that ``on`` holds for."""
    op = a["operation"]
    if op == "count":
        return "sum", F.when(on, F.lit(1.0)).otherwise(F.lit(0.0)), None
    if op in ("first", "last"):
        return op, v, F.when(on, order) if op == "first" else F.when(on & v.isNotNull(), order)
    return op, F.when(on & ~F.isnan(v), v), None


def _zero(df: DataFrame, a: dict, suppress: bool):
    """What makes a value of zero NULL: that of a double alone, so not the first or last of an integer or text."""
    if not suppress or a["operation"] in ("first", "last") and df.schema[a["input"]].dataType.typeName() not in ("double", "float"):
        return lambda c: c
    return lambda c: F.nullif(c, F.lit(0.0))


SESSION = ["_HashId", "_common", "_low", "_high"]


def _gapped(rows: DataFrame, conf: dict, *by: str):
    """Flows grouped by session: two flows of one are at most the timeout apart."""
    gaps = F.element_at(F.array(*[F.lit(float(g["end_timeout"])) for g in conf["groups"]]), F.col("_group") + 1)
    gap = F.concat((gaps * 1_000_000 + 1).cast("bigint").cast("string"), F.lit(" microseconds"))  # a gap of just the timeout does not end it
    return rows.groupBy(*SESSION, *by, F.session_window("event_time", gap).alias("_w"))


def _one_gap(conf: dict) -> bool:
    """All flows of a connection have one timeout, whichever way they go."""
    sides = {*conf["key"].get("a", []), *conf["key"].get("b", [])}
    return len({g["end_timeout"] for g in conf["groups"]}) == 1 or not any(sides & set(g["selector"]) for g in conf["groups"])


def _sessions(df: DataFrame, conf: dict, aggs: dict[str, tuple], part_rows: int | None) -> DataFrame:
    """One row a session with aggs {name: (kind, value, order)}: kinds sum, min, max, and first or last by an order.

    Spark keeps a key's flows in one task while it merges their windows. Keys with more than ``part_rows`` flows are cut
    into ranges of time: sessions are found in each range, and only the first and last one of a range, which may go on
    in another, are merged over ranges (where both directions have one timeout).
    """
    rows = keyed(df, conf).filter(~F.col("_dup"))
    whole = {n: _folded(kind, v, order) for n, (kind, v, order) in aggs.items()}
    plain = lambda r: _gapped(r, conf).agg(*[c.alias(n) for n, c in whole.items()])
    if part_rows is None or df.isStreaming or not _one_gap(conf):
        return plain(rows)
    rows = rows.withColumn("_k", F.xxhash64(*SESSION))
    hot = staged(rows.groupBy("_k").agg(F.count("*").alias("n")).filter(F.col("n") > part_rows), "hot-sessions")
    found = hot.agg(F.count("*").alias("keys"), F.sum("n").alias("n")).first()
    if not found["keys"]:
        return plain(rows)
    hashes = F.broadcast(hot.select("_k")) if found["keys"] <= HOT_KEYS else hot.select("_k")
    some, k = rows.join(hashes, "_k", "left_semi"), min(MOST_PARTS, max(2, -(-found["n"] // part_rows)))
    micros = F.unix_micros(F.col("event_time").cast("timestamp"))
    cuts = sorted(set(some.agg(F.percentile_approx(micros, [i / k for i in range(1, k)], max(10_000, 4 * k)).alias("q")).first()["q"]))
    parts = _gapped(some.withColumn("_part", bucket_of(micros, cuts)), conf, "_part")
    held = parts.agg(*[c.alias(n) for n, c in whole.items()], *[_order_of(kind, v, order).alias(f"_by_{n}") for n, (kind, v, order) in aggs.items() if kind in ("first", "last")])
    held = held.withColumns({"_start": F.col("_w")["start"], "_end": F.col("_w")["end"]}).drop("_w")
    inside = Window.partitionBy(*SESSION, "_part").orderBy("_start")
    held = staged(held.withColumn("_edge", F.lag("_start").over(inside).isNull() | F.lead("_start").over(inside).isNull()), "sessions")
    over = Window.partitionBy(*SESSION).orderBy("_start")  # at most two rows a range
    edges = held.filter("_edge").withColumn("_new", (F.coalesce(F.max("_end").over(over.rowsBetween(Window.unboundedPreceding, -1)) <= F.col("_start"), F.lit(True))).cast("int"))
    edges = edges.withColumn("_n", F.sum("_new").over(over)).groupBy(*SESSION, "_n").agg(*[_merged(kind, n).alias(n) for n, (kind, _, _) in aggs.items()])
    names = [*SESSION, *aggs]
    return plain(rows.join(hashes, "_k", "left_anti")).select(*names).unionByName(held.filter("NOT _edge").select(*names)).unionByName(edges.select(*names))


def _order_of(kind: str, v: Column, order: Column) -> Column:
    """By what the value of a session was the first or last."""
    return F.min(order) if kind == "first" else F.max(order)


def _folded(kind: str, v: Column, order: Column | None) -> Column:
    return {"sum": lambda: F.sum(v), "min": lambda: F.min(v), "max": lambda: F.max(v), "first": lambda: F.min_by(v, order), "last": lambda: F.max_by(v, order)}[kind]()


def _merged(kind: str, n: str) -> Column:
    return _folded(kind, F.col(n), F.col(f"_by_{n}") if kind in ("first", "last") else None)


def _shown_keys(conf: dict, swap: Column) -> dict[str, Column]:
    key, out = conf["key"], {}
    at = {f: F.col(f"_k_{i}") for i, f in enumerate(key_fields(conf))}
    for f in key["common"]:
        out[f] = at[f]
    for x, y in zip(key.get("a", []), key.get("b", [])):
        out[x] = F.when(swap, at[y]).otherwise(at[x])
        out[y] = F.when(swap, at[x]).otherwise(at[y])
    return out


def _swapped(conf: dict) -> Column:
    return F.col("_flags").bitwiseAND(SYN_ACK) != 0 if conf.get("swap_ab") else F.lit(False)


def new_connections(df: DataFrame, conf: dict = DEFAULT, zero_suppression: bool = True, part_rows: int | None = PART_ROWS) -> DataFrame:
    """The newConnection record of each session: what its first flow says. ``part_rows``: as in ``connections``."""
    validate(conf)
    conf = normal(conf)
    order, first = _first_side(conf)
    values = _values(conf)
    aggs = {f"_k_{i}": ("first", c, order) for i, c in enumerate(first.values())} | {f"_v_{i}": ("first", v, order) for i, v in values.items()}
    found = _sessions(df, conf, aggs | {"_flags": ("first", F.col("_flags"), order), "first_time": ("min", F.col("event_time"), None)}, part_rows)
    swap, out = _swapped(conf), {}
    for i, a in enumerate(conf["aggregates"]):
        n, op, zero = a["name"], a["operation"], _zero(df, a, zero_suppression)
        v = F.lit(1.0) if op == "count" else F.col(f"_v_{i}")
        if op in ("sum", "min", "max"):
            v = F.nanvl(v, F.lit(0.0 if op == "sum" else None).cast("double"))
        if a.get("split"):  # the other side has no flow yet: nothing, or a sum or count of zero
            none = F.lit(0.0 if op in ("sum", "count") else None).cast("double")
            out[f"{n}_AB"], out[f"{n}_BA"] = zero(F.when(swap, none).otherwise(v)), zero(F.when(swap, v).otherwise(none))
        else:
            out[n] = zero(v)
    out |= _shown_keys(conf, swap)
    return found.select("_HashId", F.lit("newConnection").alias("_RecordType"), F.lit(True).alias("_IsFirst"), *[c.alias(n) for n, c in out.items()], "first_time")


def connections(df: DataFrame, conf: dict = DEFAULT, zero_suppression: bool = True, first_report: bool = True, part_rows: int | None = PART_ROWS) -> DataFrame:
    """One endConnection record a session: the key fields of its first flow, aggregates, _HashId, _RecordType,
    _IsFirst (``first_report``: whether nothing was reported of a connection before its end), first and last flow
    time. Duplicates open no session and count nothing. Keys with more than ``part_rows`` flows are cut into ranges of time."""
    validate(conf)
    conf = normal(conf)
    values = _values(conf)
    order, first = _first_side(conf)
    # the first flow's source end decides the direction, so both ends are summed and named after it
    aggs = {f"_k_{i}": ("first", c, order) for i, c in enumerate(first.values())} | {"_first_a": ("first", F.col("_a"), order), "_flags": ("first", F.col("_flags"), order)}
    for i, a in enumerate(conf["aggregates"]):
        v = values.get(i)
        if a.get("split"):
            aggs[f"_l_{i}"] = _total(a, v, F.col("_a") == F.col("_low"), order)
            aggs[f"_h_{i}"] = _total(a, v, F.col("_a") != F.col("_low"), order)
        else:
            aggs[f"_t_{i}"] = _total(a, v, F.lit(True), order)
    found = _sessions(df, conf, aggs | {"first_time": ("min", F.col("event_time"), None), "last_time": ("max", F.col("event_time"), None)}, part_rows)
    swap = _swapped(conf)
    ab_low = (F.col("_first_a") == F.col("_low")) != swap
    out = {}
    for i, a in enumerate(conf["aggregates"]):
        n, zero = a["name"], _zero(df, a, zero_suppression)
        if a.get("split"):
            out[f"{n}_AB"] = zero(F.when(ab_low, F.col(f"_l_{i}")).otherwise(F.col(f"_h_{i}")))
            out[f"{n}_BA"] = zero(F.when(ab_low, F.col(f"_h_{i}")).otherwise(F.col(f"_l_{i}")))
        else:
            out[n] = zero(F.col(f"_t_{i}"))
    out |= _shown_keys(conf, swap)
    return found.select("_HashId", F.lit("endConnection").alias("_RecordType"), F.lit(first_report).alias("_IsFirst"), *[c.alias(n) for n, c in out.items()], "first_time", "last_time")


def flow_logs(df: DataFrame, conf: dict = DEFAULT) -> DataFrame:
    """Every gated flow, duplicates too, with its connection's id; its own columns as they are."""
    return gated(df).filter(_has_key(conf)).select(*[F.col(f"`{c}`") for c in df.columns], _hash_id(*_ends(conf)).alias("_HashId"), F.lit("flowLog").alias("_RecordType"))


def classify(df: DataFrame, conf: dict = DEFAULT) -> DataFrame:
    """Counts of input rows: discarded (protocol), rejected (a key field is missing), duplicate, newConnection and update."""
    duplicate = F.coalesce(F.col("Duplicate").cast("boolean"), F.lit(False)) if "Duplicate" in df.columns else F.lit(False)
    gate = F.coalesce(F.col("Proto").cast("double").isin(*[float(p) for p in PROTOCOLS]), F.lit(False))
    kind = F.when(~gate, "discarded").when(~_has_key(conf), "rejected").when(duplicate, "duplicate").otherwise("update")
    found = df.groupBy(kind.alias("classification")).agg(F.count("*").alias("n"))
    new = connections(df, conf).groupBy().agg(F.count("*").alias("n"))
    both = found.unionByName(new.select(F.lit("newConnection").alias("classification"), "n")).unionByName(new.select(F.lit("update").alias("classification"), (-F.col("n")).alias("n")))
    return both.groupBy("classification").agg(F.sum("n").alias("n")).filter("n > 0")


def end_reasons(records: DataFrame, conf: dict = DEFAULT) -> DataFrame:
    """(group, reason, n): ended connections of ``track``'s records by scheduling group and reason, FIN_flag or timeout."""
    named = conf | {"groups": [g | {"number": i} for i, g in enumerate(conf["groups"])]}
    ends = records.filter("_RecordType = 'endConnection'").withColumn("group", _group_value(named, "number").cast("int"))
    return ends.groupBy("group", F.col("_EndReason").alias("reason")).agg(F.count("*").alias("n"))
