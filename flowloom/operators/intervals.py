"""Ranges that overlap, told apart: a sweep makes them disjoint, and values are looked up among what it leaves.

``disjoint`` turns overlapping ranges, of which the least by an order counts, into segments that do not overlap: ranges
are walked by their lower bounds with a heap of those that are open, so a segment costs a few steps however many ranges lie
around it. The ranges of one key are one task's work, unless they are many: those are cut at places of about as many lower
bounds, a range going to each place that it reaches into.

``locate`` finds each value's segment: by binary search in a sorted array that is sent to the workers, and a join of the one
found bound with the broadcast segments, or, beyond a size that is checked, by an as-of join in ranges of the values.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.coerce import free_names
from flowloom.functions.ranges import bucket_of
from flowloom.functions.storage import staged
from flowloom.operators.asof import as_of

#: Ranges of one key that one task sweeps.
PART_ROWS, MOST_PARTS = 200_000, 10_000
#: Segments up to which their bounds (16 bytes each) and values are broadcast.
BROADCAST_SEGMENTS = 1_000_000
_HIGHEST = 2**63 - 1


def swept(ranges: Iterable[tuple]) -> Iterator[tuple]:
    """(low, high, value) without overlap, from (low, high, order, value) sorted by low; high is exclusive, the least order counts."""
    open_: list[tuple] = []  # (order, number, high, value)
    at, held, number = 0, None, 0

    def upto(end) -> Iterator[tuple]:
        nonlocal at, held
        while open_ and at < end:
            if open_[0][2] <= at:
                heapq.heappop(open_)
                continue
            _, n, high, value = open_[0]
            to = min(end, high)
            if held is not None and held[3] == n and held[1] == at:
                held = (held[0], to, value, n)
            else:
                if held is not None:
                    yield held[:3]
                held = (at, to, value, n)
            at = to
        at = end

    for low, high, order, value in ranges:
        if high <= low:
            continue
        if open_:
            yield from upto(low)
        at = low
        heapq.heappush(open_, (order, number, high, value))
        number += 1
    if open_:
        yield from upto(max(x[2] for x in open_))
    if held is not None:
        yield held[:3]


def gathered(places: Iterable[tuple[pa.Array, int]]) -> pa.Array:
    """The values at (array, place), in that order; of each array only those that are asked for are copied."""
    arrays: dict[int, pa.Array] = {}
    asked: dict[int, list[int]] = {}
    order: dict[int, list[int]] = {}
    for n, (a, i) in enumerate(places):
        if id(a) not in arrays:
            arrays[id(a)], asked[id(a)], order[id(a)] = a, [], []
        asked[id(a)].append(i)
        order[id(a)].append(n)
    taken = pa.concat_arrays([a.take(pa.array(asked[k], pa.int64())) for k, a in arrays.items()])
    return taken if len(arrays) == 1 else taken.take(pa.array(np.argsort(np.concatenate(list(order.values()))), pa.int64()))


def sweep_batches(batches: Iterable[pa.RecordBatch], keys: list[str], order: list[str]) -> Iterator[pa.RecordBatch]:
    """(keys, low, high, value) without overlap, from (keys, part, low, high, order, value) sorted by these."""
    at = [*keys, "part"]
    kinds: dict[str, pa.DataType] = {}

    def given() -> Iterator[tuple]:
        for b in batches:
            if not kinds:
                kinds.update({n: b.schema.field(n).type for n in [*keys, "low", "high", "value"]})
            values = b["value"]  # one array of a batch: each b[...] is another one
            yield from zip(zip(*[b[c].to_pylist() for c in at]), b["low"].to_pylist(), b["high"].to_pylist(), zip(*[[(x is not None, x) for x in b[c].to_pylist()] for c in order]) if order else [()] * len(b), ((values, i) for i in range(len(b))))

    def segments() -> Iterator[tuple]:
        rows, ahead = given(), None
        ahead = next(rows, None)
        while ahead is not None:
            key = ahead[0]

            def group():
                nonlocal ahead
                while ahead is not None and ahead[0] == key:  # noqa: B023
                    yield ahead[1:]
                    ahead = next(rows, None)

            for low, high, v in swept(group()):
                yield (*key[:-1], low, high, v)

    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        *columns, values = zip(*out)
        return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, kinds.values())], gathered(values)], list(kinds))

    for s in segments():
        out.append(s)
        if len(out) >= 10_000:
            yield batch()
            out = []
    if out:
        yield batch()


def disjoint(ranges: DataFrame, keys: list[str], order: list[str], value: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(keys, low, high, value): where ranges (keys, low, high exclusive, both long; order columns; value) of one key overlap,
    the least by order counts (NULL first; of equal ones any). Empty ranges and NULL bounds are left out."""
    n_order, n_key = [f"o{i}" for i in range(len(order))], [f"k{i}" for i in range(len(keys))]
    rows = ranges.filter("low < high").select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, n_key)], F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"), *[F.col(f"`{c}`").alias(n) for c, n in zip(order, n_order)], F.col(f"`{value}`").alias("value"))
    counts = staged(rows.groupBy(*n_key).agg(F.count("*").alias("n")).filter(F.col("n") > part_rows), "many-ranges") if keys else None
    n = counts.agg(F.sum("n")).first()[0] if keys else rows.count()
    if n and n > part_rows:
        some = rows.join(counts.drop("n"), n_key, "left_semi") if keys else rows
        k = min(MOST_PARTS, -(-n // part_rows))
        cuts = sorted(set(some.agg(F.percentile_approx("low", [i / k for i in range(1, k)], max(10_000, 4 * k)).alias("q")).first()["q"] or []))
        first, last = bucket_of(F.col("low"), cuts), bucket_of(F.col("high") - 1, cuts)
        lows, highs = F.array(*[F.lit(x).cast("long") for x in [-(2**63), *[c + 1 for c in cuts]]]), F.array(*[F.lit(x).cast("long") for x in [*[c + 1 for c in cuts], _HIGHEST]])
        some = some.withColumn("part", F.explode(F.sequence(first, last))).withColumns({"low": F.greatest("low", F.get(lows, F.col("part"))), "high": F.least("high", F.get(highs, F.col("part")))})
        rows = some.unionByName(rows.join(counts.drop("n"), n_key, "left_anti").withColumn("part", F.lit(0))) if keys else some
    else:
        rows = rows.withColumn("part", F.lit(0))
    at = [*n_key, "part"]
    dealt = rows.repartition(*at).sortWithinPartitions(*at, "low", *n_order)
    schema = T.StructType([*[T.StructField(n, rows.schema[n].dataType) for n in n_key], T.StructField("low", T.LongType()), T.StructField("high", T.LongType()), T.StructField("value", rows.schema["value"].dataType)])

    found = dealt.mapInArrow(lambda batches: sweep_batches(batches, n_key, n_order), schema)
    return found.select(*[F.col(n).alias(k) for n, k in zip(n_key, keys)], "low", "high", F.col("value").alias(value))


def searched(values: Column, lows: np.ndarray, highs: np.ndarray, spark, names: list[str] | None = None) -> Column:
    """The low bound (or name) of the segment (low, high exclusive; ascending) that holds each value, by binary search; else NULL."""
    text = lows.dtype.kind == "S"
    sent, kind = spark.sparkContext.broadcast((lows, highs, None if names is None else np.array(names, object))), "string" if text or names is not None else "long"

    @F.pandas_udf(kind)
    def search(v: pd.Series) -> pd.Series:
        lows, highs, named = sent.value
        known = v.notna().to_numpy()
        x = np.array(v[known].to_numpy(), lows.dtype)
        if not len(lows) or not len(x):
            return pd.Series([None] * len(v), dtype=object)
        i = np.searchsorted(lows, x, side="right") - 1
        inside = (i >= 0) & (x < highs[np.maximum(i, 0)])
        out = np.full(len(v), None, object)
        if named is not None:
            found = named[i[inside]].tolist()
        else:
            found = [x.decode() for x in lows[i[inside]]] if text else lows[i[inside]].tolist()
        out[np.flatnonzero(known)[inside]] = found
        return pd.Series(out, dtype=object)

    return search(values)


def locate(df: DataFrame, number: Column, segments: DataFrame, value: str, most: int = BROADCAST_SEGMENTS) -> DataFrame:
    """df with the value of the segment (low, high exclusive, value; disjoint) that holds the number, NULL where none does."""
    at, until, found = free_names(df, "_at", "_until", "_found")
    known = staged(segments, "segments")
    if known.count() <= most:
        rows = known.select("low", "high").toLocalIterator()
        bounds = np.array(sorted((r["low"], r["high"]) for r in rows), np.int64).reshape(-1, 2)
        table = known.select(F.col("low").alias(found), value)
        hit = df.withColumn(at, searched(number, bounds[:, 0], bounds[:, 1], df.sparkSession))
        return hit.join(F.broadcast(table), F.col(at) == F.col(found), "left").drop(at, found)
    right = known.select(F.col("low").alias("t"), F.struct(F.col("high"), F.col(value)).alias("held"))
    out = as_of(df.withColumn(at, number), right, [], at, "t", {until: "held"})
    return out.withColumn(value, F.when(F.col(at) < F.col(until)["high"], F.col(until)[value])).drop(at, until)
