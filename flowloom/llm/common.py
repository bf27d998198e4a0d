"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.storage import discard, scratch, shared_dir, staged  # noqa: F401  the operators import them from here

#: Rows that one range bucket holds on average.
ROWS_PER_BUCKET = 1500


#: What clears the caches that a Python worker keeps from task to task, by the module that fills them.
CACHES: dict[str, Callable[[], None]] = {}


def release(owner: str | None = None) -> None:
    """Called in a task before it starts on its rows: Spark reuses Python workers, so caches of other operators than
    ``owner`` go, and memory that was freed since goes back to the system, for the executor counts it."""
    for name, clear in CACHES.items():
        if name != owner:
            clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


#: Bytes of an Arrow batch from Spark to its Python workers.
BATCH_BYTES = 4_000_000


def small_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by bytes, where the session's configuration does not say how: ten thousand documents, Spark's
    measure, can be any size, and each batch is held several times over."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(BATCH_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores in front until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def all_nullable(kind: T.DataType) -> T.DataType:
    """The type with every field and element nullable, as values that come from Python workers are for all that Spark knows."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, all_nullable(f.dataType), True) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(all_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(all_nullable(kind.keyType), all_nullable(kind.valueType), True)
    return kind


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below sf_dir."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def range_splits(df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET, most: int = 10_000) -> list[int]:
    """Ascending upper bounds that cut the integer key into buckets of about rows_per_bucket rows.

    One aggregation over the key column alone; at most ``most`` numbers reach the driver. NULL keys
    are not counted and belong to bucket 0.
    """
    rows = df.select(F.count(key).alias("n")).first()["n"]
    buckets = min(most, max(1, -(-rows // rows_per_bucket)))
    if buckets == 1:
        return []
    cuts = [i / buckets for i in range(1, buckets)]
    found = df.select(F.percentile_approx(key, cuts, max(10_000, 4 * buckets)).alias("q")).first()["q"]
    return sorted(set(found))


def bucket_of(key: Column, splits: list[int]) -> Column:
    """The number of splits below key (NULL: 0), found in two steps of about sqrt(n) comparisons."""
    if not splits:
        return F.lit(0)
    width = max(1, int(len(splits) ** 0.5))
    groups = [splits[i : i + width] for i in range(0, len(splits), width)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    k = F.coalesce(key.cast("long"), F.lit(splits[0]).cast("long"))
    coarse = F.size(F.filter(longs([g[-1] for g in groups]), lambda s: s < k))
    fine = F.size(F.filter(F.coalesce(F.get(F.array(*[longs(g) for g in groups]), coarse), longs([])), lambda s: s < k))
    return (coarse * F.lit(width) + fine).cast("int")


def fine_buckets(df: DataFrame, key: str, rows_per_bucket: int, most: int = 10_000, last: list[int] | None = None) -> tuple[Column, Column]:
    """(coarse, fine): range buckets of the integer key, both in its order; each coarse one is cut into equal
    widths of the key where ``most`` of them cannot hold rows_per_bucket rows each. NULL keys have the buckets -1;
    keys in ``last`` are the greatest of their buckets. Only coarse bounds reach the driver."""
    seen = df.select(F.count(key).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    found = range_splits(df, key, rows_per_bucket, most)
    splits = sorted({*found, *(last or [])})
    none = F.col(key).isNull()
    coarse = F.when(none, F.lit(-1)).otherwise(bucket_of(F.col(key), splits))
    parts = -(-seen["n"] // (rows_per_bucket * (len(found) + 1)))
    if parts <= 1:
        return coarse, coarse.cast("long")
    exact = lambda x: x.cast("decimal(20,0)")  # noqa: E731  widths and bounds may be beyond long
    lows, highs = [seen["low"], *[s + 1 for s in splits]], [*splits, seen["high"]]
    pick = lambda xs: F.get(F.array(*[exact(F.lit(str(x))) for x in xs]), F.greatest(coarse, F.lit(0)))
    width = F.greatest((pick(highs) - pick(lows)).cast("double") + 1, F.lit(1.0))
    at = F.floor((exact(F.col(key)) - pick(lows)).cast("double") * parts / width)
    return coarse, F.when(none, F.lit(-1)).otherwise(coarse.cast("long") * parts + F.greatest(F.lit(0), F.least(at, F.lit(parts - 1))))
