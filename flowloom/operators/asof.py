"""As-of joins: each row meets the last row of another table that has its key and is not later.

Both tables' rows are dealt by key and range of time, so a key with a third of all rows is many tasks' work. Within a range a
window carries the last right row forward. Across ranges it comes from one row a key and range: the last right rows of
all ranges are carried forward over those ranges that left rows ask for, and stand first in their range. So left rows are shuffled
once, nothing is collected by key, and what goes across ranges is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.ranges import bucket_of

#: Rows that a range holds on average, and the most ranges.
ROWS_PER_RANGE, MOST_RANGES = 1_000_000, 10_000


def _long(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    c = F.col(f"`{column}`")
    return F.unix_micros(c.cast("timestamp")) if kind in ("timestamp", "timestamp_ntz", "date") else c.cast("long")


def as_of(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, columns: dict[str, str], order: list[str] | None = None, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """left with ``columns`` ({new name: right column}) of the last right row of the same ``on`` columns at or before its time.

    Times are timestamps (to the microsecond) or whole numbers; of right rows of one key and time the greatest by ``order``
    counts. NULL keys and NULL times match nothing; right rows without either are left out. A new name replaces a column of left.
    """
    keys = [f"k{i}" for i in range(len(on))]
    held = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns.values())])
    later = F.struct(*[F.col(f"`{c}`") for c in order]) if order else F.lit(0)
    r = right.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(on, keys)], _long(right, right_time).alias("t"), later.alias("later"), held.alias("held")).dropna(subset=[*keys, "t"])
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row")
    whole = left.select(*[F.col(f"`{k}`").cast(r.schema[n].dataType).alias(n) for k, n in zip(on, keys)], _long(left, left_time).alias("t"), row)
    known = F.lit(True)
    for c in [*keys, "t"]:
        known = known & F.col(c).isNotNull()
    asked = whole.filter(known)

    times = asked.select("t").unionByName(r.select("t"))
    n = times.count()
    k = min(MOST_RANGES, max(1, -(-n // rows_per_range)))
    cuts = sorted(set(times.agg(F.percentile_approx("t", [i / k for i in range(1, k)], max(10_000, 4 * k)).alias("q")).first()["q"])) if k > 1 else []
    part = bucket_of(F.col("t"), cuts)
    at = [*keys, "part"]
    asked, r = asked.withColumn("part", part), r.withColumn("part", part)
    if cuts:
        last = r.groupBy(*at).agg(F.max_by("held", F.struct("t", "later")).alias("held"))
        wanted = asked.select(*at).groupBy(*at).agg(F.lit(None).cast(last.schema["held"].dataType).alias("held"))
        before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1) if keys else Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # without keys: a row a range
        both = wanted.unionByName(last).groupBy(*at).agg(F.first("held", ignorenulls=True).alias("held"))
        carried = both.withColumn("held", F.last("held", ignorenulls=True).over(before)).filter("held IS NOT NULL")
        r = r.unionByName(carried.withColumns({"t": F.lit(-(2**63)).cast("long"), "later": F.lit(None).cast(r.schema["later"].dataType)}).select(*r.columns))
    rows = asked.withColumns({"side": F.lit(1), "held": F.lit(None).cast(r.schema["held"].dataType), "later": F.lit(None).cast(r.schema["later"].dataType)})
    rows = rows.unionByName(r.withColumns({"side": F.lit(0), "row": F.lit(None).cast(asked.schema["row"].dataType)}))
    forward = Window.partitionBy(*at).orderBy("t", "side", "later").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("held", F.last("held", ignorenulls=True).over(forward)).filter("side = 1").select("row", "held")
    found = found.unionByName(whole.filter(~known).select("row", F.lit(None).cast(r.schema["held"].dataType).alias("held")))
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in left.columns if c not in columns], *[F.col(f"held.c{i}").alias(n) for i, n in enumerate(columns)])
