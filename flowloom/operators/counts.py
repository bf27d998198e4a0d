"""Counts beside the rows: what a plan skips is counted in the pass that skips it.

A ``Counts`` puts observations into DataFrames. They cost a sum in each task and no job of their own, and are there once the
DataFrame has been run. On a stream ``StreamCounts`` adds up what each batch reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class Counts:
    """Named counts of DataFrames, each of the first action over it."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, conditions: dict[str, Column], sums: dict[str, Column] | None = None) -> DataFrame:
        """df, with counts of the rows that each condition holds for; also of the rows in all, as ``rows``, and sums."""
        found = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]]
        found += [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (sums or {}).items()]
        if df.isStreaming:
            return df.observe(name, *found)
        if name in self._seen:
            raise ValueError(f"{name!r} is watched already")
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], *found)

    def read(self) -> dict[str, dict[str, int]]:
        """The counts by name; waits for a DataFrame that is being run, so each must have been started."""
        return {name: dict(o.get) for name, o in self._seen.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """(name, count, n): the counts as rows."""
        rows = [(name, k, n) for name, counts in self.read().items() for k, n in sorted(counts.items())]
        return spark.createDataFrame(rows, "name string, count string, n long")


class StreamCounts(StreamingQueryListener):
    """The counts of all batches of a session's streams, added up by name."""

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        for name, row in (event.progress.observedMetrics or {}).items():
            mine = self.totals.setdefault(name, {})
            for k, n in row.asDict().items():
                mine[k] = mine.get(k, 0) + (n or 0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
