"""Several sinks of one stream: a micro-batch is read once and handed to each, and a replay writes nothing twice.

Each sink has a ledger of the batches that it has written, one small file a batch in a shared folder. When a batch is
repeated after a failure, sinks that have it are passed over and only the others are called. A sink that may fail halfway
must itself be able to repeat a batch; ``files`` is: it writes to a folder of the batch's number and replaces it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from flowloom.plans.pipeline import Pipeline

#: Entries of a ledger that are kept behind the newest.
KEPT = 100


class Ledger:
    """Which batches a sink has written."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, jvm = path.rstrip("/"), spark._jvm
        self._at = lambda n: jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={n}")
        self._fs = self._at(0).getFileSystem(spark._jsc.hadoopConfiguration())

    def has(self, number: int) -> bool:
        return self._fs.exists(self._at(number))

    def add(self, number: int) -> None:
        self._fs.create(self._at(number), True).close()
        if number >= KEPT:
            self._fs.delete(self._at(number - KEPT), False)


def files(path: str, form: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to a folder of its number."""
    return lambda df, number: df.write.mode("overwrite").format(form).save(f"{path}/batch={number}")


def fan_out(df: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], ledger: str, checkpoint: str, pipeline: Pipeline | None = None):
    """A stream writer that hands each micro-batch to all sinks (name: sink(df, batch number)), to be started.

    With a pipeline the sinks have the names of its sink stages and get their rows; what several stages follow is kept
    while the batch lasts, and so is the batch itself.
    """
    if pipeline is not None and set(sinks) != {s["name"] for s in pipeline.stages if s.get("sink")}:
        raise ValueError("each sink stage needs a sink, and each sink a stage")

    def batch(rows: DataFrame, number: int) -> None:
        ledgers = {name: Ledger(rows.sparkSession, f"{ledger}/{name}") for name in sinks}
        left = [name for name in sinks if not ledgers[name].has(number)]
        if not left:
            return
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = dict.fromkeys(left, rows) if pipeline is None else pipeline.run(rows)
            for name in left:
                sinks[name](found[name], number)
                ledgers[name].add(number)
        finally:
            rows.unpersist()

    return df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
