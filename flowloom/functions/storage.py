"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_inside: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a session within one process may leave it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, name: str, keep: bool = False, **options: str) -> DataFrame:
    """df written as Parquet to a new folder of the shared directory and read back: cuts the lineage,
    survives lost executors, and lets several later branches read one result. ``keep``: beyond the scratch around it; ``options``: of the Parquet writer."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    if _inside and not keep:
        _inside[-1].append(out)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; other DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "staged_at", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Tables staged inside are deleted at the end, so what is made from them must have been written by then."""
    _inside.append([])
    try:
        yield
    finally:
        discard(*_inside.pop())
