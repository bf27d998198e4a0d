"""What the trained operators share: the held-out split and bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m (NULL id: as an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m


def unique_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) with one row an id: the larger label where an id has several; rows without either are left out."""
    return labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna().groupBy("doc_id").agg(F.max("label").alias("label"))


def bounded(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """About ``rows`` rows of df at most, the same for the same rows: those whose hashed key falls into the share."""
    n = df.count()
    share = min(1.0, rows / n) if n else 1.0
    return df if share >= 1.0 else df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


#: Numbers in one block of a partition's sums, and lanes that the partitions' blocks are added in first.
BLOCK, LANES = 512, 32


def summed(df: DataFrame, width: int, length: int, part) -> np.ndarray:
    """The sum over df's partitions of part(x, y): a tree of blocks.

    Each partition sends its sums as blocks of ``BLOCK`` numbers to one of ``LANES`` lanes; a task adds the blocks of
    its lanes, and the driver adds at most LANES vectors of ``length`` numbers.
    """

    def work(batches):
        total = np.zeros(length)
        for b in batches:
            if len(b):
                total += part(matrix(b["x"], width), b["label"].to_numpy().astype(float))
        if total.any():
            data = [total[i : i + BLOCK].tobytes() for i in range(0, length, BLOCK)]
            yield pa.RecordBatch.from_pydict({"lane": pa.array([TaskContext.get().partitionId() % LANES] * len(data), pa.int32()), "block": pa.array(range(len(data)), pa.int32()), "data": pa.array(data, pa.binary())})

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for block, data in zip(b["block"].to_pylist(), b["data"].to_pylist()):
                total[block] = total.get(block, 0.0) + np.frombuffer(data)
        if total:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(total), pa.int32()), "data": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    parts = df.select("x", "label").mapInArrow(work, "lane int, block int, data binary").repartition("lane")
    out = np.zeros(length)
    for r in parts.select("block", "data").mapInArrow(add, "block int, data binary").collect():
        out[r["block"] * BLOCK :][:BLOCK] += np.frombuffer(r["data"])
    return out
