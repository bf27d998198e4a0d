"""Packing of documents into training sequences: bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document goes whole into the window that it
leaves with the least room. When none fits, the fullest window is filled up with the document's head,
emitted, and what is left of the document is placed again; longer documents give full windows of their
own. At the end a partition joins what its open windows hold; all partitions' joined leftovers are then
laid end to end and cut every ``length`` ids, and the one remaining tail is cut at powers of two, so
that no sequence needs padding unless the caller asks for a fixed length.

Edge cases: NULL or empty text is the end id alone; a text of any length is cut into windows of its own and a rest;
of equally full windows the one opened first is taken; NULL and repeated doc_ids are packed like any other row; an
empty table gives no piece. Other columns are not read and may have any name.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.llm.common import small_batches, staged, table
from flowloom.llm.token_files import batches_of, encoder, tokenizer_path

LENGTH, OPEN_WINDOWS, END_ID = 2048, 32, 1
#: Partitions in a lane, and partitions up to which their leftovers' places (two numbers each) are broadcast.
LANE, BASES = 1000, 1_000_000
PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long, ids binary"


class Windows:
    """The open windows of one partition, sorted by room."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.rooms: list[tuple[int, int]] = []  # (room, window number), ascending
        self.held: dict[int, list[tuple]] = {}
        self.n = 0
        self.full: list[list[tuple]] = []

    def place(self, doc: int | None, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while start < total:
            left = total - start
            if left >= self.length:
                self.full.append([(doc, start, ids[start : start + self.length], total)])
                start += self.length
                continue
            at = bisect.bisect_left(self.rooms, (left, -1))
            if at < len(self.rooms):  # best fit
                start = self._put(at, doc, ids, start, left)
            elif len(self.rooms) < self.most:
                self.held[self.n] = []
                bisect.insort(self.rooms, (self.length, self.n))
                self.n += 1
            else:  # none fits: the fullest is filled up and goes
                start = self._put(0, doc, ids, start, self.rooms[0][0])

    def _put(self, at: int, doc, ids: np.ndarray, start: int, size: int) -> int:
        room, w = self.rooms.pop(at)
        self.held[w].append((doc, start, ids[start : start + size], len(ids)))
        if room == size:
            self.full.append(self.held.pop(w))
        else:
            bisect.insort(self.rooms, (room - size, w))
        return start + size

    def leftovers(self) -> list[tuple]:
        """Pieces of the open windows, the fullest first."""
        return [p for _, w in self.rooms for p in self.held[w]]


def _rows(pieces: list[tuple], with_ids: bool) -> pa.RecordBatch:
    """pieces: (doc, start, ids, doc tokens, sequence, offset)."""
    cols = list(zip(*pieces)) if pieces else [[]] * 6
    crc = [zlib.crc32(i.astype("<u4").tobytes()) for i in cols[2]]
    data = [i.astype("<u4").tobytes() if with_ids or s < 0 else None for i, s in zip(cols[2], cols[4])]
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(cols[0], pa.int64()), "start": pa.array(cols[1], pa.int64()), "length": pa.array([len(i) for i in cols[2]], pa.int64()),
        "doc_tokens": pa.array(cols[3], pa.int64()), "sequence_id": pa.array(cols[4], pa.int64()), "offset": pa.array(cols[5], pa.int64()),
        "ids_crc32": pa.array(crc, pa.int64()), "ids": pa.array(data, pa.binary()),
    })


def pack(df: DataFrame, length: int = LENGTH, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID, path: str | None = None, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids_crc32, ids (uint32 LE; NULL without with_ids)."""
    path, spark = path or tokenizer_path(), df.sparkSession
    small_batches(spark)

    def work(batches):
        enc, part = encoder(path), TaskContext.get().partitionId()
        w, sequence, end = Windows(length, open_windows), part << 32, np.array([end_id], enc.dtype)

        def emitted():
            nonlocal sequence
            out = []
            for pieces in w.full:
                at = 0
                for p in pieces:
                    out.append((*p, sequence, at))
                    at += len(p[2])
                sequence += 1
            w.full.clear()
            return out

        for b in batches:
            docs = b["doc_id"].to_pylist()
            for at, texts in batches_of(b["text"].to_pylist()):
                for doc, data in zip(docs[at:], enc.encode(texts)):
                    w.place(doc, np.concatenate([np.frombuffer(data, enc.dtype), end]))
                if w.full:
                    yield _rows(emitted(), with_ids)
        at, out = 0, []
        for p in w.leftovers():  # sequence -1-part: the partition's leftovers, laid end to end
            out.append((*p, -1 - part, at))
            at += len(p[2])
        yield _rows(out, with_ids)

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    packed = staged(texts.mapInArrow(work, PIECE), "packed")
    rest = packed.filter("sequence_id < 0")
    # where each partition's leftovers begin: sums over lanes of LANE partitions reach the driver, the rest is a window in each lane
    sizes = rest.withColumn("lane", F.expr(f"(-1 - sequence_id) div {LANE}")).groupBy("lane", "sequence_id").agg(F.sum("length").alias("n"))
    sizes, lanes, total = staged(sizes, "leftovers"), [], 0
    for r in sorted(sizes.groupBy("lane").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["lane"]):
        lanes.append((r["lane"], total))
        total += r["n"]
    earlier = Window.partitionBy("lane").orderBy(F.desc("sequence_id")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    bases = sizes.withColumn("before", before).join(F.broadcast(spark.createDataFrame(lanes, "lane long, first long")), "lane").select("sequence_id", (F.col("first") + F.col("before")).alias("base"))
    rest = rest.join(F.broadcast(bases) if len(lanes) * LANE <= BASES else bases, "sequence_id")
    whole, first = total // length * length, (1 << 62)
    cuts = [whole]
    while cuts[-1] < total:  # the tail, by powers of two
        cuts.append(cuts[-1] + (1 << (total - cuts[-1]).bit_length() - 1))

    def cut(batches):
        for b in batches:
            out = []
            for doc, start, doc_tokens, base, offset, data in zip(*[b[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "base", "offset", "ids")]):
                ids, at = np.frombuffer(data, "<u4"), base + offset
                while len(ids):
                    if at < whole:
                        number, inside, room = at // length, at % length, length - at % length
                    else:
                        k = bisect.bisect_right(cuts, at) - 1
                        number, inside, room = whole // length + k, at - cuts[k], cuts[k + 1] - at
                    out.append((doc, start, ids[:room], doc_tokens, first + number, inside))
                    ids, start, at = ids[room:], start + len(ids[:room]), at + len(ids[:room])
            yield _rows(out, with_ids)

    return packed.filter("sequence_id >= 0").unionByName(rest.mapInArrow(cut, PIECE))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
