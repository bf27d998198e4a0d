"""Byte-level tokenization shared by packing and token files, and the Elias-Fano token-file format.

A token file holds one shard: the ids of its documents, concatenated, with the documents' boundaries and
their doc_ids as two Elias-Fano sequences. Layout, all little-endian:

    magic 8s | docs u64 | ids u64 | first doc_id i64 | bytes per id u8 | low bits u8, of boundaries and of doc_ids | pad 5x
    for boundaries, then doc_ids: low parts: ceil(docs*low/8) bytes | upper part length u64 | upper bits |
        select samples: every 256th set bit's place, u64 each
    ids

The boundary after document i is the i-th number of its sequence, and document i's doc_id less the first one is
that of the other. A number's low bits lie side by side; its upper part is a unary bit vector in which the i-th set
bit stands at upper+i, so ``select`` (a sampled place, then a popcount walk over bytes) returns any of them without a
table of 64-bit numbers.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.llm.common import CACHES, bucket_of, fine_buckets, release, small_batches, staged, table

MAGIC, HEAD = b"FLTOKEN2", "<8sQQqBBB5x"
SAMPLE = 256
#: Entries that a worker's cache of encoded words may hold, and their letters.
CACHE_ENTRIES, CACHE_LETTERS = 1_000_000, 16_000_000
#: Rows of one token file on average.
ROWS_PER_FILE = 1500
#: Ranges at most that the rows of frequent ids are sorted in; each range's rows may fill many files.
HOT_RANGES = 200
#: Frequent ids at most that reach the driver, the most frequent first; a further one has under a 10,000th of the rows.
HOT_IDS = 10_000
#: Rows of the manifest (two numbers each) up to which it is broadcast.
MANIFEST_ROWS = 1_000_000
_SPLIT = re.compile(r" (?=\S)")
_LATIN = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]")
_encoders: dict[str, "Encoder"] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts to little-endian uint16 or uint32 ids with the tokenizers library.

    A byte-level tokenizer's pieces never cross a space that a non-space follows, a single line end
    between two non-spaces, or the place between a Latin letter and a comma or full stop. So a text is
    cut there and each distinct word is encoded once per worker. The cache is emptied when it is full,
    so memory is bounded whatever the vocabulary. Texts that hold one of the vocabulary's added tokens are
    encoded whole, as the library does it (an added token's text gives its one id).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = sorted(t.content for t in self.tok.get_added_tokens_decoder().values())
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"  # native order is little-endian on all hosts that Spark runs on here
        self.cache: dict[str, bytes] = {}
        self.letters = 0
        self.marks = {m: self._ids([m])[0] for m in ",."}
        starts = [i for t, i in self.tok.get_vocab().items() if t.startswith("\u0120")]  # pieces that begin with a space
        self.begins = np.zeros(self.tok.get_vocab_size(), bool)
        self.begins[starts] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space: encoded as one text and cut where a piece begins with a space."""
        (data,) = self._ids([" " + " ".join(words)])
        at = np.flatnonzero(self.begins[np.frombuffer(data, self.dtype)]) * self.dtype.itemsize
        if len(at) != len(words):
            return self._ids([" " + w for w in words])
        ends = [*at[1:].tolist(), len(data)]
        return [data[i:j] for i, j in zip(at.tolist(), ends)]

    def _fill(self, words: set[str]) -> None:
        cache = self.cache
        missing = words.difference(cache)
        if len(cache) + 2 * len(missing) > CACHE_ENTRIES or self.letters > CACHE_LETTERS:
            cache.clear()
            missing, self.letters = words, 0
        self.letters += sum(map(len, missing))
        marked = [w for w in missing if w[-1:] in self.marks and _LATIN.match(w[-2:-1])]
        plain = missing.difference(marked).union([w[:-1] for w in marked]).difference(cache)
        bare = [w for w in plain if w[0] in "\r\n"]
        cache.update(zip(bare, self._ids([w[w[0] == "\r" :] for w in bare])))
        rest = list(plain.difference(bare))
        for i in range(0, len(rest), 2048):
            cache.update(zip(rest[i : i + 2048], self._words(rest[i : i + 2048])))
        for w in marked:
            cache[w] = cache[w[:-1]] + self.marks[w[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """A word's key is the word where a space precedes it, "\\n" and the word at a line's beginning, "\\r" and the word at the text's."""
        whole = {i: self._ids([t])[0] for i, t in enumerate(texts) if self.added and self.added.search(t)}
        if whole:
            rest = iter(self.encode([t for i, t in enumerate(texts) if i not in whole]))
            return [whole[i] if i in whole else next(rest) for i in range(len(texts))]
        cut = []
        for t in texts:
            if " ".join(t.split()) == t.replace("\n", " "):  # single spaces and line ends alone
                words = t.replace("\n", " \n").split(" ")
            else:
                words = _SPLIT.split(t)
            words[0] = "\r" + words[0]
            cut.append(words)
        self._fill(set().union(*cut))
        get = self.cache.__getitem__
        return [b"".join(map(get, words)) for words in cut]


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file; other operators' tasks drop it."""
    release("token_files")
    CACHES["token_files"] = _encoders.clear
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def batches_of(texts: list[str], most_chars: int = 2_000_000):
    """Slices of texts of about most_chars characters, so that working memory is bounded."""
    at = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= most_chars:
            yield at, texts[at : i + 1]
            at, n = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def elias_fano(bounds: np.ndarray, total: int) -> tuple[int, bytes, bytes, bytes]:
    """(low bits, low parts, upper bits, select samples) of non-decreasing bounds up to total."""
    n = len(bounds)
    low = max(0, int(total // n).bit_length() - 1) if n else 0
    b = bounds.astype(np.uint64)
    lows = ((b[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel() if low else np.empty(0, np.uint8)
    places = (b >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    bits[places] = 1
    pack = lambda x: np.packbits(x, bitorder="little").tobytes()
    return low, pack(lows), pack(bits), places[::SAMPLE].astype("<u8").tobytes()


def write_shard(doc_ids: np.ndarray, docs: list[bytes], dtype: np.dtype) -> bytes:
    """One token file; doc_ids ascend."""
    sizes = np.array([len(d) // dtype.itemsize for d in docs], np.int64)
    bounds = np.cumsum(sizes)
    total, n = int(bounds[-1]) if len(bounds) else 0, len(docs)
    first = int(doc_ids[0]) if n else 0
    steps = doc_ids.astype(np.int64).view(np.uint64) - np.uint64(first % (1 << 64))  # also where the span is beyond int64
    low, *parts = elias_fano(bounds, total)
    low_ids, *id_parts = elias_fano(steps, int(steps[-1]) if n else 0)
    head = struct.pack(HEAD, MAGIC, n, total, first, dtype.itemsize, low, low_ids)
    packed = [x for lows, upper, samples in (parts, id_parts) for x in (lows, struct.pack("<Q", len(upper)), upper, samples)]
    return b"".join([head, *packed, *docs])


class Sequence:
    """An Elias-Fano sequence of n numbers in a file, from byte ``at`` to ``end``."""

    def __init__(self, data: bytes, at: int, n: int, low: int):
        self.n, self.low = n, low
        self.lows = np.unpackbits(np.frombuffer(data, np.uint8, (n * low + 7) // 8, at), bitorder="little")
        at += (n * low + 7) // 8
        (size,) = struct.unpack_from("<Q", data, at)
        self.upper = np.frombuffer(data, np.uint8, size, at + 8)
        self.samples = np.frombuffer(data, "<u8", -(-n // SAMPLE), at + 8 + size)
        self.end = at + 8 + size + 8 * len(self.samples)

    def select(self, i: int) -> int:
        """The place of the i-th set bit of the upper part."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        if not left:
            return place
        byte = (place + 1) // 8
        bits = int(self.upper[byte]) >> (place + 1) % 8 if (place + 1) % 8 else int(self.upper[byte])
        base = place + 1
        while bits.bit_count() < left:
            left -= bits.bit_count()
            base = (base // 8 + 1) * 8
            bits = int(self.upper[base // 8])
        while True:
            if bits & 1:
                left -= 1
                if not left:
                    return base
            bits >>= 1
            base += 1

    def all(self) -> np.ndarray:
        """All numbers, as uint64: the set bits' places and the low parts at once."""
        upper = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n] - np.arange(self.n)
        out = upper.astype(np.uint64) << np.uint64(self.low)
        lows = self.lows[: self.n * self.low].reshape(self.n, self.low)
        for k in range(self.low):
            out |= lows[:, k].astype(np.uint64) << np.uint64(k)
        return out

    def __getitem__(self, i: int) -> int:
        low = self.lows[i * self.low : (i + 1) * self.low]
        return (self.select(i) - i << self.low) + sum(int(b) << k for k, b in enumerate(low))


class Shard:
    """A token file opened for reading."""

    def __init__(self, data: bytes):
        magic, self.n, self.total, self.first, width, low, low_ids = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.bounds = Sequence(data, struct.calcsize(HEAD), self.n, low)
        self.steps = Sequence(data, self.bounds.end, self.n, low_ids)
        self.ids = np.frombuffer(data, f"<u{width}", self.total, self.steps.end)

    def doc_id(self, i: int) -> int:
        return self.first + self.steps[i]

    def document(self, i: int) -> tuple[int, np.ndarray]:
        """(start, ids) of the i-th document."""
        start = self.bounds[i - 1] if i else 0
        return start, self.ids[start : self.bounds[i]]


#: A file's place: coarse and fine range of ids, then segments between and at the frequent ids of a range, then pieces of such an id.
FILE_KEY = ["part", "bucket", "segment", "piece"]


def _dealt(docs: DataFrame, rows_per_file: int, coarse: int) -> DataFrame:
    """docs with the FILE_KEY columns, which order the files as their rows.

    Ids (NULL as well) of more rows than a file are taken out of the ranges. Their rows are sorted by id and text in
    ranges of both, equal rows dealt at will, and cut to pieces of rows_per_file.
    """
    counts = docs.groupBy("doc_id").count()
    hot = counts.filter(F.col("count") > rows_per_file).orderBy(F.desc("count")).limit(HOT_IDS).collect()
    ids = sorted(r["doc_id"] for r in hot if r["doc_id"] is not None)
    is_hot = F.when(F.col("doc_id").isNull(), F.lit(len(ids) < len(hot))).otherwise(F.col("doc_id").isin(ids) if ids else F.lit(False))
    cold = docs.filter(~is_hot) if hot else docs
    part, bucket = fine_buckets(cold.select("doc_id"), "doc_id", rows_per_file, coarse)
    below = bucket_of(F.col("doc_id"), ids) * 2
    out = cold.withColumns({"part": part, "bucket": bucket, "segment": below, "piece": F.lit(0).cast("long")})
    if not hot:
        return out
    ranges = min(HOT_RANGES, -(-sum(r["count"] for r in hot) // rows_per_file))
    rows = docs.filter(is_hot).withColumn("_any", F.rand(0)).repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "text", "_any")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").drop("_any").withColumn("piece", F.floor(F.monotonically_increasing_id() / rows_per_file))
    return out.unionByName(staged(rows, "frequent-ids").withColumns({"part": part, "bucket": bucket, "segment": below + 1}))


def write_token_files(df: DataFrame, path: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", rows_per_file: int = ROWS_PER_FILE, coarse: int = 10_000) -> DataFrame:
    """Encode df's texts and write token files in ascending doc_id order; returns the table of files.

    One row a file: shard (files in ascending order), n_docs, n_ids, base (ids of all files before it)
    and payload (the file's bytes), kept in the shared folder. NULL text counts as empty and still gets
    its end id. Rows with a NULL doc_id come first, in files of their own, and get the id -2**63; repeated
    doc_ids follow each other, ordered by text, and fill several files where one has more rows than a file.
    An empty table gives no file. Other columns are not read.
    """
    small_batches(df.sparkSession)
    path = path or tokenizer_path()
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = _dealt(docs, rows_per_file, coarse)

    def encode(group: pa.Table) -> pa.Table:
        enc = encoder(path)
        ids, texts = group["doc_id"].fill_null(-(2**63)).to_numpy(), group["text"]
        order = np.argsort(ids, kind="stable")
        if len(ids) > 1 and (np.diff(ids[order]) == 0).any():
            keys = texts.to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], keys[i])))
        end, rows = np.array([end_id], enc.dtype).tobytes(), []
        for _, part in batches_of(texts.take(pa.array(order)).to_pylist()):
            rows += [x + end for x in enc.encode(part)]
        n = sum(map(len, rows)) // enc.dtype.itemsize
        data = write_shard(ids[order], rows, enc.dtype)
        key = {c: group[c][:1] for c in FILE_KEY}
        return pa.table({**key, "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([n], pa.int64()), "payload": pa.array([data], pa.large_binary()).cast(pa.binary())})

    files = staged(dealt.groupBy(*FILE_KEY).applyInArrow(encode, "part int, bucket long, segment int, piece long, n_docs long, n_ids long, payload binary"), "token-files")
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n"), F.count("*").alias("files")).collect()  # at most ``coarse`` and one
    bases, at, number = [], 0, 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        bases.append((r["part"], at, number))
        at, number = at + r["n"], number + r["files"]
    start = F.broadcast(df.sparkSession.createDataFrame(bases, "part int, _base long, _number long"))
    order = Window.partitionBy("part").orderBy(*FILE_KEY[1:])
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    manifest = files.select(*FILE_KEY, "n_ids").join(start, "part").select(
        *FILE_KEY, (F.col("_number") + F.row_number().over(order) - 1).alias("shard"), (F.col("_base") + F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).alias("base")
    )
    manifest = staged(manifest, "token-manifest")
    named = files.join(F.broadcast(manifest) if manifest.count() <= MANIFEST_ROWS else manifest, FILE_KEY)
    return named.select("shard", "n_docs", "n_ids", "payload", "base")


def read_token_files(files: DataFrame) -> DataFrame:
    """One row a document from token files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batches):
        for b in batches:
            for base, data in zip(b["base"].to_pylist(), b["payload"]):
                s = Shard(data.as_py())
                ends = s.bounds.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])[: s.n]
                ids = s.ids.astype("<u4")
                crcs = [zlib.crc32(ids[i:j]) for i, j in zip(starts.tolist(), ends.tolist())]
                doc_ids = (s.steps.all() + np.uint64(s.first % (1 << 64))).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids), "start": pa.array(starts + base), "n_tokens": pa.array(ends - starts), "ids_crc32": pa.array(crcs, pa.int64()),
                })

    return files.select("base", "payload").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), end_id=0))
