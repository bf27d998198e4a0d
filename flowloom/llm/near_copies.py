"""Near copies by exact five-word Jaccard similarity: SimHash links and minhash bands propose pairs, shingle sets decide.

Documents with the same set of shingles are one node, and each node has a SimHash of that set.

1. SimHash: fingerprints within ``RADIUS`` bits are linked as in op1 (``simhash.link_shards``: shards of agreeing bits, a
   BK-tree in each); nodes of one fingerprint link to its first. Fingerprints that near finds the closest copies, those
   of a few words' difference, but a pair at similarity 0.8 differs in about ten bits, so a second way finds the rest:
2. A node's minhash values are cut to ``BANDS`` bands of ``ROWS``; nodes that agree on a band share a bucket. Two nodes at
   similarity 0.8 share none with a chance of (1 - 0.8**5)**24 = 0.00007, and with less the more alike they are. A node and
   the first node of ``STAR_BANDS`` of its buckets are compared. What is alike, by either way, becomes one component.
3. Of the nodes of buckets that still hold several components, shingles are counted once: those that no other such node
   has are its own. A node with ``own`` of its ``size`` shingles can share at most the rest, which bounds its similarity to
   any other; nodes whose bound is below the least similarity go. Nodes that are joined by the buckets left are one family. A
   family is compared in tiles: each tile holds two of its blocks (or the one), so memory is bounded, and a node with its
   set goes to as many tiles as its family has blocks, one mostly. All pairs of different components in a tile are looked
   at by the bound, then by their ``ROWS * BANDS`` minhash values (two bits of each: a pair at 0.8 agrees on fewer than
   ``LIKELY`` with a chance of under 0.000001), then by their sets. A tile gives a forest of the links that it confirms: at
   most a row for each of its nodes, however many pairs are alike. No pair of different texts leaves a tile.

A pair links when the exact Jaccard similarity of its shingle sets is ``LEAST`` or more. Groups are the
connected components; of each, one row stays: that of the smallest id (NULL last), of equal ids one.

Edge cases: NULL or empty texts have no shingles and are copies of each other; under five words, all words are
the one shingle; texts of any length are read whole; letter case (A-Z) and the kind of white space do not count;
rows with NULL or repeated ids are rows like others; an empty table stays empty. Other columns stay as they are,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import discard, free_name, release, scratch, small_batches, staged
from flowloom.llm.simhash import _WORD, RADIUS, components, link_shards, majority

SIZE, LEAST = 5, 0.8
ROWS, BANDS = 5, 24
#: Nodes and shingles of a block, two of which a task compares at once.
BLOCK, BLOCK_SHINGLES = 4096, 1_000_000
#: Buckets whose first node a node is compared with first; minhash values whose two bits a pair must agree on before
#: its sets are compared.
STAR_BANDS, LIKELY = 3, 82
#: Differing minhash values in a byte of four of them.
_DIFFER = np.array([sum((x >> k & 3) > 0 for k in (0, 2, 4, 6)) for x in range(256)], np.uint8)
#: Numbers of rows to drop, and hashes of texts to read again, up to which they are broadcast.
GONE_ROWS = WANTED_ROWS = 2_000_000
_RNG = np.random.default_rng(80)
_ADD = _RNG.integers(0, 2**64, ROWS * BANDS, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**64, ROWS * BANDS, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, size: int = SIZE) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    w = _WORD.findall((text or "").encode().lower())
    if not w:
        return np.empty(0, np.uint64)
    grams = map(b" ".join, zip(*[w[i:] for i in range(size)])) if len(w) >= size else [b" ".join(w)]
    h = xxhash.xxh64_intdigest
    return np.unique(np.array([h(g) for g in grams], np.uint64))


def _node(hashes: np.ndarray) -> int:
    """A document's node: a hash of its shingle set."""
    return xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes())


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """The ROWS * BANDS minhash values of a shingle set."""
    least = np.full(ROWS * BANDS, 2**64 - 1, np.uint64)
    for i in range(0, len(hashes), 1024):
        part = (hashes[i : i + 1024] ^ _ADD[:, None]) * _TIMES[:, None]
        least = np.minimum(least, (part ^ part >> np.uint64(32)).min(axis=1))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One value for each band of minhash values."""
    raw = least.astype("<u8").tobytes()
    return np.array([xxhash.xxh64_intdigest(raw[i * 8 * ROWS : (i + 1) * 8 * ROWS], i) for i in range(BANDS)], np.uint64)


def _signatures(batches):
    release()
    for b in batches:
        nodes, sizes, fps, values, marks = np.empty(len(b), np.uint64), np.empty(len(b), np.int64), np.empty(len(b), np.uint64), np.empty((len(b), BANDS), np.uint64), np.empty((len(b), ROWS * BANDS // 4), np.uint8)
        for i, t in enumerate(b["text"]):
            s = shingles(t.as_py())
            least = minhashes(s)
            two = (least & np.uint64(3)).astype(np.uint8).reshape(-1, 4)
            nodes[i], sizes[i], fps[i], values[i], marks[i] = _node(s), len(s), majority(s), bands(least), two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * BANDS), pa.array(values.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([b["row"], b["doc_id"], b["seen"], pa.array(nodes.view(np.int64)), pa.array(sizes), pa.array(fps.view(np.int64)), lists, pa.array([m.tobytes() for m in marks], pa.binary())], ["row", "doc_id", "seen", "node", "size", "fp", "bands", "marks"])


def _matrix(marks: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in marks), np.uint8).reshape(-1, ROWS * BANDS // 4)


def _confirmed(least: float):
    """Arrow groups: rows (i, node, root, shared, marks, set) of one tile to (a, b), a forest of the links between different
    roots; of a tile of two blocks, between these."""

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        block, node, root, shared = (rows[c].to_numpy() for c in ("i", "node", "root", "shared"))
        marks, sets = _matrix(rows["marks"].combine_chunks()), rows["set"].combine_chunks()
        size, flat = np.diff(sets.offsets.to_numpy()).astype(np.int64), sets.flatten().to_numpy()
        start = np.cumsum(size) - size
        _, flat = np.unique(flat, return_inverse=True)
        mine = np.zeros(flat.max() + 1 if len(flat) else 0, bool)
        _, group = np.unique(root, return_inverse=True)
        one = len(block) == 0 or block.min() == block.max()
        a, b = [], []
        for i in range(len(node) - 1):
            common = np.minimum(shared[i + 1 :], shared[i])  # at most
            other = np.flatnonzero((group[i + 1 :] != group[i]) & (one | (block[i + 1 :] != block[i])) & (common >= (least - 1e-9) * (size[i + 1 :] + size[i] - common))) + i + 1
            other = other[_DIFFER[marks[other] ^ marks[i]].sum(axis=1) <= ROWS * BANDS - LIKELY]
            if not len(other):
                continue
            n = size[other]
            ends = np.cumsum(n)
            own = flat[start[i] : start[i] + size[i]]
            mine[own] = True
            hits = mine[flat[np.arange(ends[-1]) + np.repeat(start[other] - ends + n, n)]]
            mine[own] = False
            met = np.diff(np.concatenate([[0], np.cumsum(hits)])[np.concatenate([[0], ends])])
            for j in other[met / (n + size[i] - met) >= least]:
                if group[j] != group[i]:
                    group[group == group[j]] = group[i]
                    a.append(min(node[i], node[j]))
                    b.append(max(node[i], node[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work


def _families(members: DataFrame) -> DataFrame:
    """(node, family): nodes of (value, node) that are joined by common values."""
    first = members.groupBy("value").agg(F.min("node").alias("a"))
    found = components(members.join(first, "value").select("a", F.col("node").alias("b"))).withColumnRenamed("root", "family")
    return members.select("node").distinct().join(found, "node", "left").select("node", F.coalesce("family", "node").alias("family"))


def _family_links(rest: DataFrame, sets: DataFrame, least: float, block: int) -> DataFrame:
    """(a, b): a forest of the confirmed links within each family of rest (node, root, size, shared, marks, family)."""
    full = rest.groupBy("family").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"), F.min("root").alias("_low"), F.max("root").alias("_high")).filter("_low < _high")
    k = F.ceil(F.greatest(F.col("n") / block, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    rows = rest.join(full.select("family", F.greatest(k, F.lit(1)).alias("k")), "family").withColumn("i", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    rows = rows.join(sets, "node").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("family", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"), "i", "node", "root", "shared", "marks", "set")
    return staged(rows.groupBy("family", "low", "high").applyInArrow(_confirmed(least), "a long, b long"), "confirmed")


def _sets(batches):
    release()
    for b in batches:
        sets = [shingles(t.as_py()) for t in b["text"]]
        yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(map(_node, sets), np.uint64, len(sets)).view(np.int64)), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "set"])


def _texts_of(wanted: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(text): one text of each wanted node, read again. The hashes are broadcast where they are not too many, for a join
    by shuffle moves every text of the table to find these few."""
    seen = staged(nodes.join(wanted, "node", "left_semi").select("seen"), "wanted")
    return texts.join(F.broadcast(seen) if seen.count() <= WANTED_ROWS else seen, "seen", "left_semi").groupBy("seen", "text").agg(F.lit(1)).select("text")


def _shingle_rows(batches):
    release()
    for b in batches:
        sets = [shingles(t.as_py()) for t in b["text"]]
        nodes = np.repeat(np.array([_node(s) for s in sets], np.uint64), [len(s) for s in sets])
        flat = np.concatenate([np.empty(0, np.uint64), *sets])
        yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(nodes.view(np.int64))], ["shingle", "node"])


def _bounded(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(node, size, shared): wanted nodes that may be alike another one; shared counts the shingles that others have too."""
    rows = _texts_of(wanted, nodes, texts).mapInArrow(_shingle_rows, "shingle long, node long")
    own = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("_other")).filter("node = _other").groupBy("node").agg(F.count("*").alias("_own"))
    found = nodes.join(wanted, "node", "left_semi").select("node", "size").join(own, "node", "left")
    found = found.select("node", "size", (F.col("size") - F.coalesce("_own", F.lit(0))).alias("shared"))
    return staged(found.filter(F.col("shared") >= (least - 1e-9) * F.col("size")), "bounded")


def _node_sets(wanted: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, set) of the wanted nodes; their texts alone are read again."""
    return staged(_texts_of(wanted, nodes, texts).mapInArrow(_sets, "node long, set array<long>").groupBy("node").agg(F.first("set").alias("set")), "sets")


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are alike."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("_b")), "b")
    common = F.size(F.array_intersect("_a", "_b"))
    return staged(both.filter(common / (F.size("_a") + F.size("_b") - common) >= least).select("a", "b"), "alike")


def _mixed(members: DataFrame) -> DataFrame:
    """(value, n): the buckets that hold nodes of several components, and how many nodes."""
    return members.groupBy("value").agg(F.count("*").alias("n"), F.min("root").alias("_low"), F.max("root").alias("_high")).filter("_low < _high").select("value", "n")


def _simhash_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): nodes that SimHash links: each fingerprint's nodes with its first, and first nodes of fingerprints within the radius."""
    first = staged(nodes.groupBy("fp").agg(F.min("node").alias("node")), "fingerprints")
    same = nodes.join(first.withColumnRenamed("node", "a"), "fp").filter("node <> a").select("a", F.col("node").alias("b"))
    near = staged(link_shards(first.select("fp")).distinct(), "simhash-links")
    named = lambda c: first.select(F.col("fp").alias(f"_{c}"), F.col("node").alias(c))
    near = near.toDF("_a", "_b").join(named("a"), "_a").join(named("b"), "_b")
    return same.unionByName(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def near_copies(df: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text", row_col: str = "_row", bucket: int = BLOCK) -> DataFrame:
    """(row, doc_id, root): one row for each row of df; rows of one group have one root. ``bucket``: nodes of a block."""
    small_batches(df.sparkSession)
    texts = df.select(F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("seen"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = df.select(F.col(row_col).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("seen"), F.col(text_col).alias("text"))
    signed = staged(rows.mapInArrow(_signatures, "row long, doc_id long, seen long, node long, size long, fp long, bands array<long>, marks binary"), "signatures")
    nodes = staged(signed.groupBy("node").agg(F.min(F.struct("seen", "size", "fp", "bands", "marks")).alias("s")).select("node", "s.seen", "s.size", "s.fp", "s.bands", "s.marks"), "nodes")
    members = nodes.select("node", F.explode("bands").alias("value"))
    first = members.groupBy("value").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1").select("value", "a")
    stars = members.join(first, "value").filter("node <> a").groupBy("a", F.col("node").alias("b")).count().filter(F.col("count") >= STAR_BANDS)
    first_pairs = staged(stars.select("a", "b").unionByName(_simhash_pairs(nodes)).distinct(), "first-pairs")
    both = first_pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = _alike(first_pairs, _node_sets(both, nodes, texts), least)
    roots = lambda links: nodes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    label = staged(roots(links).select("node", "root"), "labels")

    held = label.join(nodes.select("node", "bands"), "node").select("node", "root", F.explode("bands").alias("value"))
    rest = staged(held.join(_mixed(held).select("value"), "value"), "mixed-members")
    bounded = _bounded(rest.select("node").distinct(), nodes, texts, least)
    rest = staged(rest.join(bounded.select("node"), "node"), "bounded-members")
    rest = staged(rest.join(_mixed(rest).select("value"), "value").select("value", "node", "root"), "bounded-mixed")
    if not rest.isEmpty():
        family = staged(_families(rest.select("value", "node")), "families")
        some = rest.select("node", "root").distinct().join(bounded, "node").join(nodes.select("node", "marks"), "node").join(family, "node")
        some = staged(some, "family-members")
        links = links.unionByName(_family_links(some, _node_sets(some.select("node"), nodes, texts), least, bucket))
        label = staged(roots(links).select("node", "root"), "labels")
    return signed.select("row", "doc_id", "node").join(label.select("node", "root"), "node").select("row", "doc_id", "root")


def keep_one(df: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row of each group of near copies: the smallest id's (NULL ids last)."""
    row = free_name(df, "_row")
    numbered = staged(df.withColumn(row, F.monotonically_increasing_id()), "numbered", compression="zstd")  # all of df, which stays until the result is read
    with scratch():
        near = staged(near_copies(numbered, least, id_col, text_col, row), "near", keep=True)
    kept = near.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"].alias("row"))
    gone = staged(near.join(kept, "row", "left_anti").select(F.col("row").alias(row)), "gone")
    discard(near)
    return numbered.join(F.broadcast(gone) if gone.count() <= GONE_ROWS else gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
