"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through BK-trees.

A fingerprint bit is set where over half of the shingles' XXH64 values (seed 42) have it set. Two
fingerprints link at ``radius`` or fewer differing bits, and groups are the connected components.

Distinct fingerprints alone are compared. Two of them within the radius agree on one of radius+1 blocks
of bits, so each goes to a shard for each block's value; a shard that holds too many is split again the
same way over its remaining bits, which keeps every pair and bounds every shard. Each shard gets a
BK-tree (children keyed by their integer Hamming distance to the parent); its members follow only the
edges within the radius. A tree of all fingerprints grows with the corpus, so trees travel with their
shards instead of being broadcast. A shard emits a spanning forest of its links, never all pairs, and
the forests' union is resolved by alternating star contraction.

Edge cases: NULL or empty text (no words) has fingerprint zero and links like any other; texts of any length are
read whole; a bit that exactly half of the shingles set is 0; exact copies share a fingerprint; NULL doc_ids get a
component like other rows but never name one unless alone; repeated rows each get their row; an empty table gives
an empty result. Other columns are not read and may have any name; ``keep_first`` keeps them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import free_name, release, scratch, small_batches, staged, table

RADIUS, SHINGLE, BITS, SEED = 2, 3, 64, 42
#: Fingerprints in a shard beyond which it is split again.
SHARD = 512
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text."""
    w = _WORD.findall((text or "").encode().lower())
    if not w:
        return 0
    grams = map(b" ".join, zip(*[w[i:] for i in range(size)])) if len(w) >= size else [b" ".join(w)]
    h = xxhash.xxh64_intdigest
    return majority(np.array([h(g, SEED) for g in grams], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are those that over half of the hashes have; 0 without hashes."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, row_col: str | None = None) -> DataFrame:
    """(doc_id, fp): the fingerprint as signed long, one row for each row of df; with row_col also row."""

    def work(batches):
        release()
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), size) for t in b["text"]), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays([b["row"], b["doc_id"], pa.array(fps.view(np.int64))], ["row", "doc_id", "fp"])

    small_batches(df.sparkSession)
    row = F.lit(None) if row_col is None else F.col(row_col)
    found = df.select(row.cast("long").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, "row long, doc_id long, fp long")
    return found.drop("row") if row_col is None else found


class BKTree:
    """Integers under Hamming distance."""

    def __init__(self):
        self.root: list | None = None  # [value, position, {distance: node}]

    def add(self, value: int, position: int) -> None:
        if self.root is None:
            self.root = [value, position, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            child = node[2].get(d)
            if child is None:
                node[2][d] = [value, position, {}]
                return
            node = child

    def within(self, value: int, radius: int):
        """Positions of the values at radius or less."""
        todo = [self.root] if self.root else []
        while todo:
            v, p, children = todo.pop()
            d = (v ^ value).bit_count()
            if d <= radius:
                yield p
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)


def shard_forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, root) links that connect what the shard's links connect."""
    parent = list(range(len(values)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree = BKTree()
    for i, v in enumerate(values):
        for j in tree.within(v, radius):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
        tree.add(v, i)
    return [(values[i], values[find(i)]) for i in range(len(values)) if find(i) != i]


def _cuts(bits: int, parts: int) -> list[int]:
    return [bits * i // parts for i in range(parts + 1)]


def blocks(bits: list[int], radius: int) -> list[tuple[list[int], list[int]]]:
    """(bits that must agree, bits that remain) for each of radius+1 blocks of the given bits."""
    c = _cuts(len(bits), radius + 1)
    return [(bits[a:b], bits[:a] + bits[b:]) for a, b in zip(c, c[1:])]


def link_shards(nodes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b): a forest over the distinct fingerprints in nodes.fp that joins all within the radius."""
    found = None
    # a level's shards: the remaining bits by the path of blocks that led there
    level = {"": list(range(BITS))}
    frontier = nodes.select("fp", F.lit("").alias("path"), F.lit(0).cast("long").alias("value"))
    while True:
        following, keys = {}, []
        for path, bits in level.items():
            for i, (same, rest) in enumerate(blocks(bits, radius)):
                mask = sum(1 << b for b in same)
                mask = mask - (1 << 64) if mask >= 1 << 63 else mask
                following[f"{path}{i}"] = rest
                keys.append(F.when(F.col("path") == path, F.struct(F.lit(f"{path}{i}").alias("path"), F.col("value").bitwiseOR(F.col("fp").bitwiseAND(F.lit(mask))).alias("value"))))
        # the path and the value of all bits that agree so far name the shard
        members = frontier.select("fp", F.explode(F.filter(F.array(*keys), lambda x: x.isNotNull())).alias("k")).select("fp", "k.path", "k.value")
        last = len(next(iter(following.values()))) <= max(radius + 1, 9)  # so few bits that a shard is small anyway
        large = None if last else staged(members.groupBy("path", "value").count().filter(F.col("count") > shard).select("path", "value"), "large-shards")
        split = large is not None and not large.isEmpty()
        whole = members.join(large, ["path", "value"], "left_anti") if split else members
        groups = whole.groupBy("path", "value").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps")
        links = groups.mapInArrow(_forests(radius), "a long, b long")
        found = links if found is None else found.unionByName(links)
        if not split:
            return found
        frontier, level = staged(members.join(large, ["path", "value"], "left_semi").select("fp", "path", "value"), "large-members"), following


def _forests(radius: int):
    def work(batches):
        for b in batches:
            out = [x for fps in b["fps"].to_pylist() for x in shard_forest([f & (1 << 64) - 1 for f in sorted(fps)], radius)]
            a = np.array([x for x, _ in out], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.array([x for _, x in out], np.uint64).view(np.int64))], ["a", "b"])

    return work


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every linked node: the smallest node reachable from it.

    Alternates large-star (greater neighbours move to the smallest neighbour) and small-star (a node's
    smaller neighbours move to the smallest) until the edges no longer change.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    state = None
    for _ in range(most):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        near = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(near, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        edges = staged(small.filter("a <> b").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(now)
    raise RuntimeError("the links did not settle")


def near_duplicates(df: DataFrame, radius: int = RADIUS, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """(doc_id, fp, component_id): one row for each row of df; component_id is the group's smallest doc_id."""
    prints = staged(fingerprints(df, id_col, text_col, size), "fingerprints")
    label = _labels(prints, radius, shard).select("fp", "component_id")
    return prints.join(label, "fp")


def _labels(prints: DataFrame, radius: int, shard: int) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints in (doc_id, fp): the group's own fingerprint and its smallest doc_id."""
    # written, so that both sides of a join with it come from an exchange and a fingerprint of very many copies can be split
    with scratch():
        return staged(_named(prints, radius, shard), "labels", keep=True)


def _named(prints: DataFrame, radius: int, shard: int) -> DataFrame:
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(link_shards(nodes, radius, shard))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    moved = staged(named.join(smallest, "root").filter(~F.col("first").eqNullSafe(F.col("component_id")) | (F.col("root") != F.col("fp"))).select("fp", "root", "component_id"), "moved")
    return nodes.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id"))


def keep_first(df: DataFrame, radius: int = RADIUS, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of df: that of the smallest id (NULL ids last), of equal ids one."""
    row = free_name(df, "_row")
    numbered = staged(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    prints = staged(fingerprints(numbered, id_col, text_col, size, row), "fingerprints")
    near = prints.join(_labels(prints, radius, SHARD).select("fp", "root"), "fp")
    kept = near.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"].alias(row))
    return numbered.join(kept.select(row), row, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
