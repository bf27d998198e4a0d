"""Filter interaction audit: what each order of a chain of filters keeps, and what each filter does in it.

Rows are folded to cells at once: part, mask (one bit a filter that the row fails) and label classes, with a count. What
follows works on at most 2^k cells a part and never on rows. For each part all 2^k sets of active filters are walked in
the order of a Gray code, so that each step turns one filter on or off. Every cell keeps the number of active filters
that it fails: a step changes the counters of the cells that fail the turned filter, and the survivors change by the
cells whose counter comes to or leaves zero. The 2^k stored states answer all orders: a step of an order is the
difference of two states, and a filter's Shapley sum weighs its differences by the orders that share them.

Edge cases: NULL text is an empty text, a NULL part the empty string; labels that are NULL, missing or 0 count as not
set, of several labels of one id the larger counts; repeated rows count each; a NULL id is no smaller id than any, and
any id is smaller than NULL; equal texts of one smallest id all pass the copy filter; texts of any length are
judged whole. Other columns are not read and may have any name. An empty table has no part and gives no row.
"""

from __future__ import annotations

import itertools
from functools import reduce
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import table

#: Filters whose orders are all listed: 8! = 40,320 orders a part.
MOST = 8
WEIGHTS = ("good", "toxic")
STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
STATES = "part string, active string, survivors long, good long, toxic long"


def gray_states(masks: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The survivors of each set of active filters (row: the set as a number), in columns as in ``counts`` (one row a cell)."""
    states = np.zeros((1 << k, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)  # active filters that a cell fails
    alive = counts.sum(axis=0)
    states[0] = alive
    active = 0
    for i in range(1, 1 << k):
        turned = (i & -i).bit_length() - 1  # the bit in which the Gray codes of i - 1 and i differ
        hit = np.flatnonzero(masks >> turned & 1)
        active ^= 1 << turned
        if active >> turned & 1:
            alive = alive - counts[hit[failing[hit] == 0]].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            alive = alive + counts[hit[failing[hit] == 0]].sum(axis=0)
        states[active] = alive
    return states


def shapley_sums(states: np.ndarray, k: int) -> list[int]:
    """What each filter removes (column 0), summed over all k! orders."""
    out = []
    for f in range(k):
        rest = [s for s in range(1 << k) if not s >> f & 1]
        out.append(sum(factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) * int(states[s, 0] - states[s | 1 << f, 0]) for s in rest))
    return out


def order_rows(masks: np.ndarray, counts: np.ndarray, names: str) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders of the filters."""
    k = len(names)
    states, fails = gray_states(masks, counts, k), [int(counts[masks >> f & 1 == 1, 0].sum()) for f in range(k)]
    only, worth, out = [int(counts[masks == 1 << f, 0].sum()) for f in range(k)], shapley_sums(states, k), []
    for order in itertools.permutations(range(k)):
        active, text = 0, "".join(names[f] for f in order)
        for step, f in enumerate(order, 1):
            gone = states[active] - states[active | 1 << f]
            active |= 1 << f
            removed = int(gone[0])
            out.append((text, step, int(states[active, 0]), removed, fails[f] - removed, only[f], int(gone[1]), int(gone[2]), worth[f]))
    return out


def cells(rows: DataFrame, names: str) -> DataFrame:
    """(part, mask, n, good, toxic): rows (part, fail_<name> boolean, good, toxic boolean, n long) folded by mask."""
    mask = reduce(lambda a, b: a + b, [F.when(F.col(f"fail_{f}"), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(names)])
    sums = [F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0))).alias(c) for c in WEIGHTS]
    return rows.groupBy(F.coalesce("part", F.lit("")).alias("part"), mask.alias("mask")).agg(F.sum("n").alias("n"), *sums)


def _folded(cells: DataFrame, make, schema: str) -> DataFrame:
    def work(cell: pa.Table) -> pa.Table:
        counts = np.stack([cell[c].to_numpy().astype(np.int64) for c in ("n", *WEIGHTS)], axis=1)
        rows = make(cell["mask"].to_numpy().astype(np.int64), counts)
        columns = [pa.array(c) for c in zip(*rows)]
        names = [f.split()[0] for f in schema.split(", ")]
        types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
        columns = [c.cast(types[f.split()[1]]) for c, f in zip([pa.array([cell["part"][0].as_py()] * len(rows)), *columns], schema.split(", "))]
        return pa.Table.from_arrays(columns, names)

    return cells.groupBy("part").applyInArrow(work, schema)


def audit(rows: DataFrame, names: str) -> DataFrame:
    """One row for each part, order of the filters ``names`` (one letter each) and step; see ``cells`` for rows."""
    if not 1 <= len(set(names)) == len(names) <= MOST:
        raise ValueError(f"1 to {MOST} filters of different letters can be audited")
    return _folded(cells(rows, names), lambda m, c: order_rows(m, c, names), STEPS)


def states(rows: DataFrame, names: str) -> DataFrame:
    """The stored states: what each set of active filters (their letters, in order) leaves of each part."""
    k = len(names)

    def make(masks, counts):
        return [("".join(f for i, f in enumerate(names) if s >> i & 1), *map(int, x)) for s, x in enumerate(gray_states(masks, counts, k))]

    return _folded(cells(rows, names), make, STATES)


def text_failures(text: Column) -> dict[str, Column]:
    """The four filters that look at one text: few words, repeated words, capitals, marks."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, capitals = F.size(words), F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": n < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * n, "C": 100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"), "D": F.coalesce(text.rlike("[#$%&*|]"), F.lit(False))}


def document_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Rows for ``audit`` of the filters ABCDE. Equal rows are folded before anything is shuffled.

    A copy is told by the sha256 of its text. A text's smallest id is found by partial sums; a document fails E unless
    it has that id, so documents meet the smallest ids by text and id together, and no group of copies becomes one key.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    facts = text_failures(F.col(f"`{text_col}`"))
    flat = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"), *[c.alias(f"fail_{f}") for f, c in facts.items()])
    fails = [f"fail_{f}" for f in facts]
    rows = flat.groupBy("id", "part", "sha", *fails).agg(F.count("*").alias("n"))
    # NULL ids come last: a text that has any id at all makes its rows without one copies
    first = flat.groupBy("sha").agg(F.min("id").alias("least")).withColumnRenamed("sha", "_sha")
    told = F.when(F.col("id").isNull(), F.lit("")).otherwise(F.col("id").cast("string"))
    first = first.select("_sha", F.coalesce(F.col("least").cast("string"), F.lit("")).alias("_told"), F.lit(True).alias("_first"))
    rows = rows.withColumn("_told", told).join(first.withColumnRenamed("_told", "_least"), (F.col("sha") == F.col("_sha")) & (F.col("_told") == F.col("_least")), "left")
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col("quality").cast("int").alias("_q"), F.col("toxic").cast("int").alias("_t")).filter("_id IS NOT NULL").groupBy("_id").agg(F.max("_q").alias("_q"), F.max("_t").alias("_t"))
    rows = rows.withColumn("fail_E", F.col("_first").isNull()).join(known, F.col("id") == F.col("_id"), "left")
    return rows.select("part", *fails, "fail_E", F.coalesce(F.col("_q") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("_t") == 1, F.lit(False)).alias("toxic"), "n")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(document_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "ABCDE")


OP13_SQL = """
WITH first AS (SELECT coalesce(text, '') AS t, min(doc_id) AS least FROM documents GROUP BY 1),
words AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
known AS (SELECT doc_id, max(quality) AS q, max(toxic) AS x FROM labels GROUP BY doc_id),
masks AS (SELECT part, (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(words.t, '[^A-Z]+', '', 'g')) > 3 * length(words.t) THEN 4 ELSE 0 END) + (CASE WHEN regexp_matches(words.t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN least < words.doc_id OR (words.doc_id IS NULL AND least IS NOT NULL) THEN 16 ELSE 0 END) AS mask, coalesce(q, 0) = 1 AS good, coalesce(x, 0) = 1 AS toxic
  FROM words JOIN first ON words.t = first.t LEFT JOIN known ON words.doc_id = known.doc_id),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM masks GROUP BY 1, 2),
sets AS (SELECT CAST(s AS INTEGER) AS s FROM range(32) r(s)),
states AS (SELECT part, s, coalesce(sum(n) FILTER (WHERE mask & s = 0), 0) AS n, coalesce(sum(good) FILTER (WHERE mask & s = 0), 0) AS good, coalesce(sum(toxic) FILTER (WHERE mask & s = 0), 0) AS toxic
  FROM cells CROSS JOIN sets GROUP BY 1, 2),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)),
orders AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit, CAST(coalesce(list_sum(bits[1:k-1]), 0) AS INTEGER) AS before, CAST(list_sum(bits[1:k]) AS INTEGER) AS after FROM orders, range(1, 6) r(k)),
fails AS (SELECT part, bit, coalesce(sum(n) FILTER (WHERE mask & bit > 0), 0) AS n, coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS only FROM cells CROSS JOIN f GROUP BY 1, 2),
gone AS (SELECT a.part, filter_order, step, steps.bit, b.n AS kept, a.n - b.n AS removed, a.good - b.good AS good_lost, a.toxic - b.toxic AS toxic_lost
  FROM steps JOIN states a ON a.s = steps.before JOIN states b ON b.part = a.part AND b.s = steps.after),
worth AS (SELECT part, bit, sum(removed) AS shapley FROM gone GROUP BY 1, 2)
SELECT gone.part AS part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(fails.n - removed AS BIGINT) AS redundant, CAST(fails.only AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM gone JOIN fails ON fails.part = gone.part AND fails.bit = gone.bit JOIN worth ON worth.part = gone.part AND worth.bit = gone.bit
"""
