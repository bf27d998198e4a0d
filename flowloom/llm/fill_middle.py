"""Fill-in-middle transformation: a text is cut at two random units, and its middle moves to the end.

The units of a text (code points, or what a pattern matches from left to right) hang in an indexable skip list. Its
lowest lane has a node for each unit; each lane above has about one in ``LINK`` of the nodes of the lane below. A node
carries how many units and how many code points lie between it and the next node of its lane, so a search that walks
right while the units fit, then goes down, reaches the unit of a given rank and knows the code points before it.

The two ranks, and whether and how a text is rearranged, come from the sha256 of seed and id, so they are the same in
each run and on each machine:

- ``plain``: the text as it is, if it is empty, holds one of the marks, or by lot (``rate`` of 100 texts are rearranged);
- ``psm``: prefix mark, prefix, suffix mark, suffix, middle mark, middle;
- ``spm``: suffix mark, suffix, prefix mark, prefix, middle mark, middle (``spm`` of 100 rearranged texts).

Edge cases: NULL text counts as empty; a NULL id draws as an empty id; equal rows, and rows of one id and length, are
cut alike; either cut may lie at either end, so parts may be empty; texts of any length are cut whole (two numbers a unit
and lane are held, for one text at a time); what lies between two matches of a pattern is a unit of its own. Other
columns may have any name; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import release, small_batches, table

MARKS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 1, 90, 20
#: Nodes of a lane for each node of the next.
LINK = 16


class SkipList:
    """An indexable skip list over units; ``points`` has the code points of each."""

    def __init__(self, points: np.ndarray, rng: np.random.Generator, link: int = LINK):
        self.n = len(points)
        self.total = int(points.sum())
        #: From the lowest lane up: (units to the next node, code points to the next node, this node's place on the lane below).
        self.lanes = [(np.ones(self.n, np.uint8), points, np.arange(0))]
        while len(self.lanes[-1][0]) > link:
            units, points, _ = self.lanes[-1]
            n = len(units)
            gaps = rng.geometric(1 / link, 2 * n // link + 16)  # a node rises with a chance of one in link, the first always
            while gaps.sum() < n:
                gaps = np.concatenate([gaps, rng.geometric(1 / link, n // link + 16)])
            below = np.concatenate([[0], np.cumsum(gaps)])
            below = below[below < n]
            self.lanes.append((np.add.reduceat(units, below, dtype=np.int64), np.add.reduceat(points, below, dtype=np.int64), below))

    def reach(self, rank: int) -> int:
        """The code points before the unit of this rank (0 to n)."""
        node, units, points = 0, 0, 0
        for to_units, to_points, below in reversed(self.lanes):
            while node < len(to_units) and units + (step := int(to_units[node])) <= rank:
                units += step
                points += int(to_points[node])
                node += 1
            if node == len(to_units):  # all units lie before
                return self.total
            if len(below):
                node = int(below[node])
        return points


def unit_points(text: str, pattern: regex.Pattern | None) -> np.ndarray:
    """The code points of each unit of text; without a pattern each code point is one."""
    if pattern is None:
        return np.ones(len(text), np.uint8)
    ends, at = [], 0
    for m in pattern.finditer(text):
        if m.start() > at:
            ends.append(m.start())
        if m.end() > m.start():
            ends.append(at := m.end())
    if at < len(text):
        ends.append(len(text))
    return np.diff(np.array(sorted({0, *ends})))


def arrange(text: str, draws: tuple[int, int, int, int], rng: np.random.Generator, pattern=None, marks=MARKS, rate=RATE, spm=SPM) -> tuple:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    points = unit_points(text, pattern)
    n = len(points)
    a, b, by_lot, order = draws
    if not text or by_lot % 100 >= rate or any(m in text for m in marks):
        return n, "plain", None, None, text
    units = SkipList(points, rng)
    first, second = sorted((a % (n + 1), b % (n + 1)))
    i, j = units.reach(first), units.reach(second)
    p, s, m = marks
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if order % 100 < spm:
        return n, "spm", i, j - i, "".join((s, suffix, p, prefix, m, middle))
    return n, "psm", i, j - i, "".join((p, prefix, s, suffix, m, middle))


def _draws(id_col: str, seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


ARRANGED = T.StructType().add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")


def fill_in_middle(df: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, pattern: str | None = None, marks: tuple[str, str, str] = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output) for each row of df: ``row`` holds its columns, n its units.

    ``pattern`` says what a unit is (such as ``\\X`` for what a reader takes for one character, or ``\\S+\\s*`` for
    words); the marks must differ, and none may hold or overlap another.
    """
    if len(set(marks)) < 3 or any(not m for m in marks) or any(_overlap(x, y) for x in marks for y in marks):
        raise ValueError("marks must be three different texts that do not overlap")
    small_batches(df.sparkSession)
    place = df.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        rng, unit = np.random.default_rng(seed), regex.compile(pattern, regex.DOTALL) if pattern else None
        for b in batches:
            draws = b["draws"].flatten().to_numpy().reshape(-1, 4).tolist()
            got = [arrange(t.as_py() or "", d, rng, unit, marks, rate, spm) for t, d in zip(b["row"].field(place), draws)]
            columns = list(zip(*got)) or [()] * len(ARRANGED)
            yield pa.RecordBatch.from_arrays([b["row"], *[pa.array(c, pa.string() if f.dataType == T.StringType() else pa.int64()) for c, f in zip(columns, ARRANGED)]], ["row", *ARRANGED.names])

    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), _draws(id_col, seed).alias("draws"))
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])  # what comes from Python may be null for all that Spark knows
    schema = T.StructType([T.StructField("row", nullable, True), *ARRANGED])
    return whole.withColumn("row", F.col("row").cast(nullable)).mapInArrow(work, schema)


def _overlap(x: str, y: str) -> bool:
    """Whether y begins within x and ends in or beyond it, other than as x itself."""
    return (x != y and y in x) or any(y.startswith(x[k:]) for k in range(1, len(x)))


def rearranged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """df with each text as the transformation leaves it; all other columns stay."""
    made = fill_in_middle(df, id_col=id_col, text_col=text_col, **options)
    return made.select(*[F.col("output").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in df.columns])


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text again, from an output and its form alone. No part holds a mark, so the first one found ends a part."""

    def parts(first: str, second: str, third: str) -> list[Column]:
        after = lambda c, n: F.substring(c, n + F.lit(1), F.char_length(c))
        rest = after(output, F.lit(len(first)))
        one = F.substring_index(rest, second, 1)
        rest = after(rest, F.char_length(one) + F.lit(len(second)))
        two = F.substring_index(rest, third, 1)
        return [one, two, after(rest, F.char_length(two) + F.lit(len(third)))]

    p, s, m = marks
    prefix, suffix, middle = parts(p, s, m)
    from_psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p, m)
    return F.when(form == "psm", from_psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
h AS (SELECT *, ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2, ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4 FROM d),
f AS (SELECT *, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS i, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS j,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, i) AS pre, substring(t, i + 1, j - i) AS mid, substring(t, j + 1, n - j) AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
