"""Fill-in-middle: skip lists against plain sums, outputs against the contract, exact round trips."""

import hashlib

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.llm import fill_middle as fim


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=400), st.integers(2, 20), st.integers(0, 99))
def test_each_rank_is_reached(points, link, seed):
    units = fim.SkipList(np.array(points, np.int64), np.random.default_rng(seed), link)
    assert [units.reach(r) for r in range(len(points) + 1)] == [0, *np.cumsum(points).tolist()]


def test_lanes_carry_both_widths():
    points = np.random.default_rng(5).integers(1, 7, 200_000)
    units = fim.SkipList(points, np.random.default_rng(6))
    assert len(units.lanes) >= 4
    for to_units, to_points, _ in units.lanes:
        assert to_units.sum(dtype=np.int64) == len(points) and to_points.sum() == points.sum()
    for (below, *_), (above, *_) in zip(units.lanes, units.lanes[1:]):
        assert len(below) / 32 < len(above) < len(below) / 8
    ends = np.cumsum(points)
    for r in (1, 77, 99_999, 199_999, 200_000):
        assert units.reach(r) == ends[r - 1]


@pytest.mark.parametrize("pattern,text,want", [
    (None, "añ👍", [1, 1, 1]), (r"\X", "éa👩‍👧\r\n", [2, 1, 3, 2]), (r"\S+\s*", " two words ", [1, 4, 6]), ("x*", "axxb", [1, 2, 1]), ("a", "", []), ("z", "abc", [3]),
])
def test_units(pattern, text, want):
    got = fim.unit_points(text, regex.compile(pattern, regex.DOTALL) if pattern else None)
    assert got.tolist() == want and sum(want) == len(text)


TEXTS = [
    (1, "Short text."), (2, None), (3, ""), (4, "x"), (5, "has a <P> inside"), (6, "ends in <S>"), (7, "<M>"), (8, "<<S<P <M P> S> M>" * 9), (9, "añ👍́\n" * 50), (10, "word " * 30_000), (None, "no id"), (None, None),
    (1, "Short text."), (1, "Short text."), (-5, "minus"), (2**62, "large id"), *[(i, f"text number {i} " * (i % 7 + 1)) for i in range(100, 300)],
]


def plain(doc_id, text, seed=1, rate=90, spm=20, marks=fim.MARKS):
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    i, j = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    p, s, m = marks
    if not t or any(x in t for x in marks) or h3 % 100 >= rate:
        return len(t), "plain", None, None, t
    if h4 % 100 < spm:
        return len(t), "spm", i, j - i, s + t[j:] + p + t[:i] + m + t[i:j]
    return len(t), "psm", i, j - i, p + t[:i] + s + t[j:] + m + t[i:j]


def rows_of(spark, extra=()):
    return spark.createDataFrame([(*r, *range(len(extra))) for r in TEXTS], ", ".join(["doc_id long", "text string", *[f"`{c}` int" for c in extra]])).repartition(3)


@pytest.mark.parametrize("options", [{}, {"seed": 7, "rate": 50, "spm": 50}, {"rate": 100, "spm": 100, "marks": ("[pre]", "[suf]", "[mid]")}])
def test_transformation(spark, options):
    made = fim.fill_in_middle(rows_of(spark), **options)
    back = made.withColumn("back", fim.restored(F.col("output"), F.col("form"), options.get("marks", fim.MARKS)))
    got = sorted((repr((r["row"]["doc_id"], r["row"]["text"])), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in back.collect())
    assert [g[:6] for g in got] == sorted((repr((d, t)), *plain(d, t, **options)) for d, t in TEXTS)
    assert all(eval(g[0])[1] in (g[6], g[6] or None) for g in got)
    assert {g[2] for g in got} >= {"plain", "spm"}


def test_units_of_a_pattern_are_never_cut(spark):
    text = "é👩‍👧 one two\r\n" * 40
    df = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string")
    ends = {0, *np.cumsum([len(x) for x in regex.findall(r"\X", text)]).tolist()}
    for r in fim.fill_in_middle(df, pattern=r"\X", rate=100).collect():
        assert r["n"] == len(ends) - 1 and {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= ends


def test_other_columns(spark):
    names = ["n", "form", "row", "output", "draws", "prefix_chars", "_row", "x.y", "TEXT2"]
    df = rows_of(spark, names)
    out = fim.rearranged(df)
    assert out.columns == df.columns
    assert sorted(r["text"] for r in out.collect()) == sorted(plain(d, t)[4] for d, t in TEXTS)
    assert {tuple(r)[2:] for r in out.collect()} == {tuple(range(len(names)))}


def test_not_nullable_and_empty(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("doc_id", T.LongType(), False), T.StructField("text", T.StringType(), False)])
    assert fim.rearranged(spark.createDataFrame([(1, "a b c d")], schema)).count() == 1
    assert fim.rearranged(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("marks", [("a", "a", "b"), ("", "x", "y"), ("ab", "ba", "c"), ("aa", "b", "c"), ("abc", "b", "d")])
def test_marks_must_be_apart(spark, marks):
    with pytest.raises(ValueError):
        fim.fill_in_middle(rows_of(spark), marks=marks)
