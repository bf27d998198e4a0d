import hashlib
import re

import pytest
from pyspark.sql import functions as F

from flowloom.llm import decontamination as dec
from flowloom.llm import fingerprints as fp

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def low(t):
    return (t or "").translate(LOWER)


def passage(i, n):
    return " ".join(f"P{i}w{j % 7}x{j}" for j in range(n))


ITEMS = [(1, passage(1, 25)), (2, passage(2, 4)), (3, passage(2, 4).upper()), (4, None), (5, "..."), (6, "ÉA éA " * 8), (10, passage(1, 25))]
DOCS = [
    (1, "before " + passage(1, 25).replace(" ", ", ") + " after"), (2, passage(1, 9)), (3, "x" + passage(2, 4)), (4, "a " + passage(2, 4) + " b " + passage(2, 4)),
    (5, None), (6, ""), (7, "éa ÉA " * 3), (8, "Éa éA " * 20), (1, "clean text"), (1, "clean text"), (None, passage(1, 12)),
]


def brute(text, n=10):
    w = WORD.findall(low(text))
    hit, items = set(), set()
    for i, t in ITEMS:
        v = WORD.findall(low(t))
        m = min(n, len(v))
        for g in {tuple(v[k : k + m]) for k in range(len(v) - m + 1)} if v else ():
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) == g:
                    hit |= set(range(k, k + m))
                    items.add(str(i))
    return len(w), hit, sorted(items)


@pytest.mark.parametrize("bound", [2_000_000, 1])
def test_decontamination_marks(spark, bound):
    docs = spark.createDataFrame([(*d, "z") for d in DOCS], "doc_id long, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dec.mark(docs, items).columns == ["doc_id", "text", "n_words", "hits", "items"]
    got = dec.mark(docs, items, broadcast_windows=bound).withColumn("n_hit", dec._covered(F.col("hits"))).collect()
    want = sorted((repr(d), repr(t), len(h), n, i) for d, t in DOCS for n, h, i in [brute(t)])
    assert sorted((repr(r["doc_id"]), repr(r["text"]), r["n_hit"], r["n_words"], r["items"]) for r in got) == want


CLASHES = ["hits", "items", "n_words", "gram", "hash", "size", "pos", "item_id", "_id", "_row", "_w", "_runs", "_first", "_cut", "_doc", "_p", "_at", "_hit", "_items", "_met", "_hash", "_size", "x.y"]


@pytest.mark.parametrize("bound", [2_000_000, 1])
def test_decontamination_with_clashing_columns(spark, bound):
    docs = spark.createDataFrame([(*d, *range(len(CLASHES))) for d in DOCS], ", ".join(["doc_id long", "text string", *[f"`{c}` int" for c in CLASHES]]))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for mode in ("drop", "cut"):
        got = dec.decontaminate(docs, items, mode=mode, broadcast_windows=bound)
        assert got.columns == docs.columns
        rows = got.collect()
        assert all(tuple(r[2:]) == tuple(range(len(CLASHES))) for r in rows)
        assert len(rows) == (len(DOCS) if mode == "cut" else sum(not brute(t)[1] for _, t in DOCS))
    marked = dec.mark(docs, items, broadcast_windows=bound).collect()
    assert all(r["_id"] == 8 and r["n_words"] == brute(r["text"])[0] for r in marked)


def test_decontamination_of_a_long_text(spark):
    """20,000 words, by shuffle: positions travel without the words."""
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(20_000))
    items = spark.createDataFrame([(1, " ".join(long.split()[9_000:9_012])), (2, "nothing of it " * 5)], "item_id long, text string")
    docs = spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string")
    want = None
    for bound in (2_000_000, 1):
        got = sorted((r["doc_id"], r["n_words"], [tuple(h) for h in r["hits"]], r["items"]) for r in dec.mark(docs, items, broadcast_windows=bound).collect())
        assert got[0][1] == 20_000 and (9_001, 10) in got[0][2] and got[0][3] == ["1"] and got[1] == (2, 1, [], [])
        assert want in (None, got)
        want = got


def test_decontamination_modes(spark):
    docs = spark.createDataFrame([(*d, 3) for d in DOCS], "doc_id long, text string, extra int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dec.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(repr(r["text"]) for r in kept.collect()) == sorted(repr(t) for _, t in DOCS if not brute(t)[1])
    cut = {(r["doc_id"], r["text"]) for r in dec.decontaminate(docs, items, mode="cut").collect()}
    assert (2, passage(1, 9)) in cut and (1, "clean text") in cut and (5, None) in cut
    for _, t in cut:
        assert not brute(t)[1]
    assert any(d == 1 and t.startswith("before ") and t.endswith(" after") and "x" not in t for d, t in cut)
    assert dec.decontaminate(docs, items.limit(0)).count() == len(DOCS)
    assert dec.decontaminate(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        dec.decontaminate(docs, items, mode="other")


def shingles(text, n=5):
    w = [x for x in re.split("[\x20\x09-\x0d]+", low(text)) if x]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_query(spark, tmp_path):
    texts = [None, "", "one", "One", "a b c d e f g", " ".join(f"w{i}" for i in range(60)), "é" * 31, "tail  word\n"] + [" ".join(f"v{(i * j) % 41}" for j in range(i)) for i in range(1, 40)]
    rows = [(3 * i - 5, t, i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in fp.op8_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for k, (d, t, _) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(jaccard(shingles(t), shingles(edited)))  # exact: few shingles
        assert r["near_next"] == pytest.approx(jaccard(shingles(t), shingles(nxt)))
        assert (r["fingerprint"] == r["edited_fingerprint"]) >= (t == edited)


def test_successor_over_buckets(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in [5, 1, 9, 9, 2, 100, 50, 51]] + [(None, "n")], "doc_id long, text string")
    for rows in (2, 100):
        got = fp.with_successor(df, {"text": "nxt"}, rows_per_bucket=rows).select("text", "nxt").collect()
        assert sorted(map(tuple, got)) == sorted([("n", "t1"), ("t1", "t2"), ("t2", "t5"), ("t5", "t9"), ("t9", "t9"), ("t9", "t50"), ("t50", "t51"), ("t51", "t100"), ("t100", "n")])


def test_successor_of_frequent_and_null_ids(spark, tmp_path):
    """Each text follows exactly one, ids ascend but for one step, and no bucket holds more than its share of one id."""
    ids = [None] * 90 + [7] * 120 + list(range(-40, 60)) + [2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(d, f"t{i}", 1, 2) for i, d in enumerate(ids)], "doc_id long, text string, _tie int, _bucket int").repartition(3)
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = fp.with_successor(df, {"text": "nxt", "doc_id": "next_id"}, rows_per_bucket=10)
    assert got.columns == ["doc_id", "text", "_tie", "_bucket", "nxt", "next_id"]
    rows = got.collect()
    assert len(rows) == len(ids) and {r["nxt"] for r in rows} == {f"t{i}" for i in range(len(ids))}
    rank = lambda d: (d is not None, d or 0)
    assert sum(rank(r["next_id"]) < rank(r["doc_id"]) for r in rows) == 1
    inner = fp._dealt(df.select(F.col("doc_id").alias("_id"), "text", F.xxhash64("_metadata.row_index", "_metadata.file_path").alias("_tie")), 10)
    assert inner.groupBy("_bucket", "_id").count().agg(F.max("count")).first()[0] < 40
    clash = fp.fingerprint_documents(df.withColumnsRenamed({"_tie": "sketch", "_bucket": "n_shingles"}))
    assert clash.columns == ["doc_id", "text", "sketch", "n_shingles", "fingerprint"]


def test_sketch_estimates(spark):
    a, b = " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1000, 3000))
    df = spark.createDataFrame([(a, b, a.replace("w7 ", "w8 "))], "a string, b string, c string").select(*[fp.sketch(F.col(c)).alias(c) for c in "abc"])
    r = df.select(fp.resemblance(F.col("a"), F.col("b")).alias("j"), fp.distinct_shingles(F.col("a")).alias("n"), fp.containment(F.col("b"), F.col("a")).alias("c"), (fp.merge(F.col("a"), F.col("b")) == F.col("a")).alias("m")).first()
    assert abs(r["j"] - 2 / 3) < 0.15 and 2300 < r["n"] < 3700 and r["c"] > 0.75 and r["m"]
    assert fp.fingerprint_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("bound", [2_000_000, 1])
def test_items_without_id(spark, bound):
    """They hit words, and are one item of the empty id."""
    items = spark.createDataFrame([(None, "one two three"), (None, "four five"), (7, "four five")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two three"), (2, "x four five one two three"), (3, "four five"), (4, "none")], "doc_id long, text string")
    got = {r["doc_id"]: r["items"] for r in dec.mark(docs, items, broadcast_windows=bound).collect()}
    assert got == {1: [""], 2: ["", "7"], 3: ["", "7"], 4: []}
