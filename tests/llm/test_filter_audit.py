"""Filter audit: the registered query and the operator against chains of filters that are run one by one."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    t = text or ""
    w = WORD.findall(t)
    caps = sum("A" <= c <= "Z" for c in t)
    return [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * caps > 3 * len(t), any(c in "#$%&*|" for c in t)]


def brute(rows, labels, k=5, names="ABCDE"):
    """rows: (part, failures, good, toxic) one a document; each order is applied for real."""
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed_by = dict.fromkeys(range(k), 0)
        found = {}
        for order in itertools.permutations(range(k)):
            alive = list(own)
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if r[1][f]]
                alive = [r for r in alive if not r[1][f]]
                removed_by[f] += len(gone)
                only = sum(r[1][f] and sum(r[1]) == 1 for r in own)
                found["".join(names[x] for x in order), step] = (len(alive), len(gone), sum(r[1][f] for r in own) - len(gone), only, sum(r[2] for r in gone), sum(r[3] for r in gone), f)
        out |= {(part, *key): (*v[:-1], removed_by[v[-1]]) for key, v in found.items()}
    return out


def corpus():
    rng = random.Random(4)
    kinds = [lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 199, 200, 260]))), lambda: "same word " * 150, lambda: "SHOUT " + "quiet " * rng.randrange(300), lambda: f"cost ${rng.randrange(9)} " + " ".join(f"x{i}" for i in range(rng.randrange(300)))]
    docs = [(i, rng.choice(kinds)(), rng.choice(["en", "de", None, ""]), i) for i in range(70)]
    docs += [(70 + i, docs[i % 9][1], rng.choice(["en", "de"]), 0) for i in range(40)]  # copies, also across parts
    docs += [(200, None, "en", 0), (201, "", "fr", 0), (202, None, None, 0), (None, docs[3][1], "en", 0), (None, "only without id", "en", 0), (None, "only without id", "en", 0), (5, docs[5][1], docs[5][2], 5), (5, docs[5][1], docs[5][2], 5), (-3, docs[3][1], "en", 1)]
    docs += [(203, "a b c " * 120 + "É" * 9, "de", 0), (204, " \t\n\v\f\r ", "de", 0), (205, "long " * 200_000, "en", 0)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 110, 2)] + [(4, 1, 0), (4, 0, 1), (999, 1, 1), (None, 1, 1)]
    return docs, labels


def wanted(docs, labels):
    least = {}
    for d, t, *_ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    is_set = lambda d, c: any(x[0] == d and x[c] == 1 for x in labels if d is not None)
    copy = lambda d, t: (t or "") in least and (d is None or least[t or ""] < d)
    return brute([(p or "", [*fails(t), copy(d, t)], is_set(d, 1), is_set(d, 2)) for d, t, p, *_ in docs], labels)


def tables(spark, docs, labels, extra=""):
    return spark.createDataFrame(docs, f"doc_id long, text string, lang string, {extra or 'n_chars'} long").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def as_dict(df):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in df.collect()}


@pytest.mark.parametrize("extra", ["mask", "sha", "`_first`", "`fail_A`", "part", "quality", "n"])
def test_all_orders(spark, extra):
    docs, labels = corpus()
    got = fa.audit(fa.document_rows(*tables(spark, docs, labels, extra)), "ABCDE")
    assert got.count() == 600 * len({d[2] or "" for d in docs})
    assert as_dict(got) == wanted(docs, labels)


def test_query(spark, tmp_path):
    docs, labels = corpus()
    for name, df in zip(("documents", "labels"), tables(spark, docs, labels)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = fa.op13_filter_audit(spark, str(tmp_path))
    assert dict(got.dtypes)["step"] == "int" and dict(got.dtypes)["shapley"] == "bigint"
    assert as_dict(got) == wanted(docs, labels)


@pytest.mark.parametrize("k", [1, 2, 3, 6])
def test_states_of_any_number_of_filters(k):
    rng = np.random.default_rng(k)
    masks = np.unique(rng.integers(0, 1 << k, 40))
    counts = rng.integers(0, 50, (len(masks), 3))
    states = fa.gray_states(masks, counts, k)
    for s in range(1 << k):
        assert states[s].tolist() == counts[masks & s == 0].sum(axis=0).tolist()
    rows = [("", [bool(m >> f & 1) for f in range(k)], False, False) for m, c in zip(masks, counts[:, 0]) for _ in range(c)]
    if k < 6:
        want = brute(rows, [], k, "UVWXYZ"[:k])
        got = fa.order_rows(masks, np.stack([counts[:, 0], counts[:, 0] * 0, counts[:, 0] * 0], axis=1), "UVWXYZ"[:k])
        assert {("", r[0], r[1]): r[2:] for r in got} == want


def test_states_of_parts(spark):
    rows = spark.createDataFrame([("a", True, False, 3), ("a", True, True, 2), ("b", False, False, 7)], "part string, fail_x boolean, fail_y boolean, n long").withColumns({"good": F.lit(True), "toxic": F.lit(None).cast("boolean")})
    got = {(r["part"], r["active"]): tuple(r)[2:] for r in fa.states(rows, "xy").collect()}
    assert got == {("a", ""): (5, 5, 0), ("a", "x"): (0, 0, 0), ("a", "y"): (3, 3, 0), ("a", "xy"): (0, 0, 0), **{("b", s): (7, 7, 0) for s in ("", "x", "y", "xy")}}


def test_empty_and_wrong(spark):
    assert fa.audit(fa.document_rows(*tables(spark, [], [])), "ABCDE").collect() == []
    for names in ("", "AA", "ABCDEFGHI"):
        with pytest.raises(ValueError):
            fa.audit(fa.document_rows(*tables(spark, [], [])), names)
