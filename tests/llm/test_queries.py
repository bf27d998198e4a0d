"""The registered queries as they stand, on small tables, against plain versions of their contracts."""

import hashlib
import zlib

import numpy as np
import pytest

from flowloom.llm.queries import QUERIES
from tests.llm.test_fill_middle import plain as plain_parts
from tests.llm.test_native import brute as brute_windows
from tests.llm.test_native import ITEMS, passage
from tests.llm.test_pipeline import corpus
from tests.llm.test_simhash import brute_components, plain_fp
from tests.llm.test_suffix_dedup import brute as brute_spans
from tests.llm.test_tokens import plain
from tests.llm.test_url_filters import URLS


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs, _, labels = corpus()
    docs = [(d, t, ("en", "de")[d % 2] if d % 9 else None, s, n) for d, t, _, s, n in docs] + [(200, "1 ½ !", "en", "s", 5), (201, passage(1, 25), "de", "s", 1), (202, "x <|endoftext|> y", "en", "s", 1)]
    for name, rows, schema in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", ITEMS, "item_id long, text string"), ("pages", [(i, u[0], "") for i, u in enumerate(URLS)], "page_id long, url string, html string"),
    ):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(path / f"{name}.parquet"))
    return str(path), {d: t for d, t, *_ in docs}


def rows_of(spark, tables, name, *columns):
    df = QUERIES[name](spark, tables[0])
    assert df.columns[: len(columns)] == list(columns)
    out = {r[0]: r for r in df.collect()}
    return out, dict(df.dtypes)


def held(d, m, k):
    return zlib.crc32(str(d).encode()) % m == k


def test_op1(spark, tables):
    got, _ = rows_of(spark, tables, "op1_simhash", "doc_id", "fingerprint", "component_id")
    fps = {d: plain_fp(t) for d, t in tables[1].items()}
    want = brute_components(fps)
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in got.items()} == {d: (f"{fps[d]:016x}", want[d]) for d in fps}


@pytest.mark.parametrize("name,m,k,kind", [("op2_language_id", 4, 2, "string"), ("op3_toxicity", 4, 2, "int"), ("op5_quality", 3, 1, "int")])
def test_learned(spark, tables, name, m, k, kind):
    columns = ["doc_id", "held_out", "lang_pred", "score"] if kind == "string" else ["doc_id", "held_out", "score", "predicted"]
    got, types = rows_of(spark, tables, name, *columns)
    assert set(got) == set(tables[1]) and types["held_out"] == "boolean" and types["score"] == "double" and types[columns[2 if kind == "string" else 3]] == kind
    for d, r in got.items():
        assert r["held_out"] == held(d, m, k) and 0 <= r["score"] <= 1
        if kind == "int":
            assert r["predicted"] == (r["score"] >= (0.3 if name == "op3_toxicity" else 0.5))
        else:
            assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in tables[1][d] or "")) and r["lang_pred"] in ("en", "de", "und")


def test_op4(spark, tables):
    got, _ = rows_of(spark, tables, "op4_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.values()), key=repr) == brute_spans(list(tables[1].items()))


def test_op6(spark, tables):
    pieces = QUERIES["op6_packing"](spark, tables[0])
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got: dict = {}
    for p in pieces.collect():
        got.setdefault(p["doc_id"], []).append(p)
    for d, t in tables[1].items():
        ids, at = plain(t) + [1], 0
        for p in sorted(got[d], key=lambda p: p["start"]):
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)


def test_op7(spark, tables):
    got, _ = rows_of(spark, tables, "op7_url_filters", "page_id", "host", "path", "rule", "verdict")
    assert {i: tuple(r)[1:] for i, r in got.items()} == {i: u[1:] for i, u in enumerate(URLS)}


def test_op8(spark, tables):
    got, _ = rows_of(spark, tables, "op8_fingerprints", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    ids = sorted(tables[1])
    for d, after in zip(ids, ids[1:] + ids[:1]):
        t, nxt = tables[1][d] or "", tables[1][after] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert got[d]["n_chars"] == len(t) and got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[d]["fingerprint"] == got[d]["edited_fingerprint"]) >= (t == edited) and (got[d]["near_next"] == 1) >= (t == nxt)


def test_op9(spark, tables):
    got, _ = rows_of(spark, tables, "op9_token_files", "doc_id", "start", "n_tokens", "ids_crc32")
    at = 0
    for d in sorted(tables[1]):
        ids = plain(tables[1][d]) + [0]
        assert tuple(got[d]) == (d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op10(spark, tables):
    got, _ = rows_of(spark, tables, "op10_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for d, t in tables[1].items():
        n, hit, items = brute_windows(t)
        assert tuple(got[d]) == (d, n, len(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit))


def test_op11(spark, tables):
    got, types = rows_of(spark, tables, "op11_fill_middle", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for d, t in tables[1].items():
        n, form, prefix, middle, output = plain_parts(d, t)
        assert tuple(got[d]) == (d, n, form, prefix, middle, sha(output), sha(t or ""))
    assert types["n"] == types["prefix_chars"] == "bigint" and {r["form"] for r in got.values()} == {"plain", "psm", "spm"}
