"""The pipeline on a small corpus, held against brute force stage by stage."""

import random
import zlib

import numpy as np

import corpus_pipeline
from tests.llm.test_native import WORD, low
from tests.llm.test_simhash import brute_components, plain_fp
from tests.llm.test_suffix_dedup import brute as brute_spans
from tests.llm.test_tokens import plain


def corpus():
    rng = random.Random(12)
    text = lambda k: " ".join("".join(rng.choice(["ba", "ko", "ri", "te", "mu", "sa", "lo", "né"]) for _ in range(rng.randrange(1, 5))) for _ in range(k))
    items = [(i, text(14)) for i in range(6)]
    shared = text(40)
    docs = []
    for i in range(90):
        t = text(80)
        if i % 10 == 3:
            w = t.split()
            for _ in range(3):
                w[rng.randrange(80)] = rng.choice(["moron", "idiot", "scum"])
            t = " ".join(w)
        if i % 9 == 4:
            t += " " + items[i % 6][1]
        if i % 7 == 5:
            t = t + " " + shared
        docs.append([i, t])
    docs += [[90 + k, docs[k][1]] for k in range(4)] + [[94, docs[6][1].replace(" ", "  ", 1)], [95, None], [96, ""]]
    labels = [(i, 1, int(i % 10 == 3)) for i in range(90)]
    return [(i, t, "xx", "s", len(t or "")) for i, t in docs], items, labels


def spans_text(rows):
    """Texts after removal, as brute_spans judges them."""
    first, out = {}, {}
    for d, t in rows:
        b = t.encode()
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(d, first.get(b[i : i + 50], d))
    for d, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = True
        out[d] = bytes(x for x, g in zip(b, gone) if not g).decode(errors="replace")
    assert {d: len(t.encode()) for d, t in rows} == {r[0]: r[1] for r in brute_spans(rows)}
    return out


def test_pipeline(spark, tmp_path):
    docs, items, labels = corpus()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    bad = ("moron", "idiot", "scum")
    kept = {d: t or "" for d, t, *_ in docs if not any(w in bad for w in (t or "").split())}
    groups = brute_components({d: plain_fp(t) for d, t in kept.items()})
    kept = {d: t for d, t in kept.items() if groups[d] == d}
    kept = spans_text(list(kept.items()))
    windows = {tuple(w[k : k + 10]) for _, t in items for w in [WORD.findall(low(t))] for k in range(len(w) - 9)}
    clean = {}
    for d, t in kept.items():
        w = WORD.findall(low(t))
        if not any(tuple(w[k : k + 10]) in windows for k in range(len(w) - 9)):
            clean[d] = t
    assert 0 < len(clean) < len(kept) < len(docs)

    got: dict[int, list] = {}
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got.setdefault(p["doc_id"], []).append((p["start"], p["length"], p["ids_crc32"]))
    assert set(got) == set(clean)
    for d, t in clean.items():
        ids = plain(t) + [1]
        for start, n, crc in got[d]:
            assert zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()) == crc
        assert sum(n for _, n, _ in got[d]) == len(ids)


def test_stages_keep_columns(spark, tmp_path):
    docs, items, labels = corpus()
    for name, rows, schema in (("benchmark", items, "item_id long, text string"), ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, str(tmp_path))
        assert out.columns == empty.columns and out.collect() == []
