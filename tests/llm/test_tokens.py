import zlib

import numpy as np
import pytest

from flowloom.llm import packing
from flowloom.llm.token_files import Shard, encoder, read_token_files, tokenizer_path, write_shard, write_token_files

SCHEMA = "doc_id long, text string, shard int, n_ids string"
ROWS = [(i, t, 7, "x") for i, t in enumerate(["", "a", None, "Hello  world \n\n x", " lead", "tail ", "word " * 900, "é ü\t\tz", "a", "<|endoftext|> b", "end<|endoftext|>", "a <|endoftext|><|endoftext|>  x\n<|endoftext"] + [f"doc {i} text, with words." * (i % 40) for i in range(60)])]


def plain(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library():
    texts = [r[1] or "" for r in ROWS] + [" \n x", "\n\n y  z", "a\x1cb c", "a \u00a0b", "it's 12 3's  ", "\u3000x y"]
    enc = encoder(tokenizer_path())
    for t, b in zip(texts, enc.encode(texts)):
        assert np.frombuffer(b, enc.dtype).tolist() == plain(t)


def test_shard_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 255, 256, 257, 2000):
        docs = [rng.integers(0, 60000, rng.choice([0, 1, 5, 3000]) if n < 300 else rng.integers(0, 9)).astype("<u2") for _ in range(n)]
        ids = np.sort(rng.integers(-(2**63), 2**63 - 1, n, endpoint=True)) if n % 2 else np.sort(rng.integers(-9, n, n))
        s = Shard(write_shard(ids, [d.tobytes() for d in docs], np.dtype("<u2")))
        assert [s.doc_id(i) for i in range(n)] == ids.tolist() and (s.steps.all() + np.uint64(s.first % (1 << 64))).view(np.int64).tolist() == ids.tolist()
        assert s.bounds.all().tolist() == [s.bounds[i] for i in range(n)]
        at = 0
        for i, d in enumerate(docs):
            start, ids = s.document(i)
            assert start == at and ids.tolist() == d.tolist()
            at += len(d)
        assert s.total == at


@pytest.mark.parametrize("rows,coarse", [(9, 10_000), (4, 3), (1500, 10_000)])
def test_token_files(spark, rows, coarse):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    files = write_token_files(df, rows_per_file=rows, coarse=coarse)
    assert files.count() == 1 if rows > len(ROWS) else files.count() > 5
    got = {r["doc_id"]: r for r in read_token_files(files).collect()}
    at = 0
    for i, t, *_ in ROWS:
        ids = plain(t) + [0]
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_edge(spark):
    assert read_token_files(write_token_files(spark.createDataFrame([], SCHEMA))).collect() == []
    rows = [(5, "b", 0, ""), (5, "a", 0, ""), (None, "c", 0, ""), (5, "a", 0, "")]
    got = sorted(tuple(r)[:3] for r in read_token_files(write_token_files(spark.createDataFrame(rows, SCHEMA))).collect())
    assert got == [(-(2**63), 0, 2), (5, 2, 2), (5, 4, 2), (5, 6, 2)]


@pytest.mark.parametrize("length,windows", [(64, 3), (2048, 32)])
def test_packing(spark, length, windows):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    pieces = packing.pack(df, length=length, open_windows=windows).collect()
    docs, seqs = {}, {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0 and p["ids_crc32"] == zlib.crc32(p["ids"])
        docs.setdefault(p["doc_id"], []).append((p["start"], ids))
        seqs.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for i, t, *_ in ROWS:
        got = [x for _, ids in sorted(docs[i]) for x in ids]
        assert got == plain(t) + [1]
        assert all(p["doc_tokens"] == len(got) for p in pieces if p["doc_id"] == i)
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)


def test_packing_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []
    one = packing.pack(spark.createDataFrame([(None, None, 0, "")], SCHEMA)).collect()
    assert [(r["doc_id"], r["length"], r["offset"]) for r in one] == [(None, 1, 0)]


@pytest.mark.parametrize("rows,coarse", [(9, 3), (4, 10_000)])
def test_token_files_null_and_frequent_ids(spark, rows, coarse):
    """NULL ids, ids at both ends of the range and a frequent one: no file holds more rows of an id than allowed."""
    few = [(i * 10**17 - 5 * 10**18, f"few {i}") for i in range(100)] + [(2**63 - 1, "last"), (-(2**63) + 1, "early")]
    docs = few + [(None, f"none {i:03}") for i in range(60)] + [(7, f"seven {i % 20:02}" + " x" * (i % 20)) for i in range(70)] + [(8, "eight"), (6, "six")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    files = write_token_files(df, rows_per_file=rows, coarse=coarse)
    shards = sorted((r["shard"], r["base"], r["n_ids"], [x.doc_id(i) for x in [Shard(r["payload"])] for i in range(x.n)]) for r in files.collect())
    assert [s for s, *_ in shards] == list(range(len(shards)))
    assert max(max(map(ids.count, ids)) for *_, ids in shards) <= rows
    assert sum((-(2**63)) in ids for *_, ids in shards) >= 60 // rows and sum(7 in ids for *_, ids in shards) >= 70 // rows
    at, got = 0, sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in read_token_files(files).collect())
    for (start, d, n, crc), (want, text) in zip(got, sorted((-(2**63) if i is None else i, t) for i, t in docs), strict=True):
        ids = plain(text) + [0]
        assert (start, d, n, crc) == (at, want, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
