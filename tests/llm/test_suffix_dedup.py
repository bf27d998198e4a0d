import hashlib
import random

import numpy as np
import pyarrow as pa

from flowloom.llm import suffix_dedup as sd


def brute(rows, length=50):
    first = {}
    for d, t in rows:
        b, d = (t or "").encode(), 2**63 - 1 if d is None else d
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(d, first.get(w, d))
    out = []
    for d, t in rows:
        b, e = (t or "").encode(), 2**63 - 1 if d is None else d
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < e:
                gone[i : i + length] = True
        turn = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), int((turn == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "on", "é", "an", "re", "ß"]) for _ in range(rng.randrange(1, 4)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(k) for k in (8, 12, 20, 60)]
    rows = []
    for i in range(n):
        parts = [text(rng.randrange(0, 50))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts += [p[a : a + rng.randrange(20, 200)], text(rng.randrange(10))]
        rows.append((rng.randrange(1000), "".join(parts)))
    rows += [(5000 + i, rows[3][1]) for i in range(5)] + [(7, None), (8, ""), (None, passages[3]), (None, passages[3]), (9, "a" * 300), (10, "a" * 120), (11, "ab" * 100), (12, "ba" * 100), (9, "a" * 300)]
    return rows


def got_of(spark, rows, **kw):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, chunk string")
    out = sd.repeated_spans(df, **kw).withColumn("sha", F.sha2("kept", 256)).collect()
    return sorted(((r["row"]["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), r["sha"]) for r in out), key=repr)


def test_matches_brute_force(spark):
    rows = corpus()
    want = brute(rows)
    for size in (900, 3000, 9000):  # many chunks, and few
        assert got_of(spark, rows, chunk_bytes=size) == want
    assert got_of(spark, rows) == want  # one chunk


def test_suffix_sorting():
    rng = np.random.default_rng(0)
    rows = rng.integers(97, 99, (400, 50)).astype(np.uint8)
    rows[:, :30] = rows[rng.integers(0, 8, 400), :30]
    rows[200:] = rows[rng.integers(0, 200, 200)]
    for shallow in (1, 3, 7):
        order, run = sd.sort_suffixes(rows, shallow)
        strings = [rows[i].tobytes() for i in order]
        assert strings == sorted(strings) and sorted(order) == list(range(400))
        for i in range(1, 400):
            assert (run[i] == run[i - 1]) == (strings[i] == strings[i - 1])


def test_sorting_within_groups():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 60, 2000):
        rows = rng.integers(97, 99, (n, 50)).astype(np.uint8)
        rows[:, :30] = rows[rng.integers(0, min(n, 8), n), :30]
        rows[n // 2 :] = rows[rng.integers(0, max(1, n // 2), n - n // 2)]
        groups = np.sort(rng.integers(0, max(1, n // 3), n))
        order, run = sd.sort_suffixes(rows, 3, groups)
        strings = [(groups[i], rows[i].tobytes()) for i in order]
        assert strings == sorted(strings) and sorted(order) == list(range(n))
        assert all((run[i] == run[i - 1]) == (strings[i] == strings[i - 1]) and strings[run[i]] == strings[i] for i in range(1, n))


def test_least_ids_in_steps():
    """Contexts of shared anchors, alone and mixed, in steps of any size."""
    rng = np.random.default_rng(5)
    length, reach = 50, 30
    made = [rng.integers(97, 100, reach + length).astype(np.uint8) for _ in range(12)]
    rows, keys = np.zeros((300, reach + length + 2), np.uint8), rng.integers(0, 12, 300).astype(np.uint64)
    for i, k in enumerate(keys):
        near, far = sorted(rng.integers(0, 31, 2).tolist())
        rows[i, :-2], rows[i, -2], rows[i, -1] = made[k], near, far
        if k % 3 == 0 and i % 2:
            rows[i, 5 * (i % 12)] = 120
        rows[i, : reach - far] = 0
        rows[i, reach - near + length : -2] = 0
    ids = rng.integers(0, 1000, 300)
    least: dict = {}
    spans = [(i, d, rows[i, reach - d : reach - d + length].tobytes()) for i in range(300) for d in range(rows[i, -2], rows[i, -1] + 1)]
    for i, d, w in spans:
        least[keys[i], d, w] = min(ids[i], least.get((keys[i], d, w), 10**6))
    for step in (1, 500, 10**6):
        got = {(i, d): x for i, near, far, x in zip(*(a.tolist() for a in sd.least_ids(rows, keys, ids, length, step))) for d in range(near, far + 1)}
        assert got == {(i, d): least[keys[i], d, w] for i, d, w in spans}
    assert [len(x) for x in sd.least_ids(rows[:0], keys[:0], ids[:0], length)] == [0] * 4


def test_empty_and_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, k int")
    assert sd.repeated_spans(df).collect() == [] and sd.remove_repeats(df).collect() == []
    line = "the same long line of text that both documents hold, word for word"
    rows = [(2, "b " + line, 1), (1, line, 2), (3, None, 3)]
    got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, k int"))
    assert got.columns == ["doc_id", "text", "k"] and sorted(map(tuple, got.collect())) == [(1, line, 2), (2, "b ", 1), (3, "", 3)]


def test_hot_anchors_match_brute_force(spark):
    """A line of 30 bytes, in a different context at each place, and passages: by windows where anchors are hot."""
    rng = random.Random(3)
    text = lambda k: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(k))
    line = "a line that many documents hold"
    rows = corpus(2) + [(2000 + i, f"{text(20)} {line} {text(9)} {line} {text(3)}") for i in range(80)]
    rows += [(3000 + i, rows[-1 - i][1][40:180]) for i in range(20)]
    want = brute(rows)
    for kw in ({"heavy": 1, "heavy_chunks": 2}, {"heavy": 2, "heavy_chunks": 3}, {"many_chunks": 3}):
        assert got_of(spark, rows, chunk_bytes=900, **kw) == want


def test_hot_anchor_sends_windows_apart(spark, monkeypatch):
    """Few contexts of a line that is everywhere are sorted in groups by its anchor; before, all were."""
    rng = random.Random(4)
    letters = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    line = "0123456789 9876543210 0246813579"
    rows = [(i, letters(60) + line + letters(60)) for i in range(400)]
    seen, sort = spark.sparkContext.accumulator(0), sd.least_ids

    def counted(rows, keys, ids, length):
        seen.add(len(rows))
        return sort(rows, keys, ids, length)

    monkeypatch.setattr(sd, "least_ids", counted)
    assert got_of(spark, rows, chunk_bytes=1500, heavy=2, heavy_chunks=4) == brute(rows)
    apart = seen.value
    assert got_of(spark, rows, chunk_bytes=1500, heavy=10**6, many_chunks=10**6) == brute(rows)
    assert apart < (seen.value - apart) // 5


def test_rows_are_copied_once_for_all_buckets():
    """What a chunk sends grows with its rows, not with rows times buckets (before, all rows were copied for each bucket)."""
    taken = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            out = super().__getitem__(at)
            taken.append(out.nbytes if isinstance(out, np.ndarray) and not np.may_share_memory(out, self) else 0)
            return out

    rows = np.zeros(3000, [("key", "<u8"), ("row", "u1", (82,))])
    rows["key"] = np.random.default_rng(8).integers(0, 2**62, 3000)
    sent = sd._packed(rows.view(Counted), "key", 1000, False)
    assert sum(len(sd._unpack(d, rows.dtype)) for _, _, d in sent) == 3000 and sum(taken) <= 2 * rows.nbytes
    assert all((sd._unpack(d, rows.dtype)["key"] % 1000 == b).all() for b, _, d in sent)


def test_contexts_as_told_by_each_window():
    """What a chunk says of its anchors, against every window by itself; texts of few letters have the same gram at many places."""
    rng, length, gram = random.Random(6), 50, 20
    texts = ["".join(rng.choice("ab" if i % 3 else "abcdefgh ") for _ in range(rng.choice([0, 49, 50, 51, 300]))) for i in range(40)] + ["a" * 200, "ab" * 90]
    c = sd.Chunk(pa.table({"doc_id": list(range(len(texts))), "text": pa.chunked_array([texts[:7], texts[7:]])}), length, gram)
    data, order = "".join(texts).encode(), sd._gram_order(np.frombuffer("".join(texts).encode(), np.uint8), gram)
    want: dict = {}
    for a, b in zip(c.starts.tolist(), c.ends.tolist()):
        for w in range(a, b - length + 1):
            for p in range(w, w + length - gram + 1):
                if order[p] == order[w : w + length - gram + 1].min():
                    want.setdefault(p, []).append(w)
    assert c.places.tolist() == sorted(want)
    for p, row in zip(c.places.tolist(), c.contexts(np.arange(len(c.places)))):
        near, far = p - max(want[p]), p - min(want[p])
        assert (row[-2], row[-1]) == (near, far)
        assert row[30 - far : 80 - near].tobytes() == data[p - far : p - near + 50] and not row[: 30 - far].any() and not row[80 - near : 80].any()


def test_kept_bytes_in_several_arrays():
    data, ends = np.frombuffer(b"onetwothree", np.uint8), np.array([0, 3, 6, 6, 11])
    for most in (1, 4, 100):
        assert sd._texts(data, ends, most).to_pylist() == [b"", b"one", b"two", b"", b"three"]
    assert sd._texts(data[:0], np.array([0, 0])).to_pylist() == [b"", b""]


def test_columns_that_are_not_nullable_or_have_dots(spark):
    from pyspark.sql import types as T

    kinds = T.StructType([T.StructField("a.b", T.LongType(), False), T.StructField("text", T.StringType(), False), T.StructField("x y", T.ArrayType(T.StringType(), False), False), T.StructField("m", T.StructType([T.StructField("d.e", T.LongType(), False)]), False)])
    shared = "".join(chr(97 + i * i * 7 % 26) for i in range(80))
    df = spark.createDataFrame([(2, f"two {shared} end", ["p"], (5,)), (1, f"one {shared}", ["q"], (6,))], kinds)
    out = {r["a.b"]: r for r in sd.remove_repeats(df, id_col="a.b").collect()}
    assert out[1]["text"] == f"one {shared}" and out[2]["text"] == "two end"  # the blank before the passage is in both
    assert out[2]["x y"] == ["p"] and out[2]["m"]["d.e"] == 5 and sd.remove_repeats(df, id_col="a.b").columns == df.columns
