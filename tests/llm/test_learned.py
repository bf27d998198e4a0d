import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from flowloom.llm import language_id as li
from flowloom.llm import quality as q
from flowloom.llm import toxicity as tox
from flowloom.llm.learning import crc_mod


def test_crc_split(spark):
    got = spark.createDataFrame([(i,) for i in (0, 7, 123456)] + [(None,)], "doc_id long").select("doc_id", crc_mod(F.col("doc_id"), 4).alias("m")).collect()
    assert [r["m"] for r in got] == [zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 4 for r in got]


# ---- toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = _next(row, x, b, i)
    return row[-1]


def _next(row, x, b, i):
    new = [i + 1]
    for j, y in enumerate(b):
        new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
    return new


def test_automaton_equals_edit_distance():
    rng = random.Random(4)
    lex = tox.Lexicon(dict.fromkeys(tox.TERMS, 4.0))
    words = [*tox.TERMS, "idi0t", "xidiot", "idit", "pathettic", "pathetc", "disgustnig", "worthles", "scumm", "scom", ""]
    for t in tox.TERMS:
        for _ in range(60):
            w = list(t)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.randrange(2)] = rng.choice(["", "e", "o", "x"])
            words.append("".join(w))
    for w in words:
        near = [(distance(w, t), t) for t in tox.TERMS if distance(w, t) <= tox.errors_for(t)]
        hit = lex.walk(w)
        assert hit == ((min(near)[1], min(near)[0]) if near else None)
        assert bool(lex.look([w])) == bool(near) or not w


def test_stems_and_context():
    lex = tox.Lexicon({"lowei*": 3.0, "idiot": 4.0})
    assert lex.walk("loweischaft") == ("lowei*", 0) and lex.walk("lower") is None
    abuse, hits = tox.features("you are an idiot, you idoit! loweiung", lex)
    quoted, said = tox.features('the word "idiot" means something he said', lex)
    assert abuse[2] == 0 and len(hits) == 2 and abuse[3] > 0
    assert quoted[2] > 0 and quoted[0] == 0 and said[0][3]
    assert not tox.features(None, lex)[0].any() and not tox.features("", lex)[0].any()


def toxic_rows(n=240):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(["ba", "ko", "ri", "te", "mu", "sa"]) for _ in range(rng.randrange(1, 5))) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["grunz" + rng.choice(["ba", "ko", "ri", "te", "mu"]), "moron", "moroon"])
        rows.append((i, " ".join(words), "s", 1))
        labels.append((i, 1, int(bad)))
    return rows + [(n, None, "s", 1), (n + 1, "", "s", 1), (None, "moron moron moron", "s", 1), (0, "clean words", "s", 1)], labels + [(None, 1, 1), (3, None, None), (3, 0, 0)]


def test_toxicity(spark):
    rows, labels = toxic_rows()
    docs, known = spark.createDataFrame(rows, "doc_id long, text string, score string, held_out int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = tox.classify(docs, known, held_out=crc_mod(F.col("doc_id"), 4) == 2).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 240]
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in held]) > 0.95
    assert tox.classify(docs, known.limit(0)).filter("doc_id is null").first()["predicted"] == 1
    assert tox.classify(docs.limit(0), known).collect() == []
    kept = tox.keep_clean(docs, known)
    assert kept.columns == docs.columns and kept.filter("doc_id = 240").count() == 1


def test_long_and_joined_words():
    lex = tox.Lexicon({"lowei*": 3.0, "idiot": 4.0, "pathetic": 4.0})
    found = lambda w: lex.look([w]).get(w)
    for n in (0, 45, 60, 500):
        assert found("lowei" + "x" * n + ("y" if not n else "")) == ("lowei*", 0)
    assert found("patheti" + "x" * 80) is None and found("x" * 100 + "idiot") is None
    for w in ("idiot/moron", "you-idiot", "scum...idiot", "x_idiat_y", "(idiot)"):
        assert found(w)[0] == "idiot"
    assert found("don't") is None and found("id.iot") == ("idiot", 1)


def test_held_out_labels_teach_nothing(spark, monkeypatch):
    """Flipped held-out labels change no score, with more labels than the sample holds."""
    monkeypatch.setattr(tox, "LEXICON_ROWS", 60)
    rows, labels = toxic_rows(400)
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    flipped = [(d, q, 1 - t if t is not None and d is not None and held(d) else t) for d, q, t in labels]
    assert flipped != labels
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, held_out int")
    got = [
        sorted(map(repr, tox.classify(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"), held_out=crc_mod(F.col("doc_id"), 4) == 2).select("doc_id", "score", "predicted").collect()))
        for x in (labels, flipped)
    ]
    assert got[0] == got[1]


# ---- quality


def plain_statistics(text):
    """The statistics, said plainly."""
    data = (text or "").encode()
    words = [w for w in data.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w]
    if not words:
        return [0.0] * q.STATISTICS
    n, k, share = len(data), len(words), lambda f: sum(map(f, data)) / len(data)
    sizes = [len(w) for w in words]
    mean = sum(sizes) / k
    lines = [x for x in data.split(b"\n") if x.strip()]
    letter, digit, space, end, comma = (lambda c: chr(c).isalpha() and c < 128 or c >= 128), (lambda c: 48 <= c < 58), (lambda c: c in b" \t\n\r\x0b\x0c"), (lambda c: c in b"!.?"), (lambda c: c in b",:;")
    letters, upper = share(letter), share(lambda c: 65 <= c < 91)
    entropy = -sum(data.count(bytes([c])) / n * np.log2(data.count(bytes([c])) / n) for c in set(data))
    return [
        np.log1p(n), np.log1p(k), mean, (sum((s - mean) ** 2 for s in sizes) / k) ** 0.5, letters, upper / max(letters, 1e-9), share(digit), share(space), share(end), share(comma),
        share(lambda c: not (letter(c) or digit(c) or space(c) or end(c) or comma(c))), entropy, len(set(words)) / k, len(set(words)) / k**0.5, sum(a == b for a, b in zip(words, words[1:])) / k,
        len(set(lines)) / len(lines), np.log1p(k / len(lines)), max(words.count(w) for w in words) / k, sizes.count(1) / k, data.count(b"|") / k,
    ]


def test_statistics_said_plainly():
    texts = ["", None, "One two, two; THREE 4!\nline | a b\n\nline | a b", "é ü ß x" * 9, "q " * 30 + " ".join(f"w{i % 11}" for i in range(99)), "\x0b \x0c"]
    for t in texts:
        assert np.allclose(q.statistics(t), plain_statistics(t))


def test_fit_equals_one_matrix(spark):
    """Scores against one ridge system over all rows at once, and pooling by hand."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, q.STATISTICS))
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=500) > 1).astype(float)
    df = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "x array<double>, label int").repartition(5)
    model = q.fit(df, features=40)
    plain = q.Model(x.mean(0), x.std(0), 40)
    f = plain.transform(x)
    weights = np.linalg.lstsq(np.vstack([f, np.diag(np.sqrt([1e-6] + [q.RIDGE] * (f.shape[1] - 1)))]), np.concatenate([y, np.zeros(f.shape[1])]), rcond=None)[0]
    assert np.allclose(model.weights, weights, atol=1e-6)
    at = np.clip(((f @ weights + 0.5) / 2 * q.BINS).astype(int), 0, q.BINS - 1)
    bins = sorted(set(at.tolist()))
    means, sizes = [y[at == b].mean() for b in bins], [(at == b).sum() for b in bins]
    for i in range(len(bins)):  # max-min formula of the isotonic fit
        want = max(min(np.average(means[a : b + 1], weights=sizes[a : b + 1]) for b in range(i, len(bins))) for a in range(i + 1))
        assert np.isclose(model.steps[1][i], want, atol=1e-6)


def test_statistics_and_isotonic():
    assert q.statistics(" ".join(["rare"] * 12 + [f"w{i}" for i in range(108)]))[17] == 0.1
    assert not q.statistics(None).any() and not q.statistics(" \n").any() and np.isfinite(q.statistics("a")).all()
    fit = q.isotonic(np.array([1.0, 1, 2, 1]), np.array([0.1, 0.6, 0.3, 0.9]))
    assert np.allclose(fit, [0.1, 0.4, 0.4, 0.9]) and (np.diff(q.isotonic(np.ones(50), np.random.default_rng(1).random(50))) >= 0).all()


def test_quality(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
        good = i % 4 != 0
        rows.append((i, " ".join(words) + "." if good else " ".join([words[0] + "$$$"] * 30 + words[:10]), 1))
        labels.append((i, int(good)))
    rows += [(300, None, 1), (301, "", 1), (None, "x", 1), (0, rows[0][1], 1)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string, x int"), spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, quality int")
    got = q.classify(docs, known, held_out=crc_mod(F.col("doc_id"), 3) == 1).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 != 0) for r in held]) > 0.95
    assert {r["score"] for r in q.classify(docs, known.limit(0)).collect()} == {0.5}
    assert q.classify(docs.limit(0), known).collect() == []


# ---- language


def plain_sum(word, pieces, p, outside):
    """All segmentations, one by one."""
    text, total = "▁" + word, 0.0
    for cut in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cut) if c], len(text)]
        value = 1.0
        for a, b in zip(at, at[1:]):
            value *= p[pieces.index(text[a:b])] if text[a:b] in pieces else outside if b - a == 1 else 0.0
        total += value
    return total


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"]
    p = np.random.default_rng(3).random((len(pieces), 2))
    index = li.Pieces(pieces)
    for words in (["ab", "ba", "aa"], ["abab", "caba", "bbbb"], ["abababacbab"]):
        got = np.exp(li.forward(index.codes(words), index, li.padded(p)))
        for i, w in enumerate(words):
            for k in range(2):
                assert np.isclose(got[i, k], plain_sum(w, pieces, list(p[:, k]), li.OUTSIDE))
        uses = li.expected(words, np.ones(len(words)), index, p[:, :1])
        assert (uses >= 0).all() and uses.sum() > 0
    # EM's counts against all segmentations, one by one
    for w in ("abab", "cab"):
        want, text, total = np.zeros(len(pieces)), "▁" + w, plain_sum(w, pieces, list(p[:, 0]), li.OUTSIDE)
        for cut in itertools.product([0, 1], repeat=len(text) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cut) if c], len(text)]
            parts = [text[a:b] for a, b in zip(at, at[1:])]
            if all(x in pieces or len(x) == 1 for x in parts):
                value = np.prod([p[pieces.index(x), 0] if x in pieces else li.OUTSIDE for x in parts])
                for x in parts:
                    if x in pieces:
                        want[pieces.index(x)] += 2 * value / total
        assert np.allclose(li.expected([w], np.array([2]), index, p[:, :1]), want)
    single = li.expected(["b"], np.array([3.0]), li.Pieces(["▁", "b"]), np.array([[0.5], [0.5]]))
    assert np.allclose(single, [3, 3])


def test_long_words_are_summed_whole():
    pieces = ["▁", "a", "b", "ab", "abba"]
    p = np.random.default_rng(3).random((len(pieces), 2))
    w = "abba" * 300 + "ba"
    sums = np.zeros((len(w) + 2, 2))
    sums[0], text = 1.0, "▁" + w
    logs = np.zeros(2)
    for i in range(1, len(text) + 1):  # scaled at every step
        for n in range(1, 5):
            if i >= n:
                part = text[i - n : i]
                sums[i] += sums[i - n] * (p[pieces.index(part)] if part in pieces else li.OUTSIDE if n == 1 else 0)
        most = sums[i].copy()
        logs += np.log(most)
        sums[: i + 1] /= most
    index = li.Pieces(pieces)
    assert np.allclose(li.forward(index.codes([w]), index, li.padded(p)), logs)
    assert max(map(len, li.vocabulary())) > 8


def test_letters_and_und():
    assert li.words_of("½ ² Ⅷ 12 _ !") == [] and li.words_of("a½b ²c") == ["a", "b", "c"] and li.words_of("Été x") == ["été", "x"]


def test_language(spark):
    rng = random.Random(6)
    parts = {"en": ["the", "ing", "th", "er", "ou"], "de": ["sch", "ein", "ung", "ch", "ü"], "fr": ["eau", "que", "é", "oi", "la"]}
    rows = [(i, " ".join("".join(rng.choice(parts[k]) for _ in range(rng.randrange(1, 4))) for _ in range(30)), k, "x") for i in range(150) for k in [("en", "de", "fr")[i % 3]]]
    rows += [(150, None, "en", "x"), (151, "12 ½ ² Ⅷ!", "de", "x"), (152, "", None, "x"), (None, "theing", None, "x"), (0, rows[0][1], "en", "x"), (153, "eauque" * 2000, "fr", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = li.identify(docs, docs, held_out=crc_mod(F.col("doc_id"), 4) == 2).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == ("en", "de", "fr")[i % 3] for i in range(150)) and by[153]["lang_pred"] == "fr"
    assert [by[i]["lang_pred"] for i in (150, 151, 152)] == ["und"] * 3
    assert {r["lang_pred"] for r in li.identify(docs, docs.limit(0)).collect()} == {"und"}
    assert li.identify(docs.limit(0), docs).collect() == []
