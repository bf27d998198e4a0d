import random

from pyspark.sql import functions as F

import corpus_pipeline
from flowloom.llm import near_copies as nc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows, least=0.8):
    """The number of the first row in each row's group, and the similarities of the pairs that link."""
    sets, label, linked = [grams(t) for _, t in rows], list(range(len(rows))), []
    for i in range(len(rows)):
        for j in range(i):
            s = jaccard(sets[i], sets[j])
            if s >= least:
                linked.append(s)
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label, linked


def corpus(seed=4):
    rng = random.Random(seed)
    text = lambda k: [f"w{rng.randrange(3000)}" for _ in range(k)]
    out = []
    for k in range(60):
        base = text(rng.choice([60, 100, 250]))
        out.append(base)
        for share in (0.006, 0.012, 0.02, 0.03, 0.05):
            w = list(base)
            for at in rng.sample(range(len(w)), max(1, round(share * len(w)))):
                w[at] = "changed" + str(rng.randrange(10**6))
            out.append(w)
    rows = [(1000 - i, " ".join(w)) for i, w in enumerate(out)]
    return rows + [(2000, None), (2001, ""), (2002, "One two"), (2003, "one  TWO")]


def test_stage_drops_copies_at_0_8_and_more(spark, tmp_path):
    rows = corpus()
    label, linked = brute(rows)
    assert sum(0.8 <= s < 0.95 for s in linked) > 100
    want = {min(d for (d, _), y in zip(rows, label) if y == x) for x in label}
    df = spark.createDataFrame([(d, t, "x", "s", 0) for d, t in rows], SCHEMA).repartition(3)
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_large_buckets_lose_no_pair(spark):
    """One text edited over and over: buckets of several components, with the second bands and without."""
    rng, w, rows = random.Random(7), [f"v{i}" for i in range(120)], []
    for i in range(80):
        w = list(w)
        for at in rng.sample(range(120), rng.choice([1, 2, 4, 6])):
            w[at] = f"n{i}x{at}"
        rows.append((i, " ".join(w)))
    label, _ = brute(rows)
    assert len(set(label)) > 3
    for bucket in (2, 256):
        df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "_row long, doc_id long, text string")
        got: dict = {}
        for r in nc.near_copies(df, bucket=bucket).collect():
            got.setdefault(r["root"], set()).add(r["row"])
        want: dict = {}
        for i, x in enumerate(label):
            want.setdefault(x, set()).add(i)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def edited(n, seed, edits, length=100):
    """n copies of one text, each with words of its own at so many places."""
    rng, base = random.Random(seed), [f"v{i}" for i in range(length)]
    out = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(length), edits):
            w[at] = f"own{i}x{at}"
        out.append((i, " ".join(w)))
    return out


def test_pairs_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """Copies that are edited too far for a link, at similarities of 0.53 on average: no pair of them is moved or verified."""
    moved = []
    whole = nc._alike
    monkeypatch.setattr(nc, "_alike", lambda pairs, *rest: (moved.append(pairs.count()), whole(pairs, *rest))[1])
    for n in (150, 600):
        moved.clear()
        rows = edited(n, n, 4)
        df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "_row long, doc_id long, text string")
        assert nc.near_copies(df).select("root").distinct().count() == n
        assert sum(moved[1:]) <= n // 10 and moved[0] <= 3 * n


def test_recall_in_a_large_group(spark):
    """Copies with one or two edits each among copies with four: all links are found, as brute force finds them."""
    rows = [(d, t) for k, e in enumerate((1, 2, 3, 4)) for d, t in ((1000 * k + d, t) for d, t in edited(120, k, e, 110))]
    label, linked = brute(rows)
    assert len(linked) > 9_000 and len(set(label)) > 100
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "_row long, doc_id long, text string").repartition(3)
    got: dict = {}
    for r in nc.near_copies(df).collect():
        got.setdefault(r["root"], set()).add(r["row"])
    want: dict = {}
    for i, x in enumerate(label):
        want.setdefault(x, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_links_that_leave_a_tile_are_a_forest(spark, monkeypatch):
    """Copies of which most are alike: the tiles' links are fewer than the nodes, in one tile and in many."""
    rows = edited(300, 5, 1, 110) + [(1000 + d, t) for d, t in edited(100, 6, 3, 110)]
    label, linked = brute(rows)
    assert len(linked) > 20_000
    whole, found = nc._family_links, []
    monkeypatch.setattr(nc, "_family_links", lambda *args: (found.append(whole(*args)), found[-1])[1])
    monkeypatch.setattr(nc, "STAR_BANDS", 25)  # leaves the tiles the work
    monkeypatch.setattr(nc, "_simhash_pairs", lambda nodes: nodes.select(nodes.node.alias("a"), nodes.node.alias("b")).limit(0))
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "_row long, doc_id long, text string")
    for bucket, most in ((4096, 1), (150, 3)):
        assert nc.near_copies(df, bucket=bucket).select("root").distinct().count() == len(set(label))
        assert 100 < found[-1].count() < most * len(rows)


def test_simhash_proposes_pairs(spark):
    """The stage's first step: fingerprints within two bits, of which the sets then decide."""
    a, b = (" ".join(f"{x}{i}" for i in range(400)) for x in "vw")
    rows = [(0, a), (1, a + " end"), (2, b), (3, b + " end"), (4, b.replace(" ", "  "))]
    fps = [nc.majority(nc.shingles(t)) for _, t in rows]
    assert all((fps[i] ^ fps[i + 1]).bit_count() <= 2 for i in (0, 2)) and (fps[0] ^ fps[2]).bit_count() > 2
    nodes = [nc._node(nc.shingles(t)) for _, t in rows]
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    table = spark.createDataFrame(sorted({(signed(n), signed(f)) for n, f in zip(nodes, fps)}), "node long, fp long")
    got = {(r["a"], r["b"]) for r in nc._simhash_pairs(table).collect()}
    assert got == {tuple(sorted((signed(nodes[i]), signed(nodes[i + 1])))) for i in (0, 2)}


def test_texts_are_not_moved_to_be_read_again(spark, monkeypatch):
    """The few texts whose sets are wanted are found where they lie; beyond the bound a shuffle finds the same."""
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "seen long, text string").repartition(3)
    nodes, wanted = rows.select(F.col("seen").alias("node"), "seen"), spark.range(0, 200, 40).select(F.col("id").alias("node"))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, joins in ((nc.WANTED_ROWS, "BroadcastHashJoin"), (1, "SortMergeJoin")):
            monkeypatch.setattr(nc, "WANTED_ROWS", most)
            found = nc._texts_of(wanted, nodes, rows)
            assert joins in found._jdf.queryExecution().executedPlan().toString()
            assert sorted(r["text"] for r in found.collect()) == sorted(f"text {i}" for i in range(0, 200, 40))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
