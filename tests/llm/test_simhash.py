import random

import xxhash

from flowloom.llm import simhash as sh

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fp(text):
    w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(LOWER)).split(" ") if x]
    if not w:
        return 0
    g = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps):
    ids = sorted(fps)
    label = {i: i for i in ids}
    for _ in ids:
        before = dict(label)
        for i in ids:
            label[i] = min(label[j] for j in ids if bin(fps[i] ^ fps[j]).count("1") <= 2)
        if label == before:
            return label
    return label


def corpus():
    rng = random.Random(5)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randrange(30)) for _ in range(120)) for _ in range(25)]
    texts = list(base) + [base[0]] * 6 + [None, "", "  \n", "One two", "one TWO", "É é", "x" * 5000]
    for b in base[:8]:
        for _ in range(5):
            w = b.split()
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    return [(i, t, "s") for i, t in enumerate(texts)]


def test_fingerprint():
    for _, t, _ in corpus():
        assert sh.fingerprint(t) == plain_fp(t)


def test_components_match_brute_force(spark):
    rows = corpus()
    want = brute_components({i: plain_fp(t) for i, t, _ in rows})
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(4)
    for shard in (512, 2):  # small shards: the split path
        got = sh.near_duplicates(df, shard=shard).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(rows)


def test_split_shards_lose_no_link(spark):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 150:
        v = rng.choice(sorted(values))
        for _ in range(rng.choice([1, 2, 5])):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    values |= {rng.getrandbits(64) for _ in range(50)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    nodes = spark.createDataFrame(signed, "fp long")
    want = brute_components(dict(zip([s[0] for s in signed], values)))
    for shard in (3, 40, 10**6):
        roots = {r["node"]: r["root"] for r in sh.components(sh.link_shards(nodes, shard=shard)).collect()}
        assert {s[0]: roots.get(s[0], s[0]) for s in signed} == want


def test_chain_and_empty(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in sh.components(links).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100: 99}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sh.near_duplicates(empty).collect() == [] and sh.keep_first(empty).collect() == []


def test_keep_first(spark):
    rows = [(3, "a b c d", 1), (1, "a b c d", 2), (None, "a b c d", 3), (2, None, 4), (7, "", 5), (9, "q r s", 6), (9, "q r s", 7)]
    got = sh.keep_first(spark.createDataFrame(rows, "doc_id long, text string, k int"))
    assert sorted(r["k"] for r in got.collect()) in ([2, 4, 6], [2, 4, 7]) and got.columns == ["doc_id", "text", "k"]
