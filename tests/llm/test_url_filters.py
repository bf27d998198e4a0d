import random

import pytest

from flowloom.llm.url_filters import filter_urls, host_rule, pattern_rule, read_rules

URLS = [
    ("http://Sub.Example.NET/en/x?q", "sub.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    ("https://a.example.com/de/1#t", "a.example.com", "/de/1", "example.com/de/", "block"),
    ("https://myexample.com/de/1", "myexample.com", "/de/1", None, "allow"),
    ("http://net", "net", "", None, "allow"),
    ("http://net/", "net", "/", "net/", "block"),
    ("ftp://x.org/fr/a://b", "x.org", "/fr/a://b", "org/fr/", "allow"),
    ("//x.net/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("https://casino-win.example.com/en/", "casino-win.example.com", "/en/", None, "block"),
    ("https://free-bets.example.com/q", "free-bets.example.com", "/q", None, "block"),
    ("https://casinos.example.com/q", "casinos.example.com", "/q", None, "allow"),
    ("https://responsible-casino.example.com/q", "responsible-casino.example.com", "/q", None, "allow"),
    ("https://x.com?a=/net/", "x.com", "", None, "allow"),
    ("http://a\nx.example.com/de/q", "a\nx.example.com", "/de/q", "example.com/de/", "block"),
    ("http://a.net/\n", "a.net", "/\n", "net/", "block"),
    ("http://x.com/\ncasino\n", "x.com", "/\ncasino\n", None, "block"),
]


def test_verdicts_inline_and_joined(spark):
    df = spark.createDataFrame([(i, u[0], "mine", 1) for i, u in enumerate(URLS)] + [(0, URLS[0][0], "mine", 1)], "page_id long, url string, host string, kind int")
    want = sorted([(i, *u[1:]) for i, u in enumerate(URLS)] + [(0, *URLS[0][1:])], key=repr)
    for limit in (2000, 0):
        got = filter_urls(df, inline_rules=limit)
        assert sorted([(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()], key=repr) == want
        assert got.columns == ["page_id", "url", "kind", "host", "path", "rule", "verdict"]


def test_clashing_columns(spark):
    names = ["_url", "_row", "_fits", "_best", "_u", "_token", "_rule", "token", "a.b"]
    df = spark.createDataFrame([(u[0], *range(len(names))) for u in URLS], "url string, " + ", ".join(f"`{n}` int" for n in names))
    for limit in (2000, 0):
        got = filter_urls(df, inline_rules=limit)
        assert got.columns == ["url", *names, "host", "path", "rule", "verdict"]
        assert sorted((tuple(r)[len(names) + 1 :] for r in got.collect()), key=repr) == sorted((u[1:] for u in URLS), key=repr)
    named = filter_urls(df.select(df["url"].alias("path")), url_col="path")
    assert sorted(r["verdict"] for r in named.collect()) == sorted(u[4] for u in URLS)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(df).collect() == []
    assert filter_urls(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string"), [], []).collect()[0]["verdict"] == "allow"


def test_tokens():
    assert host_rule("block", "Example.com", "/de/ab")["tokens"] == {"example", "com", "de"}
    assert pattern_rule("block", "^cheap^pills^")["tokens"] == {"cheap", "pills"}
    assert pattern_rule("block", "ads*track^")["tokens"] == set()


def test_thousands_of_rules_from_a_table(spark):
    """5,000 host rules and 500 pattern rules, inline and joined, against trying each."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 4)))
    rows = {(rng.choice(["allow", "block"]), ".".join(word() for _ in range(rng.choice([1, 2, 3]))), rng.choice([None, "/", f"/{word()}/"]), None) for _ in range(5000)}
    rows |= {(rng.choice(["allow", "block"]), None, None, f"^{word()}^{word()}^") for _ in range(500)}
    hosts, patterns = read_rules(spark.createDataFrame(sorted(rows, key=repr), "verdict string, host string, path string, pattern string"))
    assert len(hosts) + len(patterns) == len(rows)
    urls = [f"http://{'.'.join(word() for _ in range(rng.choice([2, 3])))}/{word()}/{word()}-{word()}" for _ in range(300)]

    def plain(url):
        host, path = url[7:].split("/", 1)[0], "/" + url[7:].split("/", 1)[1]
        found = [(len(h) + len(p), v == "block", h + p, v) for v, h, p in hosts if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if found:
            return max(found)[2:]
        found = [(len(p), v == "block", p, v) for v, p in patterns if any(all(c == "^" and not (url + "/")[i + k].isalnum() or c == (url + "/")[i + k] for k, c in enumerate(p)) for i in range(len(url) + 2 - len(p)))]
        return (None, max(found)[3]) if found else (None, "allow")

    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    want = {i: plain(u) for i, u in enumerate(urls)}
    assert len({w[0] for w in want.values()}) > 30 and {w[1] for w in want.values()} == {"allow", "block"}
    for limit in (10_000, 0):
        assert {r["page_id"]: (r["rule"], r["verdict"]) for r in filter_urls(df, hosts, patterns, inline_rules=limit).collect()} == want
    for bad in (("deny", "a", None, None), ("block", None, "/x", None)):
        with pytest.raises(ValueError):
            read_rules(spark.createDataFrame([bad], "verdict string, host string, path string, pattern string"))
    with pytest.raises(ValueError):
        read_rules(spark.createDataFrame([("block", "a", None, None)] * 3, "verdict string, host string, path string, pattern string"), 2)
