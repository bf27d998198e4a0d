"""Main text of pages: markup cases one by one, site templates over made-up hosts, and the registered query."""

import html
import random
import time

import pytest
from pyspark.sql import types as T

from flowloom.llm import html_extract as he

CASES = [
    (None, ""), ("", ""), ("no markup &amp; all", "no markup & all"), ("<p>one<p>two<br>three", "one two three"), ("<p>a<b>b</b>c<i> d</i></p>", "abc d"),
    ("<article><h1>T&eacute;&#x1F44D;&#233;&nbsp;x</h1>\n<p> a\t\n b </p></article>", "Té👍é x a b"), ("<p>&copy &amp;lt; &unknown; AT&T</p>", "© &lt; &unknown; AT&T"),
    ("<nav>m</nav><article>text<nav>in</nav></article><footer>f</footer>", "text"), ("<header>h</header><p>body text</p><footer>f</footer>", "body text"),
    ("<article><header><h1>Title</h1></header><p>x</p><footer>tags</footer></article>", "Title x"), ("<script>var a='</p>';</script><style>p{}</style><p>x</p>", "x"),
    ("<p>a<script>if (a<b) {}</SCRIPT >b</p>", "ab"), ("<p>a</p><script>never closed <p>b", "a"), ("<p>a<!-- <p>b</p> -->c</p><!-- open <p>d", "ac"), ("<p>a<!>b<?php x?>c</3>d", "abcd"),
    ("<p>1 < 2 & 3 <4", "1 < 2 & 3 <4"), ("<p>cut<div class='x", "cut"), ('<p title="a>b">x</p>', "x"), ("<p title='a>b' class=c>x</p>", "x"), ('<p class=a"b>x</p>', "x"), ("<P>x</P><DIV CLASS=AD>y</DIV>", "x"),
    ("<div class='content'><p>prose here</p></div><div class='sidebar'>links</div>", "prose here"), ("<ul><li>a<li>b</ul>c", "a b c"), ("<table><tr><td>a<td>b<tr><td>c</table>d", "a b c d"), ("<dl><dt>t<dd>d<dt>u</dl>", "t d u"),
    ("<article><p>x</p><div class='ad-slot'>y</div><div class='shadow'>z</div><p class=\"ADVERT\">w</p></article>", "x z"), ("<article>x<form>f <input> <label>l</label></form><button>b</button></article>", "x"),
    ("<article>x<section id=comments><article class=comment>c</article></section></article>", "x"), ("<main><p>m</p><aside>s</aside></main><div>o</div>", "m"), ("<div role=main>m</div><div>o</div>", "m"),
    ("<div itemprop='articleBody'>m</div><div>other words</div>", "m"), ("<main><h1>T</h1><article>a</article></main>", "T a"), ("<main><article><h1>T</h1>a</article><p>more</p></main>", "T a"),
    ("<main><h1>T</h1><article>a</article><article>b</article></main>o", "T a b"), ("<article>a</article>between<article>b</article>", "a b"), ("<article>a<article>b</article>c</article>", "abc".replace("b", " b ")),
    ("<aside><article>teaser</article></aside><article>real</article>", "real"), ("<div class='layout sidebar-right'><article>real</article></div><div class=sidebar>no</div>", "real"),
    ("<body class='cookie-consent no-sidebar'><div id=cookieBanner>we use</div><p>x</p></body>", "x"), ("<article class='post comment-free'>x</article>", "x"), ("<nav>x <ul><li>y<article><p>kept", "kept"),
    ("<p hidden>h</p><p style='display: none'>n</p><p aria-hidden=false>x</p>", "x"), ("<div role=dialog>d</div><div role='alert'>a</div>text", "text"), ("<b><p>bo</b>ld</p>", "bold"), ("</p></div>x</b>", "x"),
    ("<div><a href=1>a a</a><a href=2>b b</a><a>c c</a></div><p>prose with <a href=3>a link</a> in it</p>", "prose with a link in it"), ("<article><p><a href=1>only a link</a></p></article>", "only a link"),
    ("<div class='page has-sidebar'><h1>T</h1><p>long prose of the page</p><div class=ads>x</div></div><p>end</p>", "T long prose of the page end"),
    ("<pre>  a\n  b</pre>", "a b"), ("<textarea><p>x</p></textarea><title>t</title>y", "y"), ("<noscript>n</noscript><iframe>i</iframe>y", "y"), ("<figure><img src=x><figcaption>cap</figcaption></figure>", "cap"),
    ("<h1>a<h2>b</h1>c", "a b c"), ("<p>x<table><tr><td><p>y</table>z", "x y z"), ("<select><option>a<option>b</select>x", "x"), ("\0<p>x", "\0 x"), ("<article></article>", ""), ("<div class=widget>w</div>", ""),
]


@pytest.mark.parametrize("source,want", CASES)
def test_markup(source, want):
    assert he.main_text(source) == want


def test_broken_markup_takes_linear_time():
    began = time.time()
    deep = "<div>" * 100_000 + "<p>x</p>" + "</div>" * 100_000
    assert he.main_text(deep) == "x"
    assert he.main_text("<p><table><td>" + "<div>" * 20_000 + "x</span></p>" * 20_000) == " ".join(["x"] * 20_000).replace(" ", "")
    for junk in ('<a "' * 50_000, "<" * 200_000, "<!--" * 50_000, "<a b=" * 50_000, "<a b='" * 50_000, "</" * 50_000, "&" * 200_000, "<p a=" + "x" * 200_000):
        he.main_text(junk)
    assert time.time() - began < 30


def test_digests_tell_subtrees():
    page = lambda s: he.Page(s, {})
    d = lambda s, site=1: page(s).digest(site)[1]
    assert d("<div><p>a</p>b</div>") == d('<div class="x"> <p>a\n</p> b </div>') != 0
    assert len({d(s) for s in ("<div><p>a</p>b</div>", "<div>a<p>b</p></div>", "<div><p>ab</p></div>", "<section><p>a</p>b</section>", "<div><h2>a</h2>b</div>", "<div>b<p>a</p></div>")}) == 6
    assert d("<div>a</div>", 1) != d("<div>a</div>", 2) and d("<div><p></p> <img></div>") == 0


# ---- site templates

rng = random.Random(9)
words = lambda k: " ".join("".join(rng.choice(["ba", "ko", "ri", "te", "&amp;", "sé", "lo"]) for _ in range(rng.randrange(1, 5))) for _ in range(k))
SITES = {f"www{i}.example.org": [f"<div><div>{words(6)}</div><p>{words(5)}</p></div>", f"<section><p>{words(9)}</p></section>", f"<p>{words(7)}</p>", f"<table><tr><td>{words(3)}</table>"] for i in range(3)}


def make():
    """(page_id, url, html, wanted text): furniture without any telling name, an article of paragraphs."""
    rows = []
    copy = [words(20), words(15), words(12)]
    for host, (top, side, inner, foot) in SITES.items():
        for i in range(40):
            paragraphs = copy if i % 4 == 1 else [words(rng.randrange(5, 30)) for _ in range(3)]
            if i % 4 == 2:
                paragraphs = [*copy[:2], words(8)]  # near copies: a quarter of the host's pages share paragraphs
            own = "".join(f"<p>{p}</p>" for p in paragraphs)
            body = f"<article><h1>Head {i}</h1>{own}{inner}</article>" if i % 2 else f"<div><h1>Head {i}</h1>{own}</div>{inner}"
            want = " ".join(html.unescape(" ".join([f"Head {i}", *paragraphs])).split())
            rows.append((len(rows), f"http://{host.upper() if i % 3 else host}/{i}?q=1", f"<html><body>{top}{body}{side}{foot}</body></html>", want))
    lone = "<div>seen once</div><p>but here is prose</p>"
    rows += [(900 + i, u, lone, "seen once but here is prose") for i, u in enumerate([None, "", "no scheme", "http:///x", "http://lone.example.com"] * 6)]
    return rows + [(950, "http://www0.example.org/e", None, ""), (951, "http://www0.example.org/e", "", ""), rows[0], rows[0], (None, *rows[1][1:])]


ROWS = make()


def frame(spark, extra=()):
    return spark.createDataFrame([(*r[:3], *range(len(extra))) for r in ROWS], ", ".join(["page_id long", "url string", "html string", *[f"`{c}` int" for c in extra]])).repartition(3)


@pytest.mark.parametrize("bound", [4_000_000, 0])
def test_site_templates(spark, bound):
    got = he.extract(frame(spark), broadcast_templates=bound).collect()
    assert sorted((repr(r["row"]["page_id"]), r["text"]) for r in got) == sorted((repr(r[0]), r[3]) for r in ROWS)


def test_templates_are_what_recurs_with_other_text(spark):
    """The counts, held against a plain version."""
    contents, pages = {}, {}
    for _, url, source, _ in ROWS:
        host = (url or "").partition("://")[2].split("/")[0].lower()
        if host and source:
            content, keys = he.page_keys(source, hash(host) & (1 << 64) - 1, {})
            pages.setdefault(host, set()).add(content)
            for k in keys:
                contents.setdefault((host, k), set()).add(content)
    want = sum((len(c) >= he.PROSE_MANY and len(c) >= he.PROSE_SHARE * len(pages[h])) if k & 1 else (len(c) >= he.MANY and len(c) >= he.SHARE * len(pages[h])) for (h, k), c in contents.items())
    assert he.templates(frame(spark)).count() == want >= 3 * 6


@pytest.mark.parametrize("bound", [4_000_000, 0])
def test_columns_of_any_name_and_nullability(spark, bound):
    names = ["row", "text", "site", "key", "keys", "page", "content", "n", "x.y", "URL2"]
    got = he.extract(frame(spark, names), broadcast_templates=bound).collect()
    assert sorted(r["text"] for r in got) == sorted(r[3] for r in ROWS) and {tuple(r["row"])[3:] for r in got} == {tuple(range(len(names)))}
    strict = T.StructType([T.StructField(n, t, False) for n, t in (("page_id", T.LongType()), ("url", T.StringType()), ("html", T.StringType()))])
    assert he.extract(spark.createDataFrame([(1, "http://a/", "<p>x")], strict), broadcast_templates=bound).first()["text"] == "x"
    assert he.extract(spark.createDataFrame([], strict), broadcast_templates=bound).collect() == []


def test_query(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "pages.parquet"))
    got = he.op12_html_extract(spark, str(tmp_path))
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    assert sorted((repr(r["page_id"]), r["url"] or "", r["text"], r["n_chars"]) for r in got.collect()) == sorted((repr(r[0]), r[1] or "", r[3], len(r[3])) for r in ROWS)
