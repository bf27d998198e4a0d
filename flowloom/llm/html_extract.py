"""Main text of web pages: site templates, told by what recurs on a host, and page furniture, told by markup, go.

A page is read into elements by the rules of HTML that matter for text (optional end tags, raw text, character
references, comments), never failing on broken markup. Then, in two passes over all pages:

1. **Counting.** Each block element's subtree is hashed bottom-up (tags and words, not attributes). Spark counts for each
   host and hash in how many *different* pages it occurs: pages with the same main text are one, so copies of an
   article are no template. A subtree in at least ``MANY`` different pages and ``SHARE`` of the host's is a template;
   for prose inside an article (a paragraph, heading, quotation or list entry) it takes ``PROSE_MANY`` and ``PROSE_SHARE``.
2. **Extraction.** Templates of the page's host are deleted, and so is what the markup names: menus, footers, sidebars,
   notices, adverts, forms, scripts, reader comments, hidden elements, and page headers. What is left of the page's
   article is its text: character references decoded, white space (as Unicode has it) made one space, blocks joined by one space.

The article is the ``article`` or ``main`` element (or what a role or itemprop calls so); without one, the element named
as content that has most of the page's prose; without that, all of the page. Neither it nor what it stands in is deleted,
whatever their names.

Templates go to the workers as one sorted array of hashes, if they are at most ``BROADCAST_TEMPLATES``; beyond that pages
meet their own templates in a join by the page's hash.

Edge cases: NULL or empty html, and a page that is all furniture, give the empty text; NULL urls and urls without ``://``
belong to no host, so nothing recurs there; host letters A-Z are lower-cased; repeated rows give their text each and count
once; of unclosed comments, tags and scripts nothing is shown, as browsers do; an unclosed menu or page header ends where
an article begins; elements over ``DEPTH`` deep stand side by side; texts of any length are read whole. Columns of df may
have any name; an empty table stays empty.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import release, small_batches, staged, table

MANY, SHARE = 4, 0.5
PROSE_MANY, PROSE_SHARE = 8, 0.9
#: Templates up to which all are sent to every worker, eight bytes each.
BROADCAST_TEMPLATES = 4_000_000
DEPTH = 512

_words = lambda text: frozenset(text.split())
#: Elements without content; elements whose content is text alone; formatting elements.
VOID = _words("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr")
RAW = _words("script style textarea title iframe noembed noframes noscript xmp")
FORMATTING = _words("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q ruby s samp small span strike strong sub sup time tt u var")
#: Elements that begin and end a block.
BLOCK = _words(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td template tfoot th thead title tr ul br"
)
PROSE = _words("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption")
#: A start tag ends an open element of these kinds, unless an element of the second set stands between.
ENDS = {
    "li": (_words("li"), _words("ul ol menu dir")), "dt": (_words("dt dd"), _words("dl")), "dd": (_words("dt dd"), _words("dl")), "option": (_words("option"), _words("select datalist")),
    "tr": (_words("tr td th"), _words("table")), "td": (_words("td th"), _words("tr table")), "th": (_words("td th"), _words("tr table")),
    **{t: (_words("tr td th thead tbody tfoot caption"), _words("table")) for t in ("thead", "tbody", "tfoot")}, **{f"h{i}": (_words("h1 h2 h3 h4 h5 h6"), BLOCK - _words("h1 h2 h3 h4 h5 h6 br hr")) for i in range(1, 7)},
}
P_ENDS = BLOCK - _words("body head html title br caption legend li dt dd option optgroup tbody td tfoot th thead tr template") | _words("li dd dt")
WALLS = _words("table td th caption template object button")
_P, _NONE = _words("p"), frozenset()
HEADINGS = _words("h1 h2 h3 h4 h5 h6")
#: Furniture by element, by role, and by words of class and id.
FURNITURE = _words("nav aside footer form menu dialog search template select button datalist fieldset label legend input output progress meter canvas svg audio video object applet map")
ROLES = _words("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar")
NAMES = _words(
    "ad ads adv adbox adslot adsense adunit adsbygoogle advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promoted promotion banner cookie cookies consent gdpr ccpa notice notices "
    "notification notifications popup popover modal overlay lightbox toast alert alerts newsletter subscribe subscription signup signin login register nav navbar navigation topnav subnav menu menus submenu breadcrumb breadcrumbs crumbs "
    "sidebar sidebars rail widget widgets related recommended recommendations recirculation teaser teasers trending popular share sharing sharebar shares social socials follow footer foot colophon pagination pager paging "
    "toolbar search searchbox searchform skip skiplink disqus replies respond reviews outbrain taboola aside masthead topbar"
)
#: Words that name page headers: furniture outside of articles only. Words that name content.
HEADERS = _words("header siteheader pageheader")
CONTENT = _words("article articlebody story post entry content main maincontent text body")
NOT_COMMENTS = _words("commentary commentaries commented")

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?>"[^"]*"|'[^']*'|[^\s"'>][^\s>]*+)?+)?+)*+)(>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*+)))?""")
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Look:
    """What an element's attributes say."""

    __slots__ = ("names", "role", "hidden", "body", "furniture")

    def __init__(self, attributes: str):
        found = {}
        for name, *values in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), html.unescape("".join(values)))
        named = f"{found.get('class', '')} {found.get('id', '')}"
        self.names = {w.lower() for w in _NAME.findall(named)} | {re.sub(r"[^a-z]", "", w.lower()) for w in named.split()}
        self.role = found.get("role", "").strip().lower()
        self.hidden = "hidden" in found and found["hidden"].lower() != "until-found" or bool(_HIDDEN.search(found.get("style", "")))
        self.body = "articlebody" in found.get("itemprop", "").lower()
        self.furniture = not NAMES.isdisjoint(self.names) or any(n.startswith("comment") and n not in NOT_COMMENTS for n in self.names)


_PLAIN = Look("")


class Page:
    """The elements of a page in document order (0: the page itself) and its flow: pieces of text and block borders."""

    def __init__(self, source: str, looks: dict[str, Look]):
        self.tags, self.looks, self.parents = ["#"], [_PLAIN], [-1]
        self.flow: list[tuple[int, str | None]] = []  # (element, text; None: a border)
        self._open, self._count = [0], Counter()
        at, flow, tokens = 0, self.flow, _TOKEN.finditer(source)
        while m := next(tokens, None):
            begin, end = m.span()
            if begin > at:
                flow.append((self._open[-1], source[at:begin]))
            at = end
            closing, name, attributes, closed = m.groups()
            if not closed:  # comment, declaration, or a tag that the page ends in
                continue
            name = name.lower()
            if closing:
                self._end(name)
                continue
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = end.start() if end else len(source)
                tokens = _TOKEN.finditer(source, at)
                if name == "textarea" or name == "title":
                    flow.append((self._open[-1], None))
                continue
            self._start(name, attributes, looks)
        if at < len(source):
            flow.append((self._open[-1], source[at:]))

    def _pop_to(self, i: int) -> None:
        for e in reversed(self._open[i:]):
            self._count[self.tags[e]] -= 1
            if self.tags[e] in BLOCK:
                self.flow.append((e, None))
        del self._open[i:]

    def _close(self, kinds: frozenset, walls: frozenset) -> None:
        if any(self._count[k] for k in kinds):
            for i in range(len(self._open) - 1, 0, -1):
                tag = self.tags[self._open[i]]
                if tag in kinds:
                    return self._pop_to(i)
                if tag in walls:
                    return

    def _start(self, name: str, attributes: str, looks: dict[str, Look]) -> None:
        if name in ("html", "body", "head"):
            return
        if name in P_ENDS and self._count["p"]:
            self._close(_P, WALLS)
        if name in ENDS:
            kinds, walls = ENDS[name]
            before = -1
            while before != len(self._open):  # a new row ends both a cell and its row
                before = len(self._open)
                self._close(kinds, walls)
        elif name in ("article", "main") and (self._count["nav"] or self._count["header"]):
            for i, e in enumerate(self._open):
                if self.tags[e] == "nav" or self.tags[e] == "header" and not any(self.tags[x] in ("article", "main", "aside") for x in self._open[:i]):
                    self._pop_to(i)
                    break
        e = len(self.tags)
        look = _PLAIN
        if attributes and attributes.strip(" /\n\t"):
            look = looks.get(attributes)
            if look is None:
                if len(looks) > 20_000:
                    looks.clear()
                look = looks[attributes] = Look(attributes)
        self.tags.append(name)
        self.looks.append(look)
        self.parents.append(self._open[-1])
        if name in BLOCK:
            self.flow.append((e, None))
        if name not in VOID and len(self._open) < DEPTH:
            self._open.append(e)
            self._count[name] += 1

    def _end(self, name: str) -> None:
        if name in HEADINGS:
            return self._close(HEADINGS, WALLS)
        if not self._count[name]:
            return
        walls = BLOCK if name in FORMATTING else WALLS if name not in WALLS else _NONE
        for i in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[i]]
            if tag == name:
                return self._pop_to(i)
            if tag in walls:
                return

    # ---- what is what

    def digest(self, site: int) -> list[int]:
        """A hash of each element's subtree (tags and words), seeded by the site; 0 where it has no words."""
        n = len(self.tags)
        parts: list[list[str]] = [[] for _ in range(n)]
        children: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # (number of own texts before it, child)
        seen = 1
        for e, text in self.flow:
            while seen <= e:
                children[self.parents[seen]].append((len(parts[self.parents[seen]]), seen))
                seen += 1
            if text is not None and (words := text.split()):
                parts[e].append(" ".join(words))
        for e in range(seen, n):
            children[self.parents[e]].append((len(parts[self.parents[e]]), e))
        out = [0] * n
        for e in range(n - 1, -1, -1):
            own, inner, at = parts[e], [], 0
            for before, c in children[e]:
                inner += own[at:before]
                at = before
                if out[c]:
                    inner.append(f"\0{self.tags[c]} {out[c]:x}")
            inner += own[at:]
            if inner:
                out[e] = xxhash.xxh64_intdigest("\1".join([self.tags[e], *inner]), site) & ~1 or 2
        return out

    def sizes(self) -> tuple[list[int], list[int], list[int]]:
        """For each element: letters of text, of text in links, and links, in its subtree."""
        n = len(self.tags)
        text, linked, links = [0] * n, [0] * n, [0] * n
        for e, t in self.flow:
            if t is not None:
                text[e] += len(t.strip())
        for e in range(n - 1, 0, -1):
            if self.tags[e] == "a":
                linked[e], links[e] = text[e], 1
            p = self.parents[e]
            text[p] += text[e]
            linked[p] += linked[e]
            links[p] += links[e]
        return text, linked, links

    def inside(self, own: list[bool]) -> list[bool]:
        """Whether each element or one that it stands in is marked."""
        for e in range(1, len(own)):
            own[e] = own[e] or own[self.parents[e]]
        return own

    def judged(self) -> tuple[list[bool], list[bool], list[bool]]:
        """(furniture, in the article, prose of it) for each element."""
        n, tags, looks, parents = len(self.tags), self.tags, self.looks, self.parents
        by_tag = [tags[e] in FURNITURE or looks[e].role in ROLES or looks[e].hidden for e in range(n)]
        by_name = [looks[e].furniture for e in range(n)]
        named = lambda e: looks[e].role in ("main", "article") or tags[e] in ("main", "article")
        roots = self._roots([e for e in range(1, n) if named(e)], by_tag, by_name) or self._roots([e for e in range(1, n) if looks[e].body], by_tag, by_name)
        if roots:
            holds = [False] * n
            for r in roots:
                while r >= 0 and not holds[r]:
                    holds[r], r = True, parents[r]
            gone = [(by_tag[e] or by_name[e]) and not holds[e] for e in range(n)]
        else:
            text, linked, links = self.sizes()
            large, frame = 0.6 * (text[0] - linked[0]), [t in ("article", "main") for t in tags]  # a frame around most of the page, its title or content, is no furniture, whatever its name
            for e in range(n - 1, 0, -1):
                frame[parents[e]] = frame[parents[e]] or frame[e] or not by_name[e] and (tags[e] == "h1" or not CONTENT.isdisjoint(looks[e].names))
            by_name = [by_name[e] or tags[e] == "header" or not HEADERS.isdisjoint(looks[e].names) for e in range(n)]
            gone = [by_tag[e] or by_name[e] and not (frame[e] and text[e] - linked[e] >= large) or links[e] > 2 and linked[e] >= 0.8 * text[e] and tags[e] != "a" for e in range(n)]
            gone[0] = False
            lost = self.inside(list(gone))
            prose = [0] * n
            for e, t in self.flow:
                if t is not None and not lost[e]:
                    prose[e] += len(t.strip())
            for e in range(n - 1, 0, -1):
                prose[parents[e]] += prose[e]
            fit = [e for e in range(1, n) if not CONTENT.isdisjoint(looks[e].names) and not lost[e] and prose[e] and prose[e] >= 0.8 * prose[0]]
            roots = fit[-1:] or [0]
        article = [False] * n
        for r in roots:
            article[r] = True
        return self.inside(gone), (own := self.inside(article)), [own[e] and tags[e] in PROSE for e in range(n)]

    def _roots(self, found: list[int], by_tag: list[bool], by_name: list[bool]) -> list[int]:
        """The article of the page among the elements that say so."""
        tags, parents = self.tags, self.parents
        in_tag, in_name = self.inside(list(by_tag)), self.inside(list(by_name))
        found = [e for e in found if not in_tag[e] and not by_name[e]]
        found = [e for e in found if not in_name[e]] or found
        if len(found) < 2:
            return found
        mains = [e for e in found if tags[e] == "main" or self.looks[e].role == "main"]
        known, articles = set(found) - set(mains), []
        for e in found:
            up = parents[e]
            while up > 0 and up not in known:
                up = parents[up]
            if e in known and up <= 0:
                articles.append(e)
        if not mains or not articles:
            return articles or mains[:1]
        if len(articles) > 1:
            return mains[:1]
        under = lambda e, top: e > 0 and (e == top or under(parents[e], top))
        heads = [e for e, t in enumerate(tags) if t == "h1" and not in_tag[e]]
        return mains[:1] if any(under(e, mains[0]) for e in heads) and not any(under(e, articles[0]) for e in heads) else articles

    def text(self, gone: list[bool], article: list[bool]) -> str:
        """The words of the article that are not gone."""
        decode = html.unescape
        return " ".join("".join(" " if t is None else decode(t) if "&" in t else t for e, t in self.flow if t is None or article[e] and not gone[e]).split())


def page_keys(source: str | None, site: int, looks: dict[str, Look]) -> tuple[int, set[int]]:
    """(hash of the main text, keys of the block subtrees and the page): a key's last bit says whether it is prose of the article."""
    if not source:
        return 0, set()
    page = Page(source, looks)
    gone, article, prose = page.judged()
    keys = {d | prose[e] for e, d in enumerate(page.digest(site)) if d and (not e or page.tags[e] in BLOCK)}
    return xxhash.xxh64_intdigest(page.text(gone, article)), keys


def main_text(source: str | None, site: int = 0, looks: dict[str, Look] | None = None, template: Callable[[list[int]], list[bool]] | None = None) -> str:
    """The main text of one page; ``template`` says which of its subtrees' keys are templates of its site."""
    if not source:
        return ""
    page = Page(source, {} if looks is None else looks)
    gone, article, prose = page.judged()
    if template:
        digests = page.digest(site)
        hit = template([d | prose[e] for e, d in enumerate(digests)])
        holds = [False] * len(hit)  # the article, and what it stands in
        for e in range(len(hit) - 1, 0, -1):
            if holds[e] or article[e] and not article[page.parents[e]]:
                holds[e] = holds[page.parents[e]] = True
        own = [h and bool(d) and page.tags[e] in BLOCK and not holds[e] for e, (h, d) in enumerate(zip(hit, digests))]
        gone = page.inside([g or o for g, o in zip(gone, own)])
    return page.text(gone, article)


# ---- over all pages


def _site(url: Column) -> Column:
    """A number for the url's host; 0 where there is none."""
    host = F.lower(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1))
    return F.when(F.coalesce(host, F.lit("")) == "", F.lit(0)).otherwise(F.xxhash64(host))


def subtrees(df: DataFrame, url_col: str = "url", html_col: str = "html", by_page: bool = False) -> DataFrame:
    """(site, key, content) of the block subtrees of all pages that have a host, or (page, key) by the page's hash."""
    first = F.xxhash64(f"`{url_col}`", f"`{html_col}`") if by_page else F.lit(0).cast("long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        looks: dict[str, Look] = {}
        for b in batches:
            rows: set[tuple] = set()
            for page, site, source in zip(b["page"].to_pylist(), b["site"].to_pylist(), b["html"]):
                content, keys = page_keys(source.as_py(), site & (1 << 64) - 1, looks)
                rows |= {(page, k) for k in keys} if by_page else {(site, k, content) for k in keys}
            columns = [np.array(c, np.uint64 if i else np.int64).view(np.int64) for i, c in enumerate(zip(*rows))] or [np.empty(0, np.int64)] * (2 if by_page else 3)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["page", "key"] if by_page else ["site", "key", "content"])

    pages = df.select(first.alias("page"), _site(F.col(f"`{url_col}`")).alias("site"), F.col(f"`{html_col}`").alias("html")).filter("site <> 0")
    return pages.mapInArrow(work, "page long, key long" if by_page else "site long, key long, content long")


def templates(df: DataFrame, url_col: str = "url", html_col: str = "html", many: int = MANY, share: float = SHARE) -> DataFrame:
    """(key): the subtrees that are templates of their host."""
    found = subtrees(df, url_col, html_col)
    counted = staged(found.groupBy("site", "key").agg(F.count_distinct("content").alias("n"), F.min("content").alias("one")), "subtrees")
    # a page as a whole has one content, so all contents of a host are seen in keys that have just one
    contents = counted.filter("n = 1").select("site", F.col("one").alias("content")).distinct().groupBy("site").agg(F.count("*").alias("pages"))
    often = counted.filter(F.col("n") >= many).join(contents, "site", "left")
    pages, prose = F.greatest(F.coalesce("pages", F.lit(0)), F.col("n")), F.col("key").bitwiseAND(1) == 1
    return often.filter(F.when(prose, (F.col("n") >= PROSE_MANY) & (F.col("n") >= PROSE_SHARE * pages)).otherwise(F.col("n") >= share * pages)).select("key")


def extract(df: DataFrame, url_col: str = "url", html_col: str = "html", many: int = MANY, share: float = SHARE, broadcast_templates: int = BROADCAST_TEMPLATES) -> DataFrame:
    """(row, text) for each row of df: ``row`` holds its columns, text its main text."""
    spark = df.sparkSession
    small_batches(spark)
    known = staged(templates(df, url_col, html_col, many, share), "templates")
    place = df.columns.index(html_col)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    pages = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).cast(nullable).alias("row"), _site(F.col(f"`{url_col}`")).alias("site"))
    sent = None
    if known.count() <= broadcast_templates:
        sent = spark.sparkContext.broadcast(np.sort(np.array([r["key"] for r in known.toLocalIterator()], np.int64).view(np.uint64)))
        pages = pages.withColumn("keys", F.lit(None).cast("array<long>"))
    else:
        own = subtrees(df, url_col, html_col, by_page=True).join(known, "key", "left_semi").groupBy("page").agg(F.collect_set("key").alias("keys"))
        pages = pages.withColumn("page", F.xxhash64(f"row.`{url_col}`", f"row.`{html_col}`")).join(own, "page", "left").select("row", "site", "keys")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        looks: dict[str, Look] = {}
        everywhere = None if sent is None else sent.value

        def among(keys: list[int]) -> list[bool]:
            wanted = np.array(keys, np.uint64)
            return (everywhere[np.minimum(np.searchsorted(everywhere, wanted), len(everywhere) - 1)] == wanted).tolist()

        for b in batches:
            texts = []
            for source, site, keys in zip(b["row"].field(place), b["site"].to_pylist(), b["keys"]):
                if site == 0:
                    template = None
                elif everywhere is not None:
                    template = among if len(everywhere) else None
                else:
                    own = {k & (1 << 64) - 1 for k in keys.as_py() or ()}
                    template = (lambda found, own=own: [k in own for k in found]) if own else None
                texts.append(main_text(source.as_py(), site & (1 << 64) - 1, looks, template))
            yield pa.RecordBatch.from_arrays([b["row"], pa.array(texts, pa.string())], ["row", "text"])

    return pages.mapInArrow(work, T.StructType([T.StructField("row", nullable), T.StructField("text", T.StringType())]))


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return made.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))
