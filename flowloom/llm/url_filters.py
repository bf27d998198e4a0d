"""URL filters: pattern rules indexed by their rarest literal token (native DataFrame functions only).

Rules come in two kinds. A *host rule* ``(host, path)`` fits its host and every subdomain when the
url's path starts with the rule's path; of the host rules that fit, the longest decides. A *pattern
rule* is text in which ``*`` stands for any run of characters, ``^`` for one character that is neither
a letter nor a digit (or the url's end), and a leading ``||`` for a place where a host or one of its
parent domains begins; it blocks or allows a url on which no host rule fits.

Every rule is filed under the one of its literal tokens that the corpus' urls hold least often. A url
is cut into tokens, its tokens fetch the candidate rules, and only those run their regular expression.

Edge cases: a NULL url, or one without ``://``, has an empty host and path, fits no rule and is
allowed; urls of any length are read whole; of rules of one length that fit, a block wins, then the later name;
repeated rows each get their verdict; further columns of the input stay as they are, whatever their names (but
columns named host, path, rule or verdict are replaced by the operator's own); an empty table or rule list gives an
empty result or all-allow.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules up to this number ride in the plan as one literal; more are joined by token.
INLINE_RULES = 2000
#: Rules that a table of them may have; each is some hundred bytes.
MOST_RULES = 200_000

#: The host rules of the production filter.
HOST_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: The pattern rules of the production filter.
PATTERN_RULES = [
    ("block", "^casino^"), ("block", "^free^bets^"), ("block", "^cheap^pills^"), ("block", "^poker^"),
    ("block", "^xxx^"), ("block", "^porn^"), ("block", "^warez^"), ("block", "^torrent^"), ("block", "^phishing^"),
    ("allow", "^responsible^casino^"),
]


def host_rule(verdict: str, host: str, path: str) -> dict:
    """A host rule as regular expression over ``host#path``, with its literal tokens; neither part holds a ``#``."""
    host = host.translate(str.maketrans(UPPER, LOWER))
    whole = [t for t in re.split("[^A-Za-z0-9]+", path.rpartition("/")[0] + "/") if t] if "/" in path else []
    tokens = {t for t in re.split("[^a-z0-9]+", host) + [w.lower() for w in whole] if t}
    return {"name": f"{host}{path}", "kind": 1, "rank": len(host) + len(path), "verdict": verdict, "tokens": tokens,
            "regex": rf"^([^#]*\.)?{re.escape(host)}#{re.escape(path)}"}


def pattern_rule(verdict: str, pattern: str) -> dict:
    """A pattern rule as regular expression over the lower-cased url, with its literal tokens."""
    body, anchored = (pattern[2:], True) if pattern.startswith("||") else (pattern, False)
    regex = "(?s)" + (r"^[^/?#]*://([^/?#]*\.)?" if anchored else "") + "".join(
        ".*" if c == "*" else "(?:[^a-z0-9]|$)" if c == "^" else re.escape(c.lower()) for c in body
    )
    # a separator may be shared by two neighbours in "^a^b^", so it is only looked at where it ends a token
    bounded = re.findall(r"(?:(?<=[^A-Za-z0-9*])|(?<=^)(?=.*))([A-Za-z0-9]+)(?=[^A-Za-z0-9*])", ("/" if anchored else "*") + body + "*")
    return {"name": pattern, "kind": 0, "rank": len(pattern), "verdict": verdict, "tokens": {t.lower() for t in bounded}, "regex": regex}


def read_rules(rules: DataFrame, most: int = MOST_RULES) -> tuple[list[tuple[str, str, str]], list[tuple[str, str]]]:
    """(host rules, pattern rules) of a table (verdict, host, path, pattern): a row with a pattern is a pattern rule, one
    with a host a host rule (NULL path: ``/``); rows with neither, or with another verdict than allow or block, are an
    error, as is a table of over ``most`` rows: rules are sent to all workers."""
    rows = rules.select("verdict", "host", "path", "pattern").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rules")
    for r in rows:
        if r["verdict"] not in ("allow", "block") or not (r["host"] or r["pattern"]):
            raise ValueError(f"no rule: {r.asDict()}")
    return [(r["verdict"], r["host"], r["path"] or "/") for r in rows if not r["pattern"]], [(r["verdict"], r["pattern"]) for r in rows if r["pattern"]]


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty for NULL or a url without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    host = _lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _tokens(c: Column) -> Column:
    return F.filter(F.array_distinct(F.split(_lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+")), lambda t: t != "")


def token_counts(df: DataFrame, tokens: set[str], url_col: str = "url") -> dict[str, int]:
    """How many urls hold each of the rules' tokens; at most len(tokens) rows reach the driver."""
    if not tokens:
        return {}
    found = F.array_intersect(_tokens(F.col(url_col)), F.array(*[F.lit(t) for t in sorted(tokens)]))
    rows = df.select(F.explode(found).alias("t")).groupBy("t").count().collect()
    return {r["t"]: r["count"] for r in rows}


def index_rules(rules: list[dict], counts: dict[str, int]) -> list[dict]:
    """Each rule with its rarest token; a rule without any is filed under '' and always a candidate."""
    return [r | {"token": min(sorted(r["tokens"]), key=lambda t: counts.get(t, 0), default="")} for r in rules]


def _struct(r: dict) -> Column:
    return F.struct(
        F.lit(r["kind"]).alias("kind"), F.lit(r["rank"]).alias("rank"), F.lit(r["verdict"] == "block").alias("block"),
        F.lit(r["name"]).alias("name"), F.lit(r["regex"]).alias("regex"), F.lit(r["token"]).alias("token"),
    )


def filter_urls(df: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES, url_col: str = "url", inline_rules: int = INLINE_RULES) -> DataFrame:
    """df with host, path, rule (the deciding host rule, else NULL) and verdict ('allow' or 'block')."""
    rules = [host_rule(*r) for r in host_rules] + [pattern_rule(*r) for r in pattern_rules]
    rules = index_rules(rules, token_counts(df, set().union(*[r["tokens"] for r in rules]) if rules else set(), url_col))
    host, path = url_parts(F.col(f"`{url_col}`"))
    kept = [F.col("_row")[c].alias(c) for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    base = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), host.alias("host"), path.alias("path"), F.col(f"`{url_col}`").alias("_url"))
    if not rules:
        return base.select(*kept, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    subject = lambda c: F.when(c["kind"] == 1, F.concat_ws("#", "host", "path")).otherwise(_lower(F.coalesce(F.col("_url"), F.lit(""))))
    tokens = F.array_append(_tokens(F.col("_url")), F.lit(""))
    if len(rules) <= inline_rules:
        by_token: dict[str, list[dict]] = {}
        for r in rules:
            by_token.setdefault(r["token"], []).append(r)
        index = F.create_map(*[x for t, rs in sorted(by_token.items()) for x in (F.lit(t), F.array(*[_struct(r) for r in rs]))])
        fetched = F.flatten(F.filter(F.transform(tokens, lambda t: F.try_element_at(index, t)), lambda x: x.isNotNull()))
        fits = F.filter(fetched, lambda c: F.regexp_like(subject(c), c["regex"]))
        out = base.withColumn("_fits", fits)
    else:
        spark: SparkSession = df.sparkSession
        rows = [(r["token"], (r["kind"], r["rank"], r["verdict"] == "block", r["name"], r["regex"], r["token"])) for r in rules]
        listed = spark.createDataFrame(rows, "_token string, _rule struct<kind:int,rank:int,block:boolean,name:string,regex:string,token:string>")
        hit = (
            base.select("host", "path", "_url").distinct().withColumn("_token", F.explode(tokens)).join(listed, "_token")
            .filter(F.regexp_like(subject(F.col("_rule")), F.col("_rule.regex")))
            .groupBy("_url").agg(F.max(F.struct(*_order(F.col("_rule")), F.col("_rule").alias("r"))).alias("_best"))
        )
        best = hit.select(F.col("_url").alias("_u"), F.array(F.col("_best.r")).alias("_fits"))
        out = base.join(best, F.col("_url").eqNullSafe(F.col("_u")), "left").withColumn("_fits", F.coalesce("_fits", F.array().cast("array<struct<kind:int,rank:int,block:boolean,name:string,regex:string,token:string>>")))
    best = F.array_max(F.transform("_fits", lambda c: F.struct(*_order(c), c.alias("r"))))["r"]
    out = out.withColumn("_best", best)
    return out.select(
        *kept, "host", "path",
        F.when(F.col("_best.kind") == 1, F.col("_best.name")).alias("rule"),
        F.when(F.col("_best.block"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
    )


def _order(c: Column) -> list[Column]:
    """Host rules before pattern rules, then the longest; at a tie a block wins, then the name."""
    return [c["kind"].alias("kind"), c["rank"].alias("rank"), c["block"].alias("block"), c["name"].alias("name")]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
WITH r AS (SELECT page_id, lower(coalesce(url, '')) AS u,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
q AS (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(u, '[^a-z0-9]responsible[^a-z0-9]casino([^a-z0-9]|$)') THEN 'allow'
    WHEN regexp_matches(u, '[^a-z0-9](casino|free[^a-z0-9]bets|cheap[^a-z0-9]pills|poker|xxx|porn|warez|torrent|phishing)([^a-z0-9]|$)') THEN 'block'
    ELSE 'allow' END AS verdict FROM q
"""
