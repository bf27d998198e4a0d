"""Benchmark decontamination: a broadcast hash set of normalised test n-grams (native DataFrame functions only).

Benchmark items and documents are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII
characters. A window is ten consecutive item words, or the whole item where it has fewer (but not none).
Every document position's window hash is looked up in the set of item windows; a hit is verified word
by word. The set is broadcast only while it is under ``broadcast_windows`` windows and ``BROADCAST_BYTES``;
beyond that Spark joins positions (row, place, size and hash alone) with it by shuffle, and what is found is
verified at the documents. ``mode`` drops contaminated documents, cuts the hit words out, or only marks.

Edge cases: NULL or empty text has no words and no hits; texts of any length are read whole; an empty benchmark
gives no hits; repeated rows each get their own result; items with equal windows are all named; items without an id are
one item of the empty id. Further columns
stay as they are, whatever their names; only ``mark`` puts n_words, hits and items in the place of input columns of
these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import staged, table

WINDOW = 10
BROADCAST_WINDOWS, BROADCAST_BYTES = 2_000_000, 256_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of a lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAPS), lambda w: w != "")


def item_windows(benchmark: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, size, gram words, hash) of the benchmark."""
    w = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("_w")).filter(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (n - 1), F.lit(1)))
    return w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("_w", i, n))).alias("gram")).distinct().select(
        "item_id", F.size("gram").alias("size"), "gram", F.xxhash64("gram").alias("hash")
    )


def _covered(hits: Column) -> Column:
    """Words inside any of the (start, size) hits, which are sorted by start."""
    return F.aggregate(
        hits, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, h: F.struct(F.greatest(a["end"], h["pos"] + h["size"]).alias("end"), (a["n"] + F.greatest(F.lit(0), h["pos"] + h["size"] - F.greatest(a["end"], h["pos"]))).alias("n")),
        lambda a: a["n"],
    )


def _position(m: int):
    return lambda i: F.struct(i.alias("pos"), F.lit(m).alias("size"), F.xxhash64(F.slice("_w", i, m)).alias("hash"))


def _grams(benchmark: DataFrame, n: int, broadcast_windows: int) -> tuple[DataFrame, list[int], bool]:
    """Item windows with their items' texts, the windows' sizes (at most n), and whether the set may be broadcast."""
    grams = item_windows(benchmark, n).groupBy("gram", "size", "hash").agg(F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items"))
    length = F.length(F.array_join("gram", " ")) + F.length(F.array_join("items", " ")) + 100
    seen = grams.agg(F.count("*").alias("n"), F.sum(length.cast("double")).alias("bytes"), F.collect_set("size").alias("sizes")).first()
    small = seen["n"] <= broadcast_windows and (seen["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(grams) if small else grams, sorted(seen["sizes"]), small


def _places(sizes: list[int]) -> list[Column]:
    """For each window size an array of (pos, size, hash) of the document's windows, from the array _w."""
    out = []
    for m in sizes:
        at = F.when(F.size("_w") >= m, F.sequence(F.lit(1), F.size("_w") - (m - 1))).otherwise(F.array().cast("array<int>"))
        out.append(F.transform(at, _position(m)))
    return out


def _same(at: Column, size: Column, gram: Column) -> Column:
    # coalesce: a plain equality would become a key of the join, made for every position
    return F.coalesce(F.slice("_w", F.greatest(at, F.lit(1)), F.greatest(size, F.lit(1))) == gram, F.lit(False))


def _marked(df: DataFrame, benchmark: DataFrame, n: int, keep: list[str], text_col: str, broadcast_windows: int) -> DataFrame:
    """(_row struct of the ``keep`` columns, n_words, hits, items), one row for each row of df."""
    grams, sizes, small = _grams(benchmark, n, broadcast_windows)
    w = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), words(F.col(text_col)).alias("_w")).withColumn("_id", F.monotonically_increasing_id())
    if not small:
        w = staged(w, "words")
        at = w.select("_id", F.explode_outer(F.concat(*_places(sizes))).alias("_p")).select("_id", F.col("_p.pos").alias("pos"), F.col("_p.size").alias("size"), F.col("_p.hash").alias("hash"))
        met = at.join(grams, ["hash", "size"]).groupBy("_id").agg(F.collect_list(F.struct("pos", "size", "gram", "items")).alias("_met"))
        true = F.filter("_met", lambda m: _same(m["pos"], m["size"], m["gram"]))
        hits = F.array_sort(F.array_distinct(F.transform(true, lambda m: F.struct(m["pos"].alias("pos"), m["size"].alias("size")))))
        items = F.array_sort(F.array_distinct(F.flatten(F.transform(true, lambda m: m["items"]))))
        none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
        return w.join(met, "_id", "left").select("_row", F.size("_w").cast("long").alias("n_words"), none(hits, "array<struct<pos:int,size:int>>").alias("hits"), none(items, "array<string>").alias("items"))
    start = F.lit(0)  # the word before the first; its row stands for the document
    positions = [F.array(F.struct(start.alias("pos"), F.lit(0).alias("size"), F.lit(None).cast("long").alias("hash"))), *_places(sizes)]
    found = (
        w.withColumn("_at", F.concat(*positions)).select("_id", "_row", "_w", F.explode_outer("_at").alias("_p"))
        .select("_id", "_row", "_w", F.col("_p.pos").alias("pos"), F.col("_p.size").alias("_size"), F.col("_p.hash").alias("_hash"))
        .join(grams, F.col("_hash") == grams["hash"], "left")
        .filter((F.col("pos") == 0) | (F.col("gram").isNotNull() & _same(F.col("pos"), F.col("_size"), F.col("gram"))))
        .select(
            "_id", F.when(F.col("pos") == 0, F.struct("_row", F.size("_w").cast("long").alias("n_words"))).alias("_doc"),
            F.when(F.col("pos") > 0, F.struct("pos", F.col("_size").alias("size"))).alias("_hit"), F.col("items").alias("_items"),
        )
    )
    grouped = found.groupBy("_id").agg(
        F.first("_doc", ignorenulls=True).alias("_doc"), F.array_sort(F.collect_set("_hit")).alias("hits"), F.collect_set("_items").alias("_items")
    )
    return grouped.select("_doc._row", F.col("_doc.n_words").alias("n_words"), "hits", F.array_sort(F.array_distinct(F.flatten("_items"))).alias("items"))


def mark(df: DataFrame, benchmark: DataFrame, n: int = WINDOW, keep: list[str] | None = None, text_col: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row for each row of df: its ``keep`` columns, n_words, hits (array of (pos, size), by pos) and items (sorted texts).

    The documents are scanned once. Positions carry only a hash until one is found in the item windows;
    what is shuffled is the found positions and one row of the ``keep`` columns for each document.
    """
    keep = df.columns if keep is None else keep
    marked = _marked(df, benchmark, n, keep or df.columns[:1], text_col, broadcast_windows)
    own = ("n_words", "hits", "items")
    return marked.select(*[F.col("_row")[c].alias(c) for c in keep if c.lower() not in own], *own)


def decontaminate(df: DataFrame, benchmark: DataFrame, n: int = WINDOW, mode: str = "drop", text_col: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """df without contaminated documents (``drop``), or with the hit words taken out of their texts (``cut``)."""
    if mode not in ("drop", "cut"):
        raise ValueError(f"unknown mode {mode!r}")
    columns = df.columns
    marked = _marked(df, benchmark, n, columns, text_col, broadcast_windows)
    if mode == "drop":
        return marked.filter(F.size("hits") == 0).select(*[F.col("_row")[c].alias(c) for c in columns])
    text = F.col("_row")[text_col]
    found = F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    first_is_word = F.coalesce(F.regexp_like(F.get("_runs", F.lit(0)), F.lit(r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")), F.lit(False)).cast("int")
    # run r (from 0) is word number (r + first_is_word) / 2 + (1 - first_is_word)... counted from 1 where the parity fits
    number = lambda r: ((r + F.lit(2) - F.col("_first")) / 2).cast("int")
    is_word = lambda r: ((r + F.col("_first")) % 2) == 1
    hit = lambda r: is_word(r) & F.exists("hits", lambda h: (h["pos"] <= number(r) + F.col("_first")) & (number(r) + F.col("_first") < h["pos"] + h["size"]))
    kept = F.array_join(F.filter(F.transform("_runs", lambda x, r: F.when(~hit(r), x)), lambda x: x.isNotNull()), "")
    out = marked.withColumn("_runs", found).withColumn("_first", first_is_word).withColumn("_cut", F.when(F.size("hits") == 0, text).otherwise(kept))
    return out.select(*[F.col("_cut").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in columns])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    n_hit = _covered(F.col("hits")).cast("long")
    return mark(docs.select("doc_id", "text"), items, keep=["doc_id"]).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


OP10_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bg AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i+least(len(w), 10)-1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM bg),
dg AS (SELECT r, m, i, array_to_string(w[i:i+m-1], ' ') AS g FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, sizes WHERE len(w) >= m)),
hits AS (SELECT dg.r, dg.m, dg.i, bg.item_id FROM dg JOIN bg ON dg.m = bg.m AND dg.g = bg.g),
hw AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT r, i, m FROM hits)) GROUP BY r),
it AS (SELECT r, count(*) AS n, string_agg(t, ',' ORDER BY t) AS s FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS t FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hw.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
    sha256(coalesce(it.s, '')) AS items_sha256, hw.n IS NOT NULL AS contaminated
FROM dw LEFT JOIN hw USING (r) LEFT JOIN it USING (r)
"""
