"""Document fingerprints: bottom-k sketches of shingle hashes (native DataFrame functions only).

A document's words are lower-cased (A-Z) runs free of white space; its shingles are five words long (a
shorter document has one shingle, of all its words; one without words has none). The sketch keeps the k
smallest distinct 64-bit hashes. Two sketches merge by taking the k smallest of their union; the union's
k smallest estimate resemblance, the k-th hash estimates the number of distinct shingles, and both give
containment.

Edge cases: NULL text counts as empty; texts of any length are read whole; equal texts have equal fingerprints; two
empty sketches have resemblance 1, an empty and another one 0. In op8's query, rows with a NULL doc_id come first,
rows with the same doc_id follow each other in an order that a hash decides, and an empty table gives an empty
result. ``fingerprint_documents`` keeps the other columns, but puts sketch, fingerprint and n_shingles in the place of
columns of these names; ``with_successor`` keeps all but those that it is told to write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.llm.common import fine_buckets, staged, table

K, SHINGLE = 128, 5
#: Buckets of consecutive ids at most, and ids with buckets of their own, the most frequent first.
BUCKETS, HOT_IDS = 1_000_000, 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cased words between white space."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """A hash for each shingle of the text."""
    return F.transform(F.array(words(text)), lambda w: F.when(F.size(w) == 0, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, size)))
    ))[0]


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The k smallest distinct shingle hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, size))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all: exact while both documents have at most k/2."""
    union = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, from resemblance and the two counts."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1 + j) / na))


def as_text(a: Column) -> Column:
    """16 hex digits for each hash, smallest hash first."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprint_documents(df: DataFrame, k: int = K, size: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """df with its sketch (array of long), fingerprint (text) and n_shingles (estimate)."""
    out = df.withColumn("sketch", sketch(F.col(text_col), k, size))
    return out.withColumns({"fingerprint": as_text(F.col("sketch")), "n_shingles": distinct_shingles(F.col("sketch"), k)})


def _dealt(df: DataFrame, rows_per_bucket: int) -> DataFrame:
    """df (with columns _id and _tie) with _bucket (struct, in the order of the ids) and _guest.

    Buckets are ranges of ids; an id (NULL too) with more rows than two buckets hold is the last of its range and has
    buckets of its own. The rows of one id follow each other by _tie, a hash that names the row and is the same each
    time df is read. The first row of each bucket also goes to the bucket before it, as a guest (the first bucket's to
    the last), so that each row meets its successor within a bucket.
    """
    ids = df.select("_id", "_tie")
    rows_per_bucket = max(rows_per_bucket, ids.count() // BUCKETS)  # so many buckets at most: their first rows are broadcast
    hot = ids.groupBy("_id").count().filter(F.col("count") > 2 * rows_per_bucket).orderBy(F.desc("count")).limit(HOT_IDS)
    hot = [(r["_id"], -(-r["count"] // rows_per_bucket)) for r in hot.collect()]
    coarse, fine = fine_buckets(ids, "_id", rows_per_bucket, last=[i for i, _ in hot if i is not None])
    pieces = F.broadcast(df.sparkSession.createDataFrame(hot, "_hot long, _pieces long"))
    placed = df.join(pieces, F.col("_id").eqNullSafe(F.col("_hot")) & F.col("_pieces").isNotNull(), "left") if hot else df.withColumns({"_hot": F.lit(None), "_pieces": F.lit(None).cast("long")})
    piece = F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(1 + F.floor((F.shiftright("_tie", 32) + F.lit(2.0**31)) / 2**32 * F.col("_pieces"))).cast("long")
    placed = placed.withColumn("_bucket", F.struct(coarse.cast("long").alias("coarse"), fine.alias("fine"), piece.alias("piece"))).drop("_hot", "_pieces")
    none = F.struct(F.col("_id").isNotNull().alias("some"), "_id", "_tie")
    firsts = staged(placed.groupBy("_bucket").agg(F.min(none).alias("first")), "buckets")
    ends = sorted((r["last"]["coarse"], r["last"]) for r in firsts.groupBy("_bucket.coarse").agg(F.max("_bucket").alias("last")).collect())  # one row a coarse bucket
    before = [(c, tuple(ends[i - 1][1])) for i, (c, _) in enumerate(ends)]
    before = F.broadcast(df.sparkSession.createDataFrame(before, "coarse long, _end struct<coarse:long,fine:long,piece:long>"))
    earlier = F.lag("_bucket").over(Window.partitionBy("_bucket.coarse").orderBy("_bucket"))
    ring = firsts.withColumn("_earlier", earlier).join(before, F.col("_bucket.coarse") == F.col("coarse")).select(F.col("first._id").alias("_first"), F.col("first._tie").alias("_first_tie"), F.coalesce("_earlier", "_end").alias("_goes"))
    stays = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("guest"))
    goes = F.struct(F.col("_goes").alias("b"), F.lit(True).alias("guest"))
    return (
        placed.join(F.broadcast(ring), F.col("_id").eqNullSafe(F.col("_first")) & (F.col("_tie") == F.col("_first_tie")), "left")
        .withColumn("_to", F.explode(F.when(F.col("_goes").isNotNull(), F.array(stays, goes)).otherwise(F.array(stays))))
        .withColumns({"_bucket": F.col("_to.b"), "_guest": F.col("_to.guest")}).drop("_to", "_first", "_first_tie", "_goes")
    )


def _by_id():
    return Window.partitionBy("_bucket").orderBy("_guest", F.col("_id").asc_nulls_first(), "_tie")


def with_successor(df: DataFrame, columns: dict[str, str], id_col: str = "doc_id", rows_per_bucket: int = 500) -> DataFrame:
    """df with columns of the next row in id order (NULL first; the last row's next is the first).

    Rows move once, to buckets of about rows_per_bucket rows; a window of each bucket finds the successors.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(F.monotonically_increasing_id()).alias("_tie"))
    rows = staged(rows, "rows")
    found = _dealt(rows, rows_per_bucket).withColumns({f"_{i}": F.lead(F.col("_row")[c]).over(_by_id()) for i, c in enumerate(columns)}).filter(~F.col("_guest"))
    kept = [F.col("_row")[c].alias(c) for c in df.columns if c not in columns.values()]
    return found.select(*kept, *[F.col(f"_{i}").alias(n) for i, n in enumerate(columns.values())])


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")  # of the row in its file, however files are split
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("_id"), place.alias("_tie"), F.coalesce("text", F.lit("")).alias("text"))
    paired = _dealt(docs, 500).withColumn("_next", F.lead("text").over(_by_id()))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = paired.withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "_edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    )
    sketched = edited.select(
        "_bucket", "_guest", "_id", "_tie", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("_own"), F.when(~F.col("_guest"), sketch(F.col("_edited"))).alias("_changed"),
    )
    return sketched.withColumn("_after", F.lead("_own").over(_by_id())).filter(~F.col("_guest")).select(
        F.col("_id").alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("_own")).alias("fingerprint"), as_text(F.col("_changed")).alias("edited_fingerprint"),
        resemblance(F.col("_own"), F.col("_changed")).alias("near_edited"), resemblance(F.col("_own"), F.col("_after")).alias("near_next"),
    )
