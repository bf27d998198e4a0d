"""A corpus pipeline of five stages: toxicity, near-duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept. All but
the last return the columns of documents. A stage that drops documents looks at its own input alone;
labels and benchmark come from sf_dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import decontamination, near_copies, packing, suffix_dedup, toxicity
from flowloom.llm.common import discard, scratch, staged, table
from flowloom.llm.learning import crc_mod


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; the model learns from the same rows as op3's."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), held_out=crc_mod(F.col("doc_id"), 4) == 2)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a five-word Jaccard similarity of 0.8 or more, that with the smallest id stays."""
    return near_copies.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that an earlier document has are cut out; n_chars follows the text."""
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of 2048 ids."""
    return packing.pack(docs, with_ids=False).drop("ids")


STAGES = [
    ("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("suffix_dedup", cut_repeats), ("decontamination", drop_contaminated), ("packing", pack),
]
#: No stage but decontamination can be said in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again, and what it was made from deleted."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch():
            kept = staged(stage(spark, docs, sf_dir), name, keep=True)
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
