"""A corpus in five stages: toxic documents go, of equal texts one stays, of near
copies one stays, passages that earlier documents hold are taken out, and what is
left is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return the columns of documents. Stages are written as
Parquet below the shared folder and read again by the next; what a stage has
written for itself goes once its result stands.

Null texts count as empty and are clean, unlike anything but one another (exact
dedup keeps one of them). Rows that repeat an id are judged each by its own text;
of equal rows all stay or go together. Rows with a null id are never dropped as
copies, change nothing in others and are packed like any. Columns beside those
of documents pass through unchanged, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.llm import exact_dedup, near_dedup, packing, substring_dedup, toxicity
from reelspan.llm.runtime import materialize, scratch_tables


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more; fitted on the labels of rows that
    are not held out, among the documents given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit_on(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 or more over five-word shingles, the row
    with the smallest id."""
    return near_dedup.drop_near_duplicates(docs, numerator=4, denominator=5)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of 50 words or more that a document with a smaller id holds."""
    out = substring_dedup.drop_repeated_passages(docs, window=50)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 4096 tokens."""
    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", drop_passages),
    ("packing", pack),
]

#: Classifying and packing aren't SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch_tables() as made:
            docs = made.keep(materialize(stage(spark, docs, sf_dir), name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
