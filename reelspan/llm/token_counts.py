"""Token counts through a cache of content digests.

A text's key is the digest of its normalised content; with the digest of the
tokenizer's version it names a stored count. Texts whose key is not stored are
encoded, each distinct content once, and their counts are appended.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import dealt_join, materialize, partitions, pieces, scratch_path
from .textkit import chunks
from .tokenise import Vocabulary, encoder

CACHE = "tokenizer string, digest string, n_tokens long"


def content_digest(text: Column) -> Column:
    """Digest of a text as it is counted: null is empty, nothing else changes.

    Any stronger normalisation would have to be one that no tokenizer's count
    depends on.
    """
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def stored_counts(spark, path: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) stored for a tokenizer, each digest once, however often runs
    have stored it; none where nothing was stored yet."""
    try:
        stored = spark.read.schema(CACHE).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.filter(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is a vocabulary file, ``cache`` the Parquet folder of counts,
    by default one that starts empty. Each run appends a folder of its own there,
    so runs at once don't disturb each other and a digest may be stored twice.
    Null texts count as empty (0 tokens). Repeated rows, ties and null ids each
    keep their own row. A text is never cut. Other columns are ignored, whatever
    their names. An empty table gives an empty result and adds no counts.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary.load(spark, tokenizer)
    cache = cache or scratch_path(spark, "token-cache")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = materialize(docs.select(F.col(id_col).alias("doc_id"), content_digest(F.col(text_col)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")), "counts-keyed")
    # one row stands for each missing content; only digests and ids are shuffled to find it
    contents = materialize(keyed.groupBy("digest").agg(F.min("doc_id").alias("_id"), F.count("*").alias("rows")), "counts-contents")
    misses = contents.select("digest", "_id").join(stored_counts(spark, cache, vocabulary.digest), "digest", "left_anti")
    # rows meet by digest and id, so copies are dealt out; as many partitions as keep the keys of each few
    n = partitions(pieces(docs.select(id_col, text_col), 16 << 20))
    wanted = misses.select(F.xxhash64("digest", "_id").alias("_key")).repartition(n, "_key")
    texts = docs.select(content_digest(F.col(text_col)).alias("_digest"), F.col(id_col).alias("_doc"), text.alias("text"))
    texts = texts.select("_digest", "text", F.xxhash64("_digest", "_doc").alias("_key")).repartition(n, "_key")
    first = texts.join(wanted.hint("shuffle_hash"), "_key", "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(vocabulary), set()
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for part in chunks((r for r in rows if r[0] not in seen and not seen.add(r[0])), lambda r: len(r[1])):
                n = [len(x) // 4 for x in encode.ids([r[1] for r in part])]
                yield pa.RecordBatch.from_pydict({"tokenizer": pa.array([vocabulary.digest] * len(n)), "digest": pa.array([r[0] for r in part]), "n_tokens": pa.array(n, pa.int64())})

    first.select("_digest", "text").mapInArrow(count, CACHE).write.parquet(f"{cache}/{uuid.uuid4().hex}")
    known = stored_counts(spark, cache, vocabulary.digest)
    counted = dealt_join(keyed, known, "digest", ["doc_id"], contents, pieces(keyed, 16 << 20))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
