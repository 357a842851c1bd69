"""The corpus operators as queries over the test tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat_format, exact_dedup, fingerprints, html_extract, near_dedup, packing, substring_dedup, token_counts, toxicity

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit_on(docs, _read(spark, sf_dir, "labels"))
    return toxicity.toxicity_scores(docs, model).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_passages(_read(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), capacity=4096, end_id=1, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), limit=2048)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"), numerator=85, denominator=100)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_read(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(_read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_read(spark, sf_dir, "documents"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_messages(_read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_substring_dedup, op3_best_fit_packing, op4_token_counts, op5_html_extraction, op6_minhash_near_dedup, op7_exact_dedup, op8_byte_bpe, op9_fingerprints, op10_chat_formatting)}

_SPACES = r"[\x20\x09-\x0D]+"
_WORDS = rf"list_filter(regexp_split_to_array(coalesce({{}}, ''), '{_SPACES}'), lambda x: x <> '')"

ORACLE_SQL = {
    "op2_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS low FROM g GROUP BY s),
hit AS (SELECT g.doc_id, g.i FROM g JOIN m USING (s) WHERE m.low < g.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hit),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT p.doc_id, count(*) AS n, string_agg(w[p.p], ' ' ORDER BY p.p) AS t FROM p LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.p = p.p WHERE gone.p IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op6_minhash_near_dedup": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS MATERIALIZED (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id, d.doc_id <= coalesce(low.b, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op10_chat_formatting": """
SELECT conv_id, turn, coalesce(role, 'user') AS role, turn AS order_turn, CAST(0 AS INTEGER) AS order_rank, CAST(0 AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_invalid,
CAST(NULL AS BOOLEAN) AS linked, CAST(json_object('content', coalesce(text, ''), 'role', coalesce(role, 'user')) AS VARCHAR) AS message
FROM conversations""",
}
