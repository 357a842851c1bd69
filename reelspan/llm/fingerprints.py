"""MinHash fingerprints of documents.

A fingerprint is one byte of each of ``PERMUTATIONS`` universal hash functions'
least value over the text's five-word shingles, in hexadecimal. Two texts'
likeness is the share of equal bytes, corrected for chance, which estimates the
Jaccard similarity of their shingles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .near_dedup import PART_BYTES, confirm_pairs, shingle_sets
from .runtime import dealt_join, materialize, partitions, pieces, text_key
from .textkit import U64, chunks, minhash, mix, shingles, universal, words

PERMUTATIONS = 128
SHINGLE = 5
#: Bands that a signature is cut into.
BANDS = 32
#: Classes of a bucket that one task holds against as many others of it.
MEMBERS = 1024
_PAIR = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double"


def signatures(texts: list[bytes], count: int = PERMUTATIONS, k: int = SHINGLE) -> np.ndarray:
    """A byte per text and hash function."""
    values, first = shingles(words(texts), k)
    return (mix(minhash(values, first, *universal(count, 9))) >> U64(56)).astype(np.uint8)


def fingerprint_strings(texts: list[str]) -> list[str]:
    """Fingerprints of texts; that of a text without words is empty."""
    coded = [t.encode() for t in texts]
    return [s.tobytes().hex() if c.split() else "" for s, c in zip(signatures(coded), coded, strict=True)]


def like(a: str, b: str) -> float:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1. Equal ones have 1;
    a text without words is like no other."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    same = int((np.frombuffer(bytes.fromhex(a), np.uint8) == np.frombuffer(bytes.fromhex(b), np.uint8)).sum())
    return max(0.0, (same / PERMUTATIONS - 1 / 256) / (1 - 1 / 256))


def edited(text: str, after: str) -> str:
    """The text with its last half replaced by the start of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of each row. Null texts count as empty; repeated rows
    and null ids keep a row each; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), lambda r: len(r[1] or "")):
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(fingerprint_strings([r[1] or "" for r in rows]))], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def _described(rows: list[tuple]) -> pa.RecordBatch:
    """(doc_id, text, next doc's text) to the columns of ``_PAIR``."""
    changed = [edited(text, after) for _, text, after in rows]
    prints = fingerprint_strings([r[1] for r in rows] + changed)
    own, other = prints[: len(rows)], prints[len(rows) :]
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()),
        "n_chars": pa.array([len(r[1]) for r in rows], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        "fingerprint": pa.array(own),
        "edited_fingerprint": pa.array(other),
        "near_edited": pa.array(list(map(like, own, other)), pa.float64()),
    })


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in ascending order to ``_PAIR`` rows, each with the next row of its task;
    besides, the task's first (kind 1) and last row (kind 2) with their texts."""
    part = TaskContext.get().partitionId()

    def ends(kind: int, doc, text) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int64()), "doc_id": pa.array([doc], pa.int64()), "text": pa.array([text]), "n_chars": pa.nulls(1, pa.int64()), **{c: pa.nulls(1, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}, **{c: pa.nulls(1, pa.float64()) for c in ("near_edited", "near_next")}})

    def full(rows: list[tuple]) -> pa.RecordBatch:
        # one row more than is put out: the last gives the next fingerprint only
        own = _described([(a[0], a[1], b[1]) for a, b in zip(rows, rows[1:], strict=False)] + [(rows[-1][0], rows[-1][1], "")])
        n = len(rows) - 1
        prints = own.column("fingerprint").to_pylist()
        own = own.slice(0, n)
        nexts = pa.array(list(map(like, prints, prints[1:])), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int64()), own.column(0), pa.nulls(n, pa.string()), *own.columns[1:], nexts], ["kind", "part", "doc_id", "text", *own.schema.names[1:], "near_next"])

    last = None
    for batch in batches:
        for rows in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), lambda r: len(r[1])):
            if last is None:
                yield ends(1, *rows[0])
            else:
                rows.insert(0, last)
            last = rows[-1]
            if len(rows) > 1:
                yield full(rows)
    if last is not None:
        yield ends(2, *last)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The next document is that of the next larger id, after the last the first;
    ids that are equal follow one another by text, null ids come first, and a
    single row is its own next. Null texts count as empty. Rows are dealt out by
    ranges of the id, so a task's rows follow one another; only the last row of a
    task needs the first row of the next, and finds it by a join of such rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # beside the id, a digest of the row splits a run of equal ids among tasks
    ordered = source.withColumn("_tie", F.xxhash64("text")).repartitionByRange(partitions(pieces(source, 16 << 20)), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    schema = f"kind int, part long, doc_id long, text string, {_PAIR.removeprefix('doc_id long, ')}, near_next double"
    rows = materialize(ordered.mapInArrow(_along, schema), "fingerprints", "kind")
    # a row per task: their order is a window over as many rows as there were tasks
    heads = rows.filter("kind = 1").select("part")
    order = Window.orderBy("part")
    follows = heads.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("_follows"))
    after = rows.filter("kind = 1").select(F.col("part").alias("_follows"), F.col("text").alias("after"))
    seams = rows.filter("kind = 2").select("part", "doc_id", "text").join(follows, "part").join(after, "_follows").select("doc_id", "text", "after")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = _described([r])
                near = like(own.column("fingerprint")[0].as_py(), fingerprint_strings([r[2]])[0])
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array([near], pa.float64())], [*own.schema.names, "near_next"])

    bridged = seams.mapInArrow(joined, f"{_PAIR}, near_next double")
    return rows.filter("kind = 0").select(*bridged.columns).unionByName(bridged)


def least_equal(threshold: float) -> int:
    """Two sets as similar as ``threshold`` have fewer equal bytes with probability 1e-9 at most."""
    p, below = threshold + (1 - threshold) / 256, 0.0
    for n in range(PERMUTATIONS):
        below += math.comb(PERMUTATIONS, n) * p**n * (1 - p) ** (PERMUTATIONS - n)
        if below > 1e-9:
            return n
    return PERMUTATIONS


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_key, a digest of the shingle set and the signature of each text with words."""
    for batch in batches:
        for rows in chunks(zip(*(c.to_pylist() for c in batch.columns), strict=True), lambda r: len(r[2])):
            rows = [(*r[:2], r[2].encode()) for r in rows if r[2].encode().split()]
            if rows:
                texts = [r[2] for r in rows]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in shingle_sets(texts, SHINGLE, False)]
                own = [s.tobytes() for s in signatures(texts)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(digests, pa.binary()), pa.array(own, pa.binary())], ["doc_id", "text_key", "digest", "signature"])


def _alike(least: int):
    """The pairs (a, b) of a bucket's two parts (or of one) whose signatures have ``least``
    equal bytes or more, each in the first band that it shares."""

    def run(table: pa.Table) -> pa.Table:
        ids, side = table.column("id").to_numpy(), table.column("side").to_numpy()
        band, low, high = (table.column(c)[0].as_py() for c in ("band", "low", "high"))
        signed = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)
        bases, a, b = np.flatnonzero(side == low), [], []
        for i in np.flatnonzero(side == high):
            base = bases[ids[bases] < ids[i]] if low == high else bases
            same = signed[base] == signed[i]
            near = same.sum(axis=1) >= least
            shared = same[near].reshape(-1, BANDS, PERMUTATIONS // BANDS).all(axis=2)
            found = ids[base[near][shared[:, band] & (shared.argmax(axis=1) == band)]]
            a.append(np.minimum(found, ids[i]))
            b.append(np.maximum(found, ids[i]))
        return pa.table({c: pa.array(np.concatenate([np.empty(0, np.int64), *v]), pa.int64()) for c, v in (("a", a), ("b", b))})

    return run


def similar_pairs(docs: DataFrame, numerator: int = 4, denominator: int = 5, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, class_id) of each row whose text has words, and the linked (a, b) of the
    classes, a < b. A class has the texts of one set of distinct shingles, and any
    number for an id; two are linked if denominator * intersection >= numerator * union
    of their sets.

    Signatures of classes are cut into ``BANDS`` bands of equal bytes and those that
    share a band are joined: buckets are cut into parts of about ``MEMBERS``, each two
    parts meet in a task, and a task hands on only pairs whose whole signatures are
    near. Those are verified on full shingle sets. At similarity 0.8 bands and
    signatures miss a pair with probability 5e-8, at 0.5 with 0.13. Null texts count
    as empty and have no class, as texts without words; null ids and rows that repeat
    an id count as rows of their own, other columns are ignored, and an empty table
    gives two empty results.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ship_package(docs.sparkSession)
    signed = materialize(source.mapInArrow(_signed, "doc_id long, text_key long, digest binary, signature binary"), "signatures")
    first = signed.groupBy("digest").agg(F.min(F.struct("text_key", "doc_id", "signature")).alias("first"))
    classes = materialize(first.select("digest", "first.*", F.monotonically_increasing_id().alias("id")), "classes")
    rows = signed.select("doc_id", "text_key", "digest")
    sizes = rows.groupBy("digest").agg(F.count("*").alias("rows"))
    members = dealt_join(rows, classes.select("digest", F.col("id").alias("class_id")), "digest", ["doc_id", "text_key"], sizes, pieces(rows, PART_BYTES)).select("doc_id", "class_id")

    width = PERMUTATIONS // BANDS
    bands = F.array(*(F.struct(F.lit(i).alias("band"), F.xxhash64(F.substring("signature", 1 + i * width, width)).alias("key")) for i in range(BANDS)))
    keyed = classes.select("id", "signature", F.explode(bands).alias("k")).select("id", "signature", "k.*")
    parts = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").select("band", "key", F.ceil(F.col("n") / MEMBERS).cast("int").alias("parts"))
    dealt = keyed.join(parts, ["band", "key"]).withColumn("side", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("band", "key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "id", "signature")
    near = materialize(dealt.groupBy("band", "key", "low", "high").applyInArrow(_alike(least_equal(numerator / denominator)), "a long, b long"), "near-pairs")

    asked = classes.join(near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi").select("id", F.col("doc_id").alias("rep"), F.col("text_key").alias("rep_key"))
    texts = source.join(asked, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_key") == F.col("rep_key"))).groupBy("id").agg(F.first("text").alias("text"))
    return members, confirm_pairs(near, materialize(texts, "texts"), numerator, denominator, SHINGLE, False).filter("linked").select("a", "b")
