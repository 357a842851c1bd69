"""Near duplicates: MinHash bands propose, odd sketches estimate, full sets confirm.

Texts with equal shingle sets form a class; only one text of a class goes on. Its
MinHash samples give band keys and, folded into a parity bitmap, an odd sketch:
the population count of two sketches' XOR estimates their similarity closely
where it is high. In each band bucket every member is first held against the
bucket's first one. Buckets whose members are linked by then are done. Those of
more than ``PROBES`` members that are not give way to buckets of longer keys over
many more samples. In what is still mixed, members of different components are
held against each other in tasks of a bounded size, which confirm on full sets
what the sketches let through and hand on only links that join components. So a
large group of near copies costs about one comparison a member, and no link
between different texts is given up.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .components import components
from .runtime import dealt_join, materialize, pieces, scratch_tables, text_key, without
from .textkit import LOWER, U64, chunks, minhash, mix, shingles, universal, words

#: MinHash samples in a sketch; the first BANDS * ROWS also make the band keys.
#: At similarity 0.85 all bands miss a pair with probability 4e-7, at 0.8 3e-5.
SAMPLES, BANDS, ROWS = 128, 20, 4
SKETCH_BITS = 512
#: Samples of the longer keys for members of large buckets that stay mixed: at similarity
#: 0.85 all of them miss a pair with probability 5e-12, at 0.8 6e-6.
LONG_BANDS, LONG_ROWS = 170, 12
#: Members of a bucket, and bytes of their sets, that one task holds against as many others of it.
PROBES, SET_BYTES = 4096, 24 << 20
#: Stored bytes of the parts that a hot component's or set's rows are dealt to.
PART_BYTES = 16 << 20
_SKETCH = "doc_id long, text_key long, n_shingles long, digest binary, bands array<long>, sketch array<long>"


def shingle_sets(texts: list[bytes], k: int, lower: bool) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    values, first = shingles(words([t.translate(LOWER) for t in texts] if lower else texts), k)
    return [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps of the samples (a row for each text), as 64-bit words: each
    sample with its number flips one bit."""
    n, k = samples.shape
    bit = (mix(samples ^ mix(np.arange(k, dtype=U64))[None, :]) % U64(bits)).astype(np.int64)
    counts = np.bincount((np.arange(n)[:, None] * bits + bit).ravel(), minlength=n * bits).reshape(n, -1)
    return np.packbits((counts & 1).astype(np.uint8), axis=1).view(np.int64)


def most_differing_bits(threshold: float, k: int = SAMPLES, n: int = SKETCH_BITS) -> int:
    """Above so many differing bits, two sketches are not of sets as similar as
    ``threshold``: the expected count plus 5.5 standard deviations."""
    differing = 2 * k * (1 - threshold)
    shrink = math.exp(-2 * differing / n)
    sampling, folding = 2 * math.sqrt(k * threshold * (1 - threshold)) * shrink, 3.5
    return math.ceil(n / 2 * (1 - shrink) + 5.5 * math.hypot(sampling, folding))


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Keys of ``bands`` bands of ``rows`` samples each, a row for each text."""
    keys = np.zeros((len(samples), bands), U64)
    for r in range(rows):
        keys = mix(keys + samples[:, r : bands * rows : rows])
    return mix(keys + np.arange(bands, dtype=U64)[None, :]).view(np.int64)


def _lists(rows: np.ndarray) -> pa.ListArray:
    """A matrix as a column of lists of one length."""
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.ravel()))


def sketch(docs: DataFrame, k: int, lower: bool) -> DataFrame:
    """doc_id, text_key, n_shingles, a digest of the shingle set, band keys and odd sketch
    of ``docs`` (doc_id, text_key, text). A text counts with its bits' counters towards
    a chunk, so many short ones stay small."""
    a, b = universal(SAMPLES, 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in chunks(zip(*(c.to_pylist() for c in batch.columns), strict=True), lambda r: len(r[2] or "") + SKETCH_BITS * 8):
                texts = [(r[2] or "").encode() for r in rows]
                values, first = shingles(words([t.translate(LOWER) for t in texts] if lower else texts), k)
                sets = [np.unique(values[i:j]) for i, j in zip(first[:-1], first[1:], strict=True)]
                samples = minhash(values, first, a, b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), _lists(band_keys(samples, BANDS, ROWS)), _lists(odd_sketches(samples))],
                    ["doc_id", "text_key", "n_shingles", "digest", "bands", "sketch"],
                )

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, _SKETCH)


def _full_sets(texts: DataFrame, k: int, lower: bool) -> DataFrame:
    """id, whether it is in a large bucket, and the full shingle set of each of ``texts``;
    besides the longer keys of those in large buckets."""
    a, b = universal(LONG_BANDS * LONG_ROWS, 7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("id").to_pylist(), (t.as_py().encode() for t in batch.column("text")), batch.column("large").to_pylist(), strict=True)
            for own in chunks(rows, lambda r: len(r[1]) + LONG_BANDS * LONG_ROWS * 8 * r[2], limit=4 << 20):
                sets = shingle_sets([t for _, t, _ in own], k, lower)
                keys = []
                for s, (_, _, large) in zip(sets, own, strict=True):
                    keys.append(band_keys(minhash(s, np.array([0, len(s)]), a, b), LONG_BANDS, LONG_ROWS)[0] if large else None)
                yield pa.RecordBatch.from_arrays([pa.array([i for i, *_ in own], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], ["id", "shingles", "long_bands"])

    return texts.select("id", "text", "large").mapInArrow(run, "id long, shingles array<long>, long_bands array<long>")


def _differing_bits(x: str, y: str):
    words_ = SKETCH_BITS // 64
    return sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(words_)), F.lit(0))


def confirm_pairs(pairs: DataFrame, texts: DataFrame, numerator: int, denominator: int, k: int, lower: bool) -> DataFrame:
    """The (a, b) of ``pairs`` whose full shingle sets are similar enough, with all
    tried pairs: (a, b, linked)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)
        for batch in batches:
            linked = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                if known[0] != a:
                    known = (a, shingle_sets([x.as_py().encode()], k, lower)[0])
                one, two = known[1], shingle_sets([y.as_py().encode()], k, lower)[0]
                both = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(denominator * both >= numerator * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    first = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _rows_of(column: pa.ChunkedArray) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    flat = np.concatenate([np.empty(0, np.int64), *(c.flatten().to_numpy() for c in column.chunks)])
    return flat.view(np.uint64).reshape(len(column), -1)


class _Components:
    """Numbers of the members' components, joined as links are found."""

    def __init__(self, component: np.ndarray):
        self.of = np.unique(component, return_inverse=True)[1]

    def join(self, i: int, j: int) -> bool:
        """Whether i and j were in different components; they are in one now."""
        a, b = self.of[i], self.of[j]
        if a != b:
            self.of[self.of == b] = a
        return a != b


def _between(most: int, numerator: int, denominator: int):
    """Within a bucket, the links (a, b) between members of different components that
    join them. A pair is tried in its first shared bucket only, where its sketches
    differ in at most ``most`` bits, and counts if its full sets say so."""

    def run(table: pa.Table) -> pa.Table:
        ids, comp = table.column("id").to_numpy(), table.column("component").to_numpy()
        # where a bucket is whole, its members are held against one another and are here once
        probe, base = (table.column("probe").fill_null(p).to_numpy(zero_copy_only=False) == p for p in (True, False))
        bits, bands = _rows_of(table.column("sketch")), _rows_of(table.column("bands"))
        key = np.int64(table.column("key")[0].as_py()).view(np.uint64)
        lists = table.column("shingles").combine_chunks()
        values, ends = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        size = np.diff(ends)
        base = np.flatnonzero(base)
        # every shingle of the base with the members that have it
        owner = np.repeat(np.arange(len(base)), size[base])
        held = np.concatenate([np.empty(0, np.int64), *(values[ends[i] : ends[i + 1]] for i in base)])
        order = np.argsort(held, kind="stable")
        held, owner = held[order], owner[order]
        joined, out = _Components(comp), []
        for i in np.flatnonzero(probe):
            place = np.flatnonzero((comp[base] > comp[i]) & (joined.of[base] != joined.of[i]))
            place = place[np.bitwise_count(bits[base[place]] ^ bits[i]).sum(axis=1) <= most]
            place = place[bands[i][(bands[base[place]] == bands[i]).argmax(axis=1)] == key] if len(place) else place
            if not len(place):
                continue
            own = values[ends[i] : ends[i + 1]]
            low, high = np.searchsorted(held, own, "left"), np.searchsorted(held, own, "right")
            n = high - low
            at = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
            both = np.bincount(owner[at], minlength=len(base))[place]
            for j in base[place[denominator * both >= numerator * (size[i] + size[base[place]] - both)]]:
                if joined.join(i, j):
                    out.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([min(p) for p in out], pa.int64()), "b": pa.array([max(p) for p in out], pa.int64())})

    return run


def _mixed(members: DataFrame) -> DataFrame:
    """Of ``members`` (key, id, component), those in buckets of different components, with
    the number of the bucket's members and the bytes of their sets (by ``bytes``). Members
    of hot buckets are dealt to several tasks."""
    members = materialize(members, "bucket-members")
    buckets = materialize(members.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q"), F.count("*").alias("n"), F.sum("bytes").alias("total")), "buckets")
    mixed = dealt_join(members, buckets.filter("p < q").select("key", "n", "total"), "key", ["id"], buckets.select("key", F.col("n").alias("rows")), pieces(members, PART_BYTES))
    return mixed.filter("n IS NOT NULL")


def _judged(docs: DataFrame, numerator: int, denominator: int, k: int, lower: bool, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and kept of each row."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    with scratch_tables() as made:
        found = made.keep(materialize(sketch(source, k, lower), "sketches"))
        named = found.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        # nodes are classes by a number of their own, since rows may repeat an id with other texts
        first = named.groupBy("digest", "n_shingles").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
        classes = made.keep(materialize(first.select("digest", F.col("first.doc_id").alias("rep"), F.col("first.text_key").alias("rep_key"), (F.col("n_shingles") * 8).alias("bytes"), F.monotonically_increasing_id().alias("id")), "classes"))
        chosen = named.withColumnRenamed("digest", "_digest").join(classes, (F.col("_digest") == F.col("digest")) & (F.col("doc_id") == F.col("rep")) & (F.col("text_key") == F.col("rep_key")))
        nodes = materialize(chosen.select("id", "bytes", "bands", "sketch").dropDuplicates(["id"]), "nodes")

        # buckets of at least two classes, and their members
        keyed = nodes.select("id", "bytes", F.explode("bands").alias("key"))
        buckets = keyed.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).filter("leader < last").drop("last")
        members = materialize(keyed.join(buckets, "key"), "members")
        involved = classes.select("id", "rep", "rep_key").join(members.select("id").distinct(), "id", "left_semi")
        texts = source.join(involved, (F.col("doc_id") == F.col("rep")) & (F.col("text_key") == F.col("rep_key")))
        texts = materialize(texts.groupBy("id").agg(F.first("text").alias("text")), "texts")

        most = most_differing_bits(numerator / denominator)
        sketches = nodes.select("id", "sketch")
        stars = members.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
        near = (
            stars.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("p")), "a")
            .join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("q")), "b")
            .filter(_differing_bits("p", "q") <= most).select("a", "b")
        )
        links = materialize(confirm_pairs(near, texts, numerator, denominator, k, lower).filter("linked").select("a", "b"), "links")
        parts = materialize(components(links), "components")

        labelled = members.select("key", "id", "bytes").join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = materialize(_mixed(labelled), "mixed")
        asked = mixed.groupBy("id", "component", "bytes").agg(F.max(F.col("n") > PROBES).alias("large"))
        sets = materialize(_full_sets(texts.join(asked.select("id", "large"), "id"), k, lower), "sets")
        open_ = mixed.filter(F.col("n") <= PROBES).join(nodes.select("id", "bands", "sketch"), "id")
        longer = sets.filter("long_bands IS NOT NULL").select("id", F.col("long_bands").alias("bands"), F.explode("long_bands").alias("key"))
        longer = _mixed(longer.join(asked.select("id", "component", "bytes"), "id")).join(sketches, "id")
        order = ["key", "id", "component", "n", "total", "bands", "sketch"]
        deal = open_.select(*order).unionByName(longer.select(*order)).join(sets.select("id", "shingles"), "id")
        deal = materialize(deal.withColumn("parts", F.greatest(F.ceil(F.col("n") / PROBES), F.ceil(F.col("total") / SET_BYTES)).cast("int")), "open")
        # a large bucket is cut into parts, and each two parts meet in a task
        own, other = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        member = ["id", "component", "sketch", "bands", "shingles"]
        whole = deal.filter("parts = 1").select("key", F.lit(0).alias("part"), F.lit(0).alias("against"), *member, F.lit(None).cast("boolean").alias("probe"))
        cut = deal.filter("parts > 1")
        probes = cut.select("key", own.alias("part"), other.alias("against"), *member, F.lit(True).alias("probe"))
        bases = cut.select("key", other.alias("part"), own.alias("against"), *member, F.lit(False).alias("probe"))
        more = whole.unionByName(probes).unionByName(bases).groupBy("key", "part", "against").applyInArrow(_between(most, numerator, denominator), "a long, b long")
        parts = materialize(components(links.unionByName(materialize(more, "links"))), "components")

        # rows of a large component, and of a set that many texts share, are dealt to several tasks
        ranked = materialize(classes.select("id", "digest", "rep").join(parts, "id"), "ranked")
        groups = ranked.groupBy("component").agg(F.min("rep").alias("_component"), F.count("*").alias("rows"))
        named = dealt_join(ranked, groups.select("component", "_component"), "component", ["id"], groups.select("component", "rows"), pieces(ranked, PART_BYTES)).select("digest", "_component")
        alone = classes.join(parts.select("id"), "id", "left_anti").select("digest", F.col("rep").alias("_component"))
        by_class = made.keep(materialize(named.unionByName(alone), "components-of-classes"))
        rows = found.select("doc_id", "text_key", "n_shingles", "digest")
        whole = dealt_join(rows, by_class, "digest", ["doc_id", "text_key"], rows.groupBy("digest").agg(F.count("*").alias("rows")), pieces(rows, PART_BYTES), made)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return whole.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, numerator: int = 4, denominator: int = 5, k: int = 5, lower: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two texts are linked if denominator * intersection >= numerator * union of
    their sets of distinct ``k``-word shingles (``lower``: A-Z in lower case). A
    text of fewer words is one shingle; one without words (or null) has none and
    is linked with nothing. component_id is the least id reached, kept says that
    it is the row's own. A null id has no component and is kept. Rows that repeat
    an id are judged by their own texts, and their component is the least id of
    what those reach. Other columns are ignored; an empty
    table gives an empty result.
    """
    return _judged(docs, numerator, denominator, k, lower, id_col, text_col).drop("text_key")


def drop_near_duplicates(docs: DataFrame, numerator: int = 4, denominator: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the rows of each component that have its least id; same columns. Rows
    that repeat an id are judged by their own texts; rows with a null id stay."""
    gone = _judged(docs, numerator, denominator, 5, True, id_col, text_col).filter(~F.col("kept")).select("doc_id", "text_key")
    return without(docs, id_col, text_key(text_col), gone)
