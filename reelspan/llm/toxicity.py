"""Toxicity by a counterfactually regularised logistic classifier.

Features are the presence of a text's distinct words and word starts. The
classifier is fitted on a bounded sample of labelled rows; beside the logistic
loss it pays for every change of score when the identity terms of a labelled
sentence are swapped for others, so that neutral mentions of a group do not
move it. Scoring reads whole texts and carries only the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .runtime import materialize, scratch_tables
from .textkit import U64, chunks, mix

#: Groups of terms that name people by the same kind of trait; terms of a group are swapped for one another.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists", "sikhs"),
    ("gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "hispanic"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("deaf", "blind", "disabled", "autistic"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)
#: Labelled rows the fit takes at most, by order of a hash of their ids.
FIT_ROWS = 8_000
#: A feature counts if so many of these rows have it, and it tells the labels apart by
#: so large a log-likelihood ratio.
LEAST_ROWS, LEAST_RATIO = 4, 10.0
#: Code points of the word starts that are features beside whole words.
STARTS = (4, 5, 6)

_SEPARATES = np.ones(0x3000, bool)
_SEPARATES[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False
_SEPARATES[0xAA] = _SEPARATES[0xB5] = _SEPARATES[0xBA] = False
_SEPARATES[0xC0:0x2000] = False
_SEPARATES[[0xD7, 0xF7]] = True
_SEPARATES[0x2070:0x3000] = False
_PRIME = U64(0x100000001B3)


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words and word starts of many texts, repeats included,
    and the number of the text each is from. Words are runs of letters and digits
    of any script; an empty or null text has none."""
    lower = [(t or "").lower() for t in texts]
    a = np.frombuffer("\n".join(lower).encode("utf-32-le", "replace"), "<u4")
    inside = np.zeros(len(a) + 2, bool)
    inside[1:-1] = ~_SEPARATES[np.minimum(a, 0x2FFF)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    places = np.cumsum([len(t) + 1 for t in lower])
    of = np.searchsorted(places, start, side="right")
    size = end - start
    whole = np.zeros(len(start), U64)
    owners, found = [], []
    # a character at a time over all words still that long
    live = np.arange(len(start))
    for i in range(int(size.max()) if len(size) else 0):
        live = live[size[live] > i]
        whole[live] = (whole[live] ^ a[start[live] + i].astype(U64)) * _PRIME + U64(i + 1)
        if i + 1 in STARTS:
            owners.append(of[live])
            found.append(mix(whole[live] ^ U64(0xABCD)))
    return np.concatenate([*owners, of]), np.concatenate([*found, mix(whole)])


def features(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of one text."""
    return np.unique(hashed([text])[1])


def swapped(text: str, by: int = 1) -> str | None:
    """The text with each identity term replaced by a later one of its group; None
    if it has none."""
    other = {t: g[(i + by) % len(g)] for g in IDENTITY_TERMS for i, t in enumerate(g)}
    out, changed = [], False
    for word in text.split(" "):
        bare = word.strip(".,;:!?\"'()[]\n\r\t")
        if (new := other.get(bare.lower())) is not None:
            word, changed = word.replace(bare, new.capitalize() if bare[:1].isupper() else new), True
        out.append(word)
    return " ".join(out) if changed else None


@dataclass
class Classifier:
    """Weights of hashed features, in the order of the hashes."""

    keys: np.ndarray = field(default_factory=lambda: np.empty(0, U64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    bias: float = 0.0

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """A score for each text: the logistic of the summed weights of what it has."""
        margin = np.full(len(texts), self.bias)
        if len(self.keys):
            of, found = hashed(texts)
            at = np.searchsorted(self.keys, found)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == found
            n = len(self.keys)
            once = np.unique(of[hit] * n + at[hit])
            margin += np.bincount(once // n, self.weights[once % n], len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


def solve(keys: np.ndarray, rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], fairness: float, ridge: float, steps: int) -> Classifier:
    """The classifier over ``keys``. ``rows`` holds the places in them of what each row
    has, ``pairs`` those that a swap takes away and those that it brings."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return Classifier(bias=bias)

    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate([np.empty(0, np.int32), *sets])

    p, total, size = y.sum(), len(y), len(keys)
    row, col = flat(rows)
    off_row, off_col = flat([a for a, _ in pairs])
    on_row, on_col = flat([b for _, b in pairs])
    # both labels weigh the same in all, whatever their shares
    weigh = np.where(y > 0, total / (2 * p), total / (2 * (total - p)))
    w, bias = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(row, w[col], total)
        error = weigh * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(col, error[row], size) / total + ridge * w
        if pairs:
            gap = np.bincount(off_row, w[off_col], len(pairs)) - np.bincount(on_row, w[on_col], len(pairs))
            g += 2 * fairness / len(pairs) * (np.bincount(off_col, gap[off_row], size) - np.bincount(on_col, gap[on_row], size))
        g = np.append(g, error.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    # 0.5 stands halfway between the labels where they are apart, not at the edge of one
    z = bias + np.bincount(row, w[col], total)
    low, high = np.quantile(z[y == 0], 0.999), np.quantile(z[y > 0], 0.01)
    if low < high:
        bias -= (low + high) / 2
    return Classifier(keys, w, float(bias))


def held_out(id_col: str):
    """Whether a row is kept from every fit: crc32 of its id as text is a multiple of 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _swaps(text: str, own: np.ndarray, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each sentence with identity terms and its swaps: the features that a swap takes
    away and those that it brings."""
    if len(np.intersect1d(own, terms, assume_unique=True)):
        for sentence in text.replace("\n", ". ").split(". "):
            for by in (1, 2):
                if (other := swapped(sentence, by)) is not None:
                    a, b = features(sentence), features(other)
                    yield np.setdiff1d(a, b, assume_unique=True), np.setdiff1d(b, a, assume_unique=True)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts (tie, label, text) to rows with their features, and to swaps (no
    label) with the features that go and come."""
    terms = np.unique(np.concatenate([hashed([t])[1][-1:] for g in IDENTITY_TERMS for t in g]))
    for batch in batches:
        for tie, label, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            own = features(text.as_py())
            swaps = list(_swaps(text.as_py(), own, terms))
            n = len(swaps)
            yield pa.RecordBatch.from_pydict({
                "tie": pa.array([tie.as_py()] * (n + 1), pa.string()),
                "label": pa.array([label.as_py()] + [None] * n, pa.int32()),
                "features": pa.array([own.view(np.int64), *(a.view(np.int64) for a, _ in swaps)], pa.list_(pa.int64())),
                "brought": pa.array([None, *(b.view(np.int64) for _, b in swaps)], pa.list_(pa.int64())),
            })


def _log_likelihood_ratio(n: Column, pos: Column, total: float, p: float) -> Column:
    """Of a feature's presence (in n rows, pos of them labelled 1) against the label."""

    def part(x: Column, row: Column, col: float) -> Column:
        return F.when(x > 0, x * F.log(x * total / (row * col))).otherwise(0.0)

    return part(pos, n, p) + part(n - pos, n, total - p) + part(p - pos, total - n, p) + part(total - p - (n - pos), total - n, total - p)


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, fairness: float = 5.0, ridge: float = 1e-5, steps: int = 600, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Classifier:
    """Fit on at most ``rows`` labelled rows that are not held out. Rows without id,
    text or label are passed over; an id labelled twice counts twice. ``fairness``
    weighs the mean squared change of margin between sentences and their swaps.
    With no rows, or rows of one label, every score is the label's share.

    Texts are hashed and features are counted and chosen on the executors; what
    reaches the driver are the chosen features and, of each row, their places.
    """
    spark = ship_package(docs.sparkSession)
    own = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
    # the sample is drawn from the labels before any text is read, and is at most ``rows`` long
    sample = own.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).orderBy(F.xxhash64("_id"), "_id", "_label").limit(rows)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).filter("_text IS NOT NULL")
    labelled = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_id")).select(F.col("_id").cast("string"), "_label", "_text")
    with scratch_tables():
        described = materialize(labelled.mapInArrow(_described, "tie string, label int, features array<long>, brought array<long>"), "labelled-features")
        known = described.filter("label IS NOT NULL")
        seen = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("pos")).first()
        total, p = float(seen["n"]), float(seen["pos"])
        if not 0 < p < total:
            return solve(np.empty(0, U64), [], np.repeat([1.0, 0.0], [int(p), int(total - p)]), [], fairness, ridge, steps)
        counts = known.select("label", F.explode("features").alias("key")).groupBy("key").agg(F.count("*").alias("n"), F.sum("label").alias("pos"))
        names = np.unique(np.concatenate([features(t) for g in IDENTITY_TERMS for t in g])).view(np.int64).tolist()
        telling = (F.col("n") >= LEAST_ROWS) & (_log_likelihood_ratio(F.col("n"), F.col("pos"), total, p) > LEAST_RATIO)
        keys = np.sort(counts.filter(telling | F.col("key").isin(names)).select("key").toArrow().column(0).to_numpy().view(U64))
        kept = spark.sparkContext.broadcast(keys)

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def within(lists) -> pa.Array:
                found = (np.asarray(x.values.to_numpy() if x.is_valid else (), np.int64).view(U64) for x in lists)
                return pa.array([np.searchsorted(kept.value, np.intersect1d(f, kept.value, assume_unique=True)).astype("<i4").tobytes() for f in found], pa.binary())

            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("tie"), batch.column("label"), within(batch.column("features")), within(batch.column("brought"))], ["tie", "label", "features", "brought"])

        got = described.mapInArrow(places, "tie string, label int, features binary, brought binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["tie"], -1 if r["label"] is None else r["label"], r["features"], r["brought"]))
    at = [(r["label"], np.frombuffer(r["features"], "<i4"), np.frombuffer(r["brought"], "<i4")) for r in got]
    return solve(keys, [a for label, a, _ in at if label is not None], np.asarray([label for label, *_ in at if label is not None], float), [(a, b) for label, a, b in at if label is None], fairness, ridge, steps)


def toxicity_scores(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score, predicted (1 if score >= 0.5).

    Null and empty texts get the score of a text without words. Repeated rows and
    null ids keep a row each; other columns are ignored; texts are whole.
    """
    model = ship_package(docs.sparkSession).sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = chunks((t.as_py() or "" for t in batch.column(1)), len)
            score = np.concatenate([np.empty(0), *(model.value.scores(p) for p in parts)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is 0.5 or more; same columns. Each row is
    judged by its own text, whatever its id; a null text counts as empty."""
    model = ship_package(docs.sparkSession).sparkContext.broadcast(classifier)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = chunks((t.as_py() or "" for t in batch.column(at)), len)
            score = np.concatenate([np.empty(0), *(model.value.scores(p) for p in parts)])
            yield batch.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)
