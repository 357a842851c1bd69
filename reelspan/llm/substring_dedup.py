"""Repeated passages by sharded phrase automata.

A window is a run of W consecutive words of one document. Its anchor is the
least hash among its runs of about W/2 words, so equal windows have equal
anchors wherever they stand. Documents are dealt out to blocks; then

1. the blocks' distinct anchors meet, and those of at least two documents come
   back to the blocks that have them;
2. stretches of windows with such anchors, packed by anchor shard, meet again,
   now with their words: each shard confirms the windows that occur in at least
   two documents, compiles them into an Aho-Corasick automaton over word numbers
   and streams all of its stretches through it, which locates every occurrence
   and the least document of each;
3. the blocks remove what smaller documents already hold.

Each block sends an anchor or stretch once, with its least document, however
many of its documents share it, so a passage of a third of all documents costs
a shard one entry a block. Around such a passage every document has stretches
of its own with the same anchor; those of hot anchors are dealt out window by
window, since only equal windows need to meet. The text itself is shuffled once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .runtime import partitions, pieces, text_key
from .textkit import U64, Words, chunks, mix, sequences, words

#: Estimated bytes of a block, and of the input for each shard.
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 4 << 20
#: An anchor of more runs of windows than that is hot: its windows are dealt out one by one.
HOT = 2000
#: Phrases from which an automaton is compiled.
PHRASES = 500
#: Stands for no document.
NONE = np.iinfo(np.int64).max
_MESSAGE = "shard int, block int, data binary"
_ANSWER = "block int, data binary"


def _dump(*values) -> bytes:
    return zstandard.compress(pickle.dumps(values, protocol=5), 1)


def _load(data) -> tuple:
    return pickle.loads(zstandard.decompress(data.as_py()))


def anchors(w: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each run of ``window`` words, and whether the run is inside one text."""
    n = len(w.hash) - window + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, bool)
    k = (window + 1) // 2
    runs = sequences(w.hash, k)
    least = runs[:n].copy()
    for j in range(1, window - k + 1):
        np.minimum(least, runs[j : j + n], out=least)
    text = np.repeat(np.arange(len(w.first) - 1), w.counts())
    return mix(least), text[:n] == text[window - 1 :]


def _texts(table: pa.Table) -> Iterator[tuple[list, list[bytes]]]:
    """A block's rows in a fixed order, some at a time: places in the table, texts."""
    rows = ((i, (t.as_py() or "").encode()) for i, t in enumerate(table.column("text")))
    for part in chunks(rows, lambda r: len(r[1])):
        yield [i for i, _ in part], [t for _, t in part]


def _by_key(keys: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with the least and the largest of their documents and the sum of n."""
    order = np.argsort(keys, kind="stable")
    keys, low, high, n = keys[order], low[order], high[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    if not len(first):
        return keys, low, high, n
    return keys[first], np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), np.add.reduceat(n, first)


def _shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys % U64(shards)).astype(np.int64)


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(NONE).to_numpy()


def _offer_anchors(window: int, shards: int, most: int):
    def run(table: pa.Table) -> pa.Table:
        ids, found = _ids(table), []
        for at, texts in _texts(table):
            w = words(texts)
            least, whole = anchors(w, window)
            # neighbouring windows mostly share their anchor
            new = np.concatenate(([True], (least[1:] != least[:-1]) | ~whole[:-1])) if len(least) else whole
            pick = np.flatnonzero(new & whole)
            text = np.searchsorted(w.first, pick, side="right") - 1
            own = ids[np.asarray(at, np.int64)[text]]
            found.append(_by_key(least[pick], own, own, np.ones(len(own), np.int64)))
        keys, low, high, n = _by_key(*map(np.concatenate, zip(*found, strict=True)))
        known = low != NONE  # documents without an id take no part
        keys, low, high, n = keys[known], low[known], high[known], n[known]
        shard = _shards_of(keys, shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        own = np.split(order, cuts[1:]) if len(order) else []
        block = table.column("block")[0].as_py()
        return pa.table({"shard": pa.array(shard[order][cuts], pa.int32()), "block": pa.array([block] * len(own), pa.int32()), "data": pa.array([_dump(keys[o], low[o].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), low[o] != high[o], np.minimum(n[o], most + 1).astype("<u4")) for o in own], pa.binary())})

    return run


def _shared_anchors(most: int):
    """To each block of a shard, those of its anchors that at least two documents have,
    and which of them are hot: with more than ``most`` runs of windows."""

    def run(table: pa.Table) -> pa.Table:
        parts = []
        for data in table.column("data"):
            keys, low, several, n = _load(data)
            parts.append((keys, np.ascontiguousarray(np.frombuffer(low, np.uint8).reshape(8, -1).T).reshape(-1).view("<i8"), several, n))
        keys, low, several, n = map(np.concatenate, zip(*parts, strict=True))
        distinct, least, largest, times = _by_key(keys, low, low, n.astype(np.int64))
        shared = np.union1d(distinct[least != largest], keys[several])
        hot = distinct[times > most]
        answers = [p[0][np.isin(p[0], shared)] for p in parts]
        keep = [i for i, a in enumerate(answers) if len(a)]
        blocks = table.column("block").to_pylist()
        return pa.table({"block": pa.array([blocks[i] for i in keep], pa.int32()), "data": pa.array([_dump(answers[i], np.isin(answers[i], hot)) for i in keep], pa.binary())})

    return run


def _stretches(table: pa.Table, shared: np.ndarray, hot: np.ndarray, window: int) -> Iterator[tuple]:
    """Maximal runs of windows of one document with the same shared anchor, or of a hot
    anchor its windows one by one: place in the table, key, first window, windows, the
    words in between. The key is the anchor, or a hash of a hot anchor's window."""
    for at, texts in _texts(table):
        w = words(texts)
        least, whole = anchors(w, window)
        if not len(shared) or not len(least):
            continue
        place = np.searchsorted(shared, least)
        place[place == len(shared)] = 0
        hit = whole & (shared[place] == least)
        alone = hit & hot[place]
        apart = least[1:] != least[:-1]
        starts = np.flatnonzero(hit & np.concatenate(([True], ~hit[:-1] | apart | alone[1:])))
        ends = np.flatnonzero(hit & np.concatenate((~hit[1:] | apart | alone[:-1], [True])))
        text = np.searchsorted(w.first, starts, side="right") - 1
        for s, e, t in zip(starts, ends, text, strict=True):
            raw = b" ".join(w.buffer[w.start[s] : w.end[e + window - 1]].split())
            key = int.from_bytes(hash_of(raw)[:8], "little") if alone[s] else int(least[s])
            yield at[t], key, int(s - w.first[t]), int(e - s + 1), raw


def _answered(table: pa.Table) -> list[tuple]:
    return [_load(d) for d in table.column("data")]


def _shared_of(answers: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """A block's shared anchors in order, and whether each is hot."""
    if not answers:
        return np.empty(0, U64), np.empty(0, bool)
    shared, hot = (np.concatenate([a[i] for a in answers]) for i in range(2))
    order = np.argsort(shared)
    return shared[order], hot[order]


def _offer_stretches(window: int, shards: int):
    def run(table: pa.Table, right: pa.Table) -> pa.Table:
        shared, hot = _shared_of(_answered(right))
        ids, held = _ids(table), {}
        if len(shared):
            for at, anchor, _, _, raw in _stretches(table, shared, hot, window):
                doc = int(ids[at])
                if doc != NONE:
                    own = held.setdefault(anchor % shards, {})
                    low, high, _ = own.get(raw, (doc, doc, anchor))
                    own[raw] = (min(low, doc), max(high, doc), anchor)
        block = table.column("block")[0].as_py() if len(table) else 0
        return pa.table({"shard": pa.array(list(held), pa.int32()), "block": pa.array([block] * len(held), pa.int32()), "data": pa.array([_dump(list(own), [v[0] for v in own.values()], [v[0] != v[1] for v in own.values()], [v[2] for v in own.values()]) for own in held.values()], pa.binary())})

    return run


def _locate_phrases(window: int):
    """A shard's answer to each block: of each stretch, the least document of each window."""

    def run(table: pa.Table) -> pa.Table:
        import ahocorasick

        asked = [_load(d) for d in table.column("data")]
        # stretches of the whole shard by anchor, with their least document and whether there are several
        total: dict[bytes, tuple[int, bool]] = {}
        groups: dict[int, list[bytes]] = {}
        for raws, low, several, anchor in asked:
            for raw, doc, many, key in zip(raws, low, several, anchor, strict=True):
                old = total.get(raw)
                if old is None:
                    groups.setdefault(key, []).append(raw)
                    total[raw] = (doc, many)
                else:
                    total[raw] = (min(doc, old[0]), many or old[1] or doc != old[0])
        found: dict[bytes, np.ndarray] = {}
        number: dict[bytes, int] = {}
        confirmed: dict[tuple, int] = {}
        streams: dict[bytes, tuple] = {}

        def coded(raw: bytes) -> tuple:
            return tuple([number.setdefault(x, len(number)) for x in raw.split()])

        def stream() -> None:
            """Compile the confirmed phrases and locate them in their anchors' stretches."""
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            least, length = list(confirmed.values()), list(map(len, confirmed))
            for i, phrase in enumerate(confirmed):
                automaton.add_word(phrase, i)
            automaton.make_automaton()
            for raw, ids in streams.items():
                own = None
                for end, which in automaton.iter(ids):
                    if own is None:
                        own = np.full(len(ids) - window + 1, NONE, np.int64)
                    part = own[end - length[which] + 1 : end - window + 2]
                    np.minimum(part, least[which], out=part)
                if own is not None:
                    found[raw] = own
            for held in (number, confirmed, streams):
                held.clear()

        # Equal windows have equal anchors, so phrases are confirmed anchor by anchor. Where all
        # its stretches are the same, that one is a phrase; else each window of two documents is.
        for raws in groups.values():
            if len(raws) == 1:
                doc, many = total[raws[0]]
                if many:
                    ids = streams[raws[0]] = coded(raws[0])
                    confirmed[ids] = doc
            else:
                seen: dict[tuple, tuple[int, bool]] = {}
                for raw in raws:
                    doc, many = total[raw]
                    ids = streams[raw] = coded(raw)
                    for i in range(len(ids) - window + 1):
                        phrase = ids[i : i + window]
                        old = seen.get(phrase)
                        seen[phrase] = (doc, many) if old is None else (min(doc, old[0]), many or old[1] or doc != old[0])
                confirmed.update((phrase, doc) for phrase, (doc, many) in seen.items() if many)
            # an automaton looks a word up among all that follow a place, so many small ones
            # are built sooner than a large one
            if len(confirmed) >= PHRASES:
                stream()
        if confirmed:
            stream()
        blocks, out = [], []
        for block, (raws, *_) in zip(table.column("block").to_pylist(), asked, strict=True):
            if own := {raw: found[raw] for raw in raws if raw in found}:
                blocks.append(block)
                out.append(_dump([hash_of(raw) for raw in own], [len(v) for v in own.values()], np.concatenate(list(own.values())).astype("<i8").tobytes()))
        return pa.table({"block": pa.array(blocks, pa.int32()), "data": pa.array(out, pa.binary())})

    return run


def hash_of(raw: bytes) -> bytes:
    """A stretch's name in answers: a 128-bit digest of its words."""
    import hashlib

    return hashlib.blake2b(raw, digest_size=16).digest()


def _remove(window: int):
    def run(table: pa.Table, right: pa.Table) -> pa.Table:
        which = right.column("which").to_pylist()
        answers = _answered(right)
        shared, hot = _shared_of([a for a, k in zip(answers, which, strict=True) if k == 0])
        least: dict[bytes, np.ndarray] = {}
        for (names, lengths, data), k in ((a, k) for a, k in zip(answers, which, strict=True) if k == 1):
            flat, ends = np.frombuffer(data, "<i8"), np.cumsum(lengths)
            least.update((n, flat[b - m : b]) for n, m, b in zip(names, lengths, ends, strict=True))
        ids = _ids(table)
        starts: dict[int, list[np.ndarray]] = {}
        if least:
            for at, _, first, _, raw in _stretches(table, shared, hot, window):
                if (own := least.get(hash_of(raw))) is not None and ids[at] != NONE:
                    hit = np.flatnonzero(own < ids[at])
                    if len(hit):
                        starts.setdefault(at, []).append(first + hit)
        n_words, n_removed, kept = [], [], []
        for i, text in enumerate(table.column("text")):
            own = (text.as_py() or "").encode().split()
            gone = 0
            if i in starts:
                step = np.zeros(len(own) + 1, np.int64)
                at = np.unique(np.concatenate(starts[i]))
                step[at] += 1
                np.add.at(step, at + window, -1)
                stay = np.cumsum(step[:-1]) == 0
                gone = int(len(own) - stay.sum())
                kept.append(b" ".join([own[j] for j in np.flatnonzero(stay)]).decode())
            else:
                kept.append(b" ".join(own).decode())
            n_words.append(len(own))
            n_removed.append(gone)
        return pa.table({"doc_id": table.column("doc_id"), "text_key": table.column("text_key"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.string())})

    return run


def _judged(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, n_words, n_removed and kept_text of each row."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    blocks, shards = pieces(source, BLOCK_BYTES), pieces(source, SHARD_BYTES)
    # one shuffle of the text, read three times
    dealt = source.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(blocks)).cast("int")).repartition(partitions(blocks), "block")
    by_block = dealt.groupBy("block")
    offered = by_block.applyInArrow(_offer_anchors(window, shards, HOT), _MESSAGE)
    shared = offered.repartition(partitions(shards), "shard").groupBy("shard").applyInArrow(_shared_anchors(HOT), _ANSWER)
    stretches = by_block.cogroup(shared.groupBy("block")).applyInArrow(_offer_stretches(window, shards), _MESSAGE)
    located = stretches.repartition(partitions(shards), "shard").groupBy("shard").applyInArrow(_locate_phrases(window), _ANSWER)
    answers = shared.withColumn("which", F.lit(0)).unionByName(located.withColumn("which", F.lit(1)))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(_remove(window), "doc_id long, text_key long, n_words long, n_removed long, kept_text string")


def repeated_passages(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text.

    Removes each word covered by a window of ``window`` words that also starts in
    a document with a smaller id; windows are judged on the input. kept_text is
    the other words joined by one space. A null text has no words; one shorter
    than a window loses none. Rows with a null id neither lose words nor make
    others lose them; rows with the same id don't remove one another. Other
    columns are ignored, texts are whole, an empty table gives an empty result.
    """
    return _judged(docs, window, id_col, text_col).drop("text_key")


def drop_repeated_passages(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages taken out of the text; same rows and columns, and
    texts that lose nothing stay as they are. Rows that repeat an id are changed each
    by its own text; rows with a null id stay as they are."""
    found = _judged(docs, window, id_col, text_col).filter("n_removed > 0 AND doc_id IS NOT NULL")
    # repeated rows lose the same words, so one of them speaks for all
    changed = found.select(F.col("doc_id").alias("changed_id"), F.col("text_key").alias("changed_key"), F.col("kept_text").alias("kept")).dropDuplicates(["changed_id", "changed_key"])
    joined = docs.select(F.struct("*").alias("row"), text_key(text_col).alias("key")).join(changed, (F.col(f"row.`{id_col}`") == F.col("changed_id")) & (F.col("key") == F.col("changed_key")), "left")
    return joined.select(F.when(F.col("kept").isNotNull(), F.col("row").withField(f"`{text_col}`", F.col("kept"))).otherwise(F.col("row")).alias("row")).select("row.*")
