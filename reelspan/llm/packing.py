"""Best-fit packing of token pieces into sequences of a fixed capacity.

Pieces matter by their length only, so the plan is made on the histogram of
lengths, which has at most ``capacity`` entries at any corpus size. Pieces
above a third of the capacity are matched greedily, at most two to a bin, the
largest with the largest that fits beside it; smaller ones, in falling order,
go where they leave the least room. Equal bins and equal pieces are moved in
bulk. Every piece then finds its place from its rank among those of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import materialize
from .textkit import chunks
from .tokenise import Vocabulary, encoder

PIECES = "doc_id long, piece int, start long, length long, ids binary, part long, nth long"


class Runs:
    """Where the pieces of one length go: pieces of rank ``rank[i]`` and on fill the
    bins from ``bin[i]``, ``copies[i]`` to a bin, the first at ``offset[i]``."""

    def __init__(self) -> None:
        self.rank, self.bin, self.copies, self.offset, self.used = [], [], [], [], 0

    def add(self, n: int, first_bin: int, copies: int, offset: int) -> None:
        for a, v in ((self.rank, self.used), (self.bin, first_bin), (self.copies, copies), (self.offset, offset)):
            a.append(v)
        self.used += n


def plan(histogram: dict[int, int], capacity: int) -> tuple[dict[int, Runs], int]:
    """Places for ``histogram[length]`` pieces of each length; and how many bins."""
    left = {n: c for n, c in sorted(histogram.items(), reverse=True) if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a piece must have from 1 to capacity tokens")
    runs = {n: Runs() for n in left}
    bins = 0
    gaps: list[int] = []  # in rising order, those of which some bins are open
    room: dict[int, list[tuple[int, int]]] = {}  # gap: (first bin, bins)

    def opened(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in room:
                bisect.insort(gaps, gap)
                room[gap] = []
            room[gap].append((first, n))

    large = [n for n in left if 3 * n > capacity]
    rising = sorted(large)
    for n in large:
        while left[n]:
            at = bisect.bisect_right(rising, min(capacity - n, n)) - 1
            while at >= 0 and (left[rising[at]] == 0 or rising[at] == n and left[n] < 2):
                if left[rising[at]] == 0:
                    rising.pop(at)
                at -= 1
            if at < 0:
                m = left[n]
                runs[n].add(m, bins, 1, 0)
                opened(capacity - n, bins, m)
                left[n] = 0
            else:
                mate = rising[at]
                m = left[n] // 2 if mate == n else min(left[n], left[mate])
                if mate == n:
                    runs[n].add(2 * m, bins, 2, 0)
                    left[n] -= 2 * m
                else:
                    runs[n].add(m, bins, 1, 0)
                    runs[mate].add(m, bins, 1, n)
                    left[n] -= m
                    left[mate] -= m
                opened(capacity - n - mate, bins, m)
            bins += m
    for n in (n for n in left if 3 * n <= capacity):
        todo = left[n]
        while todo:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):
                opened(capacity, bins, -(-todo // (capacity // n)))
                bins += -(-todo // (capacity // n))
                continue
            gap = gaps[at]
            first, count = room[gap].pop()
            if not room[gap]:
                del room[gap], gaps[at]
            each = gap // n
            full = min(count, todo // each)
            if full:
                runs[n].add(full * each, first, each, capacity - gap)
                opened(gap - each * n, first, full)
                todo -= full * each
            if full < count and todo:
                runs[n].add(todo, first + full, each, capacity - gap)
                opened(gap - todo * n, first + full, 1)
                full, todo = full + 1, 0
            opened(gap, first + full, count - full)
    return runs, bins


def encoded_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of each document: ids by the tokenizer, then ``end_id``, cut
    into pieces of ``capacity`` only if longer. ``ids`` holds little-endian
    unsigned 32-bit numbers; (part, nth) is the rank among a task's pieces of
    the same length. A null or empty text has the one token ``end_id``."""
    vocabulary = Vocabulary.load(docs.sparkSession, tokenizer)
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, nth = encoder(vocabulary), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for rows in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), lambda r: len(r[1] or "")):
                out = []
                for (doc, _), ids in zip(rows, encode.ids([r[1] for r in rows]), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        n = len(own) // 4
                        out.append((doc, k, at // 4, n, own, part, nth[n]))
                        nth[n] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids", "part", "nth"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id and offset, packed into few bins of ``capacity``.

    Needs ``length``, ``part`` and ``nth`` as ``encoded_pieces`` gives them and
    must be stable when read again (a table). Payload columns pass through. The
    driver sees the histogram of lengths alone; the places it sends out are
    runs over that histogram, bounded by the capacity too.
    """
    spark = pieces.sparkSession
    counts = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(histogram, capacity)
    table = spark.sparkContext.broadcast({n: tuple(np.asarray(x, np.int64) for x in (r.rank, r.bin, r.copies, r.offset)) for n, r in runs.items()})
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    # as many rows as parts and lengths: they grow with the pieces, so they are never broadcast
    ranked = pieces.join(base.hint("merge"), ["length", "part"]).withColumn("_rank", F.col("_base") + F.col("nth")).drop("_base", "part", "nth")
    payload = [c for c in ranked.columns if c != "_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                first, bin_, copies, start = table.value[int(n)]
                i = np.searchsorted(first, rank[own], side="right") - 1
                d = rank[own] - first[i]
                sequence[own] = bin_[i] + d // copies[i]
                offset[own] = start[i] + d % copies[i] * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in payload), pa.array(sequence), pa.array(offset)], [*payload, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.select(*payload).schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id,
    offset. Without ``keep_ids`` the ids are dropped once their checksum is taken.

    Pieces of a sequence follow one another without gaps from offset 0. Null
    texts count as empty; repeated ids and rows are packed each for itself; a
    null id stays null; other columns are ignored; an empty table gives none.
    """
    cut = encoded_pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
    cut = cut.withColumn("ids_crc32", F.crc32("ids"))
    return pack(materialize(cut if keep_ids else cut.drop("ids"), "pieces"), capacity)


def checksum(ids: bytes) -> int:
    """What ids_crc32 holds for a piece's ids."""
    return zlib.crc32(ids)
