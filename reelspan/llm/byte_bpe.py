"""Byte-level BPE by a global shuffle of distinct words.

Documents are read in blocks. Each block splits its texts into pre-tokens and
keeps, for every position, the number of the word standing there; its distinct
words, packed by hash bucket, go through one shuffle in which each distinct
word of the corpus is encoded once. The ids return to the blocks that asked,
and every document is put together by position. A frequent word costs a block
one entry, however often it stands there, so no word makes a task heavy.
"""

from __future__ import annotations

import hashlib
import pickle
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import partitions, pieces
from .textkit import chunks
from .tokenise import Vocabulary, ranks

#: Bytes of text whose words share a block.
BLOCK_BYTES = 24 << 20
_PARTS = "kind int, block long, bucket int, data binary"
_kept: dict[str, object] = {}


def packed(a: np.ndarray) -> bytes:
    """Numbers below 2**32, compressed byte plane by byte plane."""
    return zstandard.compress(a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def unpacked(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).reshape(-1).view("<u4")


def packed_strings(values: list[bytes]) -> bytes:
    head = packed(np.fromiter(map(len, values), np.uint32, len(values)))
    return struct.pack("<I", len(head)) + head + zstandard.compress(b"".join(values), 3)


def unpacked_strings(data: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<I", data)
    ends = np.cumsum(unpacked(data[4 : 4 + n]).astype(np.int64)).tolist()
    raw = zstandard.decompress(data[4 + n :])
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def tokenizer(v: Vocabulary, pattern: str):
    """This worker's tiktoken encoding of a vocabulary."""
    if v.digest not in _kept:
        import tiktoken

        _kept[v.digest] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(v.data.value), special_tokens={})
    return _kept[v.digest]


def token_bytes(v: Vocabulary) -> dict[int, bytes]:
    """The token-byte table: the bytes of each id; as long as the vocabulary."""
    if (key := f"bytes {v.digest}") not in _kept:
        _kept[key] = {i: b for b, i in ranks(v.data.value).items()}
    return _kept[key]


def _split_blocks(pattern: str, buckets: int):
    """Documents to rows of kind 0 (a bucket's words, by falling frequency), 1 (where the
    words of the buckets stand among the block's) and 2 (some documents, with the
    words of each by position). A block's words are numbered by falling frequency, so
    most positions take one or two bytes before they are compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, part, block = regex.compile(pattern).findall, TaskContext.get().partitionId(), 0
        number: dict[str, int] = {}
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = 0

        def row(kind: int, bucket: list, data: list[bytes]) -> pa.RecordBatch:
            n = len(data)
            return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.int32()), pa.array([(part << 32) + block] * n, pa.int64()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())], ["kind", "block", "bucket", "data"])

        def whole_block() -> Iterator[pa.RecordBatch]:
            often = np.zeros(len(number), np.int64)
            for _, _, at in held:
                often += np.bincount(at, minlength=len(often))
            coded = [w.encode() for w in number]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in coded), np.int64, len(coded))
            by_rank = np.argsort(-often, kind="stable")
            rank = np.empty_like(by_rank)
            rank[by_rank] = np.arange(len(by_rank))
            order = by_rank[np.argsort(bucket[by_rank], kind="stable")]
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for own in np.split(order, cuts[1:]) if len(order) else ():
                yield row(0, [bucket[own[0]]], [packed_strings([coded[i] for i in own])])
            yield row(1, [None], [packed(rank[order])])
            while held:
                docs, counts, at = held.pop()
                yield row(2, [None], [pickle.dumps((docs, packed(counts), packed(rank[at])), protocol=5)])

        for batch in batches:
            for rows in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), lambda r: len(r[1] or "")):
                counts, at = [], array("I")
                for _, text in rows:
                    found = find(text or "")
                    for w in found:
                        if w not in number:
                            number[w] = len(number)
                    at.extend(map(number.__getitem__, found))
                    counts.append(len(found))
                    size += len(text or "")
                held.append(([r[0] for r in rows], np.asarray(counts, np.uint32), np.frombuffer(at, np.uint32)))
                if size >= BLOCK_BYTES:
                    yield from whole_block()
                    number, size, block = {}, 0, block + 1
        if held:
            yield from whole_block()

    return run


def _words_of(table: pa.Table) -> pa.Table:
    """A block's words, bucket by bucket."""
    return table.filter(pc.equal(table.column("kind"), 0)).select(["block", "bucket", "data"])


def _encode_words(v: Vocabulary, pattern: str):
    """The ids of each block's words of a bucket; a bucket's rows stand together, and
    each of its distinct words is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memo, at = tokenizer(v, pattern)._encode_single_piece, {}, None
        for batch in batches:
            out = []
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data"), strict=True):
                if bucket != at:
                    memo, at = {}, bucket
                own = unpacked_strings(data.as_py())
                for w in own:
                    if w not in memo:
                        memo[w] = np.asarray(encode(w), "<u4").tobytes()
                ids = [memo[w] for w in own]
                out.append(packed(np.fromiter((len(x) // 4 for x in ids), np.uint32, len(ids))))
                out[-1] = struct.pack("<I", len(out[-1])) + out[-1] + packed(np.frombuffer(b"".join(ids), "<u4"))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), pa.array(out, pa.binary())], ["block", "bucket", "data"])

    return run


def _reassemble(finish):
    """A block's documents from its words' ids; ``finish(ids)`` gives the columns of one."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = sorted(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist(), strict=True))
        lengths, ids = [], []
        for _, data in found:
            (n,) = struct.unpack_from("<I", data)
            lengths.append(unpacked(data[4 : 4 + n]))
            ids.append(unpacked(data[4 + n :]))
        kinds = left.column("kind").to_pylist()
        order = unpacked(left.column("data")[kinds.index(1)].as_py()).astype(np.int64)
        n = np.concatenate([*lengths, np.empty(0, "<u4")]).astype(np.int64)
        flat = np.concatenate([*ids, np.empty(0, "<u4")])
        at = np.concatenate(([0], np.cumsum(n)))[:-1]
        length, start = np.empty_like(n), np.empty_like(n)
        length[order], start[order] = n, at  # by the block's own numbers
        docs, out = [], []
        for kind, data in zip(kinds, left.column("data"), strict=True):
            if kind == 2:
                own, counts, at = pickle.loads(data.as_py())
                w = unpacked(at)
                m = length[w]
                ends = np.cumsum(m)
                flat_ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[w] - ends + m, m)]
                words_to = np.cumsum(unpacked(counts).astype(np.int64))
                to = np.concatenate(([0], ends))[np.concatenate(([0], words_to))]
                docs += own
                out += [finish(flat_ids[i:j]) for i, j in zip(to[:-1], to[1:], strict=True)]
        return pa.table([pa.array(docs, pa.int64()), *(pa.array(x, t) for x, t in zip(zip(*out, strict=True), finish.types, strict=True))], names=["doc_id", *finish.names])

    return run


class _Digests:
    """Of a document: how many ids, the digest of their decimals, and that of the bytes they decode to."""

    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    types = (pa.int64(), pa.string(), pa.string())

    def __init__(self, v: Vocabulary):
        self.v = v

    def __call__(self, ids: np.ndarray) -> tuple:
        table = token_bytes(self.v)
        if (key := f"decimal {self.v.digest}") not in _kept:
            _kept[key] = {i: str(i) for i in table}
        listed = ids.tolist()
        text = " ".join(map(_kept[key].__getitem__, listed))
        return len(listed), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(b"".join(map(table.__getitem__, listed))).hexdigest()


class _Ids:
    """Of a document: its ids and the bytes they decode to."""

    names = ("ids", "decoded")
    types = (pa.list_(pa.int32()), pa.binary())

    def __init__(self, v: Vocabulary):
        self.v = v

    def __call__(self, ids: np.ndarray) -> tuple:
        return ids.astype(np.int32), b"".join(map(token_bytes(self.v).__getitem__, ids.tolist()))


def _encoded(docs: DataFrame, path: str, pattern: str, finish, schema: str, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    v = Vocabulary.load(spark, path)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    buckets, blocks = pieces(source, 4 << 20), pieces(source, BLOCK_BYTES)
    # one shuffle of all parts, read by both branches; a task takes block after block
    by_block = source.mapInArrow(_split_blocks(pattern, buckets), _PARTS).repartition(partitions(blocks), "block").groupBy("block")
    words = by_block.applyInArrow(_words_of, "block long, bucket int, data binary").repartition(partitions(buckets), "bucket").sortWithinPartitions("bucket")
    ids = words.mapInArrow(_encode_words(v, pattern), "block long, bucket int, data binary").repartition(partitions(blocks), "block")
    return by_block.cogroup(ids.groupBy("block")).applyInArrow(_reassemble(finish(v)), schema)


def encode_digests(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row, ids encoded and
    decoded as in ``encode``, without carrying them on."""
    return _encoded(docs, vocabulary, pattern, _Digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col)


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary) of each row.

    A null text counts as empty and has no ids. Repeated ids and rows each get
    their own row, null ids stay null, other columns are ignored, texts of any
    length are whole, and an empty table gives an empty result.
    """
    return _encoded(docs, vocabulary, pattern, _Ids, "doc_id long, ids array<int>, decoded binary", id_col, text_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the bytes of its ids, by the token-byte table, which is broadcast
    since it is as long as the vocabulary. A null list decodes to no bytes; an id
    outside the vocabulary raises KeyError."""
    v = Vocabulary.load(encoded.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(v)
        for batch in batches:
            out = [b"".join(table[i] for i in ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col)).mapInArrow(run, "doc_id long, decoded binary")
