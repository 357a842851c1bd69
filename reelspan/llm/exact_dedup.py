"""Exact duplicates with the heavy hitters split off.

A Misra-Gries pass over the text digests names every digest that can make up
more than 1/(counters+1) of the rows. Their exact sizes are counted, and the
verified ones (at most ``counters`` rows, so of bounded size) are broadcast:
their copies are decided where they are read. Every other digest goes through
one ordinary shuffle, in which no group is larger than that share.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import materialize, without


def misra_gries(counters: int):
    """Summarises a task's keys by at most ``counters`` counters.

    A counter falls short of its key's frequency by at most
    rows / (counters + 1), so no more frequent key is missed.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for v in batch.column(0).value_counts().to_pylist():
                held[v["values"]] = held.get(v["values"], 0) + v["counts"]
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = {k: n - cut for k, n in held.items() if n > cut}
        yield pa.RecordBatch.from_pydict({"digest": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

    return summary


def heavy_hitters(keyed: DataFrame, counters: int = 4096) -> DataFrame:
    """(digest, keep_id, group_size) of each digest with more than
    rows / (counters + 1) rows and at least two; at most ``counters`` rows.

    ``keyed`` has doc_id and digest. Sums of the tasks' summaries rank the
    candidates; an exact count verifies them.
    """
    named = (
        keyed.select("digest").mapInArrow(misra_gries(counters), "digest string, n long")
        .groupBy("digest").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "digest").limit(counters)
    )
    exact = keyed.join(F.broadcast(named.select("digest")), "digest").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    total = keyed.agg(F.count("*").alias("total"))
    return (
        exact.join(F.broadcast(total), (F.col("group_size") * (counters + 1) > F.col("total")) & (F.col("group_size") > 1))
        .select("digest", "keep_id", "group_size")
    )


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Column | None = None, counters: int = 4096) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``normalise`` is a column over ``docs`` that replaces the text in the
    comparison; by default texts are compared as they are. A null text counts
    as empty. Of equal texts the rows with the largest id stay: one row where
    ids are unique, all rows that repeat an id together with its text. A null
    id is smaller than any other; a group of null ids only stays whole. Other
    columns of ``docs`` are not looked at, whatever their names. An empty
    table gives an empty result.
    """
    digest = text_digest(normalise if normalise is not None else F.col(text_col))
    keyed = materialize(docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest")), "digests")
    # the winners are few and are used twice: a table keeps them from being counted again
    heavy = materialize(heavy_hitters(keyed, counters), "heavy")
    hot = keyed.join(F.broadcast(heavy), "digest")
    rest = keyed.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    group = Window.partitionBy("digest")
    rest = rest.select("digest", "doc_id", F.max("doc_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size"))
    return hot.select(*rest.columns).unionByName(rest).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 4096) -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep; same columns.

    Only ids and digests of dropped rows are joined. Rows that repeat an id are
    judged by their own texts; rows with a null id always stay.
    """
    gone = exact_duplicates(docs, id_col, text_col, counters=counters).filter(~F.col("kept")).select("doc_id", "text_sha256")
    return without(docs, id_col, text_digest(F.col(text_col)), gone)
