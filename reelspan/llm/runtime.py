"""What the corpus operators share on the Spark side: scratch tables and sizing."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

_LOCAL: list[str] = []
#: Paths of the scratch tables that stand.
_TABLES: list[str] = []


def _delete(paths: list[str]) -> None:
    """Delete tables in whatever store they are."""
    context = SparkContext._active_spark_context
    for path in paths:
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _drop_scratch() -> None:
    """Scratch tables go with the program that made them, at the latest."""
    if _TABLES and SparkContext._active_spark_context is not None:
        _delete(_TABLES)
    for path in _LOCAL:
        shutil.rmtree(path, ignore_errors=True)


class Scratch:
    """The scratch tables made within a ``scratch_tables`` block that are to stay."""

    def __init__(self) -> None:
        self.kept: set[str] = set()

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.add(df._scratch_path)
        return df


@contextmanager
def scratch_tables() -> Iterator[Scratch]:
    """Delete the scratch tables made in the block at its end, but for those kept.

    What leaves the block must be read from a kept table: then nothing later
    asks for the others, even where an executor is lost.
    """
    before, own = list(_TABLES), Scratch()
    yield own
    gone = [p for p in _TABLES if p not in before and p not in own.kept]
    _delete(gone)
    _TABLES[:] = [p for p in _TABLES if p not in gone]


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Only a local master may go without the setting; a temporary folder then
    stands in. On a cluster a missing setting is an error, since a
    machine-local folder would lose rows.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="corpus-"))
    return _LOCAL[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage at a table that survives the loss of an executor, and
    computes ``df`` once however often the result is read. The table is deleted
    at the end of the ``scratch_tables`` block around, or of the program.
    """
    spark = ship_package(df.sparkSession)
    path = scratch_path(spark, name)
    _TABLES.append(path)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._scratch_path = path
    return read


#: Tasks of a stage at most, which bounds what the driver keeps of a shuffle.
MOST_TASKS = 200_000
#: Estimates from here on are Catalyst's stand-ins for "unknown" or products of a join's sides.
UNKNOWN = 1 << 50


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the bytes that ``df`` reads, which works for any store;
    where it has none, the bytes of the text columns, counted."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate < UNKNOWN:
        return estimate
    texts = [F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)) for f in df.schema if f.dataType.simpleString() == "string"]
    return int(df.agg(sum(texts, F.lit(0)).alias("n")).first()["n"])


def pieces(df: DataFrame, bytes_each: int) -> int:
    """How many pieces of about ``bytes_each`` estimated bytes ``df`` has, at least the
    session's shuffle partitions, so that each piece fits a task at any size."""
    n = int(ship_package(df.sparkSession).conf.get("spark.sql.shuffle.partitions"))
    return max(n, math.ceil(input_bytes(df) / bytes_each))


def partitions(n: int) -> int:
    """Into how many partitions ``n`` pieces are dealt: beyond ``MOST_TASKS`` a task does
    several of them, one after the other."""
    return min(n, MOST_TASKS)


#: A key with more than one in so many of all rows is hot; there are fewer such keys.
HOT = 10_000


def dealt_join(left: DataFrame, right: DataFrame, key: str, row: list[str], sizes: DataFrame, n: int, made: Scratch | None = None) -> DataFrame:
    """``left``, a written table, with the columns of ``right``, which has a row for each
    ``key`` or none. The rows of a hot key are dealt, by the columns ``row``, to as many
    parts as its share of ``n``, each of which has a copy of the key's row in ``right``.
    ``sizes`` are the ``rows`` of each key in ``left``. What the result reads besides
    its inputs is kept by ``made``."""
    size = max(left.count(), 1)
    hot = sizes.filter(F.col("rows") * HOT > size).select(key, F.ceil(F.col("rows") / size * n).cast("int").alias("_parts")).filter("_parts > 1")
    # fewer than HOT rows, whatever the input
    hot = materialize(hot, "hot-keys")
    hot = F.broadcast(made.keep(hot) if made else hot)
    parts = F.coalesce("_parts", F.lit(1))
    copies = right.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    dealt = left.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*row), parts).cast("int")).drop("_parts")
    return dealt.join(copies, [key, "_part"], "left").drop("_part")


def text_key(text_col: str) -> Column:
    """What tells rows of one id apart by their texts."""
    return F.xxhash64(F.col(text_col))


def without(docs: DataFrame, id_col: str, key: Column, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and ``key`` are in the two columns of ``gone``,
    whatever the names of its columns. Rows with a null id stay."""
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))
    return rows.join(gone.toDF("gone_id", "gone_key"), (F.col(f"row.`{id_col}`") == F.col("gone_id")) & F.col("key").eqNullSafe(F.col("gone_key")), "left_anti").select("row.*")
