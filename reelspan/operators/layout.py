"""Episodes in files: ranges, groups and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import running_total


def row_ranges(lengths: DataFrame) -> DataFrame:
    """(episode_index, length) with half-open positions of all rows in episode order."""
    placed = running_total(lengths, "episode_index", "length", "dataset_from_index")
    return placed.withColumn("dataset_to_index", F.col("dataset_from_index") + F.col("length"))


def file_groups(records: DataFrame, chunk: str = "data/chunk_index", file: str = "data/file_index") -> DataFrame:
    """Episodes and first position of each file."""
    return records.groupBy(F.col(f"`{chunk}`").alias("chunk_index"), F.col(f"`{file}`").alias("file_index")).agg(F.count("*").alias("n_episodes"), F.min("dataset_from_index").alias("file_offset"))


def camera_groups(records: DataFrame, camera: str) -> DataFrame:
    """Episodes of each video file of a camera; records without one are passed over."""
    chunk, file = (F.col(f"`videos/{camera}/{n}`") for n in ("chunk_index", "file_index"))
    return records.filter(chunk.isNotNull() & file.isNotNull()).groupBy(chunk.alias("chunk_index"), file.alias("file_index")).agg(F.count("*").alias("n_episodes"))


def within_file(records: DataFrame) -> DataFrame:
    """Each episode's rows relative to its file: local_from, local_to."""
    w = Window.partitionBy("`data/chunk_index`", "`data/file_index`")
    offset = F.min("dataset_from_index").over(w)
    return records.withColumn("local_from", F.col("dataset_from_index") - offset).withColumn("local_to", F.col("dataset_to_index") - offset)


def rows_of_episodes(records: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of data files with the episode they are for.

    ``rows`` carry chunk, file and row_index within the file. The file's ranges are
    looked up by its key; a file has as many as its episodes, and ranges don't
    overlap, so the join makes one row for each row. An episode of no or negative
    length is an error.
    """
    local = within_file(records).select(F.col("`data/chunk_index`").alias("chunk"), F.col("`data/file_index`").alias("file"), "episode_index", "local_from", "local_to")
    told = F.concat(F.lit("invalid length of episode "), F.col("episode_index").cast("string"))
    local = local.withColumn("local_to", F.when(F.col("local_to") > F.col("local_from"), F.col("local_to")).otherwise(F.raise_error(told).cast("long")))
    w = Window.partitionBy("chunk", "file").orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = local.select("chunk", "file", F.col("local_from").alias("_at"), F.lit(0).alias("_row"), F.struct("episode_index", "local_to").alias("_own"))
    data = rows.select("chunk", "file", F.col("row_index").alias("_at"), F.lit(1).alias("_row"), F.struct("*").alias("_data"))
    found = data.unionByName(marks, allowMissingColumns=True).withColumn("_own", F.last("_own", ignorenulls=True).over(w)).filter("_row = 1 AND _at < _own.local_to")
    return found.select("_data.*", F.col("_own.episode_index").alias("episode_index"))


def task_indexes(tasks: DataFrame) -> DataFrame:
    """(task_index, task) of the distinct tasks, in their order."""
    return running_total(tasks.select("task").filter("task IS NOT NULL").distinct(), "task", None, "task_index").select("task_index", "task")


def totals(episodes: Column, chunk_size: int, cameras: int) -> tuple[Column, Column]:
    """Chunks and videos of so many episodes."""
    return F.ceil(episodes / chunk_size).cast("long"), (episodes * cameras).cast("long")
