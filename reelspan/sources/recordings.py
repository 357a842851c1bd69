"""Recordings: discovery, adapters to the long signal layout, and readers."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SCALAR_SUFFIX, sources_of
from ..functions.columns import ns_of_index, ns_of_timestamp
from . import rrd
from .rrd import RECORDING, discover  # noqa: F401

def resolve(name_or_path: str, recordings_dir: str) -> Path:
    """An existing folder as it stands, else one of that name among the recordings."""
    own = Path(name_or_path)
    return own if own.is_dir() else Path(recordings_dir) / name_or_path


def long_signals(wide: DataFrame, index: str, kind: str = "timestamp", segment: str = "segment_id", scalars: bool = False) -> DataFrame:
    """Sparse wide columns ``/<source>:Scalars:scalars`` to rows (segment_id, source,
    t_ns, seq, value); nulls are not stored. Only the signal columns are read."""
    sources = sources_of(wide.columns, SCALAR_SUFFIX)
    value = (lambda c: F.array(c.cast("double"))) if scalars else (lambda c: c.cast("array<double>"))
    entries = F.array(*(F.struct(F.lit(s).alias("source"), F.when(F.col(f"`/{s}{SCALAR_SUFFIX}`").isNotNull(), value(F.col(f"`/{s}{SCALAR_SUFFIX}`"))).alias("value")) for s in sources))
    rows = wide.select(F.col(segment).cast("string").alias("segment_id"), ns_of_index(F.col(index), kind).alias("t_ns"), F.monotonically_increasing_id().alias("seq"), F.explode(entries).alias("e"))
    return rows.filter("e.value IS NOT NULL").select("segment_id", "e.source", "t_ns", "seq", "e.value")


def event_signals(events: DataFrame) -> DataFrame:
    """An event table as scalar signals: a user is a segment, an event type a source."""
    return events.filter("value IS NOT NULL").select(F.col("user_id").cast("string").alias("segment_id"), F.col("event_type").alias("source"), ns_of_timestamp(F.col("ts")).alias("t_ns"), F.col("event_id").alias("seq"), F.array("value").alias("value"))


def embedding_signals(embeddings: DataFrame) -> DataFrame:
    """Vectors as one signal: a label is a segment, the vector's id its time."""
    return embeddings.select(F.col("label").cast("string").alias("segment_id"), F.lit("embedding").alias("source"), F.col("vec_id").alias("t_ns"), F.col("vec_id").alias("seq"), F.col("embedding").cast("array<double>").alias("value"))


def open_dataset(spark: SparkSession, location: str, catalog_url: str | None = None, index: str = "canonical_time") -> DataFrame:
    """The long signal table at a path, or of that name in the session's catalog.

    A folder of recordings in their native container, or such a file, is read through
    the ``rrd`` data source, a task for each file.
    """
    if catalog_url:
        return rrd.read(spark, location, index, url=catalog_url)
    if spark.catalog.tableExists(location) if "/" not in location else False:
        return spark.table(location)
    return rrd.read(spark, location, index) if is_recording(location) else spark.read.parquet(location)


def is_recording(location: str) -> bool:
    """Whether a path is a recording in its native container, or a folder with some."""
    root = Path(location)
    return location.endswith(".rrd") or (root / RECORDING).is_file() or root.is_dir() and any(root.glob(f"*/{RECORDING}"))


def load_info(root: str | Path) -> dict:
    """``meta/info.json`` of a written dataset, which must be of version v3.0."""
    path = Path(root) / "meta" / "info.json"
    if not path.is_file():
        raise FileNotFoundError(f"no {path}")
    info = json.loads(path.read_text())
    if info.get("codebase_version") != "v3.0":
        raise ValueError(f"expected a v3.0 dataset, found {info.get('codebase_version')}")
    return info


def load_episode_records(spark: SparkSession, root: str | Path) -> DataFrame:
    """Episode records of all metadata files."""
    base = Path(root) / "meta" / "episodes"
    if not any(base.glob("chunk-*/file-*.parquet")):
        raise FileNotFoundError(f"no episode metadata in {base}")
    return spark.read.option("mergeSchema", "true").parquet(f"{base}/chunk-*/file-*.parquet")


def load_data(spark: SparkSession, root: str | Path) -> DataFrame:
    """Frame rows of all data files."""
    return spark.read.parquet(f"{root}/data/chunk-*/file-*.parquet")


def data_rows(spark: SparkSession, root: str | Path) -> DataFrame:
    """(chunk, file, row_index, row): frame rows with their place, as ``rows_of_episodes`` takes them."""
    data = load_data(spark, root)
    chunk, file = (F.regexp_extract(F.col("_metadata.file_path"), r"chunk-(\d+)/file-(\d+)\.parquet$", i).cast("long") for i in (1, 2))
    return data.select(chunk.alias("chunk"), file.alias("file"), F.col("_metadata.row_index").alias("row_index"), F.struct(*(F.col(f"`{c}`") for c in data.columns)).alias("row"))


def load_tasks(root: str | Path) -> list[tuple[int, str]]:
    """(task_index, task) of ``meta/tasks.parquet``, whose index holds the tasks, or of
    ``meta/tasks.jsonl``; none where neither is there."""
    meta = Path(root) / "meta"
    if (meta / "tasks.parquet").is_file():
        tasks = pd.read_parquet(meta / "tasks.parquet")
        names = tasks["task"] if "task" in tasks.columns else tasks.index
        return sorted((int(i), str(t)) for i, t in zip(tasks["task_index"], names, strict=True))
    if (meta / "tasks.jsonl").is_file():
        return sorted((int(r["task_index"]), r["task"]) for r in map(json.loads, (meta / "tasks.jsonl").read_text().splitlines()))
    return []
