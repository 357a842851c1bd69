"""A v3.0 dataset laid out as v2.1: a file for each episode, metadata as JSON Lines."""

from __future__ import annotations

import json
import logging
import math
import os
import re
import shutil
import subprocess
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import file_groups, rows_of_episodes
from ..sources.recordings import data_rows, load_episode_records, load_info, load_tasks

log = logging.getLogger(__name__)

# fixed values: path templates and limits of the layout
DATA_FILE = "data/chunk-{chunk_index:03d}/file-{file_index:03d}.parquet"
DATA_PATH = "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet"
VIDEO_PATH = "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"
SOURCE_VIDEO_PATH = "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4"
VIDEO_SUFFIXES = (".mp4", ".avi", ".mov", ".mkv", ".webm")
SYSTEM_FOLDERS = ("/etc", "/proc", "/sys", "/dev", "/boot", "/bin", "/sbin", "/usr")
MOST_SECONDS, MOST_CLIP_SECONDS, CUT_TIMEOUT_S = 86_400, 3_600, 300
CHUNK_SIZE = 1000


def write_episodes(frames: DataFrame, root: str, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Write the ``row`` of each episode's rows (episode_index, row_index, row) to its
    file, in order, and return (episode_index, length, path).

    Rows are grouped by episode on the executors; a file is written under another
    name and moved, so a repeated task leaves one whole file. ``root`` must be a
    file system that the executors share.
    """

    def write(key: tuple, table: pa.Table) -> pa.Table:
        episode = key[0].as_py()
        rows = table.sort_by("row_index").column("row").combine_chunks()
        own = pa.Table.from_arrays(rows.flatten(), names=[f.name for f in rows.type])
        path = Path(root) / DATA_PATH.format(episode_chunk=episode // chunk_size, episode_index=episode)
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_name(f".{path.name}.{os.getpid()}")
        pq.write_table(own, part)
        part.replace(path)
        return pa.table({"episode_index": pa.array([episode], pa.int64()), "length": pa.array([len(own)], pa.int64()), "path": [str(path)]})

    return frames.select("episode_index", "row_index", "row").groupBy("episode_index").applyInArrow(write, "episode_index long, length long, path string")


def tasks_lines(tasks: list[tuple[int, str]]) -> list[str]:
    return [json.dumps({"task_index": i, "task": t}) for i, t in sorted(tasks)]


def unflatten(flat: dict, separator: str = "/") -> dict:
    out: dict = {}
    for key, value in flat.items():
        *path, last = key.split(separator)
        at = out
        for p in path:
            at = at.setdefault(p, {})
        at[last] = value
    return out


def plain(value):
    """Numpy values and containers as JSON can hold them."""
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    if hasattr(value, "tolist"):
        return plain(value.tolist())
    return value


_LEFT_OUT = ("data/", "videos/", "stats/", "meta/")


def episode_lines(records: DataFrame) -> DataFrame:
    """(episode_index, line, stats_line): records as JSON without layout columns, the
    length taken from the range where it is missing; statistics nested anew."""
    kept = [c for c in records.columns if not c.startswith(_LEFT_OUT) and c not in ("dataset_from_index", "dataset_to_index", "length")]
    span = F.col("dataset_to_index") - F.col("dataset_from_index")
    length = F.coalesce("length", span) if "length" in records.columns else span
    features: dict[str, list[str]] = {}
    for c in records.columns:
        if c.startswith("stats/"):
            feature, _, stat = c.removeprefix("stats/").rpartition("/")
            features.setdefault(feature, []).append(stat)
    stats = F.struct(*(F.struct(*(F.col(f"`stats/{f}/{s}`").alias(s) for s in names)).alias(f) for f, names in features.items())) if features else F.create_map().cast("map<string,string>")
    return records.select("episode_index", F.to_json(F.struct(*(F.col(f"`{c}`") for c in kept), length.cast("long").alias("length"))).alias("line"), F.to_json(F.struct("episode_index", stats.alias("stats"))).alias("stats_line"))


def converted_info(info: dict, records: int, chunk_size: int) -> dict:
    """info.json of the new layout; ``records`` stands in for a missing count of episodes."""
    features = {k: {n: v for n, v in f.items() if n != "fps" or f.get("dtype") == "video"} for k, f in info["features"].items()}
    videos = [k for k, f in features.items() if f.get("dtype") == "video"]
    out = {k: v for k, v in info.items() if k not in ("data_files_size_in_mb", "video_files_size_in_mb")}
    episodes = info.get("total_episodes") or records
    return out | {"codebase_version": "v2.1", "features": features, "chunks_size": chunk_size, "data_path": DATA_PATH, "video_path": VIDEO_PATH if videos and info.get("video_path") else None, "total_chunks": math.ceil(episodes / chunk_size), "total_videos": episodes * len(videos)}


def check_video_path(path: str) -> str:
    """Refuse names with control characters or other endings than a video's."""
    if re.search(r"[\x00-\x1f\x7f]", path):
        raise ValueError("control characters in a video path")
    if any(path == p or path.startswith(f"{p}/") for p in SYSTEM_FOLDERS):
        raise ValueError(f"a video path in a system folder: {path}")
    if Path(path).suffix.lower() not in VIDEO_SUFFIXES:
        raise ValueError(f"not a video file: {path}")
    return path


def clip_arguments(source: str, target: str, start: float, end: float) -> list[str]:
    """The stream copy of [start, end) seconds, once its limits are checked."""
    check_video_path(source)
    check_video_path(target)
    if not (0 <= start <= MOST_SECONDS and 0 <= end <= MOST_SECONDS and start < end and end - start <= MOST_CLIP_SECONDS):
        raise ValueError(f"no clip from {start} to {end} seconds")
    return ["ffmpeg", "-hide_banner", "-loglevel", "error", "-ss", f"{start:.6f}", "-i", source, "-t", f"{end - start:.6f}", "-c", "copy", "-avoid_negative_ts", "1", "-y", target]


def cut(source: str, target: str, start: float, end: float) -> None:
    """Cut with ffmpeg, which the executors must have."""
    command = clip_arguments(source, target, start, end)
    try:
        subprocess.run(command, check=True, timeout=CUT_TIMEOUT_S, capture_output=True, text=True)
    except FileNotFoundError as error:
        raise RuntimeError("there is no ffmpeg to cut videos with") from error
    except subprocess.TimeoutExpired as error:
        raise RuntimeError(f"ffmpeg took over {CUT_TIMEOUT_S} s for {target}") from error
    except subprocess.CalledProcessError as error:
        raise RuntimeError(f"ffmpeg failed for {target}: {error.stderr.strip()}") from error


def video_clips(records: DataFrame, videos: list[str], root: str, template: str = SOURCE_VIDEO_PATH) -> DataFrame:
    """(episode_index, video_key, source, start, end): each episode's video file and its
    [start, end) seconds there, for every camera. ValueError if records don't tell."""

    def of(key: str) -> DataFrame:
        names = [f"videos/{key}/{n}" for n in ("chunk_index", "file_index", "from_timestamp", "to_timestamp")]
        if gone := [n for n in names if n not in records.columns]:
            raise ValueError(f"the episode records lack {', '.join(gone)}")
        chunk, file, start, end = (F.col(f"`{n}`") for n in names)
        return records.select(F.col("episode_index").cast("long").alias("episode_index"), F.lit(key).alias("video_key"), chunk.cast("long").alias("chunk_index"), file.cast("long").alias("file_index"), start.cast("double").alias("start"), end.cast("double").alias("end"))

    rows = reduce(DataFrame.unionAll, map(of, videos))

    @F.pandas_udf("string")
    def source(key: pd.Series, chunk: pd.Series, file: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(c) or pd.isna(f) else f"{root}/" + template.format(video_key=k, chunk_index=int(c), file_index=int(f)) for k, c, f in zip(key, chunk, file, strict=True)], dtype=object)

    return rows.withColumn("source", source("video_key", "chunk_index", "file_index")).select("episode_index", "video_key", "source", "start", "end")


def check_clips(clips: DataFrame, episodes: int, videos: list[str]) -> None:
    """Every episode has a clip of every camera, within the limits, from a file that exists."""
    untold = clips.filter("source IS NULL OR start IS NULL OR `end` IS NULL").select("episode_index", "video_key").first()
    if untold:
        raise ValueError(f"episode {untold[0]} has no video file or times for {untold[1]}")
    n = clips.select("episode_index", "video_key").distinct().count()
    if n != episodes * len(videos):
        raise ValueError(f"the episode records name {n} videos for {episodes} episodes of {len(videos)} cameras")
    for r in clips.select("source").distinct().toLocalIterator():
        if not Path(check_video_path(r["source"])).is_file():
            raise FileNotFoundError(f"no {r['source']}")
    bad = clips.filter(f"NOT (start >= 0 AND `end` <= {MOST_SECONDS} AND start < `end` AND `end` - start <= {MOST_CLIP_SECONDS})").first()
    if bad:
        raise ValueError(f"no clip from {bad['start']} to {bad['end']} seconds")


def write_videos(clips: DataFrame, root: str, chunk_size: int = CHUNK_SIZE, cutter: Callable[[str, str, float, float], None] = cut) -> int:
    """Cut every clip on the executors and return how many there are. A clip is made
    under another name and moved, so a repeated task leaves one whole file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                path = Path(root) / VIDEO_PATH.format(episode_chunk=r.episode_index // chunk_size, video_key=r.video_key, episode_index=r.episode_index)
                path.parent.mkdir(parents=True, exist_ok=True)
                part = path.with_name(f".{os.getpid()}.{path.name}")
                cutter(r.source, str(part), r.start, r.end)
                if not part.is_file():
                    raise RuntimeError(f"the cutter made no {path}")
                part.replace(path)
            yield pd.DataFrame({"n": [len(pdf)]})

    spread = clips.repartition("episode_index", "video_key")
    return spread.mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def convert(spark: SparkSession, root: str, chunk_size: int | None = None, cutter: Callable[[str, str, float, float], None] | None = None) -> dict:
    """Convert a dataset in place: build beside it, then swap; the old one stays as
    ``<name>_v3.0``. Existing siblings of those names are refused, not deleted.

    Where there are video features, each episode's part is cut from its video file
    by ``cutter(source, target, start, end)``, ffmpeg if none is given. What can't be
    cut (no ffmpeg, no file, no times) is an error before anything is written, and so
    are data files that the records name and that aren't there. ``chunk_size`` is by
    default the dataset's own.
    """
    info = load_info(root)
    chunk_size = chunk_size or info.get("chunks_size") or CHUNK_SIZE
    old = Path(root)
    new, backup = old.with_name(f"{old.name}_v2.1"), old.with_name(f"{old.name}_v3.0")
    for p in (new, backup):
        if p.exists():
            raise FileExistsError(f"{p} exists; move it first")
    records = load_episode_records(spark, old)
    for r in file_groups(records).select("chunk_index", "file_index").toLocalIterator():
        if not (path := old / DATA_FILE.format(chunk_index=r["chunk_index"], file_index=r["file_index"])).is_file():
            raise FileNotFoundError(f"no {path}")
    n_records = records.count()
    videos = [k for k, f in info["features"].items() if f.get("dtype") == "video"]
    if videos:
        clips = video_clips(records, videos, str(old), info.get("video_path") or SOURCE_VIDEO_PATH)
        check_clips(clips, n_records, videos)
        if cutter is None and not shutil.which("ffmpeg"):
            raise RuntimeError("there is no ffmpeg to cut videos with")
    try:
        count = write_converted(spark, old, new, info, records, n_records, chunk_size)
        if videos:
            write_videos(clips, str(new), chunk_size, cutter or cut)
    except BaseException:
        shutil.rmtree(new, ignore_errors=True)  # what is half made would only be in the way
        raise
    old.rename(backup)
    new.rename(old)
    return {"episodes": count, "backup": str(backup)}


def write_converted(spark: SparkSession, old: Path, new: Path, info: dict, records: DataFrame, n_records: int, chunk_size: int) -> int:
    """Data and metadata of the new layout; how many episodes were written."""
    (new / "meta").mkdir(parents=True)
    written = write_episodes(rows_of_episodes(records, data_rows(spark, old)), str(new), chunk_size)
    count = written.agg(F.count("*")).first()[0]
    lines = episode_lines(records)
    for name, column in (("episodes.jsonl", "line"), ("episodes_stats.jsonl", "stats_line")):
        with open(new / "meta" / name, "w") as f:
            for r in lines.orderBy("episode_index").select(column).toLocalIterator():
                f.write(r[0] + "\n")
    (new / "meta" / "tasks.jsonl").write_text("".join(f"{x}\n" for x in tasks_lines(load_tasks(old))))
    (new / "meta" / "info.json").write_text(json.dumps(plain(converted_info(info, n_records, chunk_size)), indent=4))
    for name in ("stats.json", "modality.json"):
        if (old / "meta" / name).is_file():
            shutil.copy2(old / "meta" / name, new / "meta" / name)
        elif name == "modality.json":
            log.warning("there is no %s to take over", name)
    if (old / "images").is_dir():
        shutil.copytree(old / "images", new / "images")
    return count
