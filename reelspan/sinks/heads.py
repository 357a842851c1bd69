"""Writers of episode datasets, by format."""

from __future__ import annotations

import json
import shutil
from abc import ABC, abstractmethod
from dataclasses import dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ExportConfig
from ..operators.layout import row_ranges
from ..operators.order import running_total
from ..operators.samples import feature_statistics
from ..sources.recordings import load_data, load_episode_records

# fixed values: names of numbered files, how many a chunk holds, and the format's own columns
FILE_PATH = "chunk-{chunk_index:03d}/file-{file_index:03d}.parquet"
CHUNK_FILES = 1000
OWN_FEATURES = {k: {"dtype": t, "shape": [1], "names": None} for k, t in (("timestamp", "float32"), ("frame_index", "int64"), ("episode_index", "int64"), ("index", "int64"), ("task_index", "int64"))}
#: Episode records in a file.
RECORDS_PER_FILE = 100_000
#: The column that says which file a row goes to.
FILE = "_file"


def write_files(rows: DataFrame, order: list[str], folder: Path, first: int = 0) -> int:
    """Write ``rows`` to ``chunk-NNN/file-NNN.parquet`` below ``folder``, a file for each of
    their ``FILE`` numbers in order, from number ``first`` on; the number after the
    last. Executors write sorted parts; the driver gives them their names."""
    parts = folder.with_name(f".{folder.name}.parts")
    rows.repartition(FILE).sortWithinPartitions(FILE, *order).write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy(FILE).parquet(str(parts))
    for part in sorted(parts.glob(f"{FILE}=*/*.parquet"), key=lambda p: int(p.parent.name.partition("=")[2])):
        path = folder / FILE_PATH.format(chunk_index=first // CHUNK_FILES, file_index=first % CHUNK_FILES)
        path.parent.mkdir(parents=True, exist_ok=True)
        part.rename(path)
        first += 1
    shutil.rmtree(parts)
    return first


@dataclass
class ExportResult:
    format: str
    root: str
    episodes: int = 0
    frames: int = 0
    metadata: dict = field(default_factory=dict)


class Head(ABC):
    """A format: features from the first sample, then episodes, then the rest."""

    format_name: str

    def __init__(self, config: ExportConfig, root: str):
        self.config, self.root, self.features = config, root, None

    @abstractmethod
    def infer(self, samples: DataFrame) -> dict: ...

    @abstractmethod
    def begin(self, samples: DataFrame) -> None:
        """Take the samples of all episodes; sets ``episodes``, how many there are."""

    @abstractmethod
    def write(self, first: int, end: int) -> int:
        """Write the episodes from ``first`` to before ``end``; how many stand by then."""

    @abstractmethod
    def finalize(self) -> ExportResult: ...


class LeRobotHead(Head):
    """Frames in Parquet files, with episode records, tasks, statistics and info."""

    format_name = "lerobot_v3"
    #: Rows after which a data file ends with its episode.
    rows_per_file = 500_000
    #: Files that stand.
    files = 0

    def infer(self, samples: DataFrame) -> dict:
        """Type, shape and names of each feature, from the first sample."""
        first = samples.orderBy("episode_index", "frame_index").limit(1)
        shapes = [F.size("action").alias("action"), F.size("state").alias("state")]
        if "images" in samples.columns:
            shapes.append(F.transform_values("images", lambda _, v: F.struct(v["height"].alias("h"), v["width"].alias("w"))).alias("images"))
        row = first.select(*shapes).first()
        if row is None:
            raise RuntimeError("no sample to infer features from")
        found = {"action": {"dtype": "float32", "shape": [row["action"]], "names": None}}
        if row["state"] > 0:
            found["observation.state"] = {"dtype": "float32", "shape": [row["state"]], "names": None}
        for camera, size in sorted((row["images"] if "images" in samples.columns else {}).items()):
            found[f"observation.images.{camera}"] = {"dtype": "video" if self.config.cameras else "image", "shape": [size["h"], size["w"], 3], "names": ["height", "width", "channels"]}
        self.features = found
        return found

    def frames(self, samples: DataFrame) -> DataFrame:
        """A row for each sample, under the format's names; episodes are numbered anew."""
        kept = row_ranges(samples.groupBy("episode_index").agg(F.count("*").alias("length")))
        number = running_total(kept, "episode_index", None, "_episode").select("episode_index", "_episode", "dataset_from_index")
        rows = samples.join(number, "episode_index")
        columns = [F.col("action")]
        if "observation.state" in self.features:
            columns.append(F.col("state").alias("observation.state"))
        columns += [F.col("images")[k.removeprefix("observation.images.")].alias(k) for k in self.features if k.startswith("observation.images.")]
        place = F.expr("row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1").cast("long")
        file = F.floor(F.col("dataset_from_index") / self.rows_per_file).cast("long")
        return rows.select(*columns, F.lit(0).cast("long").alias("task_index"), F.col("_episode").cast("long").alias("episode_index"), place.alias("frame_index"), (F.col("dataset_from_index") + place).alias("index"), (place / self.config.fps).cast("float").alias("timestamp"), file.alias(FILE))

    def begin(self, samples: DataFrame) -> None:
        if self.features is None:
            self.infer(samples)
        if Path(self.root).exists():
            raise ValueError(f"the output exists: {self.root}")
        self.rows = self.frames(samples)
        self.episodes = self.rows.agg(F.max("episode_index").alias("last")).first()["last"] + 1

    def write(self, first: int, end: int) -> int:
        """Data in numbered files, an episode whole in one file."""
        own = self.rows.filter((F.col("episode_index") >= first) & (F.col("episode_index") < end))
        self.files = write_files(own, ["index"], Path(self.root) / "data", self.files)
        return min(end, self.episodes)

    def finalize(self) -> ExportResult:
        root = Path(self.root)
        self.written = load_data(self.rows.sparkSession, root)
        self._write_records(root)
        return self._write_metadata(root)

    def _write_records(self, root: Path) -> None:
        """A record for each episode that was written, with its place."""
        chunk, file = (F.regexp_extract(F.col("_metadata.file_path"), r"chunk-(\d+)/file-(\d+)\.parquet$", i).cast("long") for i in (1, 2))
        lengths = self.written.select("episode_index", chunk.alias("chunk"), file.alias("file")).groupBy("episode_index").agg(F.count("*").alias("length"), F.max("chunk").alias("chunk"), F.max("file").alias("file"))
        own = F.floor(F.col("episode_index") / RECORDS_PER_FILE).cast("long")
        records = row_ranges(lengths).select(
            "episode_index", F.array(F.lit(self.config.task_description)).alias("tasks"), "length",
            F.col("chunk").alias("data/chunk_index"), F.col("file").alias("data/file_index"), "dataset_from_index", "dataset_to_index",
            F.floor(own / CHUNK_FILES).cast("long").alias("meta/episodes/chunk_index"), (own % CHUNK_FILES).alias("meta/episodes/file_index"), own.alias(FILE),
        )
        write_files(records, ["episode_index"], root / "meta" / "episodes")

    def _write_metadata(self, root: Path) -> ExportResult:
        numbers = [k for k in self.features if k == "action" or k == "observation.state"]
        stats = {}
        for k in numbers:
            rows = feature_statistics(self.written.select(F.col(f"`{k}`").alias("v")), "v").orderBy("dim").collect()
            stats[k] = {n: [r[n] for r in rows] for n in ("min", "max", "mean", "std")} | {"count": [rows[0]["count"]] if rows else [0]}
        total = self.written.agg(F.count("*").alias("n"), F.max("episode_index").alias("last")).first()
        episodes = 0 if total["last"] is None else total["last"] + 1
        info = {
            "codebase_version": "v3.0", "repo_id": self.config.dataset_id, "fps": self.config.fps, "total_episodes": episodes, "total_frames": total["n"], "total_tasks": 1,
            "chunks_size": CHUNK_FILES, "data_path": f"data/{FILE_PATH}", "video_path": None, "splits": {"train": f"0:{episodes}"}, "features": self.features | OWN_FEATURES,
        }
        (root / "meta").mkdir(parents=True, exist_ok=True)
        (root / "meta" / "info.json").write_text(json.dumps(info, indent=4))
        (root / "meta" / "stats.json").write_text(json.dumps(stats, indent=4))
        pd.DataFrame({"task_index": [0]}, index=pd.Index([self.config.task_description], name="task")).to_parquet(root / "meta" / "tasks.parquet")
        return ExportResult(self.format_name, str(root), episodes, total["n"], {"features": self.features})


class GrootHead(LeRobotHead):
    """The same with a description of modalities."""

    format_name = "groot"

    def modality(self) -> dict:
        """Slices of state and action, by the source's name where there is one source."""
        if self.features is None:
            raise RuntimeError("features are not known yet")
        out: dict = {}
        for part, feature, names in (("state", "observation.state", self.config.state), ("action", "action", self.config.action)):
            if feature in self.features:
                out[part] = {names[0] if len(names) == 1 else part: {"start": 0, "end": self.features[feature]["shape"][0]}}
        images = [k for k in self.features if k.startswith("observation.images.")]
        if images:
            out["video"] = {k.removeprefix("observation.images."): {"original_key": k} for k in images}
        out["annotation"] = {"human.task_description": {"original_key": "task_index"}}
        return out

    def finalize(self) -> ExportResult:
        result = super().finalize()
        result.metadata["modality"] = self.modality()
        (Path(self.root) / "meta" / "modality.json").write_text(json.dumps(result.metadata["modality"], indent=2) + "\n")
        return result


HEADS = {h.format_name: h for h in (LeRobotHead, GrootHead)}


def make_head(config: ExportConfig, root: str) -> Head:
    if config.format not in HEADS:
        raise ValueError(f"unknown format: {config.format}")
    return HEADS[config.format](config, root)
