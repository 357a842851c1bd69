"""Recordings in their native container as a Spark data source.

The container's own library reads a file on the executor that has it; without the
library a read says so. Rows are those of the long signal layout.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..config import SCALAR_SUFFIX, VIDEO_SUFFIX, sources_of

RECORDING = "recording.rrd"


def discover(dataset_dir: str | Path) -> list[Path]:
    """Recording files: that of the folder itself, else those of its subfolders, sorted."""
    root = Path(dataset_dir)
    if not root.is_dir():
        raise FileNotFoundError(f"no such dataset folder: {root}")
    if (root / RECORDING).is_file():
        return [root / RECORDING]
    found = sorted(root.glob(f"*/{RECORDING}"))
    if not found:
        raise FileNotFoundError(f"no {RECORDING} in {root} or its subfolders")
    return found


SIGNALS = "segment_id string, source string, t_ns long, seq long, value array<double>"
PACKETS = "segment_id string, camera string, t_ns long, seq long, data binary"


def nanoseconds(times: pa.Array) -> pa.Array:
    """Index values as nanoseconds: times and durations in their unit, else as numbers."""
    if pa.types.is_timestamp(times.type):
        return pc.cast(pc.cast(times, pa.timestamp("ns", times.type.tz)), pa.int64())
    if pa.types.is_duration(times.type):
        return pc.cast(pc.cast(times, pa.duration("ns")), pa.int64())
    return pc.cast(times, pa.int64())


def long_batches(batch: pa.RecordBatch, index: str, segment: str, first: int, packets: bool) -> Iterator[pa.RecordBatch]:
    """A wide batch as rows of the long layout, a source at a time; nulls are not stored."""
    suffix, name, payload = (VIDEO_SUFFIX, "camera", "data") if packets else (SCALAR_SUFFIX, "source", "value")
    times = nanoseconds(batch.column(batch.schema.get_field_index(index)))
    for source in sources_of(batch.schema.names, suffix):
        cells = batch.column(batch.schema.get_field_index(f"/{source}{suffix}"))
        there = pc.and_(cells.is_valid(), times.is_valid())
        rows, own = pa.array(range(first, first + len(batch)), pa.int64()).filter(there), cells.filter(there)
        if packets:
            value = pa.array([flat(c.as_py()) for c in own], pa.binary())
        elif pa.types.is_list(own.type) or pa.types.is_large_list(own.type):
            value = pc.cast(own, pa.list_(pa.float64()))
        else:
            value = pa.array([[v] for v in own.to_pylist()], pa.list_(pa.float64()))
        n = len(own)
        yield pa.RecordBatch.from_arrays([pa.array([segment] * n, pa.string()), pa.array([source] * n, pa.string()), times.filter(there), rows, value], ["segment_id", name, "t_ns", "seq", payload])


def flat(cell) -> bytes:
    """Bytes of a cell: as they are, or of lists of small numbers, nested or not."""
    if isinstance(cell, bytes):
        return cell
    return b"".join(flat(c) if isinstance(c, list | bytes) else bytes([c]) for c in cell or ())


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class RecordingReader(DataSourceReader):
    """A partition for each file; a file is read in the batches that its library makes."""

    def __init__(self, files: list[str], index: str, packets: bool):
        self.files, self.index, self.packets = files, index, packets

    def partitions(self) -> list[InputPartition]:
        return [_File(f) for f in self.files]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        try:
            import rerun
        except ImportError as error:
            raise RuntimeError("reading .rrd recordings needs the rerun library on the executors") from error
        recording = rerun.dataframe.load_recording(partition.path)
        first = 0
        for batch in recording.view(index=self.index, contents="/**").select():
            yield from long_batches(batch, self.index, Path(partition.path).parent.name, first, self.packets)
            first += len(batch)


class RecordingSource(DataSource):
    """``spark.read.format("rrd")`` with options path, index, and what (signals or packets)."""

    @classmethod
    def name(cls) -> str:
        return "rrd"

    def _packets(self) -> bool:
        return self.options.get("what", "signals") == "packets"

    def schema(self) -> str:
        return PACKETS if self._packets() else SIGNALS

    def reader(self, schema) -> RecordingReader:
        path = self.options["path"]
        if "url" in self.options:
            raise ValueError("catalog servers can't be read; give a folder of recordings")
        files = [path] if path.endswith(".rrd") else [str(p) for p in discover(path)]
        return RecordingReader(files, self.options.get("index", "canonical_time"), self._packets())


def read(spark: SparkSession, path: str, index: str = "canonical_time", what: str = "signals", **options: str) -> DataFrame:
    """Signals or packets of a recording file, or of the recordings of a folder."""
    spark.dataSource.register(RecordingSource)
    return spark.read.format("rrd").options(path=path, index=index, what=what, **options).load()
