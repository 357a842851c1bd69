"""Segments, their ranges, guards, trimming and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import duration_s, exceeds, largest_change
from .asof import BUCKET_NS, bucketed
from .order import running_total

#: Steps of a time grid that are made at a time.
GRID_STEPS = 10_000


def segments(signals: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Distinct segment ids; an empty subset means all."""
    found = signals.select("segment_id").distinct()
    return found.filter(F.col("segment_id").isin(subset)) if subset else found


def episode_indexes(found: DataFrame) -> DataFrame:
    """Positions of segments in sorted order, skipped ones included."""
    return running_total(found, "segment_id", None, "episode_index")


def index_ranges(signals: DataFrame, timeline: str = "canonical_time", kind: str = "timestamp") -> DataFrame:
    """Raw range of every segment over all its rows."""
    ranges = signals.groupBy("segment_id").agg(F.min("t_ns").alias("t_start"), F.max("t_ns").alias("t_end"))
    return ranges.select("segment_id", F.lit(timeline).alias("timeline"), "t_start", "t_end", F.lit(kind).alias("kind"))


def with_durations(ranges: DataFrame) -> DataFrame:
    return ranges.withColumn("duration_s", duration_s(F.col("t_start"), F.col("t_end"), F.col("kind")))


def within_duration(ranges: DataFrame, limit_s: float | None) -> DataFrame:
    """Segments not strictly longer than the limit; unknown durations pass."""
    timed = with_durations(ranges)
    return timed if limit_s is None else timed.filter(F.col("duration_s").isNull() | (F.col("duration_s") <= limit_s))


def source_ranges(signals: DataFrame, sources: list[str]) -> DataFrame:
    """First and last time of each named source in each segment."""
    return signals.filter(F.col("source").isin(sources) & F.col("value").isNotNull()).groupBy("segment_id", "source").agg(F.min("t_ns").alias("start_ns"), F.max("t_ns").alias("end_ns"))


def valid_ranges(action: DataFrame, cameras: DataFrame | None = None, n_cameras: int = 0) -> DataFrame:
    """Intersection of the action's range with those of all cameras, kept where it is
    longer than an instant. A segment that lacks a camera is left out.

    action: segment_id, start_ns, end_ns; cameras: one row a segment and camera.
    """
    both = action
    if cameras is not None and n_cameras:
        seen = cameras.groupBy("segment_id").agg(F.max("start_ns").alias("_s"), F.min("end_ns").alias("_e"), F.count("*").alias("_n")).filter(F.col("_n") == n_cameras)
        both = action.join(seen, "segment_id").select("segment_id", F.greatest("start_ns", "_s").alias("start_ns"), F.least("end_ns", "_e").alias("end_ns"))
    return both.filter("start_ns < end_ns")


def signal_presence(signals: DataFrame, source: str) -> DataFrame:
    """(segment_id, trim_start, trim_end) of the times at which a source has values."""
    own = signals.filter((F.col("source") == source) & F.col("value").isNotNull())
    return own.groupBy("segment_id").agg(F.min("t_ns").alias("trim_start"), F.max("t_ns").alias("trim_end"))


def consecutive_changes(signals: DataFrame, source: str, bucket_ns: int = BUCKET_NS) -> DataFrame:
    """(segment_id, t_ns, t_next, change, ragged) of neighbouring samples of a source
    over whole segments.

    Segments are cut into time buckets; the first sample of the next bucket that has
    one stands once more at the end of a bucket, so no task holds a whole segment.
    """
    own = bucketed(signals.filter((F.col("source") == source) & F.col("value").isNotNull()).select("segment_id", "t_ns", "seq", "value"), bucket_ns)
    heads = own.groupBy("segment_id", "_bucket").agg(F.min(F.struct("t_ns", "seq", "value")).alias("_head"))
    back = Window.partitionBy("segment_id").orderBy("_bucket")
    again = heads.select("segment_id", F.lag("_bucket").over(back).alias("_bucket"), "_head").filter("_bucket IS NOT NULL")
    rows = own.withColumn("_own", F.lit(True)).unionByName(again.select("segment_id", "_head.*", "_bucket", F.lit(False).alias("_own")))
    w = Window.partitionBy("segment_id", "_bucket").orderBy("t_ns", "seq")
    pairs = rows.select("segment_id", "t_ns", "_own", F.lead("t_ns").over(w).alias("t_next"), "value", F.lead("value").over(w).alias("_next")).filter("_own AND t_next IS NOT NULL")
    return pairs.select("segment_id", "t_ns", "t_next", largest_change(F.col("value"), F.col("_next")).alias("change"), (F.size("value") != F.size("_next")).alias("ragged"))


def signal_change(signals: DataFrame, source: str, threshold: float = 0.01, tail_ms: int = 500) -> DataFrame:
    """(segment_id, trim_start, trim_end, ragged): from the sample before the first
    change above the threshold to the sample after the last, and the tail. Both are
    null without any; ragged marks segments whose vectors differ in length, which
    cannot be trimmed."""
    moves = consecutive_changes(signals, source)
    active = exceeds(F.col("change"), threshold)
    return moves.groupBy("segment_id").agg(
        F.min(F.when(active, F.col("t_ns"))).alias("trim_start"),
        (F.max(F.when(active, F.col("t_next"))) + F.lit(tail_ms * 1_000_000).cast("long")).alias("trim_end"),
        F.bool_or("ragged").alias("ragged"),
    )


def trimmed(ranges: DataFrame, trim: DataFrame | None) -> DataFrame:
    """Ranges narrowed, never widened, by a trim; without one, as they are. What is
    then no longer than an instant goes."""
    if trim is None:
        return ranges
    both = ranges.join(trim.select("segment_id", "trim_start", "trim_end"), "segment_id", "left")
    start: Column = F.greatest("start_ns", F.coalesce("trim_start", "start_ns"))
    end: Column = F.least("end_ns", F.coalesce("trim_end", "end_ns"))
    return both.select("segment_id", start.alias("start_ns"), end.alias("end_ns")).filter("start_ns < end_ns")


def time_grid(ranges: DataFrame, step_ns: int) -> DataFrame:
    """(segment_id, frame_index, t_ns): every step from the start, the end included. Steps
    are made ``GRID_STEPS`` at a time, so the grid of a long segment is never one value."""
    last = F.floor((F.col("end_ns") - F.col("start_ns")) / step_ns).cast("long")
    some = ranges.select("segment_id", "start_ns", last.alias("_last")).withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), "_last", F.lit(GRID_STEPS).cast("long"))))
    steps = F.sequence("_first", F.least(F.col("_first") + GRID_STEPS - 1, F.col("_last")))
    return some.select("segment_id", "start_ns", F.explode(steps).alias("frame_index")).select("segment_id", "frame_index", (F.col("start_ns") + F.col("frame_index") * step_ns).alias("t_ns"))
