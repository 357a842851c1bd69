"""From signals to samples and an outcome for every segment, as one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ExportConfig
from ..functions.pixels import resized
from ..operators import asof, bounds, samples


@dataclass
class Episodes:
    """samples: segment_id, episode_index, frame_index, t_ns, action, state (images);
    status: segment_id, episode_index, status, reason, num_frames, duration_s."""

    samples: DataFrame
    status: DataFrame
    kept: DataFrame | None = None


def trim_of(signals: DataFrame, config: ExportConfig) -> DataFrame | None:
    t = config.trimming
    if t.mode == "signal_presence":
        return bounds.signal_presence(signals, t.source)
    if t.mode == "signal_change":
        return bounds.signal_change(signals, t.source, t.threshold, t.tail_ms)
    return None


def build(signals: DataFrame, config: ExportConfig, frames: DataFrame | None = None, step_ns: int | None = None, subset: list[str] | None = None, kind: str = "timestamp", keep: bool = False) -> Episodes:
    """``signals`` in the long layout, ``frames`` (segment_id, camera, t_ns,
    frame_seq, height, width, ...), which must be given where cameras are configured.

    A segment is skipped if it is too long, has no action samples, lacks a camera,
    or its ranges don't overlap; it fails if no row has all action sources, its
    trimming vectors differ in length, or no sample is left. Ranges come from
    cameras and the first action source; state does not narrow them. ``keep`` keeps
    the samples on disk, for callers that read both results.
    """
    if not config.action:
        raise ValueError("the configuration names no action source")
    if config.cameras and frames is None:
        raise ValueError(f"the configuration names cameras, but no frames are given: {', '.join(c.source for c in config.cameras)}")
    frames = frames.filter(F.col("camera").isin([c.source for c in config.cameras])) if config.cameras else None
    found = bounds.episode_indexes(bounds.segments(signals, subset))
    if subset:
        signals = signals.join(F.broadcast(found.select("segment_id")) if len(subset) <= 1000 else found.select("segment_id"), "segment_id", "left_semi")
    raw = bounds.with_durations(bounds.index_ranges(signals, config.index_column, kind))
    limit = config.max_episode_duration_s
    # those that are too long are the few; unknown durations pass
    usable = signals.join(raw.filter(F.col("duration_s") > limit).select("segment_id"), "segment_id", "left_anti") if limit else signals

    action = bounds.source_ranges(usable, config.action[:1]).select("segment_id", "start_ns", "end_ns")
    cameras = frames.groupBy("segment_id", "camera").agg(F.min("t_ns").alias("start_ns"), F.max("t_ns").alias("end_ns")) if frames is not None else None
    n_cameras = len({c.source for c in config.cameras})
    ranges = bounds.valid_ranges(action, cameras, n_cameras)
    trim = trim_of(usable, config)
    kept = bounds.trimmed(ranges, trim)
    grid = bounds.time_grid(kept, step_ns or config.step_ns)

    probes = usable.filter((F.col("source") == config.action[0]) & F.col("value").isNotNull()).select("segment_id", "t_ns")
    wanted = list(dict.fromkeys([*config.action, *config.state]))
    rows = samples.filled_vectors(asof.latest_at(probes, usable, wanted), config.action, config.state).withColumn("seq", F.lit(0).cast("long"))
    vectors = asof.nearest(grid, rows, ["action", "state"], keep=["frame_index"])
    images = None
    if n_cameras:
        # pixels stay out of the shuffle: only frame numbers are matched, per camera
        numbered = frames.select(F.concat_ws("\x1f", "segment_id", "camera").alias("segment_id"), "t_ns", F.col("frame_seq").alias("seq"), "frame_seq")
        names = F.array(*(F.lit(c.source) for c in config.cameras))
        asked = grid.select(F.explode(names).alias("camera"), "*").select(F.concat_ws("\x1f", "segment_id", "camera").alias("segment_id"), "t_ns")
        picked = asof.nearest(asked, numbered, ["frame_seq"])
        parts = F.split("segment_id", "\x1f")
        picked = picked.select(parts[0].alias("segment_id"), parts[1].alias("camera"), "t_ns", "frame_seq")
        payload = frames.select("segment_id", "camera", "frame_seq", F.struct(*(c for c in frames.columns if c not in ("segment_id", "camera", "t_ns"))).alias("frame"))
        # only frames that samples take are resized
        shown = resized(picked.join(payload, ["segment_id", "camera", "frame_seq"]), {c.source: c.resize for c in config.cameras if c.resize})
        images = samples.camera_frames(shown, n_cameras)
    made = samples.samples(vectors.select("segment_id", "frame_index", "t_ns"), vectors, images)

    if keep:
        made = made.persist(StorageLevel.DISK_ONLY)
    summary = samples.episode_summary(made)
    status = found.join(raw.select("segment_id", F.col("duration_s").alias("_raw_s")), "segment_id", "left")
    status = status.join(action.select("segment_id", F.lit(True).alias("_action")), "segment_id", "left")
    status = status.join(kept.select("segment_id", F.lit(True).alias("_kept")), "segment_id", "left").join(summary, "segment_id", "left")
    ragged = F.lit(False)
    if trim is not None and "ragged" in trim.columns:
        status = status.join(trim.filter("ragged").select("segment_id", F.lit(True).alias("_ragged")), "segment_id", "left")
        ragged = F.coalesce("_ragged", F.lit(False))
    too_long = F.coalesce(F.col("_raw_s") > limit, F.lit(False)) if limit else F.lit(False)
    reason = (
        F.when(too_long, "longer than the duration limit").when(F.col("_action").isNull(), "no action samples")
        .when(ragged, "vectors of the trimming source differ in length").when(F.col("_kept").isNull(), "no overlap of ranges")
        .when(F.col("num_frames").isNull(), "no complete sample").when(F.col("ragged_state"), "state vectors differ in length")
    )
    failed = ~too_long & F.col("_action").isNotNull() & (ragged | (F.col("_kept").isNotNull() & (F.col("num_frames").isNull() | F.col("ragged_state"))))
    outcome = F.when(failed, "failed").when(reason.isNotNull(), "skipped").otherwise("success")
    status = status.select("segment_id", "episode_index", outcome.alias("status"), reason.alias("reason"), F.coalesce("num_frames", F.lit(0)).alias("num_frames"), F.coalesce("duration_s", F.lit(0.0)).alias("duration_s"))
    good = status.filter("status = 'success'").select("segment_id", "episode_index")
    return Episodes(made.join(good, "segment_id"), status, made if keep else None)
