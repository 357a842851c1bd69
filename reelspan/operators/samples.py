"""Filled rows, samples and episode outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import concat_present, vector


def filled_vectors(filled: DataFrame, action: list[str], state: list[str]) -> DataFrame:
    """(segment_id, t_ns, action, state) of latest-at rows. A row goes if any action
    source has no value yet; state parts without value are skipped. Vectors stay
    doubles here and are narrowed in samples."""
    whole = filled.na.drop(subset=action)
    joined = F.concat(*(F.col(a) for a in action))
    parts = concat_present(*(F.col(s) for s in state)) if state else F.array().cast("array<double>")
    return whole.select("segment_id", "t_ns", joined.alias("action"), parts.alias("state"))


def camera_frames(picked: DataFrame, n_cameras: int) -> DataFrame:
    """(segment_id, t_ns, images) where all cameras have a frame; ``picked`` has one
    row a camera with frame (a struct)."""
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("camera", "frame"))))
    return picked.groupBy("segment_id", "t_ns").agg(F.count("*").alias("_n"), entries.alias("images")).filter(F.col("_n") == n_cameras).drop("_n")


def samples(grid: DataFrame, vectors: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Grid rows with vectors (and images) at exactly their time. frame_index stays
    the grid's, so a dropped sample leaves a gap."""
    out = grid.join(vectors.select("segment_id", "t_ns", "action", "state"), ["segment_id", "t_ns"])
    if images is not None:
        out = out.join(images, ["segment_id", "t_ns"])
    return out.withColumns({c: vector(F.col(c)) for c in ("action", "state")})


def episode_summary(found: DataFrame) -> DataFrame:
    """Frames, seconds from first to last, and whether state lengths differ, by segment."""
    return found.groupBy("segment_id").agg(
        F.count("*").alias("num_frames"),
        ((F.max("t_ns") - F.min("t_ns")) / F.lit(1e9)).alias("duration_s"),
        (F.min(F.size("state")) != F.max(F.size("state"))).alias("ragged_state"),
    )


def outcome_tally(status: DataFrame) -> DataFrame:
    """Segments by status (success, skipped, failed)."""
    return status.groupBy("status").agg(F.count("*").alias("n"))


def feature_statistics(rows: DataFrame, feature: str) -> DataFrame:
    """min, max, mean, population deviation and count of each dimension of a vector."""
    each = rows.select(F.posexplode(feature).alias("dim", "v")).withColumn("v", F.col("v").cast("double"))
    return each.groupBy("dim").agg(F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count("v").alias("count"))
