"""Scalar, vector and byte expressions, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ns_of_timestamp(ts: Column) -> Column:
    """Nanoseconds since the epoch; a time without zone counts as UTC by the session."""
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000).cast("long")


def ns_of_index(value: Column, kind: str) -> Column:
    """Nanoseconds of a timeline value: kind is sequence, timestamp or duration."""
    if kind == "timestamp":
        return ns_of_timestamp(value)
    return value.cast("long")


def duration_s(start_ns: Column, end_ns: Column, kind: Column | None = None) -> Column:
    """Seconds between two instants; unknown (null) on a sequence timeline."""
    seconds = (end_ns - start_ns) / F.lit(1e9)
    return seconds if kind is None else F.when(kind != "sequence", seconds)


def vector(value: Column, scalar: bool = False) -> Column:
    """A list of 32-bit floats; a scalar becomes one element."""
    return F.array(value.cast("float")) if scalar else F.transform(value, lambda x: x.cast("float"))


def concat_present(*parts: Column) -> Column:
    """Parts in order; null parts are skipped, so lengths may differ by row."""
    return F.flatten(F.filter(F.array(*parts), lambda p: p.isNotNull()))


def largest_change(a: Column, b: Column) -> Column:
    """Largest absolute difference of two vectors' elements. A null element makes it
    NaN; it is null if either vector is null or their lengths differ."""
    x = F.transform(a, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    y = F.transform(b, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    return F.when(F.size(a) == F.size(b), F.array_max(F.zip_with(x, y, lambda p, q: F.abs(p - q))))


def exceeds(change: Column, threshold: float) -> Column:
    """Strictly above the threshold; NaN and null are not."""
    return F.coalesce((change > threshold) & ~F.isnan(change), F.lit(False))


def is_annex_b(data: Column) -> Column:
    """Whether bytes begin with a three- or four-byte start code."""
    head = F.hex(F.substring(data, 1, 4))
    return F.coalesce(head.startswith("000001") | (head == "00000001"), F.lit(False))


def has_packet(data: Column) -> Column:
    return data.isNotNull() & (F.octet_length(data) > 0)


def flat_bytes(nested: Column) -> Column:
    """Bytes of nested lists of small integers; null is empty."""
    text = F.array_join(F.transform(F.coalesce(F.flatten(nested), F.array().cast("array<smallint>")), lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), "")
    return F.unhex(text)


def chunk_path(template: str, episode: Column, chunk_size: int) -> Column:
    """A path from the chunk number (episode div chunk_size) and the episode."""
    return F.format_string(template, F.floor(episode / chunk_size).cast("long"), episode)


def short_id(segment: Column) -> Column:
    return F.substring(segment, 1, 8)
