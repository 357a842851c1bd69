"""As-of joins within segments: latest-at and nearest.

Probes and data meet in one sorted pass by a window instead of a range join. A
long segment is cut into time buckets: the pass runs within a bucket, and what
stood last (or first) in the buckets before (or after) is carried in by a join on
one row a bucket, so no task holds a whole segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Default bucket: an hour, which at 250 samples a second is under a million rows a source.
BUCKET_NS = 3_600 * 10**9
_KEY = ("segment_id", "_bucket")


def bucketed(rows: DataFrame, bucket_ns: int) -> DataFrame:
    return rows.filter("t_ns IS NOT NULL").withColumn("_bucket", F.floor(F.col("t_ns") / bucket_ns).cast("long"))


def _carried(rows: DataFrame, found: dict[str, tuple[Column, list, bool, int]]) -> DataFrame:
    """Adds for each name the last non-null payload before a row in the given order.

    found: name -> (payload, order within a bucket, forward, last row of the
    frame). Payloads are structs that sort by time.
    """
    edges, carries = [], []
    for name, (payload, order, forward, upto) in found.items():
        own = Window.partitionBy(*_KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
        rows = rows.withColumn(f"_in_{name}", F.last(payload, ignorenulls=True).over(own))
        edges.append((F.max if forward else F.min)(payload).alias(f"_edge_{name}"))
        across = Window.partitionBy("segment_id").orderBy(F.col("_bucket") if forward else F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carries.append(F.last(f"_edge_{name}", ignorenulls=True).over(across).alias(f"_carry_{name}"))
    buckets = rows.groupBy(*_KEY).agg(*edges).select(*_KEY, *carries)
    out = rows.join(buckets, list(_KEY))
    for name in found:
        out = out.withColumn(name, F.coalesce(f"_in_{name}", f"_carry_{name}")).drop(f"_in_{name}", f"_carry_{name}")
    return out


def latest_at(probes: DataFrame, signals: DataFrame, sources: list[str], bucket_ns: int = BUCKET_NS) -> DataFrame:
    """``probes`` (segment_id, t_ns) with a column for each source: its latest value at
    or before the probe, null before its first. Of equal times the largest seq counts.

    Probes that repeat count once.
    """
    data = signals.filter(F.col("source").isin(sources) & F.col("value").isNotNull()).select("segment_id", "t_ns", F.lit(0).alias("_probe"), "source", "seq", "value")
    asked = probes.select("segment_id", "t_ns").distinct().select("segment_id", "t_ns", F.lit(1).alias("_probe"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("seq"), F.lit(None).cast(data.schema["value"].dataType).alias("value"))
    rows = bucketed(data.unionByName(asked), bucket_ns)
    order = [F.col("t_ns"), F.col("_probe"), F.col("seq")]
    found = {f"_v{i}": (F.when(F.col("source") == s, F.struct("t_ns", "seq", "value")), order, True, 0) for i, s in enumerate(sources)}
    filled = _carried(rows, found).filter("_probe = 1")
    return filled.select("segment_id", "t_ns", *(F.col(f"_v{i}")["value"].alias(s) for i, s in enumerate(sources)))


def nearest(grid: DataFrame, data: DataFrame, payload: list[str], bucket_ns: int = BUCKET_NS, keep: list[str] | None = None) -> DataFrame:
    """Each grid row with the payload of the nearest data row of its segment.

    The earlier of two equally near rows counts; beyond the ends the first or last
    row. Of equal data times, an exact hit and the later side take the first by
    seq, the earlier side takes the last. ``data`` has segment_id, t_ns, seq and
    the payload columns; grid rows of segments without data are left out.
    ``keep`` names the grid's columns beside segment_id and t_ns.
    """
    keep = keep or []
    extra = F.struct(*(F.col(c) for c in keep)) if keep else F.lit(None).cast("string")
    value = F.struct("t_ns", "seq", *payload)
    points = grid.select("segment_id", "t_ns", F.lit(1).alias("_probe"), F.lit(None).cast("long").alias("seq"), extra.alias("_keep"))
    there = data.filter("t_ns IS NOT NULL").select("segment_id", "t_ns", F.lit(0).alias("_probe"), "seq", value.alias("_data"))
    rows = bucketed(points.unionByName(there, allowMissingColumns=True), bucket_ns)
    before = [F.col("t_ns"), F.col("_probe").desc(), F.col("seq")]
    after = [F.col("t_ns").desc(), F.col("_probe"), F.col("seq").desc()]
    full = _carried(rows, {"_p": (F.col("_data"), before, True, -1), "_n": (F.col("_data"), after, False, -1)})
    pick = F.when(F.col("_n").isNull() | (F.col("t_ns") - F.col("_p")["t_ns"] <= F.col("_n")["t_ns"] - F.col("t_ns")), F.coalesce("_p", "_n")).otherwise(F.col("_n"))
    chosen = full.filter("_probe = 1").withColumn("_pick", pick).filter("_pick IS NOT NULL")
    return chosen.select("segment_id", "t_ns", *(F.col(f"_keep.{c}").alias(c) for c in keep), F.col("_pick")["t_ns"].alias("source_t_ns"), *(F.col("_pick")[c].alias(c) for c in payload))
