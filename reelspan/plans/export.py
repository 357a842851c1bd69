"""An export from signals to a written dataset."""

from __future__ import annotations

import logging
from collections.abc import Callable
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ExportConfig
from ..operators.samples import outcome_tally
from ..sinks.heads import ExportResult, make_head
from . import episodes
from .validate import validate_sources

log = logging.getLogger(__name__)


def export(signals: DataFrame, config: ExportConfig, output: str, frames: DataFrame | None = None, found: dict | None = None, subset: list[str] | None = None, progress: Callable[[int, int], None] | None = None, abort: Callable[[], bool] | None = None, step_ns: int | None = None, batch: int = 100_000) -> ExportResult:
    """Write the episodes of all segments that succeed.

    One bad segment stops nothing; if none succeeds, RuntimeError tells why.
    Episodes are written ``batch`` at a time: after each batch ``progress`` is told how
    many stand, and before each ``abort`` is asked; what is written by then is
    finalized, and nothing written is an error. Samples are made once and kept on
    disk for their tally, features and files.
    """
    if Path(output).exists():
        raise ValueError(f"the output exists: {output}")
    validate_sources(config, found)
    if config.cameras and frames is None:
        raise ValueError("the configuration names cameras; give their frames")
    if abort and abort():
        raise RuntimeError("aborted before any episode was written")
    built = episodes.build(signals, config, frames, step_ns, subset, keep=True)
    status = built.status.persist(StorageLevel.DISK_ONLY)
    try:
        tally = {r["status"]: r["n"] for r in outcome_tally(status).collect()}
        if not tally.get("success"):
            reasons = [f"{r['reason']}: {r['n']}" for r in status.groupBy("reason").agg(F.count("*").alias("n")).orderBy("reason").collect()]
            raise RuntimeError(f"no episode could be exported ({'; '.join(reasons) or 'no segments'})")
        if abort and abort():
            raise RuntimeError("aborted before any episode was written")
        head = make_head(config, output)
        total, written = sum(tally.values()), 0
        head.begin(built.samples)
        for first in range(0, head.episodes, batch):
            if written and abort and abort():
                break
            written = head.write(first, first + batch)
            if progress:
                progress(written, total)
        result = head.finalize()
        result.metadata |= {"attempted": sum(tally.values()), **{k: tally.get(k, 0) for k in ("success", "skipped", "failed")}}
        return result
    finally:
        status.unpersist()
        built.kept.unpersist()
