"""Whether a recording has what a configuration asks for."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ExportConfig

log = logging.getLogger(__name__)


def found_in(config: ExportConfig, signals: DataFrame, frames: DataFrame | None = None) -> dict[str, list[str]]:
    """What long tables of signals and frames have; their times are already those of the
    configured timeline."""
    return {
        "timelines": [config.index_column],
        "signals": sorted(r[0] for r in signals.select("source").distinct().collect()),
        "cameras": sorted(r[0] for r in frames.select("camera").distinct().collect()) if frames is not None else [],
    }


def missing_sources(config: ExportConfig, found: dict[str, list[str]]) -> list[str]:
    """A line for each kind of thing that is missing, with what there is instead."""
    wanted = {
        "timelines": [config.index_column],
        "signals": [*config.action, *config.state, *([config.trimming.source] if config.trimming.source else [])],
        "cameras": [c.source for c in config.cameras],
    }
    lines = []
    for kind, names in wanted.items():
        if gone := [n for n in dict.fromkeys(names) if n not in found[kind]]:
            lines.append(f"missing {kind}: {', '.join(gone)} (available: {', '.join(found[kind]) or 'none'})")
    return lines


def lacking(signals: DataFrame, sources: list[str]) -> DataFrame:
    """(segment_id, source) of the named sources that a segment has no samples of."""
    there = signals.filter(F.col("source").isin(sources)).select("segment_id", "source").distinct()
    wanted = signals.select("segment_id").distinct().select("segment_id", F.explode(F.array(*map(F.lit, sources))).alias("source"))
    return wanted.join(there, ["segment_id", "source"], "left_anti")


def validate_sources(config: ExportConfig, found: dict[str, list[str]] | None) -> None:
    """Raise ValueError for what is missing; an unreadable schema only warns."""
    if found is None:
        log.warning("the recording's schema can't be read; its sources aren't checked")
    elif lines := missing_sources(config, found):
        raise ValueError("; ".join(lines))
