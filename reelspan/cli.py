"""Command line: export a dataset of recordings, or convert one to the older layout."""

from __future__ import annotations

import argparse
import importlib
import logging
import sys
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import ExportConfig
from .functions.packets import decode_frames
from .plans.export import export
from .plans.validate import found_in
from .session import build_session
from .sinks.convert import convert
from .sources import rrd
from .sources.recordings import is_recording, open_dataset, resolve


def frames_of(spark: SparkSession, args: argparse.Namespace, config: ExportConfig, location: str) -> DataFrame | None:
    """The frames of the configured cameras, decoded here where packets are given."""
    if not config.cameras:
        return None
    if args.frames:
        return spark.read.parquet(args.frames)
    module, _, name = args.decoder.partition(":")
    if not name:
        raise ValueError("--decoder is MODULE:NAME")
    if args.packets:
        packets = spark.read.parquet(args.packets)
    elif is_recording(location):
        packets = rrd.read(spark, location, config.index_column, "packets")
    else:
        raise ValueError("the configuration names cameras; give --frames or --packets")
    try:
        new_decoder = getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError) as error:
        raise ValueError(f"no such decoder: {args.decoder} ({error})") from error
    packets = packets.filter(F.col("camera").isin([c.source for c in config.cameras]))
    return decode_frames(packets, new_decoder).persist(StorageLevel.DISK_ONLY)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="reelspan")
    p.add_argument("-v", "--verbose", action="store_true")
    commands = p.add_subparsers(dest="command", required=True)
    e = commands.add_parser("export")
    e.add_argument("--recordings-dir", default=".")
    e.add_argument("--dataset", required=True)
    e.add_argument("--config", required=True)
    e.add_argument("--output", required=True)
    e.add_argument("--catalog-url")
    images = e.add_mutually_exclusive_group()
    images.add_argument("--frames", help="table of decoded frames: segment_id, camera, t_ns, frame_seq, height, width, rgb")
    images.add_argument("--packets", help="table of H.264 packets (segment_id, camera, t_ns, seq, data), decoded by --decoder")
    e.add_argument("--decoder", default="reelspan.functions.packets:av_decoder", help="MODULE:NAME of what makes a decoder, see functions.packets.decode_frames; by default PyAV's")
    c = commands.add_parser("convert")
    c.add_argument("dataset_dir")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    try:
        spark = build_session()
        if args.command == "convert":
            convert(spark, args.dataset_dir)
            return 0
        config = ExportConfig.from_json(Path(args.config).read_text())
        location = args.dataset if args.catalog_url else str(resolve(args.dataset, args.recordings_dir))
        signals, frames = open_dataset(spark, location, args.catalog_url, config.index_column), frames_of(spark, args, config, location)
        export(signals, config, args.output, frames, found_in(config, signals, frames), progress=lambda done, of: logging.info("%d of %d episodes written", done, of))
        if config.format == "groot":
            convert(spark, args.output)
    except (ValueError, RuntimeError, FileNotFoundError) as error:
        logging.error("%s", error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
