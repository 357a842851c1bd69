"""H.264 packet bytes: length-prefixed units to start codes, and the decoder's place."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import flat_bytes, has_packet

log = logging.getLogger(__name__)
#: Bytes of decoded pixels that a task hands on at a time.
FRAME_BYTES = 16 << 20
START_CODE = b"\x00\x00\x00\x01"


def annex_b_bytes(data: bytes, look_at_head: bool = True) -> bytes:
    """Units with start codes. Data that begins with a start code is returned as it
    is (``look_at_head``), even where that is the length of a unit of 256 to 511
    bytes; a unit cut short ends the loop."""
    if look_at_head and (data[:3] == START_CODE[1:] or data[:4] == START_CODE):
        return data
    out, at = [], 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + size > len(data):
            break
        out.append(START_CODE + data[at : at + size])
        at += size
    return b"".join(out)


def frame_times(packets: Iterable[tuple[int, bytes]], decode: Callable[[bytes | None], Iterator]) -> Iterator[tuple[int, object]]:
    """(time, frame) in order: a frame takes the time of the packet being fed when it
    came out. ``decode(None)`` flushes; frames that come then take the last known
    time, and are left out if none came before. Packets the decoder rejects, with
    whatever error its library has, are passed over."""
    last = None
    for t, data in packets:
        try:
            frames = list(decode(data))
        except Exception as error:  # noqa: BLE001
            log.debug("a packet at %d was rejected: %s", t, error)
            continue
        for frame in frames:
            last = t
            yield t, frame
    if last is not None:
        for frame in decode(None):
            yield last, frame


def av_decoder() -> Callable[[bytes | None], Iterator]:
    """A decoder of Annex-B packets by PyAV, which the executors must have."""
    import av

    codec = av.CodecContext.create("h264", "r")

    def decode(data: bytes | None) -> Iterator[tuple[int, int, bytes]]:
        for frame in codec.decode(None if data is None else av.Packet(data)):
            image = frame.to_ndarray(format="rgb24")
            yield image.shape[0], image.shape[1], image.tobytes()

    return decode


def decode_frames(packets: DataFrame, new_decoder: Callable[[], Callable[[bytes | None], Iterator]]) -> DataFrame:
    """Frames of every (segment_id, camera) by a decoder made anew for each.

    ``new_decoder()`` returns a callable from Annex-B bytes to frames (height,
    width, rgb bytes), as ``av_decoder`` does where PyAV is there.
    """

    columns = ["segment_id", "camera", "t_ns", "frame_seq", "height", "width", "rgb"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for pdf in batches for r in pdf.itertuples(index=False))
        held, size = [], 0
        for key, own in groupby(rows, key=lambda r: (r.segment_id, r.camera)):
            units = ((int(r.t_ns), annex_b_bytes(bytes(r.data))) for r in own)
            for i, (t, f) in enumerate(frame_times(units, new_decoder())):
                held.append((*key, t, i, *f))
                size += len(f[2])
                if size >= FRAME_BYTES:
                    yield pd.DataFrame(held, columns=columns)
                    held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=columns)

    # cells as lists of lists of small numbers, as recordings hold them, are bytes first
    data = F.col("data") if packets.schema["data"].dataType.simpleString() == "binary" else flat_bytes(F.col("data"))
    usable = packets.withColumn("data", data).filter(has_packet(F.col("data"))).select("segment_id", "camera", "t_ns", "seq", "data")
    # a camera's packets pass through a task one after the other; neither they nor its frames are gathered
    streams = usable.repartition("segment_id", "camera").sortWithinPartitions("segment_id", "camera", "t_ns", "seq")
    return streams.mapInPandas(run, "segment_id string, camera string, t_ns long, frame_seq long, height int, width int, rgb binary")
