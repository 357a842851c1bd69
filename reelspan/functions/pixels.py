"""Resizing of frames."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resize_rgb(rgb: bytes, height: int, width: int, to_height: int, to_width: int) -> bytes:
    """Rows of RGB pixels at another size, bilinear between pixel centres; where several
    pixels fall on one they are averaged first, so that shrinking doesn't skip any."""
    image = np.frombuffer(rgb, np.uint8).reshape(height, width, 3).astype(np.float64)
    for axis, (old, new) in enumerate(((height, to_height), (width, to_width))):
        at = (np.arange(new) + 0.5) * old / new
        if new < old:
            # the mean over what each new pixel covers
            edges = np.arange(new + 1) * old / new
            total = np.concatenate((np.zeros_like(image.take([0], axis)), np.cumsum(image, axis)), axis)
            low = np.minimum(np.floor(edges).astype(int), old - 1)
            share = (edges - low).reshape([-1 if a == axis else 1 for a in range(3)])
            upto = total.take(low, axis) + image.take(low, axis) * share
            image = np.diff(upto, axis=axis) * new / old
        elif new > old:
            place = np.clip(at - 0.5, 0, old - 1)
            low = np.floor(place).astype(int)
            share = (place - low).reshape([-1 if a == axis else 1 for a in range(3)])
            image = image.take(low, axis) * (1 - share) + image.take(np.minimum(low + 1, old - 1), axis) * share
    return np.clip(np.rint(image), 0, 255).astype(np.uint8).tobytes()


def resized(picked: DataFrame, sizes: dict[str, tuple[int, int]]) -> DataFrame:
    """``picked`` (camera, frame with height, width and rgb) with the frames of the named
    cameras at their (width, height); others, and frames that fit, are left as they are."""
    if not sizes:
        return picked

    @F.pandas_udf("binary")
    def pixels(camera: pd.Series, height: pd.Series, width: pd.Series, rgb: pd.Series) -> pd.Series:
        return pd.Series([resize_rgb(bytes(p), h, w, sizes[c][1], sizes[c][0]) for c, h, w, p in zip(camera, height, width, rgb, strict=True)])

    width, height = (F.create_map(*(x for c, s in sizes.items() for x in (F.lit(c), F.lit(s[i]))))[F.col("camera")] for i in range(2))
    other = (F.col("frame.width") != width) | (F.col("frame.height") != height)
    misfit = F.coalesce(other, F.lit(False))
    fits = picked.filter(~misfit)
    frame = F.col("frame").withField("rgb", pixels("camera", "frame.height", "frame.width", "frame.rgb")).withField("width", width.cast("int")).withField("height", height.cast("int"))
    return fits.unionByName(picked.filter(misfit).withColumn("frame", frame))
