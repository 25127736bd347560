"""Summaries of per-file time series held as arrays.

A file's series is one row, so its summary needs no shuffle: the arrays are folded in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frame_mean(values: Column) -> Column:
    """Mean over the frames; null for no frames."""
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.when(F.size(values) > 0, total / F.size(values))


def frame_std(values: Column) -> Column:
    """Population standard deviation over the frames, about the mean (two passes)."""
    mean = frame_mean(values)
    centred = F.transform(values, lambda x: x.cast("double"))
    squares = F.aggregate(
        F.zip_with(centred, F.array_repeat(mean, F.size(values)), lambda x, m: (x - m) * (x - m)),
        F.lit(0.0), lambda a, x: a + x,
    )
    return F.when(F.size(values) > 0, F.sqrt(squares / F.size(values)))


def frame_stats(df: DataFrame, key: str, series: str) -> DataFrame:
    """``(key, n_frames, first_frame, mean, std)`` of one series per row."""
    s = F.col(series)
    return df.select(
        key,
        F.size(s).cast("long").alias("n_frames"),
        F.when(F.size(s) > 0, F.element_at(s, 1).cast("double")).alias("first_frame"),
        frame_mean(s).alias("mean"),
        frame_std(s).alias("std"),
    )


def audio_features(frames: DataFrame, key: str = "musicnet_id") -> DataFrame:
    """The 61 feature columns of each recording.

    ``frames`` has per row: ``mfcc`` 20 series, ``tempo`` one series, ``rms`` one series,
    ``chroma`` 12 series and ``contrast`` 7 series (a group of series is an array of arrays).
    """
    def group(name: str, count: int, std: bool = False) -> list[Column]:
        out = []
        for i in range(1, count + 1):
            values = F.element_at(name, i)
            out.append(frame_mean(values).alias(f"{name}_{i}_mean"))
            if std:
                out.append(frame_std(values).alias(f"{name}_{i}_std"))
        return out

    return frames.select(
        key,
        *group("mfcc", 20, std=True),
        F.try_element_at("tempo", F.lit(1)).cast("double").alias("tempo"),
        frame_mean(F.col("rms")).alias("rms_mean"),
        *group("chroma", 12),
        *group("contrast", 7),
    )
