"""Audio files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import coerce_id


def audio_files(spark: SparkSession, folder: str, pattern: str = "*.wav") -> DataFrame:
    """``(musicnet_id, path, content)``, one row per file; names that are no number are left out.

    Select only ``musicnet_id`` and the scan lists the files without reading their bytes.
    """
    return numbered_files(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder))


def numbered_files(files: DataFrame) -> DataFrame:
    """The same from Spark's own file rows, read at once or as a stream; numbers beyond 64 bits are no numbers."""
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select(
        coerce_id(F.when(F.regexp_like(stem, F.lit(r"^[0-9]+$")), stem)).alias("musicnet_id"), "path", "content"
    ).filter(F.col("musicnet_id").isNotNull())
