"""What is left to do: ids asked for, minus those done, by whether their file is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def work_list(requested: DataFrame, done: DataFrame, present: DataFrame, key: str = "musicnet_id") -> DataFrame:
    """``(key, has_file)`` of the ids not done yet.  All three are compared on the key alone."""
    files = present.select(key).distinct().withColumn("found", F.lit(True))
    return (
        requested.select(key).distinct()
        .join(done.select(key), key, "left_anti")
        .join(files, key, "left")
        .select(key, F.col("found").isNotNull().alias("has_file"))
    )


def pending_ids(work: DataFrame) -> DataFrame:
    return work.filter("has_file").drop("has_file")


def missing_ids(work: DataFrame) -> DataFrame:
    return work.filter(~F.col("has_file")).drop("has_file")
