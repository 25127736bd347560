"""Feature extraction by a function of the caller, file by file, in Arrow batches.

The only place where rows leave the JVM.  A file that fails gives an error row, never a lost task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import append_table, optional_table

BROADCAST_FILES = 10_000


def extract_features(files: DataFrame, extractor: Callable[[bytes], dict[str, float]], features: list[str]) -> DataFrame:
    """``(musicnet_id, error, features...)``, one row per row of ``files (musicnet_id, content)``.

    ``extractor`` maps a file's bytes to the named features.
    """
    def one(content: bytes) -> dict:
        try:
            found = extractor(bytes(content))
            return {"error": None, **{f: float(found[f]) for f in features}}
        except Exception as problem:  # noqa: BLE001 - whatever the caller's code raises
            return {"error": f"{type(problem).__name__}: {problem}", **dict.fromkeys(features)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([one(c) for c in batch["content"]], columns=["error", *features])
            rows.insert(0, "musicnet_id", batch["musicnet_id"].to_numpy())
            yield rows.astype({f: "float64" for f in features})

    schema = T.StructType(
        [T.StructField("musicnet_id", T.LongType()), T.StructField("error", T.StringType())]
        + [T.StructField(f, T.DoubleType()) for f in features]
    )
    return files.select("musicnet_id", "content").mapInPandas(run, schema)


def features_of(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("error").isNull()).drop("error")


def failures_of(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("error").isNotNull()).select("musicnet_id", "error")


def unprocessed(files: DataFrame, done: DataFrame, most: int | None = None) -> DataFrame:
    """Rows of ``files (musicnet_id, path, content)`` whose id is not in ``done``, one per id (the first path).

    Ids and paths are compared without the content.  ``most`` tells how many files there are at most,
    if the caller knows; up to ``BROADCAST_FILES`` the list of them is sent to the readers, so no content is shuffled.
    """
    chosen = files.groupBy("musicnet_id").agg(F.min("path").alias("path")).join(done.select("musicnet_id"), "musicnet_id", "left_anti")
    if most is not None and most <= BROADCAST_FILES:
        chosen = F.broadcast(chosen)
    return files.join(chosen, ["musicnet_id", "path"], "left_semi")


def append_batch(extracted: DataFrame, features_path: str, failures_path: str) -> None:
    """Append one stored batch to both tables.  ``extracted`` must be materialised: it is read more than once.

    A batch that is run again adds nothing twice: ids with features and failures already noted are left out,
    also when the first run broke off between its files.
    """
    spark = extracted.sparkSession
    found, failed = features_of(extracted), failures_of(extracted)
    old, noted = optional_table(spark, features_path, found.schema), optional_table(spark, failures_path, failed.schema)
    append_table(found.join(old.select("musicnet_id"), "musicnet_id", "left_anti"), features_path)
    append_table(failed.join(noted, ["musicnet_id", "error"], "left_anti"), failures_path)
