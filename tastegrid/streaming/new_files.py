"""Extraction over a folder that keeps growing.

The stream's own checkpoint remembers which files were seen; ids already in the feature table are
left out as well, so the stream may start on a table that a batch job has begun.  A batch run again after a crash adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.extract import append_batch, extract_features, unprocessed
from ..session import materialize
from ..sources.audio import numbered_files
from ..sources.tables import optional_table

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_IDS = T.StructType([T.StructField("musicnet_id", T.LongType())])


def start_extraction(spark: SparkSession, folder: str, extractor: Callable[[bytes], dict[str, float]],
                     features: list[str], features_path: str, failures_path: str, checkpoint: str,
                     pattern: str = "*.wav", files_per_batch: int = 1000):
    """Process all files now in ``folder`` in batches, then stop.  Returns the streaming query."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        done = optional_table(batch.sparkSession, features_path, _IDS)
        new = unprocessed(batch, done, most=files_per_batch)
        append_batch(materialize(extract_features(new, extractor, features), "extracted"), features_path, failures_path)

    files = (
        spark.readStream.format("binaryFile").schema(_FILES)
        .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(folder)
    )
    return numbered_files(files).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
