"""Extraction over a growing folder, with the ids seen and the attempts made in the stream's state.

The state store holds one small row per id: the path taken and the attempts so far.  New files and
the failures of earlier batches are two sources of one stream, grouped by id; the state decides
what is tried.  No batch reads the feature table: a batch run again gets the same rows from the
state of its version and overwrites its own folder.  Bytes never pass the state's shuffle: it sees
ids and paths, and the chosen files are read afterwards.

Rules: of several files of one id the first path of the batch that brings the id counts, and later
files of it are left out; an id that failed is tried again in a later run of the stream until it has
had ``attempts`` tries; ids of ``done`` are never tried.  A failure note counts only if it is that
of the id's latest attempt, so a note written twice by a repeated batch does nothing.

Tables: ``features_path/<batch>`` and ``failures_path/<batch>``, one folder per batch; read them
with ``read_batches``.  A batch tries at most ``files_per_batch`` new files and as many second, third,
... tries, so the list of paths that the driver passes to the reader is bounded by
``files_per_batch * attempts``.  Files stay in the folder until they have been read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.extract import extract_features, failures_of, features_of
from ..session import materialize
from ..sources.audio import numbered_files

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
NOTES = "musicnet_id long, path string, attempt int, error string"
_STATE = "path string, attempts int"
_CHOSEN = "musicnet_id long, path string, attempt int"
DONE = -1


def choose(attempts: int) -> Callable:
    """What the state does with the rows of one id: ``attempt`` is 0 for a file, else that of a failure, or ``DONE``."""
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        path, made = state.get if state.exists else (None, 0)
        rows = pd.concat(list(batches), ignore_index=True)
        tries = rows["attempt"]
        if (tries == DONE).any():
            state.update((path, DONE))
            return
        files = rows["path"][tries == 0]
        again = made > 0 and made < attempts and bool((tries == made).any())
        if made == 0 and len(files):
            path = min(files)
        elif not again:
            return
        state.update((path, made + 1))
        yield pd.DataFrame({"musicnet_id": [key[0]], "path": [path], "attempt": [made + 1]})

    return step


def chosen_files(files: DataFrame, notes: DataFrame, done: DataFrame | None, attempts: int) -> DataFrame:
    """``(musicnet_id, path, attempt)`` to try now, from streams of files, failure notes and ids done."""
    rows = files.select("musicnet_id", "path", F.lit(0).alias("attempt")).unionByName(notes.select("musicnet_id", "path", "attempt"))
    if done is not None:
        rows = rows.unionByName(done.select(F.col("musicnet_id").cast("long"), F.lit(None).cast("string").alias("path"), F.lit(DONE).alias("attempt")))
    return rows.filter(F.col("musicnet_id").isNotNull()).groupBy("musicnet_id").applyInPandasWithState(
        choose(attempts), _CHOSEN, _STATE, "append", GroupStateTimeout.NoTimeout)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All batches of a table that the stream writes."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def feature_schema(features: list[str]) -> T.StructType:
    return T.StructType([T.StructField("musicnet_id", T.LongType()), *[T.StructField(f, T.DoubleType()) for f in features]])


def _literal(path: str) -> str:
    """A path for a reader that takes patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def start_stateful_extraction(spark: SparkSession, folder: str, extractor: Callable[[bytes], dict[str, float]], features: list[str],
                              features_path: str, failures_path: str, checkpoint: str, done_path: str | None = None,
                              pattern: str = "*.wav", files_per_batch: int = 1000, attempts: int = 3):
    """Process all files now in ``folder`` and the failures so far, then stop.  Returns the streaming query."""
    # The notes are a source of the stream before there is any.
    spark.createDataFrame([], NOTES).write.mode("ignore").parquet(f"{failures_path}/start")
    spark.createDataFrame([], feature_schema(features)).write.mode("ignore").parquet(f"{features_path}/start")

    def handle(batch: DataFrame, batch_id: int) -> None:
        todo = materialize(batch, "chosen")
        paths = [r["path"] for r in todo.select("path").collect()]
        if not paths:
            return
        contents = batch.sparkSession.read.format("binaryFile").load([_literal(p) for p in paths])
        tried = contents.select("path", "content").join(todo, "path")
        out = materialize(extract_features(tried, extractor, features), "extracted")
        features_of(out).write.mode("overwrite").parquet(f"{features_path}/{batch_id:09d}")
        notes = failures_of(out).join(todo, "musicnet_id").select("musicnet_id", "path", "attempt", "error")
        notes.coalesce(1).write.mode("overwrite").parquet(f"{failures_path}/{batch_id:09d}")

    files = numbered_files(
        spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(folder))
    notes = spark.readStream.schema(NOTES).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(failures_path)
    done = spark.readStream.schema("musicnet_id long").parquet(done_path) if done_path else None
    return (
        chosen_files(files, notes, done, attempts).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
