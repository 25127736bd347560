"""Write, audit, publish: rules are counted while a table is written, and only a table that holds them becomes visible.

A table is a folder of versions and a manifest beside them.  ``write_audited`` writes a new version with the rules observed on the rows as they pass
(``DataFrame.observe``): no second scan.  If no rule is broken the version is entered in the manifest, which is all that readers
look at; a refused version stays unnamed and can be inspected at its path.

The observation sits directly on the write, so a task that runs again is counted once.  Rules are sums over rows; rules on keys or on other tables
need their own jobs and stay in ``quality``.

Edge cases: an empty table breaks no row rule and is published; rules that give null count 0; of two writers of one table
the entry with the higher version wins, ties by path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, path string, n_rows long"
REPORT = "rule_id string, table_name string, rule string, passed boolean, detail bigint, published boolean"


def _manifest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The entries of a table; none before the first is published."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest") if found else None


def _latest(spark: SparkSession, folder: str):
    entries = _manifest(spark, folder)
    return None if entries is None else entries.orderBy(F.desc("version"), "path").limit(1).first()


def read_published(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest published version, or nothing."""
    entry = _latest(spark, folder)
    return None if entry is None else spark.read.parquet(entry["path"])


def write_audited(df: DataFrame, folder: str, table: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Write a version of ``df`` below ``folder`` and publish it if no rule ``(id, text, count of broken rows)`` is broken.

    Gives the report, one row per rule.
    """
    spark = df.sparkSession
    path, seen = f"{folder}/versions/{uuid.uuid4().hex}", Observation()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(rule) for rule, _, c in rules]
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts).write.mode("error").parquet(path)
    found = seen.get
    passed = all(found[rule] == 0 for rule, _, _ in rules)
    if passed:
        last = _latest(spark, folder)
        entry = [(1 if last is None else last["version"] + 1, path, found["n_rows"])]
        spark.createDataFrame(entry, MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return spark.createDataFrame([(rule, table, text, found[rule] == 0, found[rule], passed) for rule, text, _ in rules], REPORT)
