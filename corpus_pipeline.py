"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, folder of the tables), works on all rows it is given and returns the
documents it keeps with the columns of ``documents``; the last returns sequences.  ``run`` writes each
stage's result as Parquet to the shared folder and reads it back for the next.

Further columns than those of ``documents`` are left out at the start of a stage, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.llm import jaccard, language, mixing, packing, queries
from tastegrid.session import materialize

LEAST_SCORE = 0.5
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: no letter at all, or no language at least as likely as the rest together."""
    docs = docs.select(*COLUMNS)
    judged = language.identify(docs, docs.filter(~queries.held_out()), COLUMNS)
    return judged.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row of the least (doc_id, row number) stays; of repeated rows without words, one.

    Rows are numbered and stored first, so rows are compared by their texts, also where they share an id or have none.
    """
    rows = materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row_id")), "pipeline-numbered")
    groups = jaccard.jaccard_components(rows.select(F.col("row_id").alias("doc_id"), "text"))
    found = materialize(groups.select(F.col("doc_id").alias("row_id"), "n_shingles", "component_id"), "pipeline-groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
    worded = found.filter("n_shingles > 0").join(rows.select("row_id", "doc_id"), "row_id")
    stays = worded.groupBy("component_id").agg(first.alias("first")).select("first.row_id")
    bare = rows.join(found.filter("n_shingles = 0").select("row_id"), "row_id", "left_semi").select(*COLUMNS).distinct()
    return rows.join(stays, "row_id", "left_semi").select(*COLUMNS).unionByName(bare)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each whole: the one at the edge of a source's budget goes once more or not, whichever is nearer.

    Rows are numbered and stored first, so repeated rows are mixed each and meet only their own share.
    """
    rows = materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row_id")), "pipeline-rows")
    times = F.col("copies") + (2 * F.col("cut_words") > F.col("size")).cast("int")
    mixed = mixing.mix(rows, keep=("row_id",)).select("row_id", times.cast("int").alias("times")).filter("times > 0")
    return rows.join(mixed, "row_id").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: where each piece of each document lies."""
    return packing.pack_documents(docs, queries.ranks_path())


STAGES = [("language", language_stage), ("near_duplicates", near_duplicate_stage), ("mixing", mixing_stage), ("packing", packing_stage)]
ORACLE_SQL = None  # the stages learn, hash and search; they are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
