"""Stored answers of a tag service: JSON payloads to lists of tag names.

A payload is ``{"toptags": {"tag": [{"name": ...}, ...]}}``; a single tag may come as an object in
place of the list.  Anything else gives an empty list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import cache_key, distinct_in_order, normalize_tag
from .tables import path_exists

_MANY = "toptags struct<tag:array<struct<name:string>>>"
_ONE = "toptags struct<tag:struct<name:string>>"
_NO_TAGS = "array<string>"


def payload_tags(payload: Column) -> Column:
    """Normalised, distinct, non-blank tag names of a payload, in payload order."""
    many = F.from_json(payload, _MANY)["toptags"]["tag"]["name"]
    one = F.from_json(payload, _ONE)["toptags"]["tag"]
    names = F.coalesce(many, F.when(one.isNotNull(), F.array(one["name"])), F.array().cast(_NO_TAGS))
    return distinct_in_order(F.transform(names, normalize_tag))


def fallback_tags(payloads: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """``(artist_key, tags)``, one row per normalised key, from stored payloads; only successful calls count.

    Of several answers for a key the longest list counts, of equal lengths the first in order.
    Keys in ``cache`` (artist_key, tags) keep the cached list.
    """
    answers = payloads.filter(F.col("status") == "ok").select("artist_key", payload_tags(F.col("payload")).alias("tags"), F.lit(0).alias("cached"))
    if cache is not None:
        answers = answers.unionByName(cache.select("artist_key", "tags", F.lit(1).alias("cached")))
    keyed = answers.withColumn("artist_key", cache_key(F.col("artist_key"))).filter(F.col("artist_key") != "")
    rank = F.struct(-F.col("cached"), -F.size("tags"), F.array_join("tags", "\n"))
    return keyed.groupBy("artist_key").agg(F.min_by("tags", rank).alias("tags"))


def read_tag_cache(spark: SparkSession, path: str) -> DataFrame:
    """Key-to-tags table kept as JSON lines ``{"artist_key": ..., "tags": [...]}``.

    No file, no rows; a line that cannot be read gives no row.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.TAG_CACHE)
    return (
        spark.read.schema(schemas.TAG_CACHE).option("mode", "PERMISSIVE").json(path)
        .filter(F.col("artist_key").isNotNull())
        .select("artist_key", F.coalesce("tags", F.array().cast(_NO_TAGS)).alias("tags"))
    )


def write_tag_cache(tags: DataFrame, path: str) -> None:
    tags.select("artist_key", "tags").write.mode("overwrite").json(path)
