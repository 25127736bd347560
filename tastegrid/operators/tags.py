"""Tag assignments to tag lists per artist.

Tags stay one row per (artist, tag) throughout; only the short display list becomes an array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.numbers import id_of
from ..functions.text import cache_key, normalize_tag, token_of


def clean_vocabulary(tags: DataFrame) -> DataFrame:
    """Raw ``(tag_id text, tag_name)`` to distinct usable rows; one id may bear several names."""
    return (
        tags.select(id_of(tags, "tag_id"), normalize_tag(F.col("tag_name")).alias("tag_name"))
        .dropna(subset=["tag_id"])
        .filter(F.col("tag_name") != "")
        .distinct()
    )


def clean_assignments(assignments: DataFrame) -> DataFrame:
    """Raw ``(user_id, artist_id text, tag_id text)`` to rows with usable ids."""
    return assignments.select("user_id", id_of(assignments, "artist_id"), id_of(assignments, "tag_id")).dropna(
        subset=["artist_id", "tag_id"]
    )


def tag_user_counts(assignments: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Distinct users per (artist, tag name): ``(artist_id, tag_name, tag_user_count)``.

    The distinct is by (artist, name, user), so neither a hot artist nor a hot tag gathers in one
    task; the count on top starts inside each task.
    """
    return (
        assignments.join(vocabulary, "tag_id")
        .groupBy("artist_id", "tag_name")
        .agg(F.countDistinct("user_id").alias("tag_user_count"))
    )


def top_tags(tag_counts: DataFrame, k: int = C.TOP_TAGS) -> DataFrame:
    """``(artist_id, tags_raw)``: the ``k`` most used tags, ties by name, joined with commas.

    The rank filter is applied inside each task before the shuffle (window group limit), so an
    artist with very many tags sends at most ``k`` rows per task.
    """
    best = Window.partitionBy("artist_id").orderBy(F.desc("tag_user_count"), F.asc("tag_name"))
    ranked = tag_counts.withColumn("position", F.row_number().over(best)).filter(F.col("position") <= k)
    ordered = F.array_sort(F.collect_list(F.struct("position", "tag_name")))
    return ranked.groupBy("artist_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["tag_name"]), ",").alias("tags_raw")
    )


def tag_lists(artists: DataFrame, tag_counts: DataFrame, fallback: DataFrame | None = None,
              k: int = C.TOP_TAGS) -> DataFrame:
    """All artists with their display list: own tags, else fallback tags, else the empty text.

    ``fallback`` is ``(artist_key, tags)``, unique on the key.
    """
    out = artists.select("artist_id", "artist").join(top_tags(tag_counts, k), "artist_id", "left")
    if fallback is not None:
        joined = out.join(
            fallback.withColumnRenamed("tags", "other"), cache_key(F.col("artist")) == F.col("artist_key"), "left"
        )
        other = F.array_join(F.slice("other", 1, k), ",")
        out = joined.select("artist_id", "artist", F.coalesce("tags_raw", other).alias("tags_raw"))
    return out.withColumn("tags_raw", F.coalesce("tags_raw", F.lit("")))


def missing_tags(artists: DataFrame, tag_counts: DataFrame) -> DataFrame:
    """Artists without any tag of their own."""
    return artists.select("artist_id", "artist").join(tag_counts.select("artist_id").distinct(), "artist_id", "left_anti")


def tag_documents(artists: DataFrame, tag_counts: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """``(artist_id, tag_name)`` of catalog artists, all tags: own ones, else the fallback's."""
    own = tag_counts.select("artist_id", "tag_name").join(artists.select("artist_id"), "artist_id", "left_semi")
    if fallback is None:
        return own
    other = missing_tags(artists, tag_counts).join(
        fallback, cache_key(F.col("artist")) == F.col("artist_key")
    ).select("artist_id", F.explode("tags").alias("tag_name"))
    return own.unionByName(other)


def tag_terms(documents: DataFrame, text: str = "tag_name", key: str = "artist_id") -> DataFrame:
    """One row per term occurrence of normalised texts.

    A term never spans two tags, so tags are cut one by one.
    """
    words = documents.select(key, F.explode(F.split(F.col(text), " ")).alias("word"))
    return words.select(key, token_of(F.col("word")).alias("term")).filter(F.col("term") != "")
