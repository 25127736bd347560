"""Artist catalog and the resolution of recordings to artists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.numbers import id_of
from ..functions.text import normalize_composer, normalize_text
from .dedup import lowest_row

MAP_COLUMNS = ["artist_id", "artist", "musicnet_id", "composer_raw", "match_key", "match_type"]


def build_catalog(artists: DataFrame) -> DataFrame:
    """Raw ``(artist_id text, artist, url)`` to one row per artist with a normalised name."""
    clean = artists.select(
        id_of(artists, "artist_id"), normalize_text(F.col("artist")).alias("artist"),
        *[c for c in ("url",) if c in artists.columns],
    ).dropna(subset=["artist_id", "artist"])
    return lowest_row(clean, ["artist_id"])


def clean_recordings(recordings: DataFrame) -> DataFrame:
    """Raw ``(musicnet_id text, composer_raw)`` to usable rows with ``composer_norm``."""
    named = recordings.select(id_of(recordings, "musicnet_id"), "composer_raw")
    return named.dropna(subset=["musicnet_id", "composer_raw"]).withColumn(
        "composer_norm", normalize_composer(F.col("composer_raw"))
    )


def composer_aliases(spark: SparkSession) -> DataFrame:
    """The fixed spellings as ``(composer_norm, alias, ord)``."""
    rows = [(name, a, i) for name, aliases in C.COMPOSER_ALIASES.items() for i, a in enumerate(aliases, 1)]
    return spark.createDataFrame(rows, "composer_norm string, alias string, ord int")


def match_recordings(recordings: DataFrame, catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """Map each recording to an artist by name.

    Keys are tried in order: the composer itself, then its aliases.  The first key that any artist
    bears decides: borne by one artist it is the match, borne by several there is no match and no
    later key is tried.  Blank keys never match.

    Names are resolved once per distinct composer, so a composer with a large share of all
    recordings costs no more than any other; the recordings then look their composer up.
    ``recordings`` is read twice: hand in a stored table.
    """
    bearers = (
        catalog.filter(F.col("artist") != "")
        .groupBy(F.col("artist").alias("match_key")).agg(F.count(F.lit(1)).alias("bearers"), F.min("artist_id").alias("artist_id"))
    )
    exact = F.struct(F.lit(0).alias("ord"), F.col("composer_norm").alias("match_key"), F.lit("exact").alias("match_type"))
    other = F.struct(F.col("ord").cast("int").alias("ord"), normalize_text(F.col("alias")).alias("match_key"),
                     F.lit("alias").alias("match_type"))
    first_key = (
        recordings.select("composer_norm").distinct()
        .join(aliases, "composer_norm", "left")
        .select("composer_norm", F.inline(F.array(exact, other)))
        .join(bearers, "match_key")
        .groupBy("composer_norm")
        .agg(F.min_by(F.struct("bearers", "artist_id", "match_key", "match_type"), "ord").alias("hit"))
        .filter(F.col("hit.bearers") == 1)
        .select("composer_norm", "hit.artist_id", "hit.match_key", "hit.match_type")
    )
    matched = recordings.join(first_key, "composer_norm").select(
        "artist_id", F.col("match_key").alias("artist"), "musicnet_id", "composer_raw", "match_key", "match_type"
    )
    return lowest_row(matched, ["artist_id", "musicnet_id"]).select(*MAP_COLUMNS)


def attach_recordings(catalog: DataFrame, recording_map: DataFrame) -> DataFrame:
    """Catalog plus the lowest recording id of each artist, null where there is none."""
    first = recording_map.groupBy("artist_id").agg(F.min("musicnet_id").alias("musicnet_id"))
    return catalog.select("artist_id", "artist", "url").join(first, "artist_id", "left").select(
        "artist_id", "artist", "url", "musicnet_id"
    )


def without_recordings(catalog: DataFrame) -> DataFrame:
    """Catalog when no recordings are at hand: the id column is there and null."""
    return catalog.select("artist_id", "artist", "url", F.lit(None).cast("long").alias("musicnet_id"))


def master_table(ratings: DataFrame, catalog: DataFrame) -> DataFrame:
    """Ratings with all catalog columns; ratings whose artist is unknown stay."""
    lead = ["user_id", "artist_id", "artist", "rating", "url", "musicnet_id"]
    joined = ratings.join(catalog.drop("artist"), "artist_id", "left")
    return joined.select(*lead, *[c for c in joined.columns if c not in lead])
