"""Play counts to ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import log_scale, no_nan


def rate_interactions(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """``(user_id, artist_id, weight)`` to ``(user_id, artist_id, artist, rating)``.

    * The scale is set by all interactions, also those whose artist is not in the catalog.
    * Rows without an id or weight are left out, for the extremes too: so both passes over the
      plays are one and the same plan, and a shuffle below them is done once.
    * One row per (user, artist): the lowest rating.  It is found before the join, on the pair
      key, which no hot user or hot artist can skew.
    * ``catalog`` is unique on ``artist_id``; whether it is broadcast is decided by its size.
    """
    plays = interactions.select("user_id", "artist_id", no_nan(F.col("weight")).alias("weight")).filter(
        F.col("user_id").isNotNull() & F.col("artist_id").isNotNull() & F.col("weight").isNotNull()
    )
    extremes = plays.agg(F.struct(F.min("weight").alias("lo"), F.max("weight").alias("hi")).alias("extremes")).scalar()
    pairs = (
        plays.groupBy("user_id", "artist_id").agg(F.min("weight").alias("weight"))
        .withColumn("extremes", extremes)
        .withColumn("rating", log_scale(F.col("weight"), F.col("extremes.lo"), F.col("extremes.hi")))
    )
    return pairs.join(catalog.select("artist_id", "artist"), "artist_id").select(
        "user_id", "artist_id", "artist", "rating"
    )
