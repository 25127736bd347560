"""Summaries of interactions that are stored per part and merged later.

A part (a day, a shard) keeps one row: its row count, distinct-count sketches of users and items and a quantile sketch of its ratings, a
few kilobytes whatever its size.  Figures of any set of parts are merges of those rows; no interaction is read again.

Error bounds, as published for these sketches: a merged distinct count is off by 1.04 / sqrt(2^lg_k) in standard deviations (``DEVIATIONS`` of
them are allowed here), a quantile's rank by 2.296 / k^0.9723 at 99 % (twice that is allowed).

Edge cases: null ids and null ratings count in ``n_rows`` only; a part without ratings has no quantile; no parts, no figures (null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
QUANTILE_K = 800
DEVIATIONS = 5
QUANTILES = {"rating_p25": 0.25, "rating_median": 0.5, "rating_p75": 0.75}
COUNT_BOUND = DEVIATIONS * 1.04 / 2 ** (LG_K / 2)
RANK_BOUND = 2 * 2.296 / QUANTILE_K ** 0.9723


def part_sketches(interactions: DataFrame, part: Column) -> DataFrame:
    """``(part, n_rows, users, items, ratings)``: one row of sketches per part of (user_id, artist_id, rating)."""
    return interactions.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.hll_sketch_agg("user_id", F.lit(LG_K)).alias("users"),
        F.hll_sketch_agg("artist_id", F.lit(LG_K)).alias("items"),
        F.kll_sketch_agg_double(F.col("rating").cast("double"), F.lit(QUANTILE_K)).alias("ratings"),
    )


def merged_figures(sketches: DataFrame) -> DataFrame:
    """One row ``(n_rows, users, items, rating_*)`` from the rows of any parts."""
    merged = sketches.agg(
        F.sum("n_rows").alias("n_rows"), F.hll_union_agg("users").alias("u"), F.hll_union_agg("items").alias("i"),
        F.kll_merge_agg_double("ratings").alias("r"),
    )
    return merged.select(
        "n_rows", F.hll_sketch_estimate("u").alias("users"), F.hll_sketch_estimate("i").alias("items"),
        *[F.when(F.kll_sketch_get_n_double("r") > 0, F.kll_sketch_get_quantile_double("r", F.lit(q))).alias(name) for name, q in QUANTILES.items()],
    )


def figure_checks(interactions: DataFrame, figures: DataFrame) -> DataFrame:
    """``(measure, estimate, exact, error, within_bound)``: the merged figures beside the exact ones.

    The error of a count is relative; that of a quantile is how far the wanted rank lies outside the ranks the estimate holds.
    ``figures`` has one row, put beside the rows as scalars.
    """
    row = figures.select(F.struct("*").alias("s")).scalar()
    seen = interactions.withColumn("s", row)
    ranks = [F.count_if(F.col("rating") < F.col(f"s.{name}")).alias(f"{name}_below") for name in QUANTILES]
    ranks += [F.count_if(F.col("rating") <= F.col(f"s.{name}")).alias(f"{name}_upto") for name in QUANTILES]
    exact = seen.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("rating").alias("n_ratings"), F.count_distinct("user_id").alias("users"), F.count_distinct("artist_id").alias("items"),
        F.percentile("rating", list(QUANTILES.values())).alias("quantiles"), *ranks,
    ).withColumn("s", row)
    counts = [
        F.struct(F.lit(c).alias("measure"), F.col(f"s.{c}").cast("double").alias("estimate"), F.col(c).cast("double").alias("exact"),
                 F.abs(F.try_divide(F.col(f"s.{c}") - F.col(c), F.col(c))).alias("error"), F.lit(bound).alias("bound"))
        for c, bound in (("n_rows", 0.0), ("users", COUNT_BOUND), ("items", COUNT_BOUND))
    ]
    places = [
        F.struct(F.lit(name).alias("measure"), F.col(f"s.{name}").alias("estimate"), F.col("quantiles")[i].alias("exact"),
                 F.greatest(F.try_divide(F.col(f"{name}_below"), "n_ratings") - q, q - F.try_divide(F.col(f"{name}_upto"), "n_ratings"), F.lit(0.0)).alias("error"),
                 F.lit(RANK_BOUND).alias("bound"))
        for i, (name, q) in enumerate(QUANTILES.items())
    ]
    rows = exact.select(F.inline(F.array(*counts, *places)))
    return rows.select("measure", "estimate", "exact", "error", (F.col("error") <= F.col("bound")).alias("within_bound"))
