"""Per-user train and test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .skew import rank_in_group


def shuffle_key(seed: int = C.SPLIT_SEED) -> Column:
    """Reproducible random order of a user's rows: same on every cluster and in any SQL engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("user_id").cast("string"), F.col("artist_id").cast("string")))


def label_split(ratings: DataFrame, test_share: float = C.TEST_SHARE, seed: int = C.SPLIT_SEED) -> DataFrame:
    """Ratings plus ``is_test``.

    A user with ``n`` rows gives ``max(1, round(share * n))`` of them to test, a user with fewer
    than two gives none.  Hand in a stored table: its rows are counted first.
    """
    digest = F.unhex(shuffle_key(seed))  # its bytes have the order of its text; made again where it is needed, it is never stored
    ranked = rank_in_group(ratings, ["user_id"], [digest, F.col("artist_id")], rank="rn", size="n", label="split-order", rows=ratings.count())
    n_test = F.greatest(F.lit(1), F.rint(F.col("n") * test_share).cast("long"))
    is_test = (F.col("n") >= C.MIN_ROWS_TO_SPLIT) & (F.col("rn") <= n_test)
    return ranked.select(*ratings.columns, is_test.alias("is_test"))


def train_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(~F.col("is_test")).drop("is_test")


def test_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter("is_test").drop("is_test")


def split_summary(labelled: DataFrame) -> DataFrame:
    """One row: rows and shares of both sides, their users, rows of users too small to split."""
    per_user = labelled.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test")
    )
    train = F.sum(F.col("n") - F.col("n_test"))
    test = F.sum("n_test")
    return per_user.agg(
        train.alias("train_rows"),
        test.alias("test_rows"),
        F.round(train / F.sum("n"), 6).alias("train_share"),
        F.round(test / F.sum("n"), 6).alias("test_share"),
        F.count_if(F.col("n") > F.col("n_test")).alias("train_users"),
        F.count_if(F.col("n_test") > 0).alias("test_users"),
        F.coalesce(F.sum(F.when(F.col("n") < C.MIN_ROWS_TO_SPLIT, F.col("n"))), F.lit(0)).alias("unsplit_rows"),
    )


def repair_split(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows of users found only in test move to train.  Returns all rows with ``is_test``.

    The users are compared as distinct keys; only the final lookup touches the rows.
    """
    test_only = test.select("user_id").distinct().join(train.select("user_id").distinct(), "user_id", "left_anti")
    flagged = test.join(test_only.withColumn("moved", F.lit(True)), "user_id", "left")
    return train.withColumn("is_test", F.lit(False)).unionByName(
        flagged.withColumn("is_test", F.col("moved").isNull()).select(*train.columns, "is_test")
    )


def overlap_subset(rows: DataFrame, recording_map: DataFrame) -> DataFrame:
    """Rows whose artist has at least one recording."""
    return rows.join(recording_map.select("artist_id").distinct(), "artist_id", "left_semi").select(*rows.columns)
