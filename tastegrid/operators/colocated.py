"""Tables stored side by side, so that they join without an exchange.

Both tables are written in the same number of buckets of (key, salt).  A key with more rows than a
bucket should hold gets several salts: its fact rows are spread over them and its dimension rows
repeated for each, so a hot key never fills a bucket.  There are at most as many such keys as
buckets, which bounds what is broadcast.  Facts with a null key match nothing and are spread the
same way.  The number of buckets follows the rows, so a bucket's sort does not grow with the table.

Pays where a table is joined more than once: each join of the stored pair shuffles neither side.
The tables are external ones below the shared scratch folder, named in the session's catalog.

Edge cases: repeated rows stay; keys of one side only are kept as in any left join; an empty table
gives an empty pair; a column named like the salt is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path, tasks_for

SALT = "bucket_salt"
ROWS = 300_000  # facts of one bucket


def _stored(df: DataFrame, key: str, buckets: int, label: str) -> DataFrame:
    spark = df.sparkSession
    name = f"tastegrid_{label}_{uuid.uuid4().hex}"
    # The same hash as the buckets': one file per bucket.
    df.repartition(buckets, key, SALT).write.bucketBy(buckets, key, SALT).sortBy(key, SALT).option("path", scratch_path(spark, label)).saveAsTable(name)
    return spark.table(name)


def key_counts(facts: DataFrame, key: str) -> DataFrame:
    """``(key, n)``, null keys as one."""
    return facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def _salts(counts: DataFrame, key: str, buckets: int, rows: int) -> DataFrame:
    share = F.ceil(F.col("n") * buckets / F.lit(max(rows, 1))).cast("int")
    return counts.filter(F.col(key).isNotNull()).withColumn("salts", share).filter("salts > 1").select(key, "salts")


def hot_keys(facts: DataFrame, key: str, buckets: int) -> DataFrame:
    """``(key, salts)`` of the keys with more rows than a bucket's even share: at most ``buckets`` rows."""
    return _salts(key_counts(facts, key), key, buckets, facts.count())


def store_pair(facts: DataFrame, dimension: DataFrame, key: str, buckets: int | None = None, label: str = "pair") -> tuple[DataFrame, DataFrame]:
    """Both tables in buckets of (key, salt).

    Unless given, ``buckets`` is the number of shuffle partitions, and more where a bucket would hold over ``ROWS`` facts.
    """
    if SALT in facts.columns or SALT in dimension.columns:
        raise ValueError(f"a column is named {SALT}")
    spark = facts.sparkSession
    counts = materialize(key_counts(facts, key), f"{label}-counts")  # the rows come from it, too: the facts are not evaluated once more for them
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = buckets or min(tasks_for(spark, rows, ROWS), most)
    hot = F.broadcast(materialize(_salts(counts, key, buckets, rows), f"{label}-hot"))
    number = F.monotonically_increasing_id()
    salts = F.when(F.col(key).isNull(), buckets).otherwise(F.coalesce("salts", F.lit(1)))
    salted = facts.withColumn("_row", number).join(hot, key, "left").withColumn(SALT, (F.col("_row") % salts).cast("int")).select(*facts.columns, SALT)
    spread = dimension.join(hot, key, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).select(*dimension.columns, SALT)
    return _stored(salted, key, buckets, f"{label}_facts"), _stored(spread, key, buckets, f"{label}_dimension")


def join_pair(facts: DataFrame, dimension: DataFrame, key: str, how: str = "left") -> DataFrame:
    """The stored pair joined: ``left``, ``inner``, ``left_semi`` or ``left_anti``, those that no repeated dimension row can change."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"no {how} join of a stored pair")
    return facts.join(dimension, [key, SALT], how).drop(SALT)
