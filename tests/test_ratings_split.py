import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tastegrid.operators import skew, split
from tastegrid.operators.ratings import rate_interactions

PLAYS = "user_id long, artist_id long, weight double"


def rate(spark, plays, artists=((1, "a"), (2, "b"))):
    catalog = spark.createDataFrame(list(artists), "artist_id long, artist string")
    return {(r[0], r[1]): r[3] for r in rate_interactions(spark.createDataFrame(plays, PLAYS), catalog).collect()}


def test_constant_weights(spark):
    assert rate(spark, [(1, 1, 7.0), (2, 2, 7.0)]) == {(1, 1): 3.0, (2, 2): 3.0}


def test_negative_counts_as_zero(spark):
    assert rate(spark, [(1, 1, -5.0), (2, 1, 0.0), (3, 2, 10.0)]) == {(1, 1): 1.0, (2, 1): 1.0, (3, 2): 5.0}


def test_scale_is_set_by_artists_outside_the_catalog(spark):
    got = rate(spark, [(1, 1, 0.0), (1, 2, 9.0), (1, 99, 99.0)])
    assert got == {(1, 1): 1.0, (1, 2): 3.0}


def test_duplicates_and_missing_weights(spark):
    got = rate(spark, [(1, 1, 9.0), (1, 1, 0.0), (1, 2, float("nan")), (2, 1, None), (None, 1, 3.0), (2, 2, 99.0)])
    assert got == {(1, 1): 1.0, (2, 2): 5.0}


def history(spark, sizes):
    rows = [(u, a, f"a{a}", 3.0) for u, n in sizes.items() for a in range(n)]
    return spark.createDataFrame(rows, "user_id long, artist_id long, artist string, rating double")


SIZES = {1: 1, 2: 2, 3: 5, 4: 7, 5: 8, 6: 13, 7: 50, 8: 2000}


def test_split_sizes_and_membership(spark):
    """The share of each user, drawn in the order of the hash."""
    ratings = history(spark, SIZES)
    labelled = split.label_split(ratings)
    counts = {r["user_id"]: r["t"] for r in labelled.groupBy("user_id").agg(F.count_if("is_test").alias("t")).collect()}
    assert counts == {1: 0, 2: 1, 3: 1, 4: 1, 5: 2, 6: 3, 7: 10, 8: 400}
    assert labelled.drop("is_test").exceptAll(ratings).isEmpty() and labelled.count() == ratings.count()
    plain = Window.partitionBy("user_id").orderBy(split.shuffle_key(), "artist_id")
    expect = ratings.withColumn("rn", F.row_number().over(plain)).filter(
        (F.col("user_id") == 8) & (F.col("rn") <= 400)).select("artist_id")
    got = split.test_rows(labelled).filter("user_id = 8").select("artist_id")
    assert sorted(expect.collect()) == sorted(got.collect())


def test_sliced_rank_is_the_plain_rank(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.random() ** 3, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, x double, i int")
    got = skew.rank_in_group(df, ["k"], [F.col("x"), F.col("i")], size="n")
    plain = Window.partitionBy("k")
    expect = df.withColumn("rank", F.row_number().over(plain.orderBy("x", "i")).cast("long")).withColumn("n", F.count("*").over(plain))
    assert got.count() == 5000 and got.exceptAll(expect).isEmpty()


def test_summary(spark):
    got = split.split_summary(split.label_split(history(spark, SIZES))).first().asDict()
    assert got["train_rows"] + got["test_rows"] == sum(SIZES.values())
    assert (got["test_rows"], got["train_users"], got["test_users"], got["unsplit_rows"]) == (418, 8, 7, 1)


def test_repair_moves_test_only_users(spark):
    train = spark.createDataFrame([(1, 1, 3.0)], "user_id long, artist_id long, rating double")
    test = spark.createDataFrame([(1, 2, 3.0), (2, 1, 4.0), (2, 2, 4.0)], train.schema)
    got = sorted((r["user_id"], r["artist_id"], r["is_test"]) for r in split.repair_split(train, test).collect())
    assert got == [(1, 1, False), (1, 2, True), (2, 1, False), (2, 2, False)]


def test_overlap(spark):
    rows = history(spark, {1: 3})
    found = spark.createDataFrame([(2,), (2,)], "artist_id long")
    assert [r["artist_id"] for r in split.overlap_subset(rows, found).collect()] == [2]


def test_slices_split_hot_groups_whatever_the_values(spark):
    """A group with a third of all rows, an outlying value, clustered values: no slice above twice the mean."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 300)
        for value in (F.col("id"), F.when(F.col("id") == 7, 10**15).otherwise(F.col("id")), F.floor(F.col("id") / 5000) * 10**9 + F.col("id")):
            df = spark.range(12_000).select(hot.alias("k"), value.alias("x"))
            sliced = skew.store_slices(df, ["k"], [F.col("x")], "test")
            sizes = [r["count"] for r in sliced.groupBy("slice").count().collect()]
            assert len(sizes) >= 3 and max(sizes) < 2 * 12_000 / len(sizes)
            total = skew.running_total(sliced, ["k"], [F.col("x")], F.col("x"), "before").filter("k = 1").orderBy("x").collect()
            assert [r["before"] for r in total] == [sum(r["x"] for r in total[:i]) for i in range(len(total))] if len(total) < 100 else total[1]["before"] == total[0]["x"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_ranks_without_keys_and_with_null_keys(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "k string, x int")
    assert [(r["x"], r["rank"]) for r in skew.rank_in_group(df, [], [F.col("x")]).orderBy("x").collect()] == [(1, 1), (2, 2), (3, 3)]
    assert [(r["x"], r["rank"]) for r in skew.rank_in_group(df, ["k"], [F.col("x")]).orderBy("x").collect()] == [(1, 1), (2, 1), (3, 2)]


def test_large_tables_get_more_and_narrow_tasks(spark, tmp_path, monkeypatch):
    """More rows than the session's partitions should hold: plays and slices are spread over more, with the same split, and no digest is stored."""
    from tastegrid import session
    from tastegrid.plans import standins

    spark.range(4000).select((F.col("id") % 500).alias("l_orderkey"), (F.col("id") * 7 % 97).alias("l_partkey"), (F.col("id") % 50).cast("double").alias("l_quantity")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(500).select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    plays = standins.interactions(spark, str(tmp_path)).withColumnRenamed("weight", "rating")
    want_plays, want = set(plays.collect()), set(split.label_split(plays).collect())
    monkeypatch.setattr(session, "ROWS", 100)
    monkeypatch.setattr(skew, "ROWS", 100)
    stored, plain = [], skew.materialize
    monkeypatch.setattr(skew, "materialize", lambda df, label: stored.append(plain(df, label)) or stored[-1])
    many = standins.interactions(spark, str(tmp_path)).withColumnRenamed("weight", "rating")
    got = split.label_split(many)
    assert set(many.collect()) == want_plays and set(got.collect()) == want and got.count() == len(want)
    assert "hashpartitioning(o_custkey" in many._jdf.queryExecution().executedPlan().toString() and "REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    assert stored[0].columns == [*plays.columns, "slice"] and stored[0].select("slice").distinct().count() > 4


def test_tasks_do_not_grow_below_the_shuffle_partitions(spark, tmp_path, monkeypatch):
    """Fewer tasks needed than the session has shuffle partitions, which adaptive execution would join to one a core: still as many tasks as rows need."""
    from tastegrid import session
    from tastegrid.plans import standins

    def most_rows(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    spark.range(4000).select((F.col("id") % 500).alias("l_orderkey"), (F.col("id") * 7 % 97).alias("l_partkey"), (F.col("id") % 50).cast("double").alias("l_quantity")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(500).select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        plays = standins.interactions(spark, str(tmp_path)).withColumnRenamed("weight", "rating")
        want_plays, want = set(plays.collect()), set(split.label_split(plays).collect())
        assert session.tasks_beyond(spark, 800, 100) == 0 and session.tasks_beyond(spark, 4000, 100) == 40
        monkeypatch.setattr(session, "ROWS", 100)
        monkeypatch.setattr(skew, "ROWS", 100)
        many = standins.interactions(spark, str(tmp_path)).withColumnRenamed("weight", "rating")
        stored = many.localCheckpoint()
        sliced = skew.store_slices(stored, ["user_id"], [F.col("artist_id")], "test", stored.count())
        got = split.label_split(stored)
        assert set(stored.collect()) == want_plays and set(got.collect()) == want and got.count() == len(want)
        assert most_rows(many) < 200 and sliced.select("slice").distinct().count() > 30 and sliced.groupBy("slice").count().agg(F.max("count")).first()[0] < 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
