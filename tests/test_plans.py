"""The physical plans that the large scale depends on."""

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import colocated, resume, split, tags
from tastegrid.operators.ratings import rate_interactions


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ratings_files(spark, tmp_path, rows=2000):
    path = str(tmp_path / "ratings")
    spark.range(rows).select(
        (F.col("id") % 50).alias("user_id"), F.col("id").alias("artist_id"), F.lit("a").alias("artist"), F.lit(3.0).alias("rating"),
        F.lit("wide").alias("unused")).write.parquet(path)
    return spark.read.parquet(path)


def test_scan_reads_needed_columns_and_pushes_filters(spark, tmp_path):
    plan = plan_of(ratings_files(spark, tmp_path).filter("rating >= 3.5").groupBy("user_id").count())
    assert "PushedFilters: [IsNotNull(rating), GreaterThanOrEqual(rating,3.5)]" in plan
    assert "ReadSchema: struct<user_id:bigint,rating:double>" in plan


def test_split_ranks_inside_slices(spark, tmp_path):
    plan = plan_of(split.train_rows(split.label_split(ratings_files(spark, tmp_path).drop("unused"))))
    assert "slice" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert all("slice" in line for line in plan.splitlines() if "Window [row_number" in line)


def test_top_tags_are_limited_before_the_shuffle(spark):
    counts = spark.range(100).select((F.col("id") % 3).alias("artist_id"), F.col("id").cast("string").alias("tag_name"), F.col("id").alias("tag_user_count"))
    plan = plan_of(tags.top_tags(counts))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_work_list_compares_keys_only(spark, tmp_path):
    df = ratings_files(spark, tmp_path).select(F.col("artist_id").alias("musicnet_id"), "artist")
    plan = plan_of(resume.work_list(df, df, df))
    assert plan.count("ReadSchema: struct<artist_id:bigint>") == plan.count("ReadSchema")


def test_hot_artist_is_split_at_the_join(spark, tmp_path):
    """A third of all plays on one artist, a catalog too large to broadcast: the join splits the key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        path = str(tmp_path / "plays")
        spark.range(90_000).select(
            F.col("id").alias("user_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("artist_id"),
            (F.col("id") % 90).cast("double").alias("weight")).repartition(8).write.parquet(path)
        catalog = spark.range(90_000).select(F.col("id").alias("artist_id"), F.col("id").cast("string").alias("artist"))
        rated = rate_interactions(spark.read.parquet(path), catalog)
        assert len(rated.collect()) == 90_000
        assert "skew=true" in plan_of(rated) or "isSkew" in plan_of(rated)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_stored_pairs_join_without_an_exchange(spark):
    """A hot key, null keys, keys of one side only, repeated rows: the plain join's rows, and no bucket is hot."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None)}
    facts = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500).cast("long").alias("artist_id"), (F.col("id") % 4000).alias("user_id"))
    artists = spark.range(450).select(F.col("id").alias("artist_id"), F.col("id").cast("string").alias("url")).unionByName(spark.createDataFrame([(7, "again")], "artist_id long, url string"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        assert colocated.hot_keys(facts, "artist_id", 8).collect()[0].asDict() == {"artist_id": 7, "salts": 3}
        pair = colocated.store_pair(facts, artists, "artist_id", buckets=8)
        for how in ("left", "inner", "left_semi", "left_anti"):
            joined = colocated.join_pair(*pair, "artist_id", how)
            assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
            wanted = facts.join(artists, "artist_id", how)
            assert sorted(map(str, joined.collect())) == sorted(map(str, wanted.select(joined.columns).collect()))
        per_bucket = [r["count"] for r in pair[0].groupBy("artist_id", colocated.SALT).count().collect()]
        assert max(per_bucket) <= 1.1 * 9000 / 8
        empty = colocated.store_pair(facts.limit(0), artists, "artist_id", buckets=2)
        assert colocated.join_pair(*empty, "artist_id").count() == 0
        with pytest.raises(ValueError):
            colocated.store_pair(facts.withColumn(colocated.SALT, F.lit(1)), artists, "artist_id")
        with pytest.raises(ValueError):
            colocated.join_pair(*pair, "artist_id", "full")
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_buckets_follow_the_rows(spark, monkeypatch):
    """More rows than the session's partitions should hold: more buckets, none large, and the rows of the plain join; of a small table none more."""
    facts = spark.range(4000).select(F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 900).cast("long").alias("artist_id"), F.col("id").alias("user_id"))
    artists = spark.range(800).select(F.col("id").alias("artist_id"), F.col("id").cast("string").alias("url"))
    wanted = sorted(map(str, facts.join(artists, "artist_id", "left").collect()))
    monkeypatch.setattr(colocated, "ROWS", 100)
    pair = colocated.store_pair(facts, artists, "artist_id")
    assert sorted(map(str, colocated.join_pair(*pair, "artist_id").select("artist_id", "user_id", "url").collect())) == wanted
    per_bucket = [r["count"] for r in pair[0].groupBy(F.input_file_name()).count().collect()]
    assert len(per_bucket) > 30 and max(per_bucket) < 300
    few = colocated.store_pair(facts.limit(300), artists, "artist_id")
    assert few[0].select(F.input_file_name()).distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert colocated.join_pair(*colocated.store_pair(facts.limit(0), artists, "artist_id"), "artist_id").count() == 0
