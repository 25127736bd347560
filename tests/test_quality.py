import pytest

from tastegrid.operators import quality


def by_rule(report):
    return {r["rule_id"]: (r["passed"], r["detail"]) for r in report.collect()}


@pytest.fixture
def good(spark):
    ratings = spark.createDataFrame([(1, 1, "a", 2.0), (1, 2, "b", 3.0)], "user_id long, artist_id long, artist string, rating double")
    return {
        "catalog": spark.createDataFrame([(1, "a"), (2, "b")], "artist_id long, artist string"),
        "ratings": ratings,
        "train": ratings.filter("artist_id = 1"),
        "test": ratings.filter("artist_id = 2"),
        "master": ratings,
        "tag_features": spark.createDataFrame([(1, "x", 0.5), (2, "", 0.0)], "artist_id long, tags_raw string, tfidf_x double"),
        "map": spark.createDataFrame([(1, 10), (1, 11)], "artist_id long, musicnet_id long"),
        "artist_audio_train": spark.createDataFrame([(1,)], "artist_id long"),
        "artist_audio_test": spark.createDataFrame([(1,)], "artist_id long"),
    }


def test_all_pass(spark, good):
    report = quality.dq_report(spark, good)
    rules = by_rule(report)
    assert all(ok for ok, _ in rules.values()) and len(rules) == report.count() == 29
    assert tuple(quality.report_summary(report).first()) == (29, 0, 0)


def test_failures_are_counted(spark, good):
    ratings = spark.createDataFrame(
        [(1, 1, "A ", 2.0), (2, 3, "b", 5.1), (3, 4, "c", None), (4, None, None, 1.0)], good["ratings"].schema)
    bad = good | {
        "catalog": spark.createDataFrame([(1, "a"), (1, "a"), (None, "x"), (None, "y")], "track_id long, artist string"),
        "ratings": ratings, "train": ratings.filter("user_id = 1"), "test": ratings.filter("user_id > 2"),
        "map": good["map"].unionAll(good["map"]),
        "master": good["master"].drop("rating"),
    }
    rules = by_rule(quality.dq_report(spark, bad))
    assert rules["V01"] == (True, 0) and rules["V03"] == (False, 2) and rules["V04"] == (False, 2)
    assert rules["V08"] == (False, 2) and rules["V33"] == (False, 2) and rules["V34"] == (False, 1)
    assert rules["V09"] == (False, 1) and rules["V10"] == (False, 2)
    assert rules["V14"] == (False, 1) and rules["V19"] == (False, 1) and rules["V22"] == (False, 2)


def test_missing_catalog_fails_the_references_to_it(spark, good):
    report = quality.dq_report(spark, good | {"catalog": None})
    rules = by_rule(report)
    assert rules["V25"] == (False, 1) and rules["V08"] == (False, 2) and rules["V19"] == (False, 2) and "V01" not in rules
    assert quality.report_summary(report).first()["exit_status"] == 1


def test_guard(spark, good):
    features = good["tag_features"]
    assert quality.guard_tag_features(features) is features
    for bad, message in (
        (features.limit(0), "is not empty"),
        (features.drop("tags_raw"), "has tags_raw"),
        (features.drop("tfidf_x"), "has tfidf columns"),
        (features.unionAll(features), "no duplicate artist_id"),
        (features.withColumn("tfidf_x", features.tags_raw), "numeric"),
        (features.selectExpr("cast(null as long) artist_id", "tags_raw", "tfidf_x").limit(1), "no null artist_id"),
    ):
        with pytest.raises(ValueError, match=message):
            quality.guard_tag_features(bad)
