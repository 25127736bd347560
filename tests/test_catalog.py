import pytest

from tastegrid.operators import catalog, dedup


def artists(spark, rows):
    return catalog.build_catalog(spark.createDataFrame(rows, "artist_id string, artist string, url string"))


def match(spark, names, composers):
    found = catalog.match_recordings(
        catalog.clean_recordings(spark.createDataFrame(composers, "musicnet_id string, composer_raw string")),
        artists(spark, [(str(i), n, "u") for i, n in names]), catalog.composer_aliases(spark))
    return {r["musicnet_id"]: (r["artist_id"], r["match_key"], r["match_type"]) for r in found.collect()}


def test_build_catalog(spark):
    rows = [("2", " ABBA ", "b"), ("2", "Abba", "a"), ("x", "Bad", "c"), ("3", None, "d"), ("4.0", "Z", None), (None, "Q", "e")]
    assert sorted(map(tuple, artists(spark, rows).collect())) == [(2, "abba", "a"), (4, "z", None)]


def test_exact_beats_alias(spark):
    got = match(spark, [(1, "Johann Sebastian Bach"), (2, "bach")], [("7", "Bach, Johann Sebastian")])
    assert got == {7: (1, "johann sebastian bach", "exact")}


def test_alias_fires_in_order(spark):
    bach = [("7", "Johann Sebastian Bach")]
    assert match(spark, [(1, "js bach")], bach) == {7: (1, "js bach", "alias")}
    assert match(spark, [(1, "bach"), (2, "j s bach")], bach) == {7: (2, "j s bach", "alias")}


def test_ambiguity_stops(spark):
    names = [(1, "Johann Sebastian Bach"), (2, "Johann Sebastian Bach"), (3, "bach")]
    assert match(spark, names, [("7", "Johann Sebastian Bach")]) == {}
    assert match(spark, [(1, "j s bach"), (2, "j s bach"), (3, "bach")], [("7", "Johann Sebastian Bach")]) == {}


def test_blank_names_never_match(spark):
    assert match(spark, [(1, "東京"), (2, "brahms")], [("7", "é"), ("8", "Brahms"), ("x", "Brahms")]) == {8: (2, "brahms", "exact")}


def test_attach_recordings(spark):
    base = artists(spark, [("1", "a", "u"), ("2", "b", "u")])
    found = spark.createDataFrame([(1, 9), (1, 5)], "artist_id long, musicnet_id long")
    assert sorted(map(tuple, catalog.attach_recordings(base, found).collect())) == [(1, "a", "u", 5), (2, "b", "u", None)]
    assert [r["musicnet_id"] for r in catalog.without_recordings(base).collect()] == [None, None]


def test_master_keeps_unknown_artists(spark):
    ratings = spark.createDataFrame([(1, 1, "a", 2.0), (1, 9, "z", 3.0)], "user_id long, artist_id long, artist string, rating double")
    base = spark.createDataFrame([(1, "other", "u", 5, 0.5)], "artist_id long, artist string, url string, musicnet_id long, extra double")
    got = catalog.master_table(ratings, base)
    assert got.columns == ["user_id", "artist_id", "artist", "rating", "url", "musicnet_id", "extra"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, "a", 2.0, "u", 5, 0.5), (1, 9, "z", 3.0, None, None, None)]


def test_lowest_row_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "b", 9), (1, "b", None), (2, None, 3)], "k int, a string, b int")
    assert sorted(map(tuple, dedup.lowest_row(df, ["k"]).collect())) == [(1, "b", 9), (2, None, 3)]


def test_require_unique(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, a string")
    assert dedup.require_unique(df, "k", "twice").count() == 2
    with pytest.raises(Exception, match="twice"):
        dedup.require_unique(df.unionAll(df), "k", "twice").collect()
