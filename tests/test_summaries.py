"""Sketches, audited writes and the vocabulary by way of a sketch: against exact figures, odd input, plans."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import audited, quality, sketches, tfidf

RATINGS = "user_id long, artist_id long, rating double"


def test_merged_sketches_are_near_the_exact_figures(spark):
    rows = spark.range(200_000).select((F.col("id") % 30_011).alias("user_id"), (F.col("id") % 977).alias("artist_id"), (1 + F.rand(3) * 4).alias("rating"))
    parts = sketches.part_sketches(rows, F.pmod("user_id", F.lit(16)))
    assert parts.count() == 16
    checks = {r.measure: r for r in sketches.figure_checks(rows, sketches.merged_figures(parts)).collect()}
    assert all(r.within_bound for r in checks.values()) and checks["users"].exact == 30_011 and checks["items"].exact == 977
    some = sketches.merged_figures(parts.filter("part < 4")).first()
    assert abs(some.users / rows.filter("user_id % 16 < 4").select("user_id").distinct().count() - 1) < sketches.COUNT_BOUND


def test_wrong_figures_are_out_of_bound(spark):
    rows = spark.createDataFrame([(i, i % 7, 1.0 + i % 5) for i in range(1000)], RATINGS)
    wrong = spark.createDataFrame([(999, 900, 9, 4.0, 1.0, 1.0)], "n_rows long, users long, items long, rating_p25 double, rating_median double, rating_p75 double")
    assert not any(r.within_bound for r in sketches.figure_checks(rows, wrong).collect())


def test_sketches_of_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(None, None, None), (1, None, 2.0), (1, 5, None)], RATINGS)
    got = sketches.merged_figures(sketches.part_sketches(rows, F.lit(0))).first()
    assert (got.n_rows, got.users, got.items, got.rating_median) == (3, 1, 1, 2.0)
    nothing = sketches.merged_figures(sketches.part_sketches(rows.limit(0), F.lit(0))).first()
    assert nothing.n_rows is None and nothing.rating_median is None


def test_only_tables_that_hold_their_rules_are_published(spark, tmp_path):
    folder = str(tmp_path / "ratings")
    good = spark.createDataFrame([(1, 1, 2.0, "a b"), (1, 2, 5.0, None)], RATINGS + ", artist string")
    bad = spark.createDataFrame([(1, 1, 2.0, "a  B"), (1, 2, 5.5, "x"), (1, 3, None, "x")], RATINGS + ", artist string")
    assert audited.read_published(spark, folder) is None
    refused = {r.rule_id: (r.passed, r.detail, r.published) for r in audited.write_audited(bad, folder, "ratings", quality.rating_rules(bad)).collect()}
    assert refused == {"V33": (False, 2, False), "V34": (False, 1, False)} and audited.read_published(spark, folder) is None
    assert all(r.published for r in audited.write_audited(good, folder, "ratings", quality.rating_rules(good)).collect())
    assert audited.read_published(spark, folder).count() == 2
    audited.write_audited(bad, folder, "ratings", quality.rating_rules(bad))
    assert audited.read_published(spark, folder).count() == 2
    audited.write_audited(good.limit(0), folder, "ratings", quality.rating_rules(good))
    assert audited.read_published(spark, folder).count() == 0


def test_rules_are_counted_in_the_write_itself(spark, tmp_path):
    """The rows are computed once: each passes one counter."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    rows = spark.range(1000).select(F.col("id").alias("user_id"), F.lit(2.0).alias("rating")).mapInPandas(count, "user_id long, rating double")
    report = audited.write_audited(rows, str(tmp_path / "t"), "t", quality.rating_rules(rows))
    assert report.first().passed and passed.value == 1000


def brute(rows, k, min_df):
    cf, df = Counter(t for _, t in rows if t is not None), defaultdict(set)
    for a, t in rows:
        df[t].add(a)
    kept = [(t, c, len(df[t])) for t, c in cf.items() if len(df[t]) >= min_df]
    return sorted(kept, key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("tracked", [16, 64, 4096])
@pytest.mark.parametrize("flat", [False, True])
def test_sketched_vocabulary_equals_brute_force(spark, tracked, flat):
    """Skewed counts separate, flat ones fall back; one term alone is a third of all rows."""
    rng = random.Random(tracked)
    names = [f"t{i:03d}" for i in range(600)]
    picked = rng.choices(names, k=6000) if flat else rng.choices(names, [1 / (i + 1) ** 1.5 for i in range(600)], k=6000)
    rows = [(rng.randrange(300), t) for t in picked] + [(i % 300, "hot") for i in range(3000)] + [(1, "lone")] * 900 + [(2, None)] * 50
    terms = spark.createDataFrame(rows, "artist_id long, term string").repartition(5)
    got = [tuple(r) for r in tfidf.frequent_vocabulary(terms, max_terms=12, tracked=tracked).collect()]
    assert got == brute(rows, 12, 2)


def test_sketched_vocabulary_of_nothing(spark):
    assert tfidf.frequent_vocabulary(spark.createDataFrame([(1, None)], "artist_id long, term string")).count() == 0
