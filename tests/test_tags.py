import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tastegrid.operators import tags, tfidf

VOCAB = "tag_id string, tag_name string"
USES = "user_id long, artist_id string, tag_id string"


@pytest.fixture
def counts(spark):
    vocabulary = tags.clean_vocabulary(spark.createDataFrame(
        [("1", "Rock"), ("2", "rock "), ("3", "R&B"), ("4", "é"), ("x", "bad"), ("5", "Pop"), ("5", "Pop!"), ("6", "Alt")], VOCAB))
    uses = tags.clean_assignments(spark.createDataFrame(
        [(1, "10", "1"), (1, "10", "2"), (2, "10", "3"), (None, "10", "5"), (3, "10", "4"), (3, "11", "5"), (4, "11", "6"),
         (5, "bad", "1"), (5, "11", None), (6, "12", "77")], USES))
    return tags.tag_user_counts(uses, vocabulary)


def test_user_counts(counts):
    """Two ids with one name count a user once; a null user is no user."""
    assert sorted(map(tuple, counts.collect())) == [
        (10, "pop", 0), (10, "r and b", 1), (10, "rock", 1), (11, "alt", 1), (11, "pop", 1)]


def test_top_tags_order(counts):
    assert sorted(map(tuple, tags.top_tags(counts).collect())) == [(10, "r and b,rock,pop"), (11, "alt,pop")]
    assert sorted(map(tuple, tags.top_tags(counts, 1).collect())) == [(10, "r and b"), (11, "alt")]


def test_lists_and_documents_with_fallback(spark, counts):
    artists = spark.createDataFrame([(10, "A"), (20, " B "), (21, "c"), (22, None)], "artist_id long, artist string")
    fallback = spark.createDataFrame([("b", [f"t{i}" for i in range(12)]), ("a", ["never"]), ("c", [])], "artist_key string, tags array<string>")
    lists = {r["artist_id"]: r["tags_raw"] for r in tags.tag_lists(artists, counts, fallback).collect()}
    assert lists == {10: "r and b,rock,pop", 20: ",".join(f"t{i}" for i in range(10)), 21: "", 22: ""}
    documents = Counter(r["artist_id"] for r in tags.tag_documents(artists, counts, fallback).collect())
    assert documents == {10: 3, 20: 12}
    assert sorted(r["artist_id"] for r in tags.missing_tags(artists, counts).collect()) == [20, 21, 22]
    assert {r["tags_raw"] for r in tags.tag_lists(artists, counts).filter("artist_id <> 10").collect()} == {""}


def reference_weights(docs, max_terms, min_df):
    tf = {k: Counter(words) for k, words in docs.items()}
    cf, df = Counter(), Counter()
    for c in tf.values():
        cf.update(c)
        df.update(c.keys())
    kept = sorted((t for t in cf if df[t] >= min_df), key=lambda t: (-cf[t], t))[:max_terms]
    out = {}
    for k, c in tf.items():
        w = {t: c[t] * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t in kept if c[t]}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out |= {(k, t): x / norm for t, x in w.items()}
    return kept, out


def test_tfidf_against_plain_python(spark):
    docs = {i: [f"w{(i * j) % 17}" for j in range(i % 9)] for i in range(40)}
    documents = spark.createDataFrame([(i, "") for i in docs], "artist_id long, tags_raw string")
    terms = spark.createDataFrame([(i, w) for i, ws in docs.items() for w in ws], "artist_id long, term string")
    kept, expect = reference_weights(docs, 8, 2)
    tf = tfidf.term_frequencies(terms)
    vocabulary = tfidf.vocabulary(tf, 8)
    assert [r["term"] for r in vocabulary.collect()] == kept
    got = {(r[0], r[1]): r[2] for r in tfidf.weights_long(documents, tf, vocabulary).collect()}
    assert got.keys() == expect.keys() and all(abs(got[k] - expect[k]) < 1e-12 for k in got)
    wide = tfidf.weights_wide(documents, tf, vocabulary)
    assert wide.columns == ["artist_id", "tags_raw", *[f"tfidf_{t}" for t in sorted(kept)]]
    norms = defaultdict(float)
    for r in wide.collect():
        for t in kept:
            assert abs(r[f"tfidf_{t}"] - expect.get((r["artist_id"], t), 0.0)) < 1e-12
            norms[r["artist_id"]] += r[f"tfidf_{t}"] ** 2
    assert len(norms) == 40 and all(min(abs(n), abs(n - 1)) < 1e-9 for n in norms.values())


def test_no_term_left(spark):
    documents = spark.createDataFrame([(1, "")], "artist_id long, tags_raw string")
    tf = tfidf.term_frequencies(spark.createDataFrame([(1, "a")], "artist_id long, term string"))
    with pytest.raises(ValueError, match="no term"):
        tfidf.weights_wide(documents, tf, tfidf.vocabulary(tf))


def test_terms_of_documents(spark):
    documents = spark.createDataFrame([(1, "hip hop"), (1, "lo-fi"), (2, "")], "artist_id long, tag_name string")
    assert sorted(tags.tag_terms(documents).collect()) == [Row(1, "hip"), Row(1, "hop"), Row(1, "lo-fi")]


def test_empty_tag_table(spark, counts):
    artists = spark.createDataFrame([(1, "a")], "artist_id long, artist string")
    assert tags.tag_lists(artists, counts.filter(F.lit(False))).collect() == [Row(artist_id=1, artist="a", tags_raw="")]
