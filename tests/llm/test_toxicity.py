"""Toxic spans: sums over all labellings, slopes of the likelihood, planted words, held-out documents, odd rows."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def path_weight(states, scores, log_pairs):
    return sum(s for s, y in zip(scores, states) if y) + sum(log_pairs[2 * a + b] for a, b in zip(states, states[1:]))


@pytest.mark.parametrize("n", [1, 2, 5, 9])
def test_marginals_are_those_of_all_labellings(n):
    rng = np.random.default_rng(n)
    scores, log_pairs = rng.normal(0, 2, n).tolist(), rng.normal(0, 1, 4)
    weights = {s: math.exp(path_weight(s, scores, log_pairs)) for s in itertools.product((0, 1), repeat=n)}
    total = sum(weights.values())
    got = toxicity.chain_marginals(scores, np.exp(log_pairs).tolist())[2]
    assert np.allclose(got, [sum(w for s, w in weights.items() if s[i]) / total for i in range(n)])


def test_gradient_is_the_slope_of_the_likelihood():
    rng = np.random.default_rng(2)
    n = 6
    scores, log_pairs, states = rng.normal(0, 1, n), rng.normal(0, 1, 4), rng.integers(0, 2, n)

    def likelihood(scores, log_pairs):
        every = [path_weight(s, scores, log_pairs) for s in itertools.product((0, 1), repeat=n)]
        return path_weight(states, scores, log_pairs) - math.log(sum(math.exp(w) for w in every))

    by_token, by_pair = toxicity.gradient(states, scores, log_pairs)
    for i in range(n):
        d = np.eye(n)[i] * 1e-5
        assert abs(by_token[i] - (likelihood(scores + d, log_pairs) - likelihood(scores - d, log_pairs)) / 2e-5) < 1e-6
    for i in range(4):
        d = np.eye(4)[i] * 1e-5
        assert abs(by_pair[i] - (likelihood(scores, log_pairs + d) - likelihood(scores, log_pairs - d)) / 2e-5) < 1e-6


def planted(n, seed=5):
    """(doc_id, text, toxic): toxic documents hold two or three bad words, some of them with endings of their own."""
    r = random.Random(seed)
    words = [a + b for a in ("ba", "ko", "li", "nu", "pre", "sta") for b in ("ra", "to", "mi", "ndo", "ske", "l")]
    rows = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(5, 40))]
        toxic = int(i % 5 == 0)
        for _ in range(r.randint(2, 3) if toxic else 0):
            text.insert(r.randrange(len(text)), r.choice(["zorgle", "Vexquot", "zorgle" + r.choice(words)]))
        rows.append((i, " ".join(text) + ".", toxic))
    return rows


def test_planted_words_and_their_places(spark):
    rows = planted(600)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.filter("doc_id % 3 != 1").drop("toxic"), df.select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.tag_toxicity(df.filter("doc_id % 3 = 1").withColumn("score", F.lit("clash")), model).collect()}
    for doc_id, text, toxic in rows:
        if doc_id % 3 == 1:
            assert (got[doc_id].score >= 0.3) == bool(toxic)
            hit = {i for s in got[doc_id].spans for i in range(s.start, s.end)}
            bad = {i for m in toxicity.WORD.finditer(text) if m[0].lower().startswith(("zorgle", "vexquot")) for i in range(*m.span())}
            assert bad <= hit and len(hit - bad) <= 4
    # The same model, by plain calls.
    tag = model.tagger()
    for doc_id, text, _ in rows[1:30:3]:
        assert abs(got[doc_id].score - model.document_score(tag(text))) < 1e-12


def test_held_out_documents(spark):
    out = queries.QUERIES["op13_toxicity"](spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id", "left").collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    assert sum(r.predicted for r in held if not r.toxic) <= 2 and sum(r.predicted for r in held if r.toxic) >= 0.6 * sum(r.toxic for r in held)


def test_labels_of_held_out_documents_are_not_read(spark):
    """With all labels of held-out documents turned round, the scores stay the same."""
    rows = planted(200)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    learn = df.filter("doc_id % 4 != 2")
    one = toxicity.fit(learn.select("doc_id", "text"), df.select("doc_id", "toxic"))
    two = toxicity.fit(learn.select("doc_id", "text"), df.select("doc_id", F.when(F.col("doc_id") % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic")))
    assert (one.weights == two.weights).all() and (one.slope, one.offset) == (two.slope, two.offset)


def test_odd_rows(spark):
    rows = planted(300) + [(1000, None, 0), (1001, "", 1), (None, "zorgle zorgle", 1), (1002, "!!! ...", 0), (1003, "zorgle " * 30_000, 1), (5, "again", None), (1004, "İstanbul ǅ ﬁ 🙂 zorgle Vexquot", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("mark", F.lit("clash"))
    labels = df.select("doc_id", "toxic").union(spark.createDataFrame([(7, None), (7, 0), (0, 0)], "doc_id long, toxic int"))
    model = toxicity.fit(df, labels)
    got = toxicity.tag_toxicity(df, model, ["doc_id", "mark"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (1000, 1001, 1002)}
    assert len(empty) == 1 and empty.pop() < 0.3
    assert [(s.start, s.end) for r in got if r.doc_id == 1004 for s in r.spans] == [(15, 29)]
    assert next(r for r in got if r.doc_id == 1003).spans[0].end == 7 * 30_000 - 1
    none = df.limit(0)
    assert toxicity.tag_toxicity(none, model).count() == 0
    for few in (none.select("doc_id", "toxic"), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        flat = toxicity.fit(df, few)
        assert flat.weights is None and {r.score for r in toxicity.tag_toxicity(df, flat, spans=False).collect()} == {flat.share}
