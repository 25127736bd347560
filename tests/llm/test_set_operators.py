"""Mixing, packing, neighbours, n-gram join, URL filter, shards, pipeline: plain versions and odd input."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tastegrid.llm import ann, html_text, jaccard, language, mixing, packing, queries, sharding, urls, warc, winnow

from .helpers import WORD, linked_components

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema="doc_id long, text string, source string"):
    return spark.createDataFrame(rows, schema)


# --- mixing -----------------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), ratio=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), ratio * sum(sizes.values())
    while open_ and left > 1e-9:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += share * weight[s]
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def check_mix(rows, got):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    target, taken = plain_targets(sizes), Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) <= 1e-6 * max(1, target[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size + r.cut_words
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6


def test_mix_meets_its_targets(spark):
    r = random.Random(1)
    rows = [(i, " ".join("w" * r.randint(1, 3) for _ in range(r.randint(0, 60))), r.choice(["a"] * 8 + ["b", "c", "d", "e", None])) for i in range(600)]
    rows += [(1, "repeated row", "b")] * 5 + [(None, None, "b"), (None, "x y", None), (7000, "long " * 20_000, "c"), (7001, None, "empty")]
    df = docs(spark, rows).withColumn("slice", F.lit("clash")).repartition(5)
    got = mixing.mix(df).collect()
    check_mix(rows, got)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df.repartition(2)).collect()))
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_prefers_quality(spark):
    rows = [(i, "a b c d", "s" if i % 2 else "t") for i in range(2000)] + [(9999, "z " * 3000, "big")]
    good = F.when(F.col("doc_id") % 4 < 2, 20.0).otherwise(1.0)
    got = mixing.mix(docs(spark, rows), quality=good, ratio=0.3, weights=(1,)).filter("source != 'big' AND taken > 0").collect()
    assert sum(r.doc_id % 4 < 2 for r in got) > 0.8 * len(got)


# --- packing ----------------------------------------------------------------------------------


def test_ids_are_those_of_the_merge_list(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(100).collect()]
    texts += ["", " ", "a<|endoftext|>b", "it's  \n\n x\t", "\u00e9\U0001f600\u0301 \u4e2d\u6587", "1234567 !!! ???", "x" * 5000]
    pieces = packing.tokenize_pieces(docs(spark, [(i, t, None) for i, t in enumerate(texts)]), queries.ranks_path(), keep_ids=True).collect()
    for i, text in enumerate(texts):
        want = [*slow.encode(text, add_special_tokens=False).ids, 0]
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.piece)
        assert [x for p in mine for x in p.ids] == want and [p.start for p in mine] == packing.cut_points(len(want))
        assert all(p.length == 2048 for p in mine[1:])
        assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes()) for p in mine)


def gapless(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_is_close_to_the_bound(spark):
    rows = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"), queries.ranks_path()).collect()
    assert gapless(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_odd_rows(spark):
    df = docs(spark, [(1, "word", None)] * 9 + [(None, None, None), (2, "", None), (3, "many words " * 9000, None)]).withColumn("base", F.lit("clash"))
    rows = packing.pack_documents(df, queries.ranks_path(), group_rows=4).collect()
    gapless(rows, 2048)
    assert sum(r.doc_id is None for r in rows) == 1 and Counter(r.doc_id for r in rows)[1] == 9
    assert packing.pack_documents(df.limit(0), queries.ranks_path()).count() == 0


def test_local_search_only_improves():
    r = random.Random(4)
    for _ in range(30):
        lengths = [r.randint(1, 60) for _ in range(80)]
        bins, poor = packing.best_fit(lengths, 100), [[i] for i in range(80)]
        for start in (bins, poor):
            squares = sum(sum(lengths[i] for i in b) ** 2 for b in start)
            end = packing.local_search([list(b) for b in start], lengths, 100)
            assert sorted(i for b in end for i in b) == list(range(80)) and all(sum(lengths[i] for i in b) <= 100 for b in end)
            assert len(end) <= len(start) and sum(sum(lengths[i] for i in b) ** 2 for b in end) >= squares
        assert len(packing.local_search(poor, lengths, 100)) <= 1.1 * -(-sum(lengths) // 100) + 1


# --- neighbours -------------------------------------------------------------------------------


def plain_nearest(points, queries_, k):
    out = {}
    for q, v in queries_:
        scored = sorted(((-float(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w))), i) for i, w in points if i != q))
        out[q] = scored[:k]
    return out


@pytest.mark.parametrize("cell_rows", [20_000, 200])
def test_neighbours_recall(spark, cell_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 32))
    points = [(i, (centres[i % 10] + 0.8 * rng.normal(size=32)).tolist()) for i in range(2000)]
    df = spark.createDataFrame(points, "vec_id long, embedding array<float>").withColumn("cell", F.lit("clash"))
    got = ann.nearest_neighbours(df, df.filter("vec_id % 20 = 0"), cell_rows=cell_rows, query_block=30).collect()
    exact = plain_nearest([(r.vec_id, np.array(r.embedding)) for r in df.collect()], [(r.vec_id, np.array(r.embedding)) for r in df.filter("vec_id % 20 = 0").collect()], 5)
    hits = sum(r.vec_id in {i for _, i in exact[r.query_id]} for r in got)
    assert len(got) == 500 and hits >= 0.9 * 500
    for r in got:
        score = {i: -s for s, i in plain_nearest([(i, np.array(v, dtype=np.float32).astype(float)) for i, v in points], [(r.query_id, np.array(points[r.query_id][1], dtype=np.float32).astype(float))], 2000)[r.query_id]}[r.vec_id] if r.query_id == 0 else r.score
        assert abs(score - r.score) < 1e-12


def test_neighbours_in_cells_the_sample_cannot_cut(spark):
    """Four cells of 500 points where 100 are wanted: dealt over parts, searched whole."""
    rng = np.random.default_rng(4)
    points = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(2000, 24)))]
    df = spark.createDataFrame(points, "vec_id long, embedding array<double>")
    got = ann.nearest_neighbours(df, df.filter("vec_id % 20 = 0"), cell_rows=100, sample=64, query_block=7).collect()
    exact = plain_nearest([(i, np.array(v)) for i, v in points], [(i, np.array(v)) for i, v in points if i % 20 == 0], 5)
    assert len(got) == 500 and sum(r.vec_id in {i for _, i in exact[r.query_id]} for r in got) >= 0.9 * 500


def test_vectors_of_each_length_are_searched(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)] + [(100 + i, [1.0, float(i)]) for i in range(30)] + [(200, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(df, df, k=3, cell_rows=8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {i for i, _ in rows} - {200}
    for q, v in rows[60:90]:
        want = plain_nearest([(i, np.array(w)) for i, w in rows[60:90]], [(q, np.array(v))], 3)[q]
        assert [round(s, 9) for _, s in got[q]] == [round(-s, 9) for s, _ in want]


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, None), (101, [0.0, 0.0]), (102, [1.0, nan]), (103, [inf, 1.0]), (104, [1.0, None]), (105, [1.0]), (None, [1.0, 1.0]), (50, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(df, df.filter("vec_id % 10 = 0 OR vec_id > 99"), k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 3], 10: [0, 1, 2], 20: [0, 1, 2], 30: [0, 1, 2], 50: [0, 1, 2]}
    assert ann.nearest_neighbours(df.limit(0), df.limit(0)).count() == 0
    few = df.filter("vec_id IN (1, 50)")
    assert [(r.query_id, r.vec_id) for r in ann.nearest_neighbours(few, few).orderBy("query_id").collect()] == [(1, 50), (50, 1)]


# --- n-gram join ------------------------------------------------------------------------------


def near_copies(r, n, base_words=60):
    rows, vocabulary = [], [f"w{i}" for i in range(400)]
    for group in range(n):
        base = [r.choice(vocabulary) for _ in range(r.randint(1, base_words))]
        for _ in range(r.choice([1, 1, 2, 3, 12])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append(" ".join(words))
    return rows


@pytest.mark.parametrize("block", [2048, 3])
def test_join_finds_the_components_of_all_pairs(spark, block):
    r = random.Random(6)
    texts = near_copies(r, 120) + [None, "", "  ", "Same Words", "same\twords", "a b c d e f"] + ["exact copy of one text here"] * 30
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, "exact copy of one text here"), (None, "nobody else"), (5000, "very long " + " ".join(map(str, range(30_000))))]
    df = docs(spark, rows, "doc_id long, text string").withColumn("token", F.lit("clash")).repartition(4)
    got = jaccard.jaccard_components(df, block=block).collect()
    assert Counter(map(tuple, got)) == Counter(linked_components(rows))


@pytest.fixture
def settings(spark):
    """Sets session settings for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("batch,parts", [(1, 1), (1, 40)])
def test_join_in_any_layout(spark, settings, batch, parts):
    """One row a batch, one task for all buckets, nearly one for each."""
    settings("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    settings("spark.sql.shuffle.partitions", str(parts))
    settings("spark.sql.adaptive.enabled", "false")
    texts = near_copies(random.Random(batch + parts), 10 if parts > 1 else 40) + [None, "same words", "same words"]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    got = jaccard.jaccard_components(docs(spark, rows, "doc_id long, text string"), block=3).collect()
    assert Counter(map(tuple, got)) == Counter(linked_components(rows))


def test_join_of_two_texts_with_one_leading_token(spark):
    rows = [(1, "a b c d e f g h i"), (2, "a b c d e f g h i j"), (3, "a b c d e f g h i j")]
    got = jaccard.jaccard_components(docs(spark, rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, got)) == Counter(linked_components(rows))


def test_vectors_that_overflow_bound_nothing():
    """Counts of one byte, sets of up to 70,000 tokens: no pair that is similar enough is left out."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 70_000).astype(np.uint64)
    sets = [np.unique(base[:n]) for n in (70_000, 66_000, 60_000, 20_000)] + [np.unique(base[i::7]) for i in range(3)] + [base[:50], base[:45]]
    vectors = np.stack([jaccard.count_vector(s, 16, np.uint8) for s in sets] * 9)
    sizes = np.array([len(s) for s in sets] * 9)
    assert (vectors[0] == 255).all() and (vectors[7] < 255).all()
    both = [len(np.intersect1d(s, t)) for s in sets for t in sets]
    shared = np.tile(np.array(both).reshape(len(sets), -1), (9, 9))
    assert (jaccard.overlap_bounds(vectors[:, None], sizes[:, None], vectors[None]) >= shared).all()
    tree = jaccard.CountTree(vectors, sizes)
    for i in range(len(sets)):
        need = jaccard.needed_overlap(sizes, int(sizes[i]))
        assert set(np.flatnonzero(shared[i] >= need)) <= set(tree.candidates(vectors[i], int(sizes[i]), 80)[0].tolist())


def test_common_tokens_are_split_and_counted_whole(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(n, " ".join(base[:n % 56] + [f"x{n}"] + base[n % 56 + 1:]), "a") for n in range(1, 181)] + [(999, "nothing like the others in any of these words", "a")]
    df = docs(spark, rows)
    order = jaccard.common_tokens(jaccard.materialize(jaccard._described(df, 5, 128), "test-described"))
    leading = jaccard._prefix_rows(df, order, 5, 80).collect()
    assert len({r.salt for r in leading}) > 20
    want = Counter(r.token for r in leading)
    got = jaccard._shared_rows(jaccard._prefix_rows(df, order, 5, 80)).collect()
    assert {r.token: r.members for r in got} == {t: n for t, n in want.items() if n > 1} and len(got) == sum(n for n in want.values() if n > 1)


def test_join_of_nothing(spark):
    empty = docs(spark, [], "doc_id long, text string")
    assert jaccard.jaccard_components(empty).count() == 0
    assert [tuple(r) for r in jaccard.jaccard_components(docs(spark, [(3, None)], "doc_id long, text string")).collect()] == [(3, 0, 3)]


def test_tree_returns_all_points_within_the_bound():
    rng = np.random.default_rng(2)
    vectors = rng.poisson(2.0, size=(500, 16)).astype(np.uint16)
    sizes = vectors.sum(axis=1).astype(np.int64)
    tree = jaccard.CountTree(vectors, sizes)
    for i in range(0, 500, 25):
        bound = np.minimum(vectors, vectors[i]).sum(axis=1)
        want = np.flatnonzero(bound >= jaccard.needed_overlap(sizes, int(sizes[i]), 60))
        assert sorted(tree.candidates(vectors[i], int(sizes[i]), 60)[0].tolist()) == want.tolist()


def test_common_tokens_change_nothing_but_the_order():
    tokens = np.unique(np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64))
    common = tokens[[3, 1, 8]]
    assert sorted(jaccard.prefix(tokens, common, 0)) == sorted(tokens)
    assert jaccard.prefix(tokens, common, 0)[-3:].tolist() == common.tolist()
    assert [jaccard.prefix_length(n) for n in (1, 5, 10, 100)] == [1, 2, 3, 21]


# --- URL filter -------------------------------------------------------------------------------


def test_url_filter_odd_urls(spark):
    rules = spark.createDataFrame(queries.RULES + [("a.example.net", "/en/x", "block"), (None, "/", "block"), ("net", "/", "block")], "host string, path string, action string")
    cases = {
        "http://X.Example.NET/en/1?q#f": ("x.example.net", "/en/1", "example.net/en/", "allow"), "https://a.example.net/en/xy": ("a.example.net", "/en/xy", "a.example.net/en/x", "block"),
        "http://b.net": ("b.net", "", None, "allow"), "http://b.net/": ("b.net", "/", "net/", "block"), "http://bnet/": ("bnet", "/", None, "allow"), "http://example.com/de": ("example.com", "/de", None, "allow"),
        "x://example.com/de/?": ("example.com", "/de/", "example.com/de/", "block"), "no scheme.net/": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
        "a://b.org/fr/://c.net/": ("b.org", "/fr/://c.net/", "org/fr/", "allow"), "http://?x": ("", "", None, "allow"), "http://" + "a." * 5000 + "net/": ("a." * 5000 + "net", "/", "net/", "block")}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)] + [(3, "http://b.net/")], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = urls.judge_urls(pages, rules).collect()
    assert len(got) == len(cases) + 1
    want = dict(enumerate(cases.values()))
    assert all(tuple(r)[1:] == want[r.page_id] for r in got if r.page_id != 3) and {r.verdict for r in got if r.page_id == 3} == {"block"}
    assert {r.verdict for r in urls.judge_urls(pages, rules.limit(0)).collect()} == {"allow"} and urls.judge_urls(pages.limit(0), rules).count() == 0


def test_filter_never_loses_a_listed_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    joined = keys.union(spark.range(5000).select(F.concat(F.lit("other"), "id"))).withColumn("block", urls._block(F.col("key"), 300)).join(urls.bloom_filter(keys, "key", 300), "block", "left")
    passed = joined.filter(urls.passes(F.col("key"))).groupBy(F.col("key").startswith("k").alias("listed")).count().collect()
    counts = {r["listed"]: r["count"] for r in passed}
    assert counts[True] == 5000 and counts.get(False, 0) < 500


# --- shards -----------------------------------------------------------------------------------


def test_shards_are_exact_and_mixed(spark):
    rows = [(i, f"text {i % 50}", None) for i in range(1003)] + [(None, None, None)] * 40
    df = docs(spark, rows).withColumn("slice", F.lit("clash"))
    got = sharding.shuffle_into_shards(df, 16).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert len(got) == len(rows) and sorted(by) == list(range(16)) and {len(x) for x in by.values()} == {65, 66}
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter(map(tuple, got)) == Counter(map(tuple, sharding.shuffle_into_shards(df.repartition(7), 16).collect()))
    assert sharding.shuffle_into_shards(df.limit(0), 16).count() == 0


def test_draws_follow_the_law(spark):
    from math import comb

    n = 20_000
    draws = spark.range(n).select(sharding.hypergeometric(F.lit(12), F.lit(20), F.lit(9), (F.col("id") + 0.5) / n).alias("x")).groupBy("x").count().collect()
    for r in draws:
        assert abs(r["count"] - n * comb(12, r["x"]) * comb(20, 9 - r["x"]) / comb(32, 9)) <= 2
    big = spark.range(2000).select(sharding.hypergeometric(F.lit(10**8), F.lit(10**9), F.lit(10**6), (F.col("id") + 0.5) / 2000).alias("x")).agg(F.avg("x"), F.stddev("x")).first()
    assert abs(big[0] - 10**6 / 11) < 2 and abs(big[1] / (10**6 / 11 * 10 / 11 * (1 - 10**6 / 1.1e9)) ** 0.5 - 1) < 0.02


def test_matrix_has_its_margins(spark):
    counts = spark.createDataFrame([(0, 5), (2, 70), (3, 25)], "chunk long, n long")
    rows = {r.chunk: r.room for r in sharding.communication_matrix(counts, 4, [34, 33, 33], 1).collect()}
    assert {c: sum(x) for c, x in rows.items()} == {0: 5, 1: 0, 2: 70, 3: 25} and [sum(x) for x in zip(*rows.values())] == [34, 33, 33]


# --- pipeline ---------------------------------------------------------------------------------


def test_pipeline_stages_do_their_work(spark):
    base = " ".join(f"some words number {i} stand here." for i in range(12))
    rows = [(1, base, "en", "a", 1), (2, base, "en", "b", 1), (3, base + " more", "en", "a", 1), (4, "12 34", None, "a", 1), (5, None, "en", None, None), (None, "another text entirely, of ten words or so.", "de", "b", 3),
            (6, "  und der die das  ", "de", "b", 3), (6, "  und der die das  ", "de", "b", 3), (7, "", "de", "b", 0)]
    df = spark.createDataFrame(rows, DOC)
    first = corpus_pipeline.language_stage(spark, df, SF)
    assert sorted(r.doc_id or 0 for r in first.collect()) == [0, 1, 2, 3, 6, 6] and first.columns == df.columns
    second = corpus_pipeline.near_duplicate_stage(spark, first, SF)
    assert sorted(r.doc_id or 0 for r in second.collect()) == [0, 1, 6] and second.columns == df.columns
    mixed = mixing.mix(second).collect()
    third = corpus_pipeline.mixing_stage(spark, second, SF)
    words = Counter()
    for r in third.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert {r.doc_id: (r.copies + (2 * r.cut_words > r.size)) * r.size for r in mixed if 2 * r.taken > r.size} == dict(words) and third.columns == df.columns
    assert set(third.distinct().collect()) <= set(second.collect())
    last = corpus_pipeline.packing_stage(spark, third, SF).collect()
    gapless(last, 2048)
    assert len(last) == third.count()
    assert corpus_pipeline.mixing_stage(spark, df.limit(0), SF).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "mixing", "packing"]


def test_pipeline_mixes_repeated_rows_once_each(spark):
    same = (2**60 + 1, "one two three four", "en", "a", 18, "x", 0.5)
    df = spark.createDataFrame([same] * 7 + [(None, None, None, None, None, None, None)], DOC + ", _hash string, score double")
    out = corpus_pipeline.mixing_stage(spark, df, SF)
    assert out.columns == corpus_pipeline.COLUMNS
    words = sum(len(WORD.findall(r.text)) for r in out.collect())
    assert abs(words - 42) <= 2 and {r.doc_id for r in out.collect()} == {2**60 + 1}
    assert corpus_pipeline.language_stage(spark, df, SF).columns == corpus_pipeline.COLUMNS
    assert [r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, df, SF).filter("text IS NOT NULL").collect()] == [2**60 + 1]


def test_pipeline_near_duplicates_go_by_text_not_by_id(spark):
    texts = {x: " ".join(f"{x}{i} {x}{i * 7 % 40}" for i in range(40)) for x in "pqrst"}
    rows = [(1, texts["p"]), (1, texts["q"]), (2, texts["q"] + " more"), (None, texts["r"]), (None, texts["r"] + " more"), (3, texts["s"]), (None, texts["s"] + " more"),
            (0, texts["t"]), (5, texts["t"] + " more"), (5, "unlike all others here in every word of it"), (7, ""), (7, ""), (8, None), (None, None), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], DOC).repartition(4)
    got = corpus_pipeline.near_duplicate_stage(spark, df, SF)
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    either = [(None, texts["r"]), (None, texts["r"] + " more")]
    assert sum(kept.pop(x, 0) for x in either) == 1
    assert kept == Counter([(1, texts["p"]), (1, texts["q"]), (3, texts["s"]), (0, texts["t"]), (5, rows[9][1]), (7, ""), (8, None), (None, None)])
    assert got.columns == corpus_pipeline.COLUMNS and corpus_pipeline.near_duplicate_stage(spark, df.limit(0), SF).count() == 0


def test_ids_stay_exact_beside_nulls(spark):
    big = 2**60 + 1
    df = docs(spark, [(big, "some text of a document", "a"), (None, "another text of a document", "a"), (big + 1, "x y z", None)]).coalesce(1)
    df = df.withColumn("lang", F.lit("en"))
    want = {big, None, big + 1}
    assert {r.doc_id for r in language.identify(df, df, ["doc_id"]).collect()} == want
    assert {r.doc_id for r in packing.pack_documents(df, queries.ranks_path()).collect()} == want
    following = winnow.compare_with_following(df).collect()
    assert {r.doc_id for r in following} == want and {r.doc_id for r in winnow.fingerprints(df).collect()} == want
    assert {r.doc_id: r.edited_sha256 for r in following}[big + 1] == hashlib.sha256(winnow.edited("x y z", "some text of a document").encode()).hexdigest()
    pages = df.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/").alias("url"), F.col("text").alias("html"))
    assert {r.page_id for r in html_text.extract_main_text(pages).collect()} == want
    assert {r.page_id for r in warc.derive(warc.response_records(pages)).collect()} == want


def test_a_row_repeated_in_half_the_table_is_cut(spark, settings, monkeypatch):
    """No slice holds more than twice the mean, with one row in half of the table; results stay whole."""
    from tastegrid.operators import skew

    slices = []
    stored = skew.materialize

    def watch(df, label):
        out = stored(df, label)
        slices.append((label, sorted(r["count"] for r in out.groupBy("slice").count().collect())))
        return out

    monkeypatch.setattr(skew, "materialize", watch)
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(None, None, None)] * 6000 + [(i, f"word{i} " * (1 + i % 50), "abc"[i % 3]) for i in range(6000)]
    df = docs(spark, rows).repartition(6)
    dealt = sharding.shuffle_into_shards(df, shards=3, rows_per_chunk=1000).collect()
    assert Counter(r.shard for r in dealt) == {0: 4000, 1: 4000, 2: 4000} and {(r.shard, r.slot) for r in dealt} == {(s, i) for s in range(3) for i in range(4000)}
    mixed = mixing.mix(df)
    check_mix(rows, mixed.collect())
    pieces = packing.pack(spark.range(12_000).select(
        F.when(F.col("id") < 6000, F.col("id")).alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") < 6000, F.col("id") % 97 + 1).otherwise(7).cast("long").alias("length")), group_rows=3000)
    packed = pieces.collect()
    assert len(packed) == 12_000 and gapless(packed, packing.CAPACITY) >= 1
    assert {label for label, _ in slices} >= {"shard-chunks", "shard-slots", "mix", "pack-order"}
    for label, sizes in slices:
        assert sizes[-1] <= 2 * sum(sizes) / len(sizes), (label, sizes)


def test_all_pairs_of_the_poorest_are_offered():
    """However many pieces are longer: the pair that fits is found among the shortest."""
    lengths = [50] * 70 + [3, 4, 2]
    go, come = packing._improve(list(range(72)), [72], 5, lengths)
    assert sorted(go) == [70, 71] and come == [72]
