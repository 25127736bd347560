"""Alignment of two tokenizers against plain loops over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.llm import align, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tools():
    return align.encoders(*queries.alignment_paths())


def plain_tokens(text, tools):
    """Lists of (id, start, end) on both sides, or two empty lists."""
    if not text:
        return [], []
    out = []
    letters = {v: k for k, v in tools.a.get_vocab().items()}
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in visible]
    for side in "ab":
        ids = tools.a.encode(" " + text, add_special_tokens=False).ids if side == "a" else tools.b.encode(text)
        parts, at = [], 0
        for i in ids:
            if side == "a":
                raw = bytes(ord(c) if ord(c) < 256 else hidden[ord(c) - 256] for c in letters[i])
            else:
                piece = tools.b.id_to_piece(i)
                raw = bytes([int(piece[3:5], 16)]) if tools.b.is_byte(i) else piece.replace("▁", " ").encode()
            parts.append((i, at, at + len(raw), raw))
            at += len(raw)
        if b"".join(p[3] for p in parts) != b" " + text.encode():
            return [], []
        out.append([p[:3] for p in parts])
    return out


def plain_statistics(rows, tools):
    described, counts = [], Counter()
    for doc_id, text in rows:
        a, b = plain_tokens(text, tools)
        links = [(i, k) for i, s, e in a for k, t, f in b if max(s, t) < min(e, f)]
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = ";".join(",".join(str(i) for i, _, e in a if low < e <= high) + "|" + ",".join(str(i) for i, _, e in b if low < e <= high)
                          for low, high in zip([0, *cuts], cuts))
        counts.update(links)
        described.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    highest = {}
    for (_, k), n in counts.items():
        highest[k] = max(highest.get(k, 0), n)
    return [(d, na, nb, ng, len(x), sum(counts[p] == highest[p[1]] for p in x), sum(counts[p] for p in x), sha) for d, na, nb, ng, x, sha in described]


ODD = [None, "", " ", "  two  spaces \n and\ttabs\r\n", "<|endoftext|> is <s> text </s> <unk> <0x41>", "a▁b", "ﬁne ① Å é é   x​z",
       "日本語のテキスト 🙂🙂 ñandú ÄÖÜ", "x\u0000y", "a" * 3000, "1234567890 " * 40, "don't can't THE the The", "﻿bom", "ｆｕｌｌ　ｗｉｄｔｈ"]


@pytest.mark.parametrize("chunk", [align.CHUNK, 300])
def test_statistics_against_plain_loops(spark, tools, chunk):
    r = random.Random(11)
    words = ["the", "The", "token", "tokenizer", "überall", "naïve", "12", "x=1;", "🙂", "newline\n", "…"]
    texts = ODD + [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "nobody's text"), (3, texts[3]), (3, texts[3]), (2**60 + 1, "long id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pair", F.lit("clash")).withColumn("chunk", F.lit(1)).repartition(3)
    got = align.link_statistics(df, *queries.alignment_paths(), chunk=chunk).collect()
    assert Counter(map(tuple, got)) == Counter(plain_statistics(rows, tools))
    assert sum(1 for x in got if x.n_a == 0) >= 3


def test_query_over_the_whole_table(spark, tools):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 3000]
    got = align.link_statistics(docs.filter("length(text) < 3000 OR text IS NULL"), *queries.alignment_paths()).collect()
    assert Counter(map(tuple, got)) == Counter(plain_statistics(rows, tools))
    out = queries.QUERIES["op11_align"](spark, SF)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] and out.count() == docs.count()


@pytest.mark.parametrize("kind", ["overlap", "group"])
def test_links_and_groups_of_each_document(spark, tools, kind):
    texts = ODD + ["tokenizers disagree about naïve words", "tokenizers disagree"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for row in align.align(df, *queries.alignment_paths(), links=kind, chunk=500).collect():
        a, b = plain_tokens(texts[row.doc_id], tools)
        assert row.a_ids == [x[0] for x in a] and row.b_ids == [x[0] for x in b]
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        assert [(a[g.a_from][1], a[g.a_to - 1][2]) for g in row.groups] == list(zip([0, *cuts], cuts))
        assert [(b[g.b_from][1], b[g.b_to - 1][2]) for g in row.groups] == list(zip([0, *cuts], cuts))
        if kind == "overlap":
            want = [(i, k, min(x[2], y[2]) - max(x[1], y[1])) for i, x in enumerate(a) for k, y in enumerate(b) if max(x[1], y[1]) < min(x[2], y[2])]
        else:
            want = [(i, k, 1) for g in row.groups for i in range(g.a_from, g.a_to) for k in range(g.b_from, g.b_to)]
        assert sorted(map(tuple, row.links)) == sorted(want)


def test_row_products_equal_dense_ones():
    rng = np.random.default_rng(4)
    for _ in range(20):
        x, y = ((rng.random(shape) < 0.3) * rng.integers(1, 5, shape) for shape in ((7, 9), (9, 6)))
        sparse = []
        for m in (x, y):
            row, column = np.nonzero(m)
            sparse.append(align.Rows(np.searchsorted(row, np.arange(len(m) + 1)), column, m[row, column], m.shape[1]))
        got = np.zeros((7, 6), dtype=int)
        for row, column, value in align.product_blocks(*sparse, most=5):
            got[row, column] += value
        assert (got == x @ y).all()
        back = sparse[0].transposed()
        assert (np.array([[dict(zip(back.columns[s:e], back.values[s:e])).get(i, 0) for i in range(7)] for s, e in zip(back.start, back.start[1:])]) == x.T).all()


def test_ranks_and_merges_give_the_same_ids(tools):
    """Random texts of settled characters, with words, spaces and signs in any order."""
    r = random.Random(17)
    letters = [" ", " ", "  ", "\n", "\r\n", "\t", "a", "The", "token", "é", "ß", "Ø", "ŋ", "7", "12", "²", "½", "'s", "'ll", "'", "\"", ".", "!!", "…", "—", "<|endoftext|>", "<0x41>", "_", "ª", "\u00ad"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(1, 40))) for _ in range(3000)] + ["x" * 5000, " " * 300, "a  b   c    "]
    assert tools.ranks is not None and all(align.SETTLED.fullmatch(t) for t in texts)
    want = tools.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert [a.tolist() for a in tools._encode_a(texts)] == [e.ids for e in want]
    odd = ["日本 x", "a\u00a0b", "a\x1cb", "🙂", "a\u0085b"]
    assert not any(align.SETTLED.fullmatch(t) for t in odd)
    assert [a.tolist() for a in tools._encode_a(odd)] == [tools.a.encode(" " + t, add_special_tokens=False).ids for t in odd]


def test_nothing_to_align(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.link_statistics(empty, *queries.alignment_paths()).count() == 0 and align.align(empty, *queries.alignment_paths()).count() == 0
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, align.link_statistics(none, *queries.alignment_paths()).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
