"""Language, page text, winnowing, WARC: plain versions, held-out accuracy, round trips, odd input."""

import base64
import gzip
import hashlib
import html
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastegrid.llm import batches, html_text, language, queries, warc, winnow
from tastegrid.llm.html_tree import Page, by_depth

SF = "/root/testdata/sf0.001"


# --- language ---------------------------------------------------------------------------------


def test_language_is_right_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = queries.QUERIES["op2_language"](spark, SF).filter("held_out").join(labels, "doc_id").filter("lang IS NOT NULL")
    row = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"), F.min("score"), F.max("score")).first()
    assert row[0] > 0.97 and 0 <= row[1] and row[2] <= 1


def test_language_matches_a_plain_count_of_grams():
    text = "Ab, cÉ!"
    codes = [0, ord("a"), ord("b"), 0, ord("c"), ord("é"), 0]
    assert language.letter_codes(text).tolist() == codes
    counts = language.bucket_counts(language.letter_codes(text), orders=(1, 2))
    assert counts.sum() == 7 + 6
    long = language.letter_codes("x y " * 200_000)
    assert language.bucket_counts(long).sum() == sum(len(long) - n + 1 for n in (1, 2, 3))


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "hello the", "en"), (1, "hello the", "en"), (2, None, "en"), (3, "", "de"), (None, "12 34 !", None), (4, "und der", "de"), (5, "the " * 50_000, None)],
        "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs, docs, ["doc_id"]).collect()}
    assert got == {(1, "en"), (2, "und"), (3, "und"), (None, "und"), (4, "de"), (5, "en")}
    assert language.identify(docs, docs, ["doc_id"]).count() == 7
    assert language.identify(docs.limit(0), docs.limit(0), ["doc_id"]).count() == 0
    assert {r.lang_pred for r in language.identify(docs, docs.limit(0), ["doc_id"]).collect()} == {"und"}


def test_language_learns_every_label(spark, monkeypatch):
    """More labels than one pass or slice holds; labels of letterless rows do not count."""
    names = [f"l{i:03d}" for i in range(300)]
    words = {x: " ".join(chr(0x4E00 + 7 * i + j) * 3 for j in range(7)) for i, x in enumerate(names)}
    rows = [(i, words[x], x) for i, x in enumerate(names)] + [(1000 + i, "12 34 !", f"a{i % 3}") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    once = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, docs, ["doc_id"]).collect()}
    assert all(once[i][0] == x and once[i][1] > 0.5 for i, x in enumerate(names))
    assert all(once[1000 + i] == ("und", 0.0) for i in range(9))
    monkeypatch.setattr(language, "PASS", 130)
    monkeypatch.setattr(language, "SLICE", 50)
    passes = language.identify(docs, docs, ["doc_id"])
    assert passes.columns == ["doc_id", "lang_pred", "score"]
    for r in passes.collect():
        assert r.lang_pred == once[r.doc_id][0] and abs(r.score - once[r.doc_id][1]) < 1e-9


def test_language_holds_a_text_once_and_few_as_strings(spark, monkeypatch):
    """A kept text is the one that is scored, through several passes too; rows go back in small batches, however many came at once."""
    docs = spark.createDataFrame([(i if i % 7 else None, ["the cat", "der hund", None, "12"][i % 4], ["en", "de", "en", None][i % 4]) for i in range(700)], "doc_id long, text string, lang string")
    keep = ["doc_id", "text", "lang"]
    apart = language.identify(docs, docs, ["doc_id", F.col("text"), "lang"])
    judged = language.identify(docs, docs, keep)
    assert "_text" in apart._jdf.queryExecution().toString() and "_text" not in judged._jdf.queryExecution().toString()
    want = sorted(map(repr, apart.collect()))
    assert judged.columns == [*keep, "lang_pred", "score"] and sorted(map(repr, judged.collect())) == want and len(want) == 700
    monkeypatch.setattr(language, "PASS", 1)
    assert sorted(r[:4] for r in language.identify(docs, docs, keep).fillna(0).fillna("").collect()) == sorted(r[:4] for r in judged.fillna(0).fillna("").collect())

    class Model:
        value = (["en"], np.zeros(1), np.zeros((language.BUCKETS, 1), dtype=np.float32))

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(700)), "text": ["the"] * 700})
    parts = list(language._scorer(Model, language.ORDERS, ["doc_id", "text"], 1, True)(iter([batch, batch.slice(0, 0)])))
    assert max(p.num_rows for p in parts) <= batches.AT_ONCE and [x for p in parts for x in p.column("doc_id").to_pylist()] == list(range(700))
    assert parts[0].schema.names == ["doc_id", "text", "lang_pred", "score"]


def test_values_of_a_column_are_converted_in_parts():
    sizes = []

    class Column:
        def __len__(self):
            return 1000

        def slice(self, start, n):
            sizes.append(n)
            return pa.array(range(1000)).slice(start, n)

    assert list(batches.column_values(Column())) == list(range(1000)) and max(sizes) == batches.AT_ONCE


# --- page text --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return html_text.fit(html_text.labelled_pages())


def test_page_text_on_held_out_templates(model):
    r = random.Random(99)
    right = taken = wanted = 0
    for _ in range(200):
        source = html_text.labelled_page(r)
        page = Page(source)
        truth = [t for node, t, _ in page.segments if page.label[node]]
        got = html_text.extract([source.replace("data-y", "data-z")], model)[0].split("\n")
        right += sum(len(t) for t in got if t in set(truth))
        taken, wanted = taken + sum(map(len, got)), wanted + sum(map(len, truth))
    assert right / taken > 0.9 and right / wanted > 0.95


def test_messages_give_the_marginals_of_all_states(model):
    rng = np.random.default_rng(1)
    parent = np.array([-1, 0, 0, 1, 1, 2, -1, 6])
    unary, edge = rng.normal(size=8), rng.normal(size=(2, 2))
    weight = np.zeros(8)
    total = 0.0
    for state in range(2**8):
        y = [(state >> i) & 1 for i in range(8)]
        w = np.exp(sum(u * v for u, v in zip(unary, y)) + sum(edge[y[p], y[i]] for i, p in enumerate(parent) if p >= 0))
        total, weight = total + w, weight + w * np.array(y)
    assert np.allclose(html_text.marginals(unary, parent, by_depth(parent), edge), weight / total)


def test_page_text_of_the_pages_is_their_article(spark):
    rows = queries.QUERIES["op3_html_text"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    for r in rows:
        article = r.html.partition("<article>")[2].partition("</article>")[0]
        last = [t for t in article.replace("</p>", "<p>").split("<p>") if t.strip("<>brh1/ ")][-1]
        assert " ".join(html.unescape(last.replace("<b>", "").replace("<br>", "").replace("</h1>", "")).split())[:40] in r.text
        assert "track(" not in r.text and "©" not in r.text and r.n_chars == len(r.text)


def test_page_text_odd_pages(spark, model):
    deep = "<div>" * 20_000 + "x"
    pages = [None, "", "plain", "<p>a<b", "<article><h1>T</h1><p>One  &amp;\n two &lt;3 and more words here, yes.<p>Second part, of it.</article>", deep,
             "<article><p>text<script>var a='<p>no</p>'</script> goes on, here.</p><!-- <p>no</p> --></article>", "<" * 5000, '<p a="' * 2000]
    texts = html_text.extract(pages, model)
    assert texts[:2] == ["", ""] and texts[4] == "T\nOne & two <3 and more words here, yes.\nSecond part, of it."
    assert texts[6] == "text goes on, here."
    df = spark.createDataFrame([(1, None, pages[4]), (1, None, pages[4]), (None, "u", None)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert sorted(len(r.text) for r in html_text.extract_main_text(df, model).collect())[0] == 0
    assert html_text.extract_main_text(df.limit(0), model).count() == 0


def test_page_text_reads_attributes_by_name_and_no_labels(spark, model):
    body = "<p>One &amp; two and more words here, yes.</p><p>Second part, of it, with words.</p>"
    plain = html_text.extract([f"<article>{body}</article>"], model)[0]
    assert plain == "One & two and more words here, yes.\nSecond part, of it, with words."
    odd = ['data-y="bottom"', 'data-y="12.5"', 'data-y-offset="3"', "data-y", "data-y=0", 'title="hidden treasures"', 'data-hidden="false"', "title='see id=footer'", 'data-class="ad"', "not-hidden"]
    pages = [f"<article {a}>{body}</article>" for a in odd]
    assert html_text.extract(pages, model) == [plain] * len(odd)
    for page in pages:
        assert Page(page, labelled=False).static == Page(f"<article>{body}</article>").static and not any(Page(page, labelled=False).label)
    hidden = Page("<article hidden>x</article>", labelled=False).static
    assert hidden != Page("<article>x</article>").static
    assert all(Page(f"<article {a}>x</article>", labelled=False).static == hidden for a in ('title="a>b"HIDDEN', "/hidden", "hidden=''", "style='display: none'", 'aria-hidden = "true"'))
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("url", F.lit("u"))
    assert {r.text for r in html_text.extract_main_text(df, model).collect()} == {plain}


# --- winnowing --------------------------------------------------------------------------------


def plain_winnow(text, k, window):
    k = min(k, len(text))
    hashes = [int(winnow.gram_hashes(text[i:i + k], k)[0]) for i in range(len(text) - k + 1)] if text else []
    window, chosen = min(window, len(hashes)), {}
    for start in range(len(hashes) - window + 1) if hashes else ():
        best = min(range(start, start + window), key=lambda i: (hashes[i], -i))
        chosen[best] = hashes[best]
    return sorted(chosen.items())


@pytest.mark.parametrize("text", ["", "a", "abc", "a" * 100, "the quick brown fox " * 9, "é\U0001f600x" * 30])
@pytest.mark.parametrize("k, window", [(1, 1), (5, 4), (7, 10), (25, 40)])
def test_winnow_is_the_plain_one(text, k, window):
    hashes, positions = winnow.winnow(text, k, window)
    assert list(zip(positions.tolist(), hashes.tolist())) == plain_winnow(text, k, window)


def test_shared_text_is_always_caught():
    r = random.Random(2)
    for _ in range(50):
        shared = "".join(r.choice("abcd ") for _ in range(64))
        a, b = ("".join(r.choice("abcd ") for _ in range(r.randint(0, 200))) + shared + "".join(r.choice("abcd ") for _ in range(100)) for _ in range(2))
        assert set(winnow.winnow(a)[0].tolist()) & set(winnow.winnow(b)[0].tolist())


def plain_following(rows, k, window):
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""), reverse=True)
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        third = len(text) // 3
        other = text[:len(text) - third] + following[:third]
        a, b, c = ({h for h in winnow.winnow(t, k, window)[0].tolist()} for t in (text, other, following))
        out.append((i, len(text), hashlib.sha256(other.encode()).hexdigest(), *((len(a & x) / len(a | x) if a | x else 1.0) for x in (b, c))))
    return out


def test_fingerprints_follow_the_order_of_ids(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(None, "no id at all, but some text"), (10**12, None), (10**12 + 1, ""), (-5, "x" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("clash"))
    got = winnow.compare_with_following(df.repartition(3)).select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_following(rows, winnow.K, winnow.WINDOW), key=str)


def test_fingerprints_of_ties_and_small_tables(spark):
    rows = [(1, "same words here"), (1, "same words here"), (1, "other"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = winnow.compare_with_following(df).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted((x[:3] for x in plain_following(rows, 25, 40)), key=str)
    assert len({r.fingerprint for r in got if r.n_chars == 15}) == 1
    assert winnow.compare_with_following(df.limit(0)).count() == 0
    alone = winnow.compare_with_following(df.filter("text = 'other'")).first()
    assert alone.near_next == 1.0 and winnow.fingerprints(df).count() == 4


# --- WARC -------------------------------------------------------------------------------------


def test_warc_records_go_round(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    derived = warc.derive(warc.response_records(pages))
    warc.write_warc(derived, str(tmp_path / "out"), records_per_file=50)
    back = {(r.record_id, r.refers_to, r.block_digest, r.payload_digest, r.block) for r in warc.read_warc(spark, str(tmp_path / "out")).collect()}
    assert back == {(r.record_id, r.refers_to, r.block_digest, r.payload_digest, r.block) for r in derived.collect()}
    assert len(back) == 2 * pages.count()


def test_warc_links_digests_and_text(spark):
    pages = spark.createDataFrame([
        (1, "http://a/?x", "<title>T &amp; t</title><p>One</p><p>Two <a href='/l?a=1&amp;b'>three</a><script>no</script>"), (2, None, None), (2, None, None)],
        "page_id long, url string, html string").withColumn("record", F.lit("clash"))
    responses = {r.page_id: r.record for r in warc.response_records(pages).collect()}
    rows = warc.derive(warc.response_records(pages)).collect()
    assert len(rows) == 6
    for r in rows:
        headers = dict(warc.parse_record(responses[r.page_id].encode())[0])
        assert r.refers_to == headers["WARC-Record-ID"] and r.payload_digest == headers["WARC-Payload-Digest"] and r.target_uri == headers["WARC-Target-URI"]
        assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
    by = {(r.page_id, r.warc_type): r.block for r in rows}
    assert by[1, "conversion"] == "T & t\nOne\nTwo three" and '"/l?a=1&b"' in by[1, "metadata"] and by[2, "conversion"] == ""
    broken = warc.derive(spark.createDataFrame([(7, "junk"), (8, None)], "page_id long, record string")).collect()
    assert [r.warc_type for r in broken] == ["metadata", "metadata"] and "error" in broken[0].block
    assert warc.derive(warc.response_records(pages.limit(0))).count() == 0


def by_hand(block, *headers, kind="response", length=None):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *headers, f"Content-Length: {len(block) if length is None else length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


HAND = (b"HTTP/1.1 301 Moved\r\nset-cookie: a=1\r\nX-Long: one\r\n two\r\nSet-Cookie: b=2\r\ncontent-type: text/html; charset=ISO-8859-1\r\n\r\n"
        b"<title>caf\xe9</title><p>a <a href=x>b</a>")
HAND_HEADERS = (
    "warc-record-id: <urn:x:1>", "WARC-Target-URI: http://a/?b:c", "WARC-Date: 2024-01-02T03:04:05Z", "WARC-IP-Address: 1.2.3.4", "WARC-Truncated: length",
    "WARC-Concurrent-To: <urn:x:2>", "WARC-Concurrent-To: <urn:x:3>", "WARC-Identified-Payload-Type: text/html", "warc-payload-digest: sha1:" + "A" * 32, "Content-Type: application/http")


def test_warc_keeps_source_headers_repeated_ones_and_digests():
    block_digest = "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(HAND).digest()).decode()
    (head, block), (text_head, text) = warc.derivatives(by_hand(HAND, *HAND_HEADERS, block_digest))
    got = json.loads(block)
    wanted = [tuple(x.split(": ", 1)) for x in ("WARC-Type: response", *HAND_HEADERS, block_digest, f"Content-Length: {len(HAND)}")]
    assert [tuple(x) for x in got["warc-headers"]] == wanted
    assert got["http-headers"] == [["set-cookie", "a=1"], ["X-Long", "one two"], ["Set-Cookie", "b=2"], ["content-type", "text/html; charset=ISO-8859-1"]]
    assert got["http-status"] == "HTTP/1.1 301 Moved" and got["faults"] == [] and got["outlinks"] == ["x"]
    assert got["block-digest-holds"] is True and got["payload-digest-holds"] is False and got["title"] == "café"
    for headers in (head, text_head):
        assert ("WARC-Refers-To", "<urn:x:1>") in headers and ("WARC-Concurrent-To", "<urn:x:3>") in headers and len(headers) == 14
        assert [v for k, v in headers if k.lower() == "warc-payload-digest"] == ["sha1:" + "A" * 32]
    assert text == "café\na b"


def test_warc_codings_and_types():
    page = "<p>" + "größe " * 50 + "</p>"
    text = warc.plain_text(page)

    def made(body, *headers):
        records = warc.derivatives(by_hand("\r\n".join(["HTTP/1.1 200 OK", *headers]).encode() + b"\r\n\r\n" + body, "WARC-Record-ID: <urn:x:1>"))
        return json.loads(records[0][1])["faults"], records[1][1] if len(records) > 1 else None

    data = page.encode()
    chunks = b"".join(b"%x;q=1\r\n%s\r\n" % (len(data[i:i + 7]), data[i:i + 7]) for i in range(0, len(data), 7))
    assert made(chunks + b"0\r\n\r\n", "transfer-encoding: Chunked") == ([], text)
    assert made(chunks, "Transfer-Encoding: chunked") == (["transfer-encoding"], text)
    assert made(gzip.compress(data), "content-encoding: gzip") == ([], text)
    assert made(zlib.compress(data), "Content-Encoding: deflate") == ([], text)
    assert made(zlib.compress(data)[2:-4], "Content-Encoding: deflate") == ([], text)
    assert made(gzip.compress(data)[:-8], "Content-Encoding: gzip") == (["content-encoding"], text)
    assert made(data, "Content-Encoding: br") == (["content-encoding"], None)
    assert made(b"\xff\xfe" + page.encode("utf-16-le")) == ([], text)
    assert made(b'<meta charset="latin-1"><p>\xe9') == ([], "é") and made(b"<p>\xe9\xe9") == ([], "\ufffd\ufffd") and made(b"<p>x", "Content-Type: text/html; charset=rot13") == ([], "x")
    assert made(b"1 < 2 <b>", "Content-Type: text/plain") == ([], "1 < 2 <b>") and made(b"\x89PNG", "Content-Type: image/png") == ([], None)
    assert warc.derivatives(by_hand(b"a: b", kind="warcinfo")) == [] and warc.derivatives(by_hand(b"<p>r", "Content-Type: text/html", kind="resource"))[1][1] == "r"
    assert json.loads(warc.derivatives(by_hand(HAND, length=7))[0][1])["faults"] == ["content-length"]
    long = "<p>" + "word " * 400_000
    assert made(long.encode())[1] == ("word " * 400_000).strip()


@pytest.mark.parametrize("algorithm, bits", [("sha1", base64.b32encode), ("sha256", bytes.hex), ("md5", bytes.hex)])
def test_warc_digests_of_several_algorithms(algorithm, bits):
    value = bits(hashlib.new(algorithm, b"x").digest())
    value = value.decode().rstrip("=") if isinstance(value, bytes) else value
    assert warc.holds(f"{algorithm}:{value}", b"x") is True and warc.holds(f"{algorithm}:{value}", b"y") is False
    assert warc.holds(None, b"x") is None and warc.holds("crc:1", b"x") is None and warc.holds(f"{algorithm}:!", b"x") is False


def test_warc_malformed_files_give_error_rows(spark, tmp_path):
    good, end = by_hand(HAND, *HAND_HEADERS), b"\r\n\r\n"
    files = {
        "a.warc": good + end + good + end, "b.warc": good + end + good[:-9], "c.warc": b"WARC/1.0\r\nno colon here\r\n\r\nblock" + end + good + end,
        "d.warc": by_hand(HAND, length="x") + end + good, "e.warc": by_hand(HAND, length=3) + end + good + end, "f.warc": b"", "g.warc": b"junk",
        "h.warc.gz": gzip.compress(good + end) + gzip.compress(good + end), "i.warc.gz": (gzip.compress(good + end) + gzip.compress(good + end))[:-20]}
    (tmp_path / "in").mkdir()
    for name, data in files.items():
        (tmp_path / "in" / name).write_bytes(data)
    got = {}
    for r in warc.raw_records(spark, str(tmp_path / "in")).collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.offset, r.error))
        assert r.error or bytes(r.record) == good
    step = len(good) + 4
    assert got == {
        "a.warc": [(0, None), (step, None)], "b.warc": [(0, None), (step, "cut off")], "c.warc": [(0, "no WARC header"), (len(files["c.warc"]) - step, None)],
        "d.warc": [(0, "wrong length"), (len(files["d.warc"]) - len(good), None)], "e.warc": [(0, "wrong length"), (len(files["e.warc"]) - step, None)],
        "g.warc": [(0, "no WARC header")], "h.warc.gz": [(0, None), (step, None)], "i.warc.gz": got["i.warc.gz"]}
    assert got["i.warc.gz"][0] == (0, None) and all(error for _, error in got["i.warc.gz"][1:]) and len(got["i.warc.gz"]) > 1
    rows = warc.read_warc(spark, str(tmp_path / "in")).collect()
    assert sum(r.error is None for r in rows) == 9 and all(r.record_id == "<urn:x:1>" and r.content_length == len(HAND) for r in rows if r.error is None)
    records = warc.raw_records(spark, str(tmp_path / "in")).filter("error IS NULL").withColumn("page_id", F.col("offset"))
    assert {r.block for r in warc.derive(records).filter("warc_type = 'conversion'").collect()} == {"café\na b"}
