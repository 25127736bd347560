"""The operators of this subpackage as queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, html_text, jaccard, language, mixing, packing, repair, sharding, toxicity, urls, warc, winnow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def alignment_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def held_out() -> F.Column:
    """One third of the ids, by checksum; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query
def op1_mixing(spark, d):
    return mixing.mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_language(spark, d):
    docs = table(spark, d, "documents")
    return language.identify(docs, docs.filter(~held_out()), ["doc_id", held_out().alias("held_out")])


@query
def op3_html_text(spark, d):
    return html_text.extract_main_text(table(spark, d, "pages"))


@query
def op4_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), ranks_path())


@query
def op5_neighbours(spark, d):
    points = table(spark, d, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(points, points.filter(F.col("vec_id") % 50 == 0), k=5)


@query
def op6_jaccard(spark, d):
    return jaccard.jaccard_components(table(spark, d, "documents"))


@query
def op7_url_filter(spark, d):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return urls.judge_urls(table(spark, d, "pages"), rules)


@query
def op8_warc(spark, d):
    derived = warc.derive(warc.response_records(table(spark, d, "pages")))
    return derived.select("page_id", *[c for c in derived.columns if c not in ("page_id", "headers")])


@query
def op9_sharding(spark, d):
    dealt = sharding.shuffle_into_shards(table(spark, d, "documents"), shards=16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_winnowing(spark, d):
    return winnow.compare_with_following(table(spark, d, "documents"))


@query
def op11_align(spark, d):
    return align.link_statistics(table(spark, d, "documents"), *alignment_paths())


@query
def op12_repair(spark, d):
    return repair.repair_statistics(table(spark, d, "conversations"))


@query
def op13_toxicity(spark, d):
    """Fitted anew on the labels of all documents that are not held out; those of held-out ones are never read."""
    docs = table(spark, d, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.fit(docs.filter(~held), table(spark, d, "labels").select("doc_id", "toxic"))
    scored = toxicity.tag_toxicity(docs, model, [F.col("doc_id"), held.alias("held_out")], spans=False)
    return scored.select("*", (F.col("score") >= 0.3).cast("int").alias("predicted"))


_MIX = r"""
WITH docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        greatest(0.05, CASE WHEN coalesce(length(text), 0) = 0 THEN 0.0
            ELSE CAST(length(translate(text, '#$%&*+<=>@[\]^_`{|}~0123456789', '')) AS DOUBLE) / CAST(length(text) AS DOUBLE) END) AS quality,
        (CAST(CAST(('0x' || left(md5(concat_ws(':', '11', CAST(doc_id AS VARCHAR))), 13)) AS BIGINT) AS DOUBLE) + 0.5) * pow(2, -52) AS u
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
), summed AS (
    SELECT *, coalesce(sum(source_size) OVER before, 0) AS size_before, coalesce(sum(weight) OVER before, 0) AS weight_before,
        sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight
    FROM weighed WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT *, CAST(total * CAST(1.5 AS DOUBLE) - size_before * 2 AS DOUBLE) / CAST(all_weight - weight_before AS DOUBLE) AS level FROM summed
), targets AS (
    SELECT source, source_size, coalesce(least(source_size * CAST(2 AS DOUBLE),
        (SELECT max(level) FROM levels WHERE level * weight <= source_size * 2) * weight), source_size * CAST(2 AS DOUBLE)) AS target
    FROM levels
), placed AS (
    SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY -ln(u) / CASE WHEN quality > 0.05 THEN quality ELSE 0.05 END, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs
), epochs AS (
    SELECT p.*, t.source_size, t.target, CASE WHEN t.source_size = 0 THEN 0 ELSE floor(t.target / t.source_size) END AS n
    FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    CAST(n * size + least(greatest(round(target - n * source_size) - before, 0), size) AS BIGINT) AS taken
FROM epochs
"""

_URLS = r"""
WITH rests AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
), judged AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parts
)
SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""



def _then(value: str, cost: str, edit: str) -> str:
    """A weight, nine digits of cost and the audit, with one more edit before it."""
    return f"(lpad(CAST(CAST(left({value}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{edit}' || substr({value}, 10))"


def _stays(letter: str, kept: str, given: str) -> str:
    return f"""CASE WHEN fault NOT IN ('b', 'd') AND letter = '{letter}' THEN {_then(kept, "(fault = 't')::BIGINT", "K")} END,
            CASE WHEN fault NOT IN ('b', 'd') THEN {_then(given, "2 + (fault = 't')::BIGINT", "R")} END"""


_REPAIR = rf"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), kinds AS (
    SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(k)), lambda i: CAST(ascii(substr(k, CAST(i AS INTEGER) + 1, 1)) AS BIGINT))),
        lambda sum_, byte_: list_reduce(list_prepend(xor(sum_, byte_), range(8)),
            lambda x, step_: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS kind
    FROM keyed
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds, (SELECT unnest([0, 1]) AS copy) WHERE kind <> 0 AND (kind = 3 OR copy = 0)
), placed AS (
    SELECT *, substr(role, 1, 1) AS letter, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS place FROM damaged
), faulty AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd'
        WHEN regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
        lag(letter) OVER (PARTITION BY conv_id ORDER BY place) || letter AS two
    FROM placed
), counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
        count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
), weighed AS (
    SELECT conv_id, n + 1 AS place, '000000000' AS v0, '000000004II' AS v1, '000000002I' AS v2, '000000000' AS v3 FROM counted
    UNION ALL
    SELECT conv_id, place, least(w0, {_then("w2", "2", "I")}, {_then(_then("w3", "2", "I"), "2", "I")}),
        least(w1, {_then("w2", "2", "I")}, {_then(_then("w3", "2", "I"), "2", "I")}), least(w2, {_then("w3", "2", "I")}), least(w3, {_then("w2", "2", "I")})
    FROM (
        SELECT w.conv_id, f.place,
            least({_then("v0", "3", "D")}, CASE WHEN fault NOT IN ('b', 'd') AND letter = 's' THEN {_then("v1", "(fault = 't')::BIGINT", "K")} END,
            {_stays("u", "v2", "v2")}) AS w0,
            least({_then("v1", "3", "D")}, {_stays("u", "v2", "v2")}) AS w1,
            least({_then("v2", "3", "D")}, {_stays("a", "v3", "v3")}) AS w2,
            least({_then("v3", "3", "D")}, {_stays("u", "v2", "v2")}) AS w3
        FROM weighed w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place - 1
    )
), best AS (
    SELECT conv_id, CAST(left(v0, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit FROM weighed WHERE place = 1
), letters AS (
    SELECT conv_id, audit, i, substr(audit, CAST(i AS INTEGER), 1) AS edit FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM best)
), turns AS (
    SELECT *, sum(CAST(edit <> 'I' AS BIGINT)) OVER w AS place, sum(CAST(edit <> 'D' AS BIGINT)) OVER w AS number,
        length(replace(audit, 'D', '')) % 2 AS odd
    FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i)
), lines AS (
    SELECT t.conv_id, string_agg(CASE WHEN edit = 'K' THEN role ELSE CASE WHEN (number - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END END
        || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS lines
    FROM turns t JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.place = greatest(t.place, 1) WHERE edit <> 'D' GROUP BY t.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES = {"op1_mixing": _MIX, "op7_url_filter": _URLS, "op12_repair": _REPAIR}
