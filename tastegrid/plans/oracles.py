"""The registered queries in SQL, written from their definitions and independently of the plans."""

from __future__ import annotations

# What a Unicode-aware \s matches, for an engine whose \s is ASCII.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def _sub(c: str, pattern: str, to: str) -> str:
    return f"regexp_replace({c}, '{pattern}', '{to}', 'g')"


def _strip(c: str) -> str:
    return _sub(c, f"^{_WS}|{_WS}$", "")


def _f1(c: str) -> str:
    return _sub(_sub(f"lower({_strip(c)})", _WS, " "), r"[^\x20-\x7E]", "")


def _composer(c: str) -> str:
    n = _f1(c)
    last = _strip(f"substr({n}, 1, strpos({n}, ',') - 1)")
    first = _strip(f"substr({n}, strpos({n}, ',') + 1)")
    return f"CASE WHEN strpos({n}, ',') > 0 THEN {_f1(f'{first} || chr(32) || {last}')} ELSE {n} END"


def _tag(c: str) -> str:
    t = f"replace(lower(coalesce({c}, '')), '&', ' and ')"
    for p in (r"[\[\]{}()<>\"''`]+", r"[/_|]+", r"[^a-z0-9+\-\s]", r"\s+"):
        t = _sub(t, p, " ")
    return f"trim({t})"


_TOKEN = r"'\b[a-z0-9][a-z0-9+\-]*\b'"
_BASE = 1_000_000_000_000

_RATED = """
  SELECT user_id, artist_id,
         CASE WHEN hi = lo THEN 3.0::DOUBLE
              ELSE round_even(((ln(1 + greatest(weight, 0)) - lo) / (hi - lo) * 4 + 1) * 10000, 0) / 10000 END AS rating
  FROM plays, (SELECT ln(1 + greatest(min(weight), 0)) AS lo, ln(1 + greatest(max(weight), 0)) AS hi FROM plays)
"""
_PARTS = f"SELECT p_partkey AS artist_id, {_f1('p_name')} AS artist, 'http://x/' || p_partkey AS url FROM part"


def _ratings(plays: str) -> str:
    return f"""plays AS ({plays}), parts AS ({_PARTS}), rated AS ({_RATED}),
ratings AS (SELECT user_id, artist_id, artist, rating FROM rated JOIN parts USING (artist_id))"""


_CUSTOMER_PLAYS = """SELECT o_custkey AS user_id, l_partkey AS artist_id, sum(l_quantity) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""
_BASKET_PLAYS = "SELECT l_orderkey AS user_id, l_partkey AS artist_id, sum(l_quantity) AS weight FROM lineitem GROUP BY 1, 2"

_LABELLED = """labelled AS (
  SELECT user_id, artist_id, artist, rating, n >= 2 AND rn <= greatest(1, round_even(n * 0.2::DOUBLE, 0)) AS is_test
  FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n,
               row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', '42', user_id, artist_id)), artist_id) AS rn
        FROM ratings)),
train AS (SELECT user_id, artist_id, artist, rating FROM labelled WHERE NOT is_test),
test AS (SELECT user_id, artist_id, artist, rating FROM labelled WHERE is_test)"""

_RATINGS = _ratings(_CUSTOMER_PLAYS)
_SPLIT = f"{_RATINGS}, {_LABELLED}"

_MEAN = "sum(CAST(round_even(rating * 10000, 0) AS BIGINT))::DOUBLE / count(rating)::DOUBLE / 10000::DOUBLE"
_PREDICTED = f"""{_SPLIT},
user_means AS (SELECT user_id, {_MEAN} AS m FROM train GROUP BY 1),
item_means AS (SELECT artist_id, {_MEAN} AS m FROM train GROUP BY 1),
predicted AS (
  SELECT t.user_id, t.artist_id, t.rating, g.m AS global_mean, coalesce(u.m, g.m) AS user_mean, coalesce(i.m, g.m) AS item_mean
  FROM test t CROSS JOIN (SELECT {_MEAN} AS m FROM train) g
  LEFT JOIN user_means u ON u.user_id = t.user_id LEFT JOIN item_means i ON i.artist_id = t.artist_id),
predictions AS (
  SELECT 'global_mean' AS model, user_id, artist_id, rating, global_mean AS prediction FROM predicted
  UNION ALL SELECT 'user_mean', user_id, artist_id, rating, user_mean FROM predicted
  UNION ALL SELECT 'item_mean', user_id, artist_id, rating, item_mean FROM predicted)"""
_ERRORS = """count(*) AS n_rows, round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse,
       round(avg(abs(rating - prediction)), 6) AS mae"""

_TOP = f"""{_SPLIT},
scores AS (SELECT artist_id, CAST(round_even(sum(CAST(round_even(rating * 10000, 0) AS BIGINT))::DOUBLE / count(*)::DOUBLE, 0) AS BIGINT) AS pts
           FROM train GROUP BY 1),
unseen AS (SELECT u.user_id, s.artist_id, s.pts FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN scores s
           WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.artist_id = s.artist_id)),
top AS (SELECT user_id, CAST(position AS INTEGER) AS position, artist_id, pts / 10000::DOUBLE AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pts DESC, artist_id) AS position FROM unseen)
        WHERE position <= 10)"""

_NEAR_EXACT = f"""{_SPLIT},
pts AS (SELECT user_id, artist_id, CAST(round_even(rating * 10000, 0) AS BIGINT) AS p FROM train),
norms AS (SELECT user_id, sqrt(sum(p * p)::DOUBLE) AS norm FROM pts GROUP BY 1),
dots AS (SELECT a.user_id, b.user_id AS neighbour_id, sum(a.p * b.p)::DOUBLE AS dot
         FROM pts a JOIN pts b ON b.artist_id = a.artist_id AND b.user_id <> a.user_id GROUP BY 1, 2),
sims AS (SELECT d.user_id, neighbour_id, dot / (na.norm * nb.norm) AS similarity
         FROM dots d JOIN norms na ON na.user_id = d.user_id JOIN norms nb ON nb.user_id = neighbour_id),
near AS (SELECT user_id, CAST(position AS INTEGER) AS position, neighbour_id, similarity
         FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity DESC, neighbour_id) AS position FROM sims)
         WHERE position <= 20)"""

_CATALOG = f"""artists AS (
  SELECT s_suppkey AS artist_id, {_f1('s_name')} AS artist, 's' AS url FROM supplier
  UNION ALL SELECT c_custkey + {_BASE}, {_f1('c_mktsegment')}, 'c' FROM customer)"""

_MATCHED = f"""{_CATALOG},
rec AS (
  SELECT o_orderkey AS musicnet_id,
         CASE o_orderstatus WHEN 'F' THEN '  SUPPLIER#' || lpad((o_custkey // 10)::VARCHAR, 9, '0') || ' '
                            WHEN 'O' THEN lpad((o_custkey // 10)::VARCHAR, 9, '0') || ', Supplier#'
                            ELSE c_mktsegment END AS composer_raw
  FROM orders JOIN customer ON o_custkey = c_custkey),
recordings AS (SELECT *, {_composer('composer_raw')} AS composer_norm FROM rec),
keys AS (
  SELECT musicnet_id, composer_norm AS match_key, 0 AS ord, 'exact' AS match_type FROM recordings
  UNION ALL SELECT musicnet_id, {_f1('s_name')}, 1, 'alias' FROM recordings
            JOIN supplier ON composer_norm = replace(lower(s_name), '#', '# ')),
bearers AS (SELECT artist AS match_key, count(*) AS n, min(artist_id) AS artist_id FROM artists WHERE artist <> '' GROUP BY 1),
first_key AS (SELECT k.musicnet_id, b.artist_id, b.n, k.match_key, k.match_type
              FROM keys k JOIN bearers b USING (match_key)
              QUALIFY row_number() OVER (PARTITION BY k.musicnet_id ORDER BY k.ord) = 1),
matched AS (SELECT f.artist_id, f.match_key AS artist, f.musicnet_id, r.composer_raw, f.match_key, f.match_type
            FROM first_key f JOIN recordings r USING (musicnet_id) WHERE f.n = 1)"""

_VECTOR_CATALOG = """vector_first AS (SELECT label::BIGINT AS artist_id, min(vec_id) AS musicnet_id FROM embeddings GROUP BY 1),
catalog AS (SELECT p.artist_id, p.artist, p.url, v.musicnet_id FROM parts p LEFT JOIN vector_first v USING (artist_id))"""

_TAG_COUNTS = f"""tag_counts AS (
  SELECT l_suppkey AS artist_id, tag_name, count(DISTINCT o_custkey) AS tag_user_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN (SELECT DISTINCT p_partkey, {_tag("p_name || ' / ' || p_brand")} AS tag_name FROM part) ON p_partkey = l_partkey
  WHERE tag_name <> '' GROUP BY 1, 2)"""
_TOP_TAGS = """top_tags AS (
  SELECT artist_id, string_agg(tag_name, ',' ORDER BY position) AS tags_raw
  FROM (SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY tag_user_count DESC, tag_name) AS position FROM tag_counts)
  WHERE position <= 10 GROUP BY 1)"""


def _payload(e: str) -> str:
    return f"""CASE {e} WHEN 'signup' THEN '{{"toptags":{{"tag":{{"name":"[Sign-Up]"}}}}}}'
     WHEN 'error' THEN '{{"toptags":'
     ELSE '{{"toptags":{{"tag":[{{"name":"' || {e} || ' & More"}},{{"name":"Events/' || {e} ||
          '"}},{{"name":" "}},{{"name":"' || {e} || ' & more"}}]}}}}' END"""


def _payload_tags(p: str) -> str:
    names = f"""CASE WHEN NOT json_valid({p}) THEN []
      WHEN json_type({p}, '$.toptags.tag') = 'ARRAY' THEN json_extract_string({p}, '$.toptags.tag[*].name')
      ELSE [json_extract_string({p}, '$.toptags.tag.name')] END"""
    clean = f"list_filter(list_transform({names}, lambda x: {_tag('x')}), lambda x: x <> '')"
    return f"list_filter({clean}, lambda x, i: list_position({clean}, x) = i)"


_FALLBACK = f"""answers AS (SELECT user_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY 1),
fallback AS (SELECT 'customer#' || lpad(user_id::VARCHAR, 9, '0') AS artist_key, {_payload_tags('payload')} AS tags
             FROM (SELECT user_id, event_type, {_payload('event_type')} AS payload FROM answers) WHERE event_type <> 'error')"""
_TAG_ARTISTS = f"""tag_artists AS (SELECT s_suppkey AS artist_id, s_name AS artist FROM supplier
  UNION ALL SELECT c_custkey + {_BASE}, c_name FROM customer)"""
_ENRICHED = f"""{_TAG_COUNTS}, {_TOP_TAGS}, {_FALLBACK}, {_TAG_ARTISTS},
enriched AS (SELECT a.artist_id, a.artist, coalesce(t.tags_raw, array_to_string(f.tags[1:10], ','), '') AS tags_raw
  FROM tag_artists a LEFT JOIN top_tags t USING (artist_id) LEFT JOIN fallback f ON f.artist_key = lower(a.artist)),
documents_of AS (
  SELECT artist_id, string_agg(tag_name, ' ') AS doc FROM tag_counts GROUP BY 1
  UNION ALL SELECT a.artist_id, array_to_string(f.tags, ' ') FROM tag_artists a JOIN fallback f ON f.artist_key = lower(a.artist)
  WHERE a.artist_id NOT IN (SELECT artist_id FROM tag_counts))"""


def _tfidf(key: str, documents: str, n: str) -> str:
    return f"""tf AS (SELECT {key}, term, count(*) AS tf
       FROM (SELECT {key}, unnest(regexp_extract_all(doc, {_TOKEN})) AS term FROM {documents}) GROUP BY 1, 2),
vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 2 ORDER BY cf DESC, term LIMIT 100),
raw AS (SELECT {key}, term, tf.tf * (ln((1 + {n})::DOUBLE / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term)),
weights AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS tfidf FROM raw)"""


_TAG_TFIDF = f"{_ENRICHED}, {_tfidf('artist_id', 'documents_of', '(SELECT count(*) FROM tag_artists)')}"
_DOC_TFIDF = f"""docs AS (SELECT doc_id, {_tag('text')} AS doc FROM documents),
{_tfidf('doc_id', 'docs', '(SELECT count(*) FROM documents)')}"""

# The terms of the tag corpus: the words of part names, brand numbers, and those of the stored answers.
_TAG_TERMS = [
    "anvil", "blue", "bolt", "brand", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod",
    "small", "widget",
    *[str(i) for i in range(1, 26)],
    "and", "click", "events", "more", "purchase", "sign-up", "view",
]
_WIDE = ",\n       ".join(
    f"round(coalesce(max(CASE WHEN term = '{t}' THEN tfidf END), 0), 6) AS tfidf_{t.replace('-', '_')}" for t in _TAG_TERMS
)

_NATION_TERMS = ["nation", *[str(i) for i in range(25)]]
_NATION_WIDE = ", ".join(f"round(coalesce(max(CASE WHEN term = '{t}' THEN tfidf END), 0), 6) AS tfidf_{t}" for t in _NATION_TERMS)
_VECTOR_WIDE = ", ".join(f"round(coalesce(any_value(embedding[{i}])::DOUBLE, 0), 6) AS audio_dim_{i}" for i in range(1, 65))

_ROLLUP_COLUMNS = ", ".join(f"round(avg(embedding[{i}]::DOUBLE), 6) AS dim_{i}" for i in range(1, 65))


def _series(name: str, count: int, length: int, statistic: str, suffix: str) -> list[str]:
    return [f"round(list_aggregate(v[{1 + i * length}:{(i + 1) * length}], '{statistic}'), 6) AS {name}_{i + 1}_{suffix}" for i in range(count)]


_AUDIO = ",\n       ".join([
    *_series("mfcc", 20, 3, "avg", "mean"), *_series("mfcc", 20, 3, "stddev_pop", "std"),
    "round(v[61], 6) AS tempo", "round(list_aggregate(v, 'avg'), 6) AS rms_mean",
    *_series("chroma", 12, 5, "avg", "mean"), *_series("contrast", 7, 9, "avg", "mean"),
])
_WORK = """work AS (SELECT o_orderkey AS musicnet_id, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS has_file
  FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F'))"""
_FRAMES = """frames AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
summaries AS (SELECT vec_id, label, count(x) AS n, avg(x) AS m, stddev_pop(x) AS sd, max(x) AS peak, any_value(v[1]) AS first
              FROM (SELECT vec_id, label, v, unnest(v) AS x FROM frames) GROUP BY 1, 2)"""

_REPORT = f"""{_SPLIT}, {_VECTOR_CATALOG},
report AS (
  SELECT * FROM (VALUES
    ('V25', 'artist_audio_test', 'table is there', false, 1),
    ('V01', 'catalog', 'has id', true, 0), ('V02', 'catalog', 'has artist', true, 0),
    ('V05', 'ratings', 'has user_id', true, 0), ('V06', 'ratings', 'has item id', true, 0), ('V07', 'ratings', 'has rating', true, 0),
    ('V11', 'master', 'has item id', true, 0), ('V12', 'master', 'has user_id', true, 0), ('V13', 'master', 'has artist', true, 0),
    ('V14', 'master', 'has rating', true, 0),
    ('V15', 'tag_features', 'has item id', true, 0), ('V16', 'tag_features', 'has tags_raw', true, 0),
    ('V17', 'tag_features', 'has tfidf columns', true, 0), ('V31', 'tag_features', 'tfidf columns are numeric', true, 0),
    ('V20', 'map', 'has artist_id', true, 0), ('V21', 'map', 'has musicnet_id', true, 0),
    ('V23', 'artist_audio_train', 'has artist_id', true, 0)) AS t(rule_id, table_name, rule, passed, detail)
  UNION ALL SELECT rule_id, table_name, rule, n = 0, n FROM (
    SELECT 'V03' AS rule_id, 'catalog' AS table_name, 'no null artist_id' AS rule, count(*) FILTER (artist_id IS NULL) AS n FROM catalog
    UNION ALL SELECT 'V04', 'catalog', 'no duplicate artist_id', count(*) - count(DISTINCT artist_id) FROM catalog
    UNION ALL SELECT 'V08', 'ratings', 'ids join to catalog', count(DISTINCT artist_id) FROM ratings WHERE artist_id NOT IN (SELECT artist_id FROM catalog)
    UNION ALL SELECT 'V33', 'ratings', 'rating in [1, 5]', count(*) FILTER (rating < 1 OR rating > 5 OR rating IS NULL) FROM ratings
    UNION ALL SELECT 'V34', 'ratings', 'artist text is normalised', count(*) FILTER (artist <> trim(regexp_replace(lower(artist), '\\s+', ' ', 'g'))) FROM ratings
    UNION ALL SELECT 'V09', 'split', 'train + test = ratings', abs((SELECT count(*) FROM train) + (SELECT count(*) FROM test) - (SELECT count(*) FROM ratings))
    UNION ALL SELECT 'V10', 'split', 'no test-only users', count(DISTINCT user_id) FROM test WHERE user_id NOT IN (SELECT user_id FROM train)
    UNION ALL SELECT 'V29', 'tag_features', 'no null artist_id', count(*) FILTER (id IS NULL) FROM tag_ids
    UNION ALL SELECT 'V18', 'tag_features', 'no duplicate artist_id', count(*) - count(DISTINCT id) FROM tag_ids
    UNION ALL SELECT 'V19', 'tag_features', 'ids join to catalog', count(DISTINCT id) FROM tag_ids WHERE id NOT IN (SELECT artist_id FROM catalog)
    UNION ALL SELECT 'V27', 'tag_features', 'is not empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM tag_ids
    UNION ALL SELECT 'V22', 'map', 'no duplicate musicnet_id', count(*) - count(DISTINCT label) FROM embeddings))"""
_REPORT = f"WITH tag_ids AS (SELECT s_suppkey AS id FROM supplier UNION ALL SELECT c_custkey + {_BASE} FROM customer), {_REPORT}"

ORACLES: dict[str, str] = {
    "ratings_normalized": f"WITH {_RATINGS} SELECT * FROM ratings",
    "split_train": f"WITH {_SPLIT} SELECT * FROM train",
    "split_test": f"WITH {_SPLIT} SELECT * FROM test",
    "split_summary": f"""WITH {_SPLIT}
SELECT count(*) FILTER (NOT is_test) AS train_rows, count(*) FILTER (is_test) AS test_rows,
       round(count(*) FILTER (NOT is_test) / count(*)::DOUBLE, 6) AS train_share, round(count(*) FILTER (is_test) / count(*)::DOUBLE, 6) AS test_share,
       count(DISTINCT user_id) FILTER (NOT is_test) AS train_users, count(DISTINCT user_id) FILTER (is_test) AS test_users,
       (SELECT count(*) FROM (SELECT user_id FROM ratings GROUP BY 1 HAVING count(*) < 2)) AS unsplit_rows
FROM labelled""",
    "split_baskets": f"WITH {_ratings(_BASKET_PLAYS)}, {_LABELLED} SELECT user_id, artist_id, rating, is_test FROM labelled",
    "split_repair": """WITH r AS (SELECT l_orderkey AS user_id, l_partkey AS artist_id, l_quantity AS rating, l_returnflag = 'R' AS t FROM lineitem)
SELECT user_id, artist_id, rating, t AND user_id IN (SELECT user_id FROM r WHERE NOT t) AS is_test FROM r""",
    "overlap_subset": f"WITH {_RATINGS} SELECT * FROM ratings WHERE artist_id IN (SELECT vec_id FROM embeddings)",
    "text_normalized": f"SELECT doc_id, {_f1('text')} AS text_norm FROM documents",
    "composer_flipped": f"SELECT doc_id, {_composer('text')} AS composer_norm FROM documents",
    "tag_normalized": f"SELECT doc_id, {_tag('text')} AS tag_norm FROM documents",
    "coerced_ids": """WITH k AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, CASE event_type WHEN 'purchase' THEN k * 100 ELSE k END AS tag_id FROM k WHERE event_type NOT IN ('error', 'signup')""",
    "lenient_scan": """SELECT p_partkey AS artist_id, p_name AS artist, CASE WHEN p_type <> 'ECONOMY' THEN p_brand END AS brand
FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')""",
    "strict_scan": "SELECT l_orderkey AS user_id, l_partkey AS artist_id, l_quantity AS weight FROM lineitem",
    "comma_scan": """SELECT s_suppkey AS musicnet_id, s_name || ', x' AS composer_raw, CASE WHEN s_nationkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) END AS note
FROM supplier""",
    "json_tags": f"""WITH p AS (SELECT event_id, {_payload('event_type')} AS payload FROM events)
SELECT event_id, array_to_string(l, '|') AS tags, len(l) AS n_tags FROM (SELECT event_id, {_payload_tags('payload')} AS l FROM p)""",
    "catalog_clean": f"WITH {_CATALOG} SELECT * FROM artists",
    "entity_match": f"WITH {_MATCHED} SELECT * FROM matched",
    "catalog_with_first_match": f"""WITH {_MATCHED}
SELECT a.artist_id, a.artist, a.url, m.musicnet_id FROM artists a
LEFT JOIN (SELECT artist_id, min(musicnet_id) AS musicnet_id FROM matched GROUP BY 1) m USING (artist_id)""",
    "master_table": f"""WITH {_RATINGS}, {_VECTOR_CATALOG}
SELECT r.user_id, r.artist_id, r.artist, r.rating, c.url, c.musicnet_id FROM ratings r LEFT JOIN catalog c USING (artist_id)""",
    "tag_user_counts": f"WITH {_TAG_COUNTS} SELECT * FROM tag_counts",
    "tag_lists_top10": f"WITH {_TAG_COUNTS}, {_TOP_TAGS} SELECT * FROM top_tags",
    "tag_enriched": f"WITH {_ENRICHED} SELECT * FROM enriched",
    "tag_missing": f"WITH {_TAG_COUNTS}, {_TAG_ARTISTS} SELECT * FROM tag_artists WHERE artist_id NOT IN (SELECT artist_id FROM tag_counts)",
    "tfidf_vocab": f"WITH {_TAG_TFIDF} SELECT * FROM vocab",
    "tfidf_long": f"WITH {_TAG_TFIDF} SELECT artist_id, term, round(tfidf, 6) AS tfidf FROM weights",
    "tfidf_wide": f"""WITH {_TAG_TFIDF} SELECT e.artist_id, e.tags_raw,
       {_WIDE}
FROM enriched e LEFT JOIN weights w USING (artist_id) GROUP BY 1, 2""",
    "tfidf_documents_vocab": f"WITH {_DOC_TFIDF} SELECT * FROM vocab",
    "tfidf_documents": f"WITH {_DOC_TFIDF} SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM weights",
    "frame_stats": f"""WITH {_FRAMES}
SELECT vec_id, n AS n_frames, round(first, 6) AS first_frame, round(m, 6) AS mean, round(sd, 6) AS std FROM summaries""",
    "audio_features": f"""SELECT vec_id AS musicnet_id,
       {_AUDIO}
FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)""",
    "artist_recordings": """SELECT label::BIGINT AS artist_id, row_number() OVER (PARTITION BY label ORDER BY vec_id::VARCHAR) AS position,
       vec_id AS musicnet_id FROM embeddings""",
    "audio_rollup": f"""SELECT label::BIGINT AS artist_id, 'label ' || label AS artist, count(*) AS recording_count,
       {_ROLLUP_COLUMNS} FROM embeddings GROUP BY label""",
    "resume_pending": f"WITH {_WORK} SELECT musicnet_id FROM work WHERE has_file",
    "missing_inputs": f"WITH {_WORK} SELECT musicnet_id FROM work WHERE NOT has_file",
    "file_feature_map": f"""WITH {_FRAMES}
SELECT vec_id AS musicnet_id, label = 9 AS failed, CASE WHEN label <> 9 THEN round(m, 6) END AS level_mean,
       CASE WHEN label <> 9 THEN round(sd, 6) END AS level_std, CASE WHEN label <> 9 THEN round(peak, 6) END AS level_peak FROM summaries""",
    "dq_report": f"{_REPORT} SELECT * FROM report",
    "dq_summary": f"""{_REPORT} SELECT count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
       CASE WHEN bool_and(passed) THEN 0 ELSE 1 END AS exit_status FROM report""",
    "baseline_global": f"WITH {_PREDICTED} SELECT user_id, artist_id, rating, global_mean AS prediction FROM predicted",
    "baseline_user": f"WITH {_PREDICTED} SELECT user_id, artist_id, rating, user_mean AS prediction FROM predicted",
    "baseline_item": f"WITH {_PREDICTED} SELECT user_id, artist_id, rating, item_mean AS prediction FROM predicted",
    "metrics_rating": f"WITH {_PREDICTED} SELECT model, {_ERRORS} FROM predictions GROUP BY 1",
    "cold_start_segments": f"""WITH {_PREDICTED}, n AS (SELECT user_id, count(*) AS n FROM train GROUP BY 1)
SELECT CASE WHEN coalesce(n, 0) <= 5 THEN 'cold' WHEN n <= 20 THEN 'near_cold' ELSE 'normal' END AS segment, model, {_ERRORS}
FROM predictions LEFT JOIN n USING (user_id) GROUP BY 1, 2""",
    "recommend_top10": f"WITH {_TOP} SELECT * FROM top",
    "metrics_ranking": f"""WITH {_TOP},
relevant AS (SELECT user_id, count(*) AS n FROM test WHERE rating >= 3.5 GROUP BY 1),
found AS (SELECT user_id, count(*) AS h, sum(1 / log2(position + 1)) AS dcg FROM top JOIN test USING (user_id, artist_id) WHERE rating >= 3.5 GROUP BY 1),
per_user AS (SELECT r.n, coalesce(h, 0) AS h, coalesce(dcg, 0) AS dcg,
                    (SELECT sum(1 / log2(i + 1)) FROM range(1, 11) t(i) WHERE i <= r.n) AS ideal
             FROM relevant r LEFT JOIN found USING (user_id))
SELECT count(*) AS n_users, round(avg(h / 10.0::DOUBLE), 6) AS precision_at_k, round(avg(h / n::DOUBLE), 6) AS recall_at_k,
       round(avg(dcg / ideal), 6) AS ndcg_at_k FROM per_user""",
    "metrics_rerank": f"""WITH {_PREDICTED},
placed AS (SELECT *, row_number() OVER (PARTITION BY model, user_id ORDER BY prediction DESC, artist_id) AS position FROM predictions),
per_user AS (SELECT model, user_id, count(*) FILTER (rating >= 3.5) AS n, count(*) FILTER (rating >= 3.5 AND position <= 10) AS h,
                    coalesce(sum(1 / log2(position + 1)) FILTER (rating >= 3.5 AND position <= 10), 0) AS dcg FROM placed GROUP BY 1, 2),
scored AS (SELECT *, (SELECT sum(1 / log2(i + 1)) FROM range(1, 11) t(i) WHERE i <= per_user.n) AS ideal FROM per_user WHERE n > 0)
SELECT model, round(avg(h / 10.0::DOUBLE), 6) AS precision_at_k, round(avg(dcg / ideal), 6) AS ndcg_at_k FROM scored GROUP BY 1""",
    "dataset_stats": f"""WITH {_RATINGS}, per_user AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY 1)
SELECT (SELECT count(*) FROM per_user) AS users, count(DISTINCT artist_id) AS items, count(*) AS interactions,
       min(rating) AS min_rating, max(rating) AS max_rating,
       round(1 - count(*) / (count(DISTINCT user_id)::DOUBLE * count(DISTINCT artist_id)), 6) AS sparsity,
       (SELECT median(n) FROM per_user) AS median_per_user FROM ratings""",
    "rating_histogram": f"""WITH {_RATINGS}
SELECT floor(CAST(round_even(rating * 10000, 0) AS BIGINT) / 5000.0::DOUBLE) / 2::DOUBLE AS bin_start, count(*) AS n FROM ratings GROUP BY 1""",
    "item_features": f"""WITH tagged AS (
  SELECT DISTINCT l_partkey AS artist_id, {_tag('n_name')} AS tag_name FROM lineitem
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
docs AS (SELECT artist_id, string_agg(tag_name, ' ') AS doc FROM tagged GROUP BY 1),
{_tfidf('artist_id', 'docs', '(SELECT count(*) FROM part)')}
SELECT p_partkey AS artist_id, {_NATION_WIDE}, CASE WHEN any_value(vec_id) IS NULL THEN 0 ELSE 1 END::DOUBLE AS has_audio, {_VECTOR_WIDE}
FROM part LEFT JOIN weights ON artist_id = p_partkey LEFT JOIN embeddings ON vec_id = p_partkey GROUP BY 1""",
    "knn_user_exact": f"WITH {_NEAR_EXACT} SELECT user_id, position, neighbour_id, round(similarity, 6) AS similarity FROM near",
    "knn_predictions_exact": f"""WITH {_NEAR_EXACT},
weighted AS (SELECT n.user_id, t.artist_id, sum(similarity * rating) / sum(similarity) AS w
             FROM near n JOIN train t ON t.user_id = n.neighbour_id GROUP BY 1, 2),
own AS (SELECT user_id, avg(rating) AS m FROM train GROUP BY 1)
SELECT t.user_id, t.artist_id, t.rating, round(coalesce(w, m), 6) AS prediction
FROM test t LEFT JOIN own USING (user_id) LEFT JOIN weighted USING (user_id, artist_id)""",
}

ORACLES["metrics_knn"] = f"SELECT 'knn' AS model, {_ERRORS} FROM ({ORACLES['knn_predictions_exact']})"

_HALF_STEP = f"""{_SPLIT},
start AS (SELECT DISTINCT artist_id, ('0x' || left(md5('42:1:' || artist_id), 8))::BIGINT / 4294967296::DOUBLE - 0.5::DOUBLE AS f FROM train),
sums AS (SELECT user_id, count(*) * 1.1::DOUBLE AS a, sum(f) AS b, sum(f * f) + count(*) * 0.1::DOUBLE AS c, sum(rating - m) AS y, sum(f * (rating - m)) AS z
         FROM train JOIN start USING (artist_id) CROSS JOIN (SELECT avg(rating) AS m FROM train) GROUP BY 1),
solved AS (SELECT user_id, (c * y - b * z) / (a * c - b * b) AS bias, (a * z - b * y) / (a * c - b * b) AS factor FROM sums)"""
ORACLES["ridge_half_step"] = f"WITH {_HALF_STEP} SELECT user_id, round(bias, 6) AS bias, round(factor, 6) AS factor FROM solved"
ORACLES["recommend_half_step"] = f"""WITH {_HALF_STEP},
lists AS (SELECT user_id, artist_id, factor * f AS score, row_number() OVER (PARTITION BY user_id ORDER BY factor * f DESC, artist_id) AS position
          FROM solved CROSS JOIN start WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = solved.user_id AND t.artist_id = start.artist_id))
SELECT user_id, CAST(position AS INTEGER) AS position, artist_id, round(score, 6) AS score FROM lists WHERE position <= 10"""

ORACLES["tfidf_vocab_sketched"] = ORACLES["tfidf_vocab"]
ORACLES["tfidf_documents_vocab_sketched"] = ORACLES["tfidf_documents_vocab"]
ORACLES["audited_writes"] = f"""{_REPORT} SELECT rule_id, table_name, rule, passed, detail, true AS published FROM report WHERE rule_id IN ('V33', 'V34')
UNION ALL SELECT 'V33', 'plays', 'rating in [1, 5]', n = 0, n, n = 0 FROM (SELECT count(*) FILTER (weight < 1 OR weight > 5 OR weight IS NULL) AS n FROM plays)"""
ORACLES["sketch_checks"] = f"""WITH {_RATINGS}
SELECT unnest(['n_rows', 'users', 'items', 'rating_p25', 'rating_median', 'rating_p75']) AS measure,
       unnest([count(*)::DOUBLE, count(DISTINCT user_id)::DOUBLE, count(DISTINCT artist_id)::DOUBLE, round(quantile_cont(rating, 0.25), 6),
               round(quantile_cont(rating, 0.5), 6), round(quantile_cont(rating, 0.75), 6)]) AS exact, true AS within_bound FROM ratings"""
ORACLES["ablation_means"] = f"SELECT * FROM ({ORACLES['metrics_rating']}) LEFT JOIN ({ORACLES['metrics_rerank']}) USING (model)"
ORACLES["model_checks"] = f"""WITH {_SPLIT}
SELECT unnest(['mf', 'mf_tags', 'mf_audio', 'mf_tags_audio']) AS model, count(*) AS n_rows, 0::BIGINT AS off_scale, true AS beats_mean FROM train"""
ORACLES["feature_step"] = f"""WITH {_SPLIT},
start AS (SELECT DISTINCT user_id, ('0x' || left(md5('42:1:' || user_id), 8))::BIGINT / 4294967296::DOUBLE - 0.5::DOUBLE AS f FROM train),
sums AS (SELECT artist_id, count(*) AS n, count(*) * 1.1::DOUBLE AS a, sum(f) AS b, sum(f * f) + count(*) * 0.1::DOUBLE AS c, sum(rating - m) AS y, sum(f * (rating - m)) AS z
         FROM train JOIN start USING (user_id) CROSS JOIN (SELECT avg(rating) AS m FROM train) GROUP BY 1),
solved AS (SELECT artist_id, n, (c * y - b * z) / (a * c - b * b) AS bias, (a * z - b * y) / (a * c - b * b) AS factor FROM sums),
described AS (SELECT p_partkey AS artist_id, p_size / 50::DOUBLE AS s, CASE WHEN p_partkey IN (SELECT vec_id FROM embeddings) THEN 1 ELSE 0 END::DOUBLE AS h FROM part),
products AS (SELECT 1 + sum(n * s * s) AS ss, sum(n * s * h) AS sh, 1 + sum(n * h * h) AS hh, sum(n * s * bias) AS sb, sum(n * h * bias) AS hb,
                    sum(n * s * factor) AS sf, sum(n * h * factor) AS hf FROM described JOIN solved USING (artist_id)),
told AS (SELECT (hh * sb - sh * hb) / (ss * hh - sh * sh) AS s_bias, (ss * hb - sh * sb) / (ss * hh - sh * sh) AS h_bias,
                (hh * sf - sh * hf) / (ss * hh - sh * sh) AS s_factor, (ss * hf - sh * sf) / (ss * hh - sh * sh) AS h_factor FROM products)
SELECT artist_id, round(s * s_bias + h * h_bias, 6) AS bias, round(s * s_factor + h * h_factor, 6) AS factor FROM described CROSS JOIN told"""
ORACLES["master_colocated"] = ORACLES["master_table"]
