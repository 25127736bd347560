"""Every operator as a query over the driver's tables: ``name -> f(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text
from ..functions.numbers import coerce_id
from ..operators import audited, baselines, catalog, colocated, evaluate, extract, factorize, feature_factors, frames, inner_products, neighbours, quality, recommend, resume, ridge_factors, rollup, sketches, split, tags, tfidf
from ..operators.ratings import rate_interactions
from ..session import materialize, scratch_path
from ..sources import delimited, payloads
from . import standins as s

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# --- ratings and split ------------------------------------------------------------------------

def _ratings(spark, d):
    return rate_interactions(s.interactions(spark, d), s.part_catalog(spark, d))


def _labelled(spark, d):
    """The split, stored: most queries below read both of its sides."""
    ratings = materialize(_ratings(spark, d), "ratings")
    return materialize(split.label_split(ratings), "split")


def _sides(spark, d):
    labelled = _labelled(spark, d)
    return split.train_rows(labelled), split.test_rows(labelled)


@query
def ratings_normalized(spark, d):
    return _ratings(spark, d)


@query
def split_train(spark, d):
    return split.train_rows(split.label_split(materialize(_ratings(spark, d), "ratings")))


@query
def split_test(spark, d):
    return split.test_rows(split.label_split(materialize(_ratings(spark, d), "ratings")))


@query
def split_summary(spark, d):
    return split.split_summary(split.label_split(materialize(_ratings(spark, d), "ratings")))


@query
def split_baskets(spark, d):
    """Short histories: users with one row stay whole in train."""
    ratings = rate_interactions(s.basket_interactions(spark, d), s.part_catalog(spark, d))
    return split.label_split(materialize(ratings, "ratings")).drop("artist")


@query
def split_repair(spark, d):
    """A given split (returned lines are test) in which some users have test rows only."""
    rows = s.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("artist_id"), F.col("l_quantity").alias("rating"),
        "l_returnflag")
    returned = F.col("l_returnflag") == "R"
    return split.repair_split(rows.filter(~returned).drop("l_returnflag"), rows.filter(returned).drop("l_returnflag"))


@query
def overlap_subset(spark, d):
    """Ratings of artists that have a recording (here: a vector)."""
    found = s.table(spark, d, "embeddings").select(F.col("vec_id").alias("artist_id"))
    return split.overlap_subset(_ratings(spark, d), found)


# --- text, ids, scans ---------------------------------------------------------------------------

@query
def text_normalized(spark, d):
    return s.table(spark, d, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("text_norm"))


@query
def composer_flipped(spark, d):
    return s.table(spark, d, "documents").select("doc_id", text.normalize_composer(F.col("text")).alias("composer_norm"))


@query
def tag_normalized(spark, d):
    return s.table(spark, d, "documents").select("doc_id", text.normalize_tag(F.col("text")).alias("tag_norm"))


@query
def coerced_ids(spark, d):
    """Ids as text in several spellings; unusable ones are dropped."""
    k = F.get_json_object("props", "$.k")
    raw = (
        F.when(F.col("event_type") == "view", F.concat(k, F.lit(".0")))
        .when(F.col("event_type") == "error", F.concat(F.lit("x"), k))
        .when(F.col("event_type") == "signup", F.lit(""))
        .when(F.col("event_type") == "purchase", F.concat(k, F.lit("e2")))
        .otherwise(k)
    )
    return s.table(spark, d, "events").select("event_id", coerce_id(raw).alias("tag_id")).dropna(subset=["tag_id"])


def _text_file(lines):
    """Ready-made lines as they are, below their name as header."""
    path = scratch_path(lines.sparkSession, "text")
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").option(
        "ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path)
    return path


@query
def lenient_scan(spark, d):
    """Parts written as ragged tab-separated text, then read back leniently."""
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_brand")
    ragged = (
        F.when(F.col("p_type") == "PROMO", F.concat(line, F.lit("\tsurplus")))
        .when(F.col("p_type") == "SMALL", F.concat(line, F.lit("\t")))
        .when(F.col("p_type") == "ECONOMY", F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name"))
        .otherwise(line)
    )
    rows = delimited.lenient_scan(spark, _text_file(s.table(spark, d, "part").select(ragged.alias("ID\tName \tBrand"))))
    rows = delimited.standard_names(rows, {"id": "artist_id", "name": "artist"})
    return rows.select(coerce_id(F.col("artist_id")).alias("artist_id"), "artist", "brand")


@query
def strict_scan(spark, d):
    """Plays written with the item before the user and a column more, then read by name."""
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in ("l_partkey", "l_returnflag", "l_orderkey", "l_quantity")])
    path = _text_file(s.table(spark, d, "lineitem").select(line.alias("ArtistID\tnote\tuserID \tweight")))
    return delimited.standard_names(delimited.strict_scan(spark, path, schemas.RAW_INTERACTIONS), schemas.STANDARD_NAMES["interactions"])


@query
def comma_scan(spark, d):
    """Suppliers written with a quoted comma, some rows short, then read by name."""
    quoted = F.concat(F.lit('"'), F.col("s_name"), F.lit(', x",'), F.col("s_suppkey").cast("string"))
    line = F.when(F.col("s_nationkey") % 2 == 0, F.concat(quoted, F.lit(","), F.col("s_nationkey").cast("string"))).otherwise(quoted)
    path = _text_file(s.table(spark, d, "supplier").select(line.alias("composer,id,note")))
    rows = delimited.standard_names(delimited.comma_scan(spark, path), schemas.STANDARD_NAMES["recordings"])
    return rows.select(coerce_id(F.col("musicnet_id")).alias("musicnet_id"), "composer_raw", "note")


@query
def json_tags(spark, d):
    names = payloads.payload_tags(F.col("payload"))
    return s.event_payloads(spark, d).select(
        "event_id", F.array_join(names, "|").alias("tags"), F.size(names).cast("long").alias("n_tags"))


# --- catalog ------------------------------------------------------------------------------------

def _entity_match(spark, d):
    recordings = materialize(catalog.clean_recordings(s.recordings(spark, d)), "recordings")
    return catalog.match_recordings(
        recordings, catalog.build_catalog(s.name_catalog(spark, d)), s.aliases(spark, d))


@query
def catalog_clean(spark, d):
    return catalog.build_catalog(s.name_catalog(spark, d))


@query
def entity_match(spark, d):
    return _entity_match(spark, d)


@query
def catalog_with_first_match(spark, d):
    return catalog.attach_recordings(catalog.build_catalog(s.name_catalog(spark, d)), _entity_match(spark, d))


def _vector_catalog(spark, d):
    """Parts as catalog; parts that share their number with a label have recordings."""
    return catalog.attach_recordings(s.part_catalog(spark, d), s.vector_map(spark, d))


@query
def master_table(spark, d):
    return catalog.master_table(_ratings(spark, d), _vector_catalog(spark, d))


@query
def master_colocated(spark, d):
    """The master table from a pair stored in buckets, joined without an exchange."""
    pair = colocated.store_pair(_ratings(spark, d), _vector_catalog(spark, d).drop("artist"), "artist_id", label="master")
    return colocated.join_pair(*pair, "artist_id")


# --- tags ---------------------------------------------------------------------------------------

def _tag_counts(spark, d):
    return tags.tag_user_counts(tags.clean_assignments(s.tag_assignments(spark, d)), tags.clean_vocabulary(s.tag_vocabulary(spark, d)))


def _fallback(spark, d):
    return payloads.fallback_tags(s.customer_payloads(spark, d))


def _tag_terms(spark, d):
    return tags.tag_terms(tags.tag_documents(s.tag_artists(spark, d), materialize(_tag_counts(spark, d), "tag-counts"), _fallback(spark, d)))


def _tag_frequencies(spark, d):
    return materialize(tfidf.term_frequencies(_tag_terms(spark, d)), "tag-terms")


@query
def tag_user_counts(spark, d):
    return _tag_counts(spark, d)


@query
def tag_lists_top10(spark, d):
    return tags.top_tags(_tag_counts(spark, d))


@query
def tag_enriched(spark, d):
    return tags.tag_lists(s.tag_artists(spark, d), _tag_counts(spark, d), _fallback(spark, d))


@query
def tag_missing(spark, d):
    return tags.missing_tags(s.tag_artists(spark, d), _tag_counts(spark, d))


@query
def tfidf_vocab(spark, d):
    return tfidf.vocabulary(_tag_frequencies(spark, d))


@query
def tfidf_vocab_sketched(spark, d):
    """The vocabulary by way of a frequent-items sketch."""
    return tfidf.frequent_vocabulary(materialize(_tag_terms(spark, d), "terms"))


@query
def tfidf_documents_vocab_sketched(spark, d):
    return tfidf.frequent_vocabulary(materialize(_document_terms(spark, d)[1], "terms"), "doc_id")


@query
def tfidf_long(spark, d):
    tf = _tag_frequencies(spark, d)
    return tfidf.weights_long(s.tag_artists(spark, d), tf, tfidf.vocabulary(tf)).withColumn("tfidf", F.round("tfidf", 6))


def _tag_features(spark, d):
    counts = materialize(_tag_counts(spark, d), "tag-counts")
    artists, fallback = s.tag_artists(spark, d), _fallback(spark, d)
    tf = materialize(tfidf.term_frequencies(tags.tag_terms(tags.tag_documents(artists, counts, fallback))), "tag-terms")
    return tfidf.weights_wide(tags.tag_lists(artists, counts, fallback), tf, tfidf.vocabulary(tf))


@query
def tfidf_wide(spark, d):
    wide = _tag_features(spark, d)
    return wide.select("artist_id", "tags_raw", *[F.round(c, 6).alias(c) for c in wide.columns if c.startswith("tfidf_")])


def _document_terms(spark, d):
    documents = s.table(spark, d, "documents").select("doc_id", text.normalize_tag(F.col("text")).alias("tag_name"))
    return documents, tags.tag_terms(documents, key="doc_id")


def _document_frequencies(spark, d):
    documents, terms = _document_terms(spark, d)
    return documents, tfidf.term_frequencies(terms, key="doc_id")


@query
def tfidf_documents_vocab(spark, d):
    return tfidf.vocabulary(_document_frequencies(spark, d)[1])


@query
def tfidf_documents(spark, d):
    documents, tf = _document_frequencies(spark, d)
    tf = materialize(tf, "document-terms")
    return tfidf.weights_long(documents, tf, tfidf.vocabulary(tf), key="doc_id").withColumn("tfidf", F.round("tfidf", 6))


# --- recordings ---------------------------------------------------------------------------------

@query
def frame_stats(spark, d):
    out = frames.frame_stats(s.table(spark, d, "embeddings"), "vec_id", "embedding")
    return out.select("vec_id", "n_frames", *[F.round(c, 6).alias(c) for c in ("first_frame", "mean", "std")])


@query
def audio_features(spark, d):
    """The 61 summary columns of every vector."""
    out = frames.audio_features(s.vector_frames(spark, d))
    return out.select("musicnet_id", *[F.round(c, 6).alias(c) for c in out.columns if c != "musicnet_id"])


@query
def artist_recordings(spark, d):
    return rollup.artist_recordings(rollup.map_recordings(s.vector_features(spark, d), s.vector_map(spark, d)))


@query
def audio_rollup(spark, d):
    out = rollup.artist_rollup(s.vector_features(spark, d), s.vector_map(spark, d))
    lead = ["artist_id", "artist", "recording_count"]
    return out.select(*lead, *[F.round(c, 6).alias(c) for c in out.columns if c not in lead])


def _work_list(spark, d):
    """Orders as recordings, those with a line of status F done, those with any line on disk."""
    lines = s.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("musicnet_id"), "l_linestatus")
    requested = s.table(spark, d, "orders").select(F.col("o_orderkey").alias("musicnet_id"))
    return resume.work_list(requested, lines.filter(F.col("l_linestatus") == "F"), lines)


@query
def resume_pending(spark, d):
    return resume.pending_ids(_work_list(spark, d))


@query
def missing_inputs(spark, d):
    return resume.missing_ids(_work_list(spark, d))


def _read_numbers(content: bytes) -> dict[str, float]:
    import numpy as np

    values = np.array(content.decode("utf-8").split(","), dtype="float64")
    return {"level_mean": values.mean(), "level_std": values.std(), "level_peak": values.max()}


@query
def file_feature_map(spark, d):
    out = extract.extract_features(s.vector_files(spark, d), _read_numbers, ["level_mean", "level_std", "level_peak"])
    return out.select("musicnet_id", F.col("error").isNotNull().alias("failed"),
                      *[F.round(c, 6).alias(c) for c in ("level_mean", "level_std", "level_peak")])


# --- quality ------------------------------------------------------------------------------------

@query
def dq_report(spark, d):
    """All rules; the map repeats its recordings and the test-side roll-up is not there."""
    labelled = _labelled(spark, d)
    parts = _vector_catalog(spark, d)
    wide = _tag_features(spark, d)
    ratings = labelled.drop("is_test")
    return quality.dq_report(spark, {
        "catalog": parts,
        "ratings": ratings,
        "train": split.train_rows(labelled),
        "test": split.test_rows(labelled),
        "master": catalog.master_table(ratings, parts),
        "tag_features": materialize(wide, "tag-features"),
        "map": s.vector_map(spark, d).select("artist_id", F.col("artist_id").alias("musicnet_id")),
        "artist_audio_train": rollup.artist_rollup(s.vector_features(spark, d), s.vector_map(spark, d)),
        "artist_audio_test": None,
    })


@query
def dq_summary(spark, d):
    return quality.report_summary(dq_report(spark, d))


@query
def audited_writes(spark, d):
    """Rules counted while tables are written: ratings are published, play counts passed off as ratings are refused."""
    rated = _ratings(spark, d)
    plays = s.interactions(spark, d).withColumnRenamed("weight", "rating")
    return audited.write_audited(rated, scratch_path(spark, "ratings"), "ratings", quality.rating_rules(rated)).unionByName(
        audited.write_audited(plays, scratch_path(spark, "plays"), "plays", quality.rating_rules(plays)))


def _sketch_checks(spark, d):
    stored = materialize(_ratings(spark, d), "ratings")
    parts = materialize(sketches.part_sketches(stored, F.pmod(F.xxhash64("user_id"), F.lit(64))), "sketches")
    return sketches.figure_checks(stored, sketches.merged_figures(parts))


@query
def sketch_figures(spark, d):
    """Figures merged from the stored sketches of 64 parts, beside the exact ones."""
    return _sketch_checks(spark, d)


@query
def sketch_checks(spark, d):
    return _sketch_checks(spark, d).select("measure", F.round("exact", 6).alias("exact"), "within_bound")


# --- models and evaluation ----------------------------------------------------------------------

def _mean_predictions(spark, d):
    train, test = _sides(spark, d)
    return train, baselines.predict_means(train, test)


@query
def baseline_global(spark, d):
    return _mean_predictions(spark, d)[1].select("user_id", "artist_id", "rating", F.col("global_mean").alias("prediction"))


@query
def baseline_user(spark, d):
    return _mean_predictions(spark, d)[1].select("user_id", "artist_id", "rating", F.col("user_mean").alias("prediction"))


@query
def baseline_item(spark, d):
    return _mean_predictions(spark, d)[1].select("user_id", "artist_id", "rating", F.col("item_mean").alias("prediction"))


@query
def metrics_rating(spark, d):
    return evaluate.error_metrics(evaluate.long_predictions(_mean_predictions(spark, d)[1], baselines.MODELS), ["model"])


@query
def cold_start_segments(spark, d):
    train, wide = _mean_predictions(spark, d)
    return evaluate.cold_start_metrics(wide, train, baselines.MODELS)


@query
def recommend_top10(spark, d):
    return recommend.top_unseen(_sides(spark, d)[0])


@query
def metrics_ranking(spark, d):
    train, test = _sides(spark, d)
    return evaluate.ranking_metrics(recommend.top_unseen(train), test)


@query
def metrics_rerank(spark, d):
    return evaluate.rerank_metrics(evaluate.long_predictions(_mean_predictions(spark, d)[1], baselines.MODELS))


@query
def dataset_stats(spark, d):
    stored = materialize(_ratings(spark, d), "ratings")
    return evaluate.dataset_stats(stored, stored)


@query
def rating_histogram(spark, d):
    return evaluate.rating_histogram(_ratings(spark, d))


def _item_features(spark, d):
    """Parts with the terms of their tags and the vector of the same number."""
    artists = s.part_catalog(spark, d)
    counts = materialize(tags.tag_user_counts(
        tags.clean_assignments(s.part_tag_assignments(spark, d)), tags.clean_vocabulary(s.part_tag_vocabulary(spark, d))), "tag-counts")
    tf = materialize(tfidf.term_frequencies(tags.tag_terms(tags.tag_documents(artists, counts))), "tag-terms")
    wide = tfidf.weights_wide(tags.tag_lists(artists, counts), tf, tfidf.vocabulary(tf))
    audio = rollup.artist_rollup(s.vector_features(spark, d), s.part_vector_map(spark, d))
    return factorize.item_features(artists, wide, audio)


@query
def item_features(spark, d):
    out = _item_features(spark, d)
    return out.select("artist_id", *[F.round(c, 6).alias(c) for c in out.columns if c != "artist_id"])


@query
def als_predictions(spark, d):
    train, test = _sides(spark, d)
    out = factorize.predict_factors(factorize.fit_factors(train), train, test)
    return out.withColumnRenamed("mf", "prediction")


def _models(spark, d):
    """Train, test and the fitted models ``mf``, ``mf_tags``, ``mf_audio``, ``mf_tags_audio``."""
    train, test = _sides(spark, d)
    features = materialize(_item_features(spark, d), "item-features")
    return train, test, feature_factors.fit_hybrids(train, features)


@query
def hybrid_predictions(spark, d):
    """All models side by side, one join a model: (user_id, artist_id) is unique in the test rows."""
    _, test, models = _models(spark, d)
    out = test.select("user_id", "artist_id", "rating")
    for name, model in models.items():
        out = out.join(ridge_factors.predict_ridge_factors(model, test, name).drop("rating"), ["user_id", "artist_id"])
    return out


def _predictions(models, rows):
    """``(model, user_id, artist_id, rating, prediction)`` of fitted models, one below the other."""
    parts = [ridge_factors.predict_ridge_factors(m, rows, "prediction").withColumn("model", F.lit(name)) for name, m in models.items()]
    return reduce(DataFrame.unionByName, parts)


def _every_prediction(spark, d):
    """Means, neighbours, factors and machines on the same test rows, stored."""
    train, test, models = _models(spark, d)
    means = evaluate.long_predictions(baselines.predict_means(train, test), baselines.MODELS)
    near = neighbours.predict_from_neighbours(train, neighbours.nearest_users_exact(train), test).withColumn("model", F.lit("knn"))
    columns = ["model", "user_id", "artist_id", "rating", "prediction"]
    every = [means.select(columns), near.select(columns), _predictions(models, test).select(columns)]
    return train, materialize(reduce(DataFrame.unionByName, every), "predictions")


@query
def metrics_rating_models(spark, d):
    """Errors of every model, as of the means in ``metrics_rating``."""
    return evaluate.error_metrics(_every_prediction(spark, d)[1], ["model"])


@query
def cold_start_models(spark, d):
    """Errors of every model by the bands of ``cold_start_segments``."""
    train, every = _every_prediction(spark, d)
    return evaluate.error_metrics(evaluate.with_band(every, train), ["segment", "model"])


@query
def metrics_ranking_models(spark, d):
    """Ranking figures of ten unseen items per user, chosen from all items by each model."""
    train, test, models = _models(spark, d)
    lists = {"item_mean": recommend.top_unseen(train), **{n: inner_products.top_by_inner_product(m.users, m.items, train) for n, m in models.items()}}
    return reduce(DataFrame.unionByName, [evaluate.ranking_metrics(x, test).withColumn("model", F.lit(n)) for n, x in lists.items()])


@query
def recommend_hybrid(spark, d):
    """The ten best unseen items of every user by the machine with tags and sound; items nobody rated are candidates, too."""
    train, _ = _sides(spark, d)
    features = materialize(_item_features(spark, d), "item-features")
    model = feature_factors.fit_feature_factors(train, features, factorize.feature_columns(features, ("tags", "audio")))
    return inner_products.top_by_inner_product(model.users, model.items, train)


@query
def model_checks(spark, d):
    """Per fitted model: train rows, predictions off the scale, and whether it is nearer to the train rows than the global mean."""
    train, _, models = _models(spark, d)
    fitted = _predictions(models, train)
    mean = train.agg(F.avg("rating")).scalar()
    error, plain = F.col("rating") - F.col("prediction"), F.col("rating") - F.col("mean")
    return fitted.withColumn("mean", mean).groupBy("model").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.coalesce(F.col("prediction").between(1, 5), F.lit(False))).alias("off_scale"),
        (F.sum(error * error) < F.sum(plain * plain)).alias("beats_mean"))


@query
def feature_step(spark, d):
    """One item half step and one feature step of rank 1 on two features (size, has a vector): what the features say of each part."""
    train = _sides(spark, d)[0].select("user_id", "artist_id", "rating")
    users = ridge_factors.first_weights(train.select(F.col("user_id").alias("artist_id")).distinct(), 1).withColumnRenamed("artist_id", "user_id")
    mean = train.agg(F.avg("rating")).first()[0]
    items = materialize(ridge_factors.half_step(train, users, "user_id", "artist_id", F.lit(mean), 1, ridge_factors.PENALTY), "half-step")
    found = s.table(spark, d, "embeddings").select(F.col("vec_id").alias("artist_id"), F.lit(1.0).alias("has_audio"))
    features = s.table(spark, d, "part").select(F.col("p_partkey").alias("artist_id"), (F.col("p_size") / 50).alias("size")).join(found, "artist_id", "left")
    counts = train.groupBy("artist_id").agg(F.count(F.lit(1)).alias("n"))
    described = materialize(feature_factors.sparse_features(features, ["size", "has_audio"], scaled=False).join(counts, "artist_id", "left").fillna(0, ["n"]), "described-items")
    told = feature_factors.told_by_features(described, feature_factors.feature_step(items, described, 2, 1, feature_factors.FEATURE_PENALTY))
    return told.select("artist_id", F.round(F.col("weights")[0], 6).alias("bias"), F.round(F.col("weights")[1], 6).alias("factor"))


def _ablation(predictions):
    return evaluate.error_metrics(predictions, ["model"]).join(evaluate.rerank_metrics(predictions), "model", "left")


@query
def ablation_table(spark, d):
    """All models on the same test rows."""
    return _ablation(_every_prediction(spark, d)[1])


@query
def ablation_means(spark, d):
    """The same table for the means alone."""
    return evaluate.ablation_table(materialize(_mean_predictions(spark, d)[1], "predictions"), baselines.MODELS)


@query
def knn_user_exact(spark, d):
    """The 20 nearest users of every user, compared with all that share an artist with it."""
    return neighbours.nearest_users_exact(_sides(spark, d)[0]).withColumn("similarity", F.round("similarity", 6))


@query
def knn_predictions_exact(spark, d):
    """All test rows, predicted from their users' exact neighbours."""
    train, test = _sides(spark, d)
    return neighbours.predict_from_neighbours(train, neighbours.nearest_users_exact(train), test).withColumn("prediction", F.round("prediction", 6))


@query
def metrics_knn(spark, d):
    """Errors of the neighbour predictions, as of the means in ``metrics_rating``."""
    return evaluate.error_metrics(knn_predictions_exact(spark, d).withColumn("model", F.lit("knn")), ["model"])


def _half_step(spark, d):
    """Train rows, first item weights, and users' weights after one half step of rank 1."""
    train = _sides(spark, d)[0]
    items = ridge_factors.first_weights(train.select("artist_id").distinct(), 1)
    mean = train.agg(F.avg("rating")).first()[0]
    users = ridge_factors.half_step(train.select("user_id", "artist_id", "rating"), items, "artist_id", "user_id", F.lit(mean), 1, ridge_factors.PENALTY)
    return train, items, materialize(users, "half-step")


@query
def ridge_half_step(spark, d):
    return _half_step(spark, d)[2].select("user_id", F.round(F.col("weights")[0], 6).alias("bias"), F.round(F.col("weights")[1], 6).alias("factor"))


@query
def recommend_half_step(spark, d):
    """Lists by inner product from weights that SQL can give, too."""
    train, items, users = _half_step(spark, d)
    return inner_products.top_by_inner_product(users, items, train).withColumn("score", F.round("score", 6))


@query
def mf_predictions(spark, d):
    train, test = _sides(spark, d)
    return ridge_factors.predict_ridge_factors(ridge_factors.fit_ridge_factors(train), test, "prediction")


@query
def recommend_mf(spark, d):
    """The ten best unseen items of every user by the fitted factors."""
    train = _sides(spark, d)[0]
    model = ridge_factors.fit_ridge_factors(train)
    return inner_products.top_by_inner_product(model.users, model.items, train)


@query
def metrics_ranking_mf(spark, d):
    """Ranking figures of those lists, as of the item means in ``metrics_ranking``."""
    train, test = _sides(spark, d)
    model = ridge_factors.fit_ridge_factors(train)
    return evaluate.ranking_metrics(inner_products.top_by_inner_product(model.users, model.items, train), test)
