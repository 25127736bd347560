"""The preparation flow, raw files to prepared tables, one function per step.

Every step reads stored tables and writes one, so a step can be run again on its own and nothing
is computed twice.  Paths are folders below ``raw`` and ``out``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import catalog as cat
from ..operators import extract, quality, resume, rollup, split, tags, tfidf
from ..operators.ratings import rate_interactions
from ..session import materialize
from ..sources import delimited, payloads, tables
from ..sources.audio import audio_files


def catalog_step(spark: SparkSession, raw: str, out: str) -> None:
    """Catalog and recording map; without recordings the map is empty and the id column null."""
    artists = delimited.standard_names(
        delimited.lenient_scan(spark, f"{raw}/artists.dat", schemas.RAW_ARTISTS, optional=("url", "pictureURL")),
        schemas.STANDARD_NAMES["artists"])
    catalog = cat.build_catalog(artists)
    path = f"{raw}/recordings.csv"
    if tables.path_exists(spark, path):
        recordings = delimited.standard_names(delimited.comma_scan(spark, path), schemas.STANDARD_NAMES["recordings"])
        stored = materialize(cat.clean_recordings(recordings), "recordings")
        found = cat.match_recordings(stored, catalog, cat.composer_aliases(spark))
    else:
        found = spark.createDataFrame([], schemas.RECORDING_MAP)
    tables.write_table(found, f"{out}/recording_map")
    stored = tables.read_table(spark, f"{out}/recording_map", schemas.RECORDING_MAP)
    tables.write_table(cat.attach_recordings(catalog, stored), f"{out}/catalog")


def ratings_step(spark: SparkSession, raw: str, out: str) -> None:
    plays = delimited.standard_names(
        delimited.strict_scan(spark, f"{raw}/user_artists.dat", schemas.RAW_INTERACTIONS),
        schemas.STANDARD_NAMES["interactions"])
    plays = tables.assert_not_null(plays, "user_id", "artist_id")
    catalog = tables.read_table(spark, f"{out}/catalog", schemas.CATALOG)
    tables.write_table(rate_interactions(plays, catalog), f"{out}/ratings")


def split_step(spark: SparkSession, out: str) -> None:
    """One table with ``is_test`` as its partition column: train and test are directories of it."""
    labelled = split.label_split(tables.read_table(spark, f"{out}/ratings", schemas.RATINGS))
    labelled.write.mode("overwrite").partitionBy("is_test").parquet(f"{out}/split")


def train_table(spark: SparkSession, out: str) -> DataFrame:
    return split.train_rows(tables.read_table(spark, f"{out}/split", schemas.LABELLED_RATINGS))


def test_table(spark: SparkSession, out: str) -> DataFrame:
    return split.test_rows(tables.read_table(spark, f"{out}/split", schemas.LABELLED_RATINGS))


def overlap_step(spark: SparkSession, out: str) -> None:
    found = tables.read_table(spark, f"{out}/recording_map", schemas.RECORDING_MAP)
    for name, rows in (("train", train_table(spark, out)), ("test", test_table(spark, out))):
        tables.write_table(split.overlap_subset(rows, found), f"{out}/ratings_{name}_overlap")


def master_step(spark: SparkSession, out: str) -> None:
    ratings = tables.read_table(spark, f"{out}/ratings", schemas.RATINGS)
    catalog = tables.read_table(spark, f"{out}/catalog", schemas.CATALOG)
    tables.write_table(cat.master_table(ratings, catalog), f"{out}/master")


def tag_step(spark: SparkSession, raw: str, out: str) -> None:
    """Tag lists and the wide term matrix.  Stored service answers are used where there are any."""
    vocabulary = tags.clean_vocabulary(delimited.standard_names(
        delimited.lenient_scan(spark, f"{raw}/tags.dat", schemas.RAW_TAGS, encoding="ISO-8859-1"),
        schemas.STANDARD_NAMES["tags"]))
    assignments = tags.clean_assignments(delimited.standard_names(
        delimited.lenient_scan(spark, f"{raw}/user_taggedartists.dat", schemas.RAW_TAG_ASSIGNMENTS),
        schemas.STANDARD_NAMES["tag_assignments"]))
    tables.write_table(tags.tag_user_counts(assignments, vocabulary), f"{out}/tag_counts")
    counts = spark.read.parquet(f"{out}/tag_counts")
    answers = tables.optional_table(spark, f"{raw}/tag_payloads", schemas.TAG_PAYLOADS)
    fallback = payloads.fallback_tags(answers, payloads.read_tag_cache(spark, f"{raw}/tag_cache.json"))
    artists = tables.read_table(spark, f"{out}/catalog", schemas.CATALOG)
    tables.write_table(
        tfidf.term_frequencies(tags.tag_terms(tags.tag_documents(artists, counts, fallback))), f"{out}/tag_terms")
    frequencies = spark.read.parquet(f"{out}/tag_terms")
    wide = tfidf.weights_wide(tags.tag_lists(artists, counts, fallback), frequencies, tfidf.vocabulary(frequencies))
    checked = materialize(wide, "tag-features")
    quality.guard_tag_features(checked)  # a refused table leaves the published one in place
    tables.write_table(checked, f"{out}/tag_features")


def extract_step(spark: SparkSession, folder: str, out: str, which: str, extractor: Callable[[bytes], dict[str, float]], features: list[str],
                 pattern: str = "*.wav") -> None:
    """Features of the mapped recordings that have none yet and whose file is in ``folder``; run again, it does what is left.

    Failures and the ids without a file are tables of their own.
    """
    path = f"{out}/audio_features_{which}"
    requested = tables.optional_table(spark, f"{out}/recording_map", schemas.RECORDING_MAP)
    done = tables.optional_table(spark, path, schemas.RECORDING_IDS)
    files = audio_files(spark, folder, pattern)
    work = materialize(resume.work_list(requested, done, files), "work-list")
    tables.write_table(resume.missing_ids(work), f"{out}/missing_{which}")
    wanted = files.join(resume.pending_ids(work), "musicnet_id", "left_semi")
    extracted = materialize(extract.extract_features(extract.unprocessed(wanted, done), extractor, features), "extracted")
    extract.append_batch(extracted, path, f"{out}/failures_{which}")


def artist_audio_step(spark: SparkSession, features: str, out: str, which: str) -> None:
    """Roll one side's feature table up to artists, with their recordings as a table of its own; without a recording
    map both are empty."""
    found = tables.optional_table(spark, f"{out}/recording_map", schemas.RECORDING_MAP)
    mapped = materialize(rollup.map_recordings(spark.read.parquet(features), found), "mapped-recordings")
    tables.write_table(rollup.artist_features(mapped), f"{out}/artist_audio_{which}")
    tables.write_table(rollup.artist_recordings(mapped), f"{out}/artist_recordings_{which}")


def report_step(spark: SparkSession, out: str) -> DataFrame:
    """The quality report over whatever tables are there; absent ones fail their rule."""
    def table(name: str) -> DataFrame | None:
        path = f"{out}/{name}"
        return spark.read.parquet(path) if tables.path_exists(spark, path) else None

    has_split = tables.path_exists(spark, f"{out}/split")
    return quality.dq_report(spark, {
        "catalog": table("catalog"),
        "ratings": table("ratings"),
        "train": train_table(spark, out) if has_split else None,
        "test": test_table(spark, out) if has_split else None,
        "master": table("master"),
        "tag_features": table("tag_features"),
        "map": table("recording_map"),
        "artist_audio_train": table("artist_audio_train"),
        "artist_audio_test": table("artist_audio_test"),
    })
