"""TF-IDF over a corpus of terms: smoothed idf, unit length per document, bounded vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.text import feature_names
from ..session import materialize

# Terms a frequent-items sketch follows, and its published error: this share of all rows, divided by the terms followed.
TRACKED = 8192
SKETCH_ERROR = 3.5


def term_frequencies(terms: DataFrame, key: str = "artist_id") -> DataFrame:
    """``(key, term, tf)``.  Grouped by both columns: no hot document or hot term gathers."""
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(frequencies: DataFrame, max_terms: int = C.MAX_TERMS, min_df: int = C.MIN_DOC_FREQUENCY) -> DataFrame:
    """``(term, cf, df)``: terms in enough documents, the most frequent of them, ties by term.

    At most ``max_terms`` rows, found with a bounded top-k rather than a full sort.
    """
    return (
        frequencies.groupBy("term").agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
        .filter(F.col("df") >= min_df)
        .orderBy(F.desc("cf"), F.asc("term"))
        .limit(max_terms)
    )


def frequent_vocabulary(terms: DataFrame, key: str = "artist_id", max_terms: int = C.MAX_TERMS, min_df: int = C.MIN_DOC_FREQUENCY,
                        tracked: int = TRACKED) -> DataFrame:
    """``vocabulary`` of ``terms (key, term)``, shuffling sketches and the rows of frequent terms in place of every (key, term).

    Each task keeps a frequent-items sketch of ``tracked`` terms; the merged sketch names candidates, which are then counted exactly.
    A term that the sketch does not name has at most ``SKETCH_ERROR * 2 / tracked`` of all rows, or, if the sketch named as many as it may, no more than the
    least it names, and never more than the rows left over by the candidates.  If the last kept term is above that bound, nothing else can
    belong to the vocabulary; else (flat counts) all terms are counted.  Null terms take no part.
    """
    named = terms.filter(F.col("term").isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(term, {tracked}, {tracked})").alias("top")).first()
    if not named["n"]:
        return vocabulary(term_frequencies(terms, key), max_terms, min_df)
    spark = terms.sparkSession
    candidates = spark.createDataFrame([(r["item"],) for r in named["top"]], "term string")
    counted = materialize(term_frequencies(terms.join(F.broadcast(candidates), "term"), key).groupBy("term").agg(
        F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df")), "candidate-terms")
    kept = counted.filter(F.col("df") >= min_df).orderBy(F.desc("cf"), F.asc("term")).limit(max_terms)
    last, n_kept = kept.agg(F.min("cf"), F.count(F.lit(1))).first()
    left_over = named["n"] - (counted.agg(F.sum("cf")).first()[0] or 0)
    full = len(named["top"]) >= tracked
    unnamed = max(2 * SKETCH_ERROR * named["n"] / tracked, min(r["count"] for r in named["top"]) if full else 0)
    if left_over == 0 or (n_kept == max_terms and last > min(unnamed, left_over)):
        return kept
    return vocabulary(term_frequencies(terms.filter(F.col("term").isNotNull()), key), max_terms, min_df)


def _raw_weights(frequencies: DataFrame, terms: DataFrame, n_documents: Column) -> DataFrame:
    """Unscaled ``tf * idf`` of the kept terms.  ``terms`` is limited, so it is safe to broadcast."""
    idf = F.log((1 + F.col("n_documents")) / (1 + F.col("df"))) + 1
    return (
        frequencies.join(F.broadcast(terms.select("term", "df")), "term")
        .withColumn("n_documents", n_documents)
        .withColumn("w", F.col("tf") * idf)
    )


def count_rows(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def weights_long(documents: DataFrame, frequencies: DataFrame, terms: DataFrame, key: str = "artist_id") -> DataFrame:
    """``(key, term, tfidf)``, non-zero weights only.

    ``documents`` has one row per document, those without terms included: they count in the idf.
    The norm is over at most ``max_terms`` rows per document.
    """
    raw = _raw_weights(frequencies, terms, count_rows(documents))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("w") / norm).alias("tfidf"))


def weights_wide(documents: DataFrame, frequencies: DataFrame, terms: DataFrame, key: str = "artist_id",
                 keep: tuple[str, ...] = ("tags_raw",)) -> DataFrame:
    """One row per document with a ``tfidf_*`` column per term, 0.0 where it has none.

    Only the terms (at most ``max_terms`` rows) come to the driver; they name the columns and are
    not computed a second time for the weights.  Weights and norm come out of one aggregate per
    document.
    """
    kept = sorted((r["term"], r["df"]) for r in terms.select("term", "df").collect())
    if not kept:
        raise ValueError("no term occurs in enough documents")
    names = [term for term, _ in kept]
    columns = feature_names(names)
    local = documents.sparkSession.createDataFrame(kept, "term string, df long")
    raw = _raw_weights(frequencies, local, count_rows(documents))
    cells = raw.groupBy(key).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        *[F.max(F.when(F.col("term") == t, F.col("w"))).alias(columns[t]) for t in names],
    )
    return documents.select(key, *keep).join(cells, key, "left").select(
        key, *keep, *[F.coalesce(F.col(c) / F.col("norm"), F.lit(0.0)).alias(c) for c in columns.values()]
    )
