"""Data-quality rules.  The report is data: ``(rule_id, table_name, rule, passed, detail)``.

Each table is read once for all its row rules; referential rules compare distinct keys only.
A missing table (None) gives one failed row and its other rules are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..sources.tables import columns_with_prefix

REPORT = "rule_id string, table_name string, rule string, passed boolean, detail bigint"


def id_column(df: DataFrame) -> str | None:
    """The item id of a table; the older name is accepted."""
    return next((c for c in ("artist_id", "track_id") if c in df.columns), None)


def _schema_rules(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(r, t, text, bool(ok), 0 if ok else 1) for r, t, text, ok in rows], REPORT)


def _row_rules(df: DataFrame, table: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Rules that count offending rows: one pass, then one report row per rule."""
    counted = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"n{i}") for i, (_, _, c) in enumerate(rules)])
    entries = F.array(*[
        F.struct(F.lit(rule).alias("rule_id"), F.lit(table).alias("table_name"), F.lit(text).alias("rule"),
                 (F.col(f"n{i}") == 0).alias("passed"), F.col(f"n{i}").alias("detail"))
        for i, (rule, text, _) in enumerate(rules)
    ])
    return counted.select(F.inline(entries))


def surplus_rows(df: DataFrame, key: str) -> DataFrame:
    """Per distinct key how many rows it has beyond the first (null is a key like any other)."""
    return df.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("surplus"), F.max(F.col(key).isNull()).alias("is_null"))


def _key_rules(df: DataFrame, key: str, table: str, null_rule: str | None, unique_rule: str) -> DataFrame:
    rules = [(unique_rule, f"no duplicate {key}", F.sum("surplus"))]
    if null_rule:
        rules.insert(0, (null_rule, f"no null {key}", F.sum(F.when(F.col("is_null"), F.col("surplus") + 1))))
    return _row_rules(surplus_rows(df, key), table, rules)


def orphan_keys(df: DataFrame, key: str, parent: DataFrame | None, parent_key: str | None) -> DataFrame:
    """Distinct keys that the parent lacks; without a parent, all of them."""
    keys = df.select(F.col(key).cast("long").alias("k")).filter(F.col("k").isNotNull()).distinct()
    if parent is None or parent_key is None:
        return keys
    return keys.join(parent.select(F.col(parent_key).cast("long").alias("k")), "k", "left_anti")


def _rows_of(df: DataFrame, sign: int) -> DataFrame:
    return df.agg((F.count(F.lit(1)) * sign).alias("n"))


def check_catalog(df: DataFrame) -> list[DataFrame]:
    spark, key = df.sparkSession, id_column(df)
    out = [_schema_rules(spark, [("V01", "catalog", "has id", key is not None),
                                 ("V02", "catalog", "has artist", "artist" in df.columns)])]
    if key:
        out.append(_key_rules(df, key, "catalog", "V03", "V04"))
    return out


def check_ratings(df: DataFrame, catalog: DataFrame | None) -> list[DataFrame]:
    spark, key = df.sparkSession, id_column(df)
    out = [_schema_rules(spark, [("V05", "ratings", "has user_id", "user_id" in df.columns),
                                 ("V06", "ratings", "has item id", key is not None),
                                 ("V07", "ratings", "has rating", "rating" in df.columns)])]
    if key:
        parent = id_column(catalog) if catalog is not None else None
        out.append(_row_rules(orphan_keys(df, key, catalog, parent), "ratings",
                              [("V08", "ids join to catalog", F.count(F.lit(1)))]))
    return out + [_row_rules(df, "ratings", [rule]) for rule in rating_rules(df)]


def rating_rules(df: DataFrame) -> list[tuple[str, str, Column]]:
    """The rules that look at one rating row at a time, as far as the table has their columns."""
    rules = []
    if "rating" in df.columns:
        outside = ~F.coalesce(F.col("rating").between(C.RATING_MIN, C.RATING_MAX), F.lit(False))
        rules.append(("V33", "rating in [1, 5]", F.count_if(outside)))
    if "artist" in df.columns:
        rules.append(("V34", "artist text is normalised", F.count_if(~is_normalised(F.col("artist")))))
    return rules


def is_normalised(text: Column) -> Column:
    """Lower-case, no outer blanks, single blanks; null passes."""
    tidy = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.coalesce(text == tidy, F.lit(True))


def check_split(train: DataFrame, test: DataFrame, ratings: DataFrame) -> list[DataFrame]:
    difference = reduce(DataFrame.unionByName, [_rows_of(train, 1), _rows_of(test, 1), _rows_of(ratings, -1)])
    test_only = test.select("user_id").distinct().join(train.select("user_id").distinct(), "user_id", "left_anti")
    return [
        _row_rules(difference, "split", [("V09", "train + test = ratings", F.abs(F.sum("n")))]),
        _row_rules(test_only, "split", [("V10", "no test-only users", F.count(F.lit(1)))]),
    ]


def check_master(df: DataFrame) -> list[DataFrame]:
    wanted = ["user_id", "artist", "rating"]
    return [_schema_rules(df.sparkSession, [
        ("V11", "master", "has item id", id_column(df) is not None),
        *[(f"V{12 + i}", "master", f"has {c}", c in df.columns) for i, c in enumerate(wanted)],
    ])]


def check_tag_features(df: DataFrame, catalog: DataFrame | None) -> list[DataFrame]:
    key, terms = id_column(df), columns_with_prefix(df, "tfidf_")
    out = [_schema_rules(df.sparkSession, [
        ("V15", "tag_features", "has item id", key is not None),
        ("V16", "tag_features", "has tags_raw", "tags_raw" in df.columns),
        ("V17", "tag_features", "has tfidf columns", bool(terms)),
        ("V31", "tag_features", "tfidf columns are numeric", all(isinstance(df.schema[c].dataType, T.NumericType) for c in terms)),
    ])]
    if key:
        parent = id_column(catalog) if catalog is not None else None
        out.append(_key_rules(df, key, "tag_features", "V29", "V18"))
        out.append(_row_rules(orphan_keys(df, key, catalog, parent), "tag_features",
                              [("V19", "ids join to catalog", F.count(F.lit(1)))]))
        out.append(_row_rules(df.select(key), "tag_features", [("V27", "is not empty", (F.count(F.lit(1)) == 0).cast("int"))]))
    return out


def check_map(df: DataFrame) -> list[DataFrame]:
    out = [_schema_rules(df.sparkSession, [("V20", "map", "has artist_id", "artist_id" in df.columns),
                                           ("V21", "map", "has musicnet_id", "musicnet_id" in df.columns)])]
    if {"artist_id", "musicnet_id"} <= set(df.columns):
        out.append(_key_rules(df, "musicnet_id", "map", None, "V22"))
    return out


def check_artist_audio(df: DataFrame, which: str) -> list[DataFrame]:
    rule = {"train": "V23", "test": "V24"}[which]
    return [_schema_rules(df.sparkSession, [(rule, f"artist_audio_{which}", "has artist_id", "artist_id" in df.columns)])]


def dq_report(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Report over the tables given: catalog, ratings, train, test, master, tag_features, map,
    artist_audio_train, artist_audio_test."""
    catalog = tables.get("catalog")
    parts = [_schema_rules(spark, [("V25", name, "table is there", False)]) for name, df in tables.items() if df is None]
    present = {name: df for name, df in tables.items() if df is not None}
    if "catalog" in present:
        parts += check_catalog(present["catalog"])
    if "ratings" in present:
        parts += check_ratings(present["ratings"], catalog)
    if {"train", "test", "ratings"} <= set(present):
        parts += check_split(present["train"], present["test"], present["ratings"])
    if "master" in present:
        parts += check_master(present["master"])
    if "tag_features" in present:
        parts += check_tag_features(present["tag_features"], catalog)
    if "map" in present:
        parts += check_map(present["map"])
    for which in ("train", "test"):
        if f"artist_audio_{which}" in present:
            parts += check_artist_audio(present[f"artist_audio_{which}"], which)
    return reduce(DataFrame.unionByName, parts)


def report_summary(report: DataFrame) -> DataFrame:
    """One row: rules passed and failed, and the exit status a job should return."""
    failed = F.count_if(~F.col("passed"))
    return report.agg(
        F.count_if("passed").alias("passed"), failed.alias("failed"), F.when(failed > 0, 1).otherwise(0).alias("exit_status")
    )


def guard_tag_features(df: DataFrame) -> DataFrame:
    """Raise unless the tag table may be published; returns it unchanged."""
    report = reduce(DataFrame.unionByName, check_tag_features(df, None)).filter(F.col("rule_id") != "V19")
    broken = [r["rule"] for r in report.filter(~F.col("passed")).orderBy("rule_id").collect()]
    if broken:
        raise ValueError("tag features are not fit to publish: " + "; ".join(broken))
    return df
