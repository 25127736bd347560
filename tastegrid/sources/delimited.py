"""Delimited text scans.  Columns are found by the names in the header, never by position.

A file is scanned with all columns of its header as text, so a row's length is judged by the file's own
width; the wanted columns are then picked by name (stripped, any case) and cast.  In a folder of several
files each header is checked against the first.  The lenient scan keeps short rows (missing fields are
null) and skips rows with too many fields; the comma scan keeps short rows and fails on long ones; the
strict scan fails on both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_row"


def standard_names(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Header names stripped and lower-cased, then renamed."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    return df.withColumnsRenamed(renames or {})


def header_schema(spark: SparkSession, path: str, sep: str = "\t", encoding: str = "UTF-8") -> T.StructType:
    """All-text schema from the header line of a file."""
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("escape", '"').option("header", True)
    return T.StructType([T.StructField(name, T.StringType(), True) for name in reader.csv(path).columns])


def _separators(line, sep: str):
    """Number of separators outside quoted fields."""
    bare = F.regexp_replace(line, r'"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))


def _reader(spark: SparkSession, sep: str, encoding: str = "UTF-8"):
    """Column pruning is off for these scans alone: with it on, a narrow select lets rows of wrong length through."""
    return (
        spark.read.option("header", True).option("enforceSchema", False)
        .option("sep", sep).option("encoding", encoding).option("quote", '"').option("escape", '"')
        .option("columnPruning", False)
    )


def _marked_scan(spark: SparkSession, path: str, header: T.StructType, sep: str, encoding: str, multi_line: bool) -> tuple[DataFrame, Column]:
    """All columns as text, short rows padded, and the mark of rows with too many fields."""
    with_corrupt = T.StructType([*header.fields, T.StructField(_CORRUPT, T.StringType(), True)])
    rows = (
        _reader(spark, sep, encoding).schema(with_corrupt)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    too_long = F.col(_CORRUPT).isNotNull() & (_separators(F.col(_CORRUPT), sep) >= len(header))
    return rows, F.coalesce(too_long, F.lit(False))


def pick_columns(rows: DataFrame, schema: T.StructType | None, optional: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """The columns of ``schema`` by name, cast; all columns without one.

    An absent column is an error, or all null if ``optional``.  A value that its type cannot hold is
    null, or an error if ``strict``.
    """
    if schema is None:
        return rows
    found: dict[str, list[str]] = {}
    for name in rows.columns:
        found.setdefault(name.strip().lower(), []).append(name)

    def picked(field: T.StructField) -> Column:
        places = found.get(field.name.lower(), [])
        if len(places) > 1:
            raise ValueError(f"column {field.name} is there {len(places)} times")
        if not places:
            if field.name not in optional:
                raise ValueError(f"no column {field.name} among {rows.columns}")
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(f"`{places[0]}`")
        cast = value.try_cast(field.dataType)
        if strict and not isinstance(field.dataType, T.StringType):
            wrong = F.raise_error(F.concat(F.lit(f"Malformed {field.name}: "), value)).cast(field.dataType)
            cast = F.when(value.isNotNull() & cast.isNull(), wrong).otherwise(cast)
        return cast.alias(field.name)

    return rows.select(*[picked(f) for f in schema.fields])


def lenient_scan(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = "\t",
                 encoding: str = "UTF-8", multi_line: bool = False, optional: tuple[str, ...] = ()) -> DataFrame:
    """Scan that pads short rows and skips long ones.

    ``multi_line`` is for files whose quoted fields hold line breaks; such files cannot be split
    between tasks, so it is off unless asked for.
    """
    rows, too_long = _marked_scan(spark, path, header_schema(spark, path, sep, encoding), sep, encoding, multi_line)
    return pick_columns(rows.filter(~too_long).drop(_CORRUPT), schema, optional)


def strict_scan(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """Scan where a malformed row is an error."""
    rows = _reader(spark, sep).schema(header_schema(spark, path, sep)).option("mode", "FAILFAST").csv(path)
    return pick_columns(rows, schema, strict=True)


def comma_scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Comma file: short rows are padded, a row with too many fields is an error; all text when no schema is given."""
    rows, too_long = _marked_scan(spark, path, header_schema(spark, path, ","), ",", "UTF-8", False)
    surplus = F.raise_error(F.concat(F.lit("Malformed row, too many fields: "), F.col(_CORRUPT))).cast("boolean")
    return pick_columns(rows.filter(F.when(too_long, surplus).otherwise(True)).drop(_CORRUPT), schema)
