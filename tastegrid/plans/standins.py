"""The driver's tables in the roles of the raw tables.  Whole tables throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..operators.catalog import composer_aliases
from ..session import spread

CUSTOMER_BASE = 1_000_000_000_000


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    n = lines.count()
    return spread(lines, n, "l_orderkey").join(spread(table(spark, d, "orders"), n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))


def interactions(spark: SparkSession, d: str) -> DataFrame:
    """Customers and the parts they bought, with the quantity."""
    lines = order_lines(spark, d).select("o_custkey", "l_partkey", "l_quantity")
    return spread(lines, table(spark, d, "lineitem").count(), "o_custkey", "l_partkey").groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("artist_id")).agg(
        F.sum("l_quantity").alias("weight")
    )


def basket_interactions(spark: SparkSession, d: str) -> DataFrame:
    """Orders and their parts: many short histories, some of a single row."""
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("artist_id")).agg(
        F.sum("l_quantity").alias("weight")
    )


def part_catalog(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("artist_id"), normalize_text(F.col("p_name")).alias("artist"),
        F.concat(F.lit("http://x/"), F.col("p_partkey").cast("string")).alias("url"),
    )


def name_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Raw artists: suppliers bear names of their own, customers share five."""
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("artist_id"), F.col("s_name").alias("artist"), F.lit("s").alias("url"))
    customers = table(spark, d, "customer").select(
        (F.col("c_custkey") + CUSTOMER_BASE).cast("string").alias("artist_id"), F.col("c_mktsegment").alias("artist"),
        F.lit("c").alias("url"))
    return suppliers.unionByName(customers)


def recordings(spark: SparkSession, d: str) -> DataFrame:
    """Orders as recordings; the status decides how the composer is written."""
    orders = table(spark, d, "orders").join(
        table(spark, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    number = F.lpad(F.floor(F.col("o_custkey") / 10).cast("string"), 9, "0")
    composer = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("  SUPPLIER#"), number, F.lit(" ")))
        .when(F.col("o_orderstatus") == "O", F.concat(number, F.lit(", Supplier#")))
        .otherwise(F.col("c_mktsegment"))
    )
    return orders.select(F.col("o_orderkey").cast("string").alias("musicnet_id"), composer.alias("composer_raw"))


def aliases(spark: SparkSession, d: str) -> DataFrame:
    """Other spellings of the suppliers, beside the fixed composers."""
    return table(spark, d, "supplier").select(
        F.replace(F.lower("s_name"), F.lit("#"), F.lit("# ")).alias("composer_norm"), F.col("s_name").alias("alias"),
        F.lit(1).alias("ord"),
    ).unionByName(composer_aliases(spark))


def tag_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("tag_id"), F.concat_ws(" / ", "p_name", "p_brand").alias("tag_name"))


def tag_assignments(spark: SparkSession, d: str) -> DataFrame:
    return order_lines(spark, d).select(
        F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("artist_id"),
        F.col("l_partkey").alias("tag_id"))


def tag_artists(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers, which have tags, and customers, which have none of their own."""
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist")).unionByName(
        table(spark, d, "customer").select((F.col("c_custkey") + CUSTOMER_BASE).alias("artist_id"), F.col("c_name").alias("artist")))


def payload_text(event_type: Column) -> Column:
    """A service answer for an event type: list, single object, or broken text."""
    many = F.concat(
        F.lit('{"toptags":{"tag":[{"name":"'), event_type, F.lit(' & More"},{"name":"Events/'), event_type,
        F.lit('"},{"name":" "},{"name":"'), event_type, F.lit(' & more"}]}}'))
    return (
        F.when(event_type == "signup", F.lit('{"toptags":{"tag":{"name":"[Sign-Up]"}}}'))
        .when(event_type == "error", F.lit('{"toptags":'))
        .otherwise(many)
    )


def event_payloads(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", payload_text(F.col("event_type")).alias("payload"))


def customer_payloads(spark: SparkSession, d: str) -> DataFrame:
    """The latest stored answer per customer."""
    latest = table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"))
    return latest.select(
        F.concat(F.lit(" CUSTOMER#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("artist_key"),
        payload_text(F.col("event_type")).alias("payload"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
    )


def vector_features(spark: SparkSession, d: str, dims: int = 64) -> DataFrame:
    """Vectors as recordings, each dimension a feature column."""
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("musicnet_id"),
        *[F.element_at("embedding", i).cast("double").alias(f"dim_{i}") for i in range(1, dims + 1)])


def vector_frames(spark: SparkSession, d: str) -> DataFrame:
    """Vectors cut into the groups of series that make up a recording."""
    def series(count: int, length: int) -> Column:
        cut = [F.slice("embedding", 1 + i * length, length).cast("array<double>") for i in range(count)]
        return F.array(*cut)

    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("musicnet_id"), series(20, 3).alias("mfcc"), F.slice("embedding", 61, 2).alias("tempo"),
        F.col("embedding").alias("rms"), series(12, 5).alias("chroma"), series(7, 9).alias("contrast"))


def vector_map(spark: SparkSession, d: str) -> DataFrame:
    """The label of a vector as its artist."""
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("musicnet_id"), F.col("label").cast("long").alias("artist_id"),
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("artist"))


def vector_files(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as files of comma-separated numbers; those of label 9 are damaged."""
    text = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ",")
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("musicnet_id"),
        F.encode(F.when(F.col("label") == 9, F.concat(text, F.lit(",?"))).otherwise(text), "utf-8").alias("content"))


def part_tag_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as tags that read like their nation: many ids share a name."""
    return table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("tag_id"), F.col("n_name").alias("tag_name"))


def part_tag_assignments(spark: SparkSession, d: str) -> DataFrame:
    """Customers tagging the parts they bought with the supplier."""
    return order_lines(spark, d).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("artist_id"), F.col("l_suppkey").alias("tag_id"))


def part_vector_map(spark: SparkSession, d: str) -> DataFrame:
    """The vector with a part's number as that part's recording."""
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("musicnet_id"), F.col("vec_id").alias("artist_id"), F.lit("part").alias("artist"))
