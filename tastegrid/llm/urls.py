"""URL filters: a blocked Bloom filter of the listed URLs, then an exact join of what passes it.

A rule is (host, path, action).  It fits its host and all subdomains when the URL's path starts
with the rule's path; the longest fitting rule decides.  So a URL is looked up under every host
suffix and path prefix that a rule could have: the (number of labels, length of path) pairs that
occur in the list, its shapes.

Size of what is broadcast: the filter has at most ``MAX_BLOCKS`` blocks of 256 bits whatever the
list (32 MB); a longer list only lets more false hits through to the exact join, which carries no
hint.  Shapes are bounded by host labels times path lengths.

Edge cases: a null URL or one without ``://`` has an empty host and path, fits no rule and gets the
default verdict; repeated rows stay repeated; rules with a null host, path or action are ignored;
of two equal rules the action first in text order counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8
ROWS_PER_BLOCK = 16
MAX_BLOCKS = 1 << 20


def url_host(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.when(F.locate("://", url) > 0, host).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit in each of the 8 words of the key's block."""
    other = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(other, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(WORDS)]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``(block, w0 .. w7)``: at most ``blocks`` rows."""
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(
        *[F.bit_or(b).alias(f"w{i}") for i, b in enumerate(_bits(F.col(key)))])


def passes(key: Column) -> Column:
    """Whether every bit of ``key`` is set in the block joined to the row."""
    found = F.lit(True)
    for i, b in enumerate(_bits(key)):
        found = found & (F.col(f"w{i}").bitwiseAND(b) != 0)
    return found


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per row of ``pages``.

    ``rules`` has text columns host, path, action.
    """
    listed = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "action").dropna()
    listed = materialize(
        listed.groupBy(F.concat("host", "path").alias("rule"), _labels(F.col("host")).alias("labels"),
                       F.length("path").alias("path_length")).agg(F.min("action").alias("action")), "url-rules")
    shapes = sorted((r["labels"], r["path_length"]) for r in listed.select("labels", "path_length").distinct().collect())
    blocks = max(1, min(MAX_BLOCKS, -(-listed.count() // ROWS_PER_BLOCK)))
    bloom = bloom_filter(listed, "rule", blocks)

    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    parts = F.split("host", r"\.", -1)
    known = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("path_length")) for n, m in shapes]) if shapes else F.array().cast(
        "array<struct<labels:int,path_length:int>>")
    fitting = F.filter(known, lambda s: (s["labels"] <= F.size(parts)) & (s["path_length"] <= F.length("path")))
    keys = F.transform(fitting, lambda s: F.concat(
        F.array_join(F.slice(parts, F.size(parts) - s["labels"] + 1, s["labels"]), "."), F.substring("path", 1, s["path_length"])))
    looked_up = urls.select("host", "path").distinct().withColumn("rule", F.explode(keys))
    possible = (
        looked_up.withColumn("block", _block(F.col("rule"), blocks)).join(F.broadcast(bloom), "block")
        .filter(passes(F.col("rule"))).select("host", "path", "rule")
    )
    # The longest text wins; of equal lengths the one with more host labels.
    best = possible.join(listed, "rule").groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("l"), "labels", "rule", "action")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
