"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows lie in chunks.  How many rows of each chunk go to each shard is drawn first, from the law
that a uniform permutation of all rows would give: the matrix has the chunk sizes as row sums and
the exact shard sizes as column sums.  It is drawn down a binary tree over the chunks; a node
splits its shards' room between its two halves by hypergeometric draws, so all nodes of a level are
rows of one table.  Then each chunk permutes its rows and deals them out by its row of the matrix,
and each shard permutes what it received.

A draw inverts the distribution function over all outcomes within nine standard deviations of the
mode (less than 1e-15 of the mass lies outside).

Chunks hold about ``rows_per_chunk`` rows.  A shard may hold any number of rows: its permutation is
a range-partitioned sort (``skew``), not one task.  Only (doc_id, size, checksum) move, no text.

Edge cases: a null text has size 1 and the checksum of no bytes; repeated rows are rows of their
own; an empty table gives no rows.  The random keys are hashes of the row and the seed: reruns agree,
rows equal in all three columns are interchangeable.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import running_total, store_slices
from ..session import materialize

ROWS_PER_CHUNK = 100_000
LEAST_CHUNKS = 16
SPREAD_LEVEL = 8
_LOG_FACTORIALS = [math.lgamma(i + 1) for i in range(10)]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _log_factorial(x: Column) -> Column:
    y = F.greatest(x, F.lit(1)).cast("double")
    stirling = y * F.log(y) - y + F.log(y * (2 * math.pi)) / 2 + 1 / (y * 12) - 1 / (y * y * y * 360) + 1 / (y * y * y * y * y * 1260)
    small = F.array(*[F.lit(v) for v in _LOG_FACTORIALS])
    return F.when(x < 10, F.get(small, x.cast("int"))).otherwise(stirling)


def hypergeometric(good: Column, bad: Column, draws: Column, uniform: Column) -> Column:
    """Number of good ones among ``draws`` of ``good + bad`` taken without replacement; ``uniform`` in (0, 1)."""
    all_ = (good + bad).cast("double")
    low, high = F.greatest(F.lit(0), draws - bad), F.least(good, draws)
    mode = F.least(F.greatest(F.floor((draws + 1.0) * (good + 1.0) / (all_ + 2)), low), high)
    deviation = F.sqrt(draws / all_ * good * (bad / all_) * ((all_ - draws) / F.greatest(all_ - 1, F.lit(1.0))))
    reach = F.ceil(deviation * 9) + 9

    def minus_log_weight(k):
        return _log_factorial(k) + _log_factorial(good - k) + _log_factorial(draws - k) + _log_factorial(bad - draws + k)

    def invert(edge):
        weights = F.transform(F.sequence(edge["first"], edge["last"]), lambda k: F.exp(edge["top"] - minus_log_weight(k)))

        def pick(w):
            goal = F.aggregate(w, F.lit(0.0), lambda a, x: a + x) * uniform
            return _let(goal, lambda g: F.aggregate(
                w, F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")),
                lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["n"] + F.when(a["sum"] + x < g, 1).otherwise(0)).alias("n")),
                lambda a: a["n"]))

        return F.least(edge["last"], edge["first"] + _let(weights, pick))

    edge = _let(mode, lambda m: F.struct(
        F.greatest(low, m - reach).alias("first"), F.least(high, m + reach).alias("last"), minus_log_weight(m).alias("top")))
    return F.when(low >= high, low).otherwise(_let(edge, invert))


def split_room(room: Column, left: Column, node: Column, level: int, seed: int) -> Column:
    """The part of each shard's ``room`` that goes to the first ``left`` rows of a node."""
    def step(state, x):
        rest = state["rest"] - x["room"]
        uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), node, x["shard"]), 11) + 0.5) * 2.0**-53
        return _let(hypergeometric(x["room"], rest, state["need"], uniform), lambda got: F.struct(
            rest.alias("rest"), (state["need"] - got).alias("need"), F.concat(state["out"], F.array(got)).alias("out")))

    numbered = F.transform(room, lambda r, i: F.struct(r.alias("room"), i.alias("shard")))
    start = F.struct(F.aggregate(room, F.lit(0).cast("long"), lambda a, r: a + r).alias("rest"), left.alias("need"),
                     F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(numbered, start, step, lambda s: s["out"])


def communication_matrix(counts: DataFrame, chunks: int, sizes: list[int], seed: int) -> DataFrame:
    """``(chunk, room)`` from ``(chunk, n)``: rows of the chunk that each shard gets.  ``chunks`` is a power of two."""
    whole = counts.sparkSession.range(chunks).withColumnRenamed("id", "chunk").join(counts, "chunk", "left")
    nodes = whole.agg(F.array_sort(F.collect_list(F.struct("chunk", F.coalesce("n", F.lit(0)).cast("long").alias("n")))).alias("x")).select(
        F.lit(0).cast("long").alias("node"), F.col("x.n").alias("counts"), F.array(*[F.lit(s).cast("long") for s in sizes]).alias("room"))
    for level in range(chunks.bit_length() - 1):
        half = chunks >> (level + 1)
        if level and level % SPREAD_LEVEL == 0:
            nodes = nodes.repartition("node")
        left_rows = F.aggregate(F.slice("counts", 1, half), F.lit(0).cast("long"), lambda a, n: a + n)
        nodes = nodes.withColumn("left_room", split_room(F.col("room"), left_rows, F.col("node"), level, seed)).select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.slice("counts", 1, half).alias("counts"), F.col("left_room").alias("room")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.slice("counts", half + 1, half).alias("counts"),
                     F.zip_with("room", "left_room", lambda a, b: a - b).alias("room")))).alias("x")).select("x.*")
    return nodes.select(F.col("node").alias("chunk"), "room")


def shuffle_into_shards(docs: DataFrame, shards: int = 16, rows_per_chunk: int = ROWS_PER_CHUNK, seed: int = 7) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``: a uniform shuffle; shard sizes differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                                   F.monotonically_increasing_id().alias("row")), "shard-rows")
    n = rows.count()
    chunks = 1 << max((LEAST_CHUNKS - 1).bit_length(), (n // rows_per_chunk).bit_length())
    sizes = [n // shards + (s < n % shards) for s in range(shards)]

    def key(what):
        return F.xxhash64(F.lit(seed), F.lit(what), "doc_id", "size", "text_crc32")

    rows = rows.withColumn("chunk", F.pmod(key("chunk"), F.lit(chunks)))
    matrix = communication_matrix(rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")), chunks, sizes, seed)
    bounds = matrix.select("chunk", F.transform(
        F.sequence(F.lit(1), F.lit(shards)), lambda i: F.aggregate(F.slice("room", F.lit(1), i), F.lit(0).cast("long"), lambda a, r: a + r)).alias("bounds"))
    # Permute each chunk; the matrix says which stretch of it goes where.  Chunks may hold copies of
    # one row in any number, so their order is cut by range too; the row number cuts the copies.
    order = [key("deal"), F.col("row")]
    permuted = running_total(store_slices(rows, ["chunk"], order, "shard-chunks"), ["chunk"], order, F.lit(1), "place")
    dealt = permuted.join(bounds, "chunk").withColumn(
        "shard", F.size(F.filter("bounds", lambda b: b <= F.col("place"))).cast("int")).drop("bounds", "place", "slice", "chunk")
    order = [key("slot"), F.col("row")]
    return running_total(store_slices(dealt, ["shard"], order, "shard-slots"), ["shard"], order, F.lit(1), "slot").select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
