"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key -ln(u) / quality; in the order of the keys the documents of a
source are a weighted sample without replacement of any length.  A source whose target is more than
its size is first taken whole, as often as it fits (complete epochs); the rest of the target is the
front of the order, found by a running sum of words.  The document at the edge is taken in part, so
a source's words equal its target, rounded.

Targets.  The sources share ``ratio`` times all words by weight; no target is above ``most`` times
its source's size, and what is cut off goes to the others by weight until none is above.  That is
the level L with sum(min(most * size, L * weight)) = ratio * all words: with sources in the order of
size per weight, a running sum finds it without iteration.

One source may hold any share of the rows: order and running sum work on range slices (``skew``).

Edge cases: a null text has no words; a null source is a source, last in order; a quality that is
null, not positive or not finite counts as the least one; repeated rows are documents of their own;
ties in the key are ordered by doc_id and the text's hash; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import running_total, store_slices
from ..session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
RATIO = 1.5
MOST = 2
LEAST_QUALITY = 0.05
SYMBOLS = "#$%&*+<=>@[\\]^_`{|}~0123456789"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def symbol_quality(text: Column) -> Column:
    """1 less the share of digits and symbols among the characters, at least ``LEAST_QUALITY``."""
    left = F.length(F.translate(text, SYMBOLS, ""))
    return F.greatest(F.lit(LEAST_QUALITY), F.coalesce(F.try_divide(left.cast("double"), F.length(text).cast("double")), F.lit(0.0)))


def _uniform(doc_id: Column, seed: int) -> Column:
    """In (0, 1), from the first 52 bits of a digest of the id."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) * 2.0**-52


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, ratio: float = RATIO, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``."""
    by_name = [F.col("source").asc_nulls_last()]
    numbered = running_total(store_slices(sizes, [], by_name, "mix-sources"), [], by_name, F.lit(1), "number").drop("slice")
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = numbered.withColumn("weight", F.get(cycle, (F.col("number") % len(weights)).cast("int")).cast("long"))
    # By size per weight: the first ones are held at their most.
    by_room = [F.col("source_size") / F.col("weight"), *by_name]
    sliced = store_slices(weighed, [], by_room, "mix-room")
    before = running_total(running_total(sliced, [], by_room, F.col("source_size"), "size_before"), [], by_room, F.col("weight"), "weight_before")
    total = F.coalesce(sliced.agg(F.sum("source_size")).scalar(), F.lit(0))
    all_weight = F.coalesce(sliced.agg(F.sum("weight")).scalar(), F.lit(0))
    level = (total * ratio - F.col("size_before") * most) / (all_weight - F.col("weight_before"))
    # Of the sources that stay below their most at their own level the first one has the largest level.
    held_less = before.withColumn("level", level).filter(F.col("level") * F.col("weight") <= F.col("source_size") * most)
    highest = held_less.agg(F.max("level")).scalar()
    return before.select("source", "source_size", F.coalesce(
        F.least(F.col("source_size") * F.lit(float(most)), highest * F.col("weight")), F.col("source_size") * F.lit(float(most))).alias("target"))


def mix(docs: DataFrame, quality: Column | None = None, weights: tuple[int, ...] = WEIGHTS, ratio: float = RATIO, most: float = MOST,
        seed: int = 11, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, text_hash, size, source, source_size, target, copies, cut_words, taken)`` and the columns ``keep``, one row per document.

    ``copies`` whole copies are taken and, if ``cut_words`` is not 0, a part of so many words more.
    A row number among ``keep`` tells repeated rows apart.
    """
    text = F.col("text")
    weight = symbol_quality(text) if quality is None else quality
    weight = F.when((weight > LEAST_QUALITY) & (weight < float("inf")), weight).otherwise(F.lit(LEAST_QUALITY))
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "source", word_count(text).alias("size"),
        (-F.log(_uniform(F.col("doc_id"), seed)) / weight).alias("key"), F.monotonically_increasing_id().alias("_row"), *keep)
    # Stored before it is cut, so that no text is read for the cuts; the row number cuts rows equal in all else.
    order = [F.col("key"), F.col("doc_id"), F.col("text_hash"), *[F.col(c) for c in keep], F.col("_row")]
    sliced = store_slices(materialize(keyed, "mix-rows"), ["source"], order, "mix")
    sizes = sliced.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, ratio, most), "mix-targets").withColumnRenamed("source", "of_source")
    placed = running_total(sliced, ["source"], order, F.col("size"), "before")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long")
    front = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    part = F.least(F.greatest(front - F.col("before"), F.lit(0)), F.col("size"))
    return joined.withColumn("epochs", epochs).withColumn("part", part).select(
        "doc_id", "text_hash", "size", "source", "source_size", "target",
        (F.col("epochs") + F.when((F.col("part") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)).alias("copies"),
        F.when(F.col("part") < F.col("size"), F.col("part")).otherwise(F.lit(0)).alias("cut_words"),
        (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), *keep)
