"""Ranks and running sums inside groups that may be too large for one task.

A window sorts each group in a single task.  When one group holds a large share of the table that
task never ends, so rows are cut by sampled quantiles of (group, order) into slices, each slice is
summed by its own task, and the totals of the slices before it are added.  It is the same way at
every size and for any distribution of the values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, tasks_beyond

ROWS = 500_000  # of one slice, where the number of rows is known


def _tasks(df: DataFrame, rows: int | None) -> list[int]:
    """The number of partitions, if ``rows`` need more than adaptive execution leaves."""
    tasks = tasks_beyond(df.sparkSession, rows or 0, ROWS)
    return [tasks] if tasks else []


def store_slices(df: DataFrame, keys: list[str], order_by: list[Column], label: str, rows: int | None = None) -> DataFrame:
    """``df`` in range partitions of (keys, order), stored once, with the partition number as ``slice``.

    The partitions are cut by sampled quantiles, so a large group spans several of them whatever
    its values; only rows equal in keys and order stay together.  Stored, because a second
    evaluation may cut elsewhere.  ``rows``, if known, keeps slices of large tables from growing.
    """
    cut = df.repartitionByRange(*_tasks(df, rows), *[F.col(k).asc_nulls_last() for k in keys], *order_by)
    return materialize(cut.withColumn("slice", F.spark_partition_id()), label)


def running_total(sliced: DataFrame, keys: list[str], order_by: list[Column], value: Column, name: str, rows: int | None = None,
                  whole: str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` (whole numbers) over the rows of the group before this one, and as ``whole`` that of the group if named.

    Each slice is summed by its own task; groups that lie in several slices get the totals of
    those slices added.  At most two groups of a slice lie in others, too, so the broadcast side has
    fewer rows than twice the slices.
    """
    part = [*keys, "slice"]
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*part).agg(F.sum(value).alias("_total"))
        .withColumns({"_offset": F.coalesce(F.sum("_total").over(earlier), F.lit(0)), "_whole": F.sum("_total").over(group), "_slices": F.count(F.lit(1)).over(group)})
        .filter("_slices > 1").select(*[F.col(c).alias(f"_of_{c}") for c in part], "_offset", "_whole")
    )
    near = sliced.repartition(*tasks, *part) if (tasks := _tasks(sliced, rows)) else sliced
    inside = Window.partitionBy(*part)
    summed = near.withColumn(name, F.coalesce(F.sum(value).over(inside.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if whole:
        summed = summed.withColumn(whole, F.sum(value).over(inside))
    same = [summed[c].eqNullSafe(F.col(f"_of_{c}")) for c in part]
    return summed.join(F.broadcast(offsets), same, "left").select(
        *sliced.columns, (F.col(name) + F.coalesce("_offset", F.lit(0))).alias(name), *([F.coalesce("_whole", whole).alias(whole)] if whole else []))


def rank_in_group(df: DataFrame, keys: list[str], order_by: list[Column], rank: str = "rank", size: str | None = None,
                  label: str = "ranked", rows: int | None = None) -> DataFrame:
    """Add the 1-based rank inside the group, and the group's row count as ``size`` if named.

    Keys are not null; with ``size``, rows with a null key are left out.  Counts come with the ranks, so no row is shuffled for them.
    """
    sliced = store_slices(df, keys, order_by, label, rows)
    if size is not None:
        sliced = sliced.dropna(subset=keys)
    ranked = running_total(sliced, keys, order_by, F.lit(1), "_before", rows, size)
    return ranked.select(*df.columns, (F.col("_before") + 1).cast("long").alias(rank), *([F.col(size).cast("long").alias(size)] if size else []))
