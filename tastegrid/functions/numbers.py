"""Rating scale, fixed-point ratings, id casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C

_WHOLE_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def clip_at_zero(c: Column) -> Column:
    """``max(0, x)`` that leaves null alone (``greatest`` would skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), c))


def round_half_even(c: Column, decimals: int) -> Column:
    """Round on the binary value, ties to even, which ``round`` does not do."""
    unit = float(10**decimals)
    return F.rint(c * unit) / unit


def log_scale(weight: Column, lowest: Column, highest: Column,
              scale_min: float = C.RATING_MIN, scale_max: float = C.RATING_MAX) -> Column:
    """Min-max of ``log1p(weight)`` on ``[scale_min, scale_max]``; constant input gives the middle.

    ``lowest`` and ``highest`` are the extreme raw weights: ``log1p`` and the clip keep order, so
    they need not be computed per row.
    """
    lo, hi = F.log1p(clip_at_zero(lowest)), F.log1p(clip_at_zero(highest))
    share = (F.log1p(clip_at_zero(weight)) - lo) / (hi - lo)
    scaled = round_half_even(share * (scale_max - scale_min) + scale_min, C.RATING_DECIMALS)
    return F.when(weight.isNotNull(), F.when(hi == lo, F.lit((scale_min + scale_max) / 2)).otherwise(scaled))


def points(rating: Column) -> Column:
    """A rating as a whole number of 1/10000.

    Sums of points are exact, so means do not depend on how rows were partitioned.
    """
    return F.rint(rating * float(C.POINTS_PER_UNIT)).cast("long")


def mean_of_points(total: Column, n: Column) -> Column:
    """Mean rating from a sum of points; null when there are no rows."""
    return F.try_divide(total.cast("double"), n.cast("double")) / float(C.POINTS_PER_UNIT)


def no_nan(c: Column) -> Column:
    """NaN as null: Spark averages let NaN through, the tables here must not hold it."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def coerce_id(c: Column) -> Column:
    """Text to long: bad text is null, ``12.0`` is 12, ``1.5`` is an error."""
    # The patterns come first: a cast that fails costs an exception per row.
    digits = F.when(F.regexp_like(c, F.lit(_WHOLE_TEXT)), c.try_cast("long"))
    wide = F.when(F.regexp_like(c, F.lit(_NUMERIC_TEXT)), c.try_cast("double"))
    fraction = F.raise_error(F.concat(F.lit("id is not a whole number: "), c)).cast("long")
    return F.coalesce(digits, F.when(wide == F.floor(wide), wide.cast("long")).when(wide.isNotNull(), fraction))


def id_of(df: DataFrame, name: str) -> Column:
    """The id column as long: text is coerced, whole-number columns only widened."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("long").alias(name)
    return coerce_id(F.col(name).cast("string")).alias(name)


def strict_id(c: Column) -> Column:
    """Cast to long where null or bad text is an error."""
    return F.coalesce(c.try_cast("long"), F.raise_error(F.lit("id is missing or not a number")).cast("long"))
