import math

import pytest
from pyspark.sql import functions as F

from tastegrid.functions import numbers


def test_coerce_id(values):
    items = ["12.0", "x", "7", None, "", "1e3", "9007199254740993", "nan", "inf", "1d", "-3"]
    assert values(numbers.coerce_id, items) == [12, None, 7, None, None, 1000, 9007199254740993, None, None, None, -3]


def test_coerce_id_rejects_fractions(values):
    with pytest.raises(Exception, match="not a whole number"):
        values(numbers.coerce_id, ["1.5"])


@pytest.mark.parametrize("bad", [None, "x"])
def test_strict_id(values, bad):
    assert values(numbers.strict_id, ["5"]) == [5]
    with pytest.raises(Exception, match="missing or not a number"):
        values(numbers.strict_id, [bad])


def test_round_half_even(values):
    assert values(lambda c: numbers.round_half_even(c, 4), [2.00005, 1.23456], "double") == [2.0, 1.2346]


def test_clip_keeps_null(values):
    assert values(numbers.clip_at_zero, [-5.0, 2.0, None], "double") == [0.0, 2.0, None]


def test_log_scale(spark):
    df = spark.createDataFrame([(w,) for w in (-5.0, 0.0, 9.0, 99.0)], "w double")
    scaled = df.select(numbers.log_scale(F.col("w"), F.lit(-5.0), F.lit(99.0)))
    expect = [round(1 + 4 * math.log1p(max(w, 0)) / math.log1p(99), 4) for w in (-5, 0, 9, 99)]
    assert [r[0] for r in scaled.collect()] == expect


def test_no_nan(values):
    assert values(numbers.no_nan, [float("nan"), 1.0, None], "double") == [None, 1.0, None]
