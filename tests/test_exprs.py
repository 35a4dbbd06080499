from pyspark.sql import functions as F

from mercato.functions.exprs import (
    cents, dedupe, half_up, half_up_signed, mean_exact, money_sum, month_key, ratio,
)
from tests.conftest import rows


def test_half_up_ties_and_types(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (1.5,), (-0.125,), (None,)], "x double")
    got = rows(df.select(half_up("x", 2), half_up("x", 0), half_up_signed("x", 2)))
    assert got == [(0.13, 0.0, 0.13), (2.5, 3.0, 2.5), (1.5, 2.0, 1.5), (-0.12, 0.0, -0.13),
                   (None, None, None)]
    assert df.select(half_up("x", 0)).schema[0].dataType.typeName() == "double"


def test_exact_money_sum_is_order_independent(spark):
    vals = [0.1] * 10 + [0.2] * 10 + [1e6 + 0.01, -0.03]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    exact = round(sum(round(v * 100) for v in vals) / 100.0, 2)
    for n in (1, 3, 7):
        got = rows(df.repartition(n).agg(money_sum("x"), mean_exact("x")))[0]
        assert got[0] == exact and got[1] == exact / len(vals)
    assert rows(df.limit(0).agg(money_sum("x")))[0][0] is None
    assert rows(spark.createDataFrame([(19.99,)], "x double").select(cents("x")))[0][0] == 1999


def test_ratio_and_month(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a long, b long")
    assert rows(df.select(ratio("a", "b"))) == [(None,), (0.25,)]
    ts = spark.sql("SELECT timestamp_ntz'2024-03-31 23:59:59' AS t")
    assert rows(ts.select(month_key("t"))) == [("2024-03",)]


def test_dedupe_handles_a_key_with_many_copies(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), (F.col("id") % 97).alias("v"))
    got = sorted(rows(dedupe(df, ["k"])))
    assert got == [(0, 0), (1, 0)]
