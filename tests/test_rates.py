"""Rounding of ratios against exact fractions."""

from fractions import Fraction
from math import floor

from pyspark.sql import functions as F

from stagelight.functions.rates import rate, rounded_ratio


def exact(part, whole, digits):
    if not whole:
        return None
    units = floor(abs(Fraction(part, whole)) * 10**digits + Fraction(1, 2))
    return float(Fraction((units if part >= 0 else -units), 10**digits))


def test_every_ratio_up_to_2000_is_rounded_half_up(spark):
    """All ties and all others: two million quotients, compared as thousandths in exact integers."""
    pairs = spark.range(1, 2001).select(F.col("id").alias("b")).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("b"))))
    found = pairs.select("a", "b", rate(F.col("a"), F.col("b")).alias("r"))
    thousandths = F.floor((F.col("a") * 2000 + F.col("b")).cast("decimal(20,0)") / (F.col("b") * 2))
    wrong = found.where(F.col("r") != thousandths.cast("double") / 1000)
    assert found.count() == sum(b + 1 for b in range(1, 2001)) and wrong.count() == 0
    ties = found.where((F.col("a") * 2000 + F.col("b")) % (F.col("b") * 2) == 0).collect()
    assert len(ties) > 1000
    assert all(row.r == exact(row.a, row.b, 3) for row in ties)


def test_special_ratios(spark):
    cases = [(0, 0), (5, 0), (None, 3), (3, None), (7, 2), (-1, 8), (-5, 1000), (10**15 - 1, 3), (1, 3 * 10**14), (0, 9)]
    rows = spark.createDataFrame(cases, "a long, b long")
    found = rows.select("a", "b", rounded_ratio(F.col("a"), F.col("b"), 2).alias("r")).collect()
    assert [r.r for r in found] == [None if None in (a, b) else exact(a, b, 2) for a, b in cases]
    assert rows.where("a = 7").select(rate(F.col("a").cast("int"), F.col("b").cast("int"))).first()[0] == 3.5
