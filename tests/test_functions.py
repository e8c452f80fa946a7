import math

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import dates as D
from ledgerline.functions import numbers as N
from ledgerline.functions import tails as T
from ledgerline.functions import text as X


def column(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr("v")).collect()]


def test_date_cascade(spark):
    got = column(spark, ["2025-01-05", "1/5/2025", "01/05/2025", "05-JAN-2025", "5-jan-2025", "02/30/2025", "", None, "2025/01/05"], D.parse_date)
    assert [None if d is None else d.isoformat() for d in got] == ["2025-01-05"] * 5 + [None] * 4


def test_safe_int(spark):
    assert column(spark, ["30", " 30 ", "30.6", "3e1", "-1", "abc", "", None, "1e300"], N.safe_int) == [30, 30, 31, 30, -1, None, None, None, None]


def test_month_difference_counts_boundaries(spark):
    row = spark.sql("select date'2025-01-31' a, date'2025-02-01' b").select(D.months_between_starts("b", "a")).first()
    assert row[0] == 1


def test_text_helpers(spark):
    assert column(spark, ["New York ", "ny", "zz"], lambda c: X.map_category(c, {"NEW YORK": "NY"})) == ["NY", "NY", "ZZ"]
    assert column(spark, ["male", " F", "", None, "x"], lambda c: X.first_letter_code(c, ("M", "F"), "U")) == ["M", "F", "U", "U", "U"]
    assert column(spark, ["a  b\n\nc", "x" * 200], X.preview) == ["a b c", "x" * 110]
    assert column(spark, [None, " ", "a"], X.is_missing) == [True, True, False]


def test_bins_are_right_closed(spark):
    assert column(spark, [-1.0, 0.0, 2.0, 2.1, None], lambda c: N.right_closed_bin(c, [0, 2], ["a", "b", "c"]), "double") == ["a", "a", "b", "c", None]


def test_ratio_of_zero_is_null(spark):
    assert spark.range(1).select(N.ratio(F.lit(1), F.lit(0))).first()[0] is None


@pytest.mark.parametrize("z", [-8.0, -2.5, 0.0, 0.3, 1.96, 4.68, 9.0])
def test_normal_tail_relative_error(spark, z):
    got = spark.range(1).select(T.normal_sf(F.lit(z))).first()[0]
    assert got == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=3e-7)


def test_chi_square_tail(spark):
    # Textbook 5% points.
    for df, point in [(1, 3.841459), (2, 5.991465), (7, 14.06714), (14, 23.68479), (30, 43.77297)]:
        assert spark.range(1).select(T.chi2_sf(F.lit(point), df)).first()[0] == pytest.approx(0.05, abs=1e-6)


def test_t_tail():
    assert T.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert T.t_two_sided(0.0, 5.5) == 1.0
    assert T.t_two_sided(1.959964, 1e7) == pytest.approx(0.05, abs=1e-5)
    assert math.isnan(T.t_two_sided(float("nan"), 3))


def test_normal_quantile(spark):
    import statistics

    from ledgerline.functions.tails import normal_quantile

    shares = [1e-12, 1e-5, 0.01, 0.02424, 0.02426, 0.3, 0.5, 0.7, 0.97574, 0.97576, 0.999, 1 - 1e-9, 0.0, 1.0]
    got = [r.z for r in spark.createDataFrame([(p,) for p in shares], "p double").select(normal_quantile(F.col("p")).alias("z")).collect()]
    assert got[-2:] == [None, None]
    for p, z in zip(shares[:-2], got):
        assert abs(z - statistics.NormalDist().inv_cdf(p)) < 2e-8 * max(1, abs(z))
