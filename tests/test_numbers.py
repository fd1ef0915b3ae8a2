import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from peerline.functions.numbers import round_divide, scrub_placeholder, to_decimal, to_double, to_whole

CELLS = {
    "1,234": None, "-": None, "": None, "x": None, "12d": None, "12f": None, "0x1A": None, "1_000": None,
    "1 2": None, "- 1": None, "1e": None, "True": None, "nan": None,
    " 12 ": 12, "1e3": 1000, "12.0": 12, "+5": 5, "5.": 5, "\t7\n": 7, "1E+3": 1000, "-8": -8,
    "9007199254740993": 9007199254740993,
}


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_scrub_is_literal_and_anywhere(spark):
    got = texts(spark, ["..", "1..2", "12", None, "a.b"]).select(scrub_placeholder(F.col("t"))).collect()
    assert [r[0] for r in got] == ["", "12", "12", None, "a.b"]


def test_whole_numbers_from_text(spark):
    got = texts(spark, CELLS).select("t", to_whole(F.col("t"), "c")).collect()
    assert {r[0]: r[1] for r in got} == CELLS


@pytest.mark.parametrize("bad", ["12.5", ".5", "1e-1", "99999999999999999999"])
def test_not_whole_is_an_error_naming_the_column(spark, bad):
    with pytest.raises(Exception, match="households: not a whole number"):
        texts(spark, ["1", bad]).select(to_whole(F.col("t"), "households")).collect()


def test_decimals_from_text(spark):
    cells = {"12.5": Decimal("12.500"), ".5": Decimal("0.500"), "1e-1": Decimal("0.100"), "109.1235": Decimal("109.124"), "..": None}
    got = texts(spark, cells).select("t", to_decimal(F.col("t")), to_double(F.col("t"))).collect()
    assert {r[0]: r[1] for r in got} == cells
    assert {r[0]: r[2] for r in got}["12.5"] == 12.5


@pytest.mark.parametrize(
    "a,b,digits,want",
    [
        (5, 2, 0, 3), (-5, 2, 0, -3), (5, -2, 0, -3), (-5, -2, 0, 3), (7, 3, 0, 2), (57, 200, 2, 29), (1, 3, 2, 33),
        (-57, 200, 2, -29), (0, 7, 2, 0), (1, 0, 2, None), (0, 0, 0, None), (None, 2, 0, None), (1, None, 0, None),
        (499_999_999_999_999, 999_999_999_999_998, 0, 1), (499_999_999_999_999, 10**15, 0, 0),
        (285 * 10**12 - 1, 10**15, 2, 28), (285 * 10**12, 10**15, 2, 29),
        # too large for whole-number arithmetic
        (9_000_000_000_000_000_001, 2, 0, 4_500_000_000_000_000_001), (-(9 * 10**18) - 1, 2, 0, -4_500_000_000_000_000_001),
        (9 * 10**18, 7 * 10**15, 2, 128_571), (9 * 10**18 + 1, 2 * 10**15, 2, 450_000),
    ],
)
def test_rounded_division(spark, a, b, digits, want):
    df = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    assert df.select(round_divide("a", "b", digits)).first()[0] == want


def test_strict_division_by_zero(spark):
    df = spark.createDataFrame([(1, 0)], "a bigint, b bigint")
    with pytest.raises(Exception, match="division by zero"):
        df.select(round_divide("a", "b", strict=True)).collect()


def test_rounded_division_against_exact_fractions(spark):
    rnd = random.Random(11)
    pairs = []
    for _ in range(4000):
        b = rnd.choice([1, -1]) * rnd.randint(1, 10 ** rnd.randint(1, 15))
        a = rnd.randint(-(10 ** rnd.randint(1, 16)), 10 ** rnd.randint(1, 16))
        if rnd.random() < 0.5:  # on and next to a tie at two digits
            b = 200 * rnd.randint(1, 10**13)
            a = b // 200 * rnd.randint(-500, 500) + rnd.choice([-1, 0, 0, 1])
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = df.select("a", "b", *(round_divide("a", "b", d).alias(f"d{d}") for d in (0, 2))).collect()
    for r in got:
        for digits in (0, 2):
            exact = Fraction(abs(r.a), abs(r.b)) * 10**digits
            size = (2 * exact.numerator + exact.denominator) // (2 * exact.denominator)
            sign = -1 if (r.a < 0) != (r.b < 0) else 1
            assert r[f"d{digits}"] == sign * size, r
