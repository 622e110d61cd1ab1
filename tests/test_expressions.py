"""Cleaning expressions on hand-made edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patio.functions import dates, numbers, text
from patio.functions.keys import charge_id, match_key


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select(expression(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def money(*values):
    return [None if v is None else Decimal(v) for v in values]


def test_mixed_locale_amounts(spark):
    got = apply(
        spark,
        numbers.mixed_locale_amount,
        ["31,905.20", "48.117,63", "254,900,00", "0,00", "1.500", "-12,50", "", "x", None, " 7,25 "],
    )
    assert got == money("31905.20", "48117.63", "254900.00", "0.00", "1500", "-12.50", None, None, None, "7.25")


def test_payment_amount_is_another_rule(spark):
    got = apply(spark, numbers.payment_amount, [" $ 1500.50", "1500,5", "1.234,56", "1e3", "$", "12.345", "999999999.99"])
    assert got == money("1500.50", "1500.50", None, None, None, "12.35", None)


def test_decimal_of_three_digits(spark):
    got = apply(spark, lambda c: numbers.try_decimal(c, "decimal(3,1)"), ["4,2", "100,5", "12,34", "", "x"])
    assert got == money("4.2", None, "12.3", None, None)


def test_integers(spark):
    assert apply(spark, numbers.try_integer, [" 12 ", "3.0", "", "x", "-5", "99999999999"]) == [12, None, None, None, -5, None]
    assert apply(spark, numbers.grouped_integer, ["1.281", "1,281", "1234.5"]) == [1281, 1281, 12345]
    assert apply(spark, numbers.floor_number, ["PB", "pb", " 3 ", "40000", "x", ""]) == [None, None, 3, None, None, None]


def test_accounts(spark):
    got = apply(spark, numbers.account_number, ["Cuenta 0012.345", "-", "1" * 22, " 12 34 ", "cuenta x", None])
    assert got == ["0012345", None, None, "1234", None, None]


def test_dates(spark):
    got = apply(
        spark,
        dates.parse_date,
        ["25/04/2025", "5/4/2025", "2025-04-25 10:00:00", "2025-04-25", "20250425", "25-04-2025", "25.4.2025", "25/04/2025 10:00"],
    )
    d = dt.date
    assert got == [d(2025, 4, 25), d(2025, 4, 5), *[d(2025, 4, 25)] * 6]
    assert apply(spark, dates.parse_date, ["2025-13-45", "2025-04", "20251345", "25/04-2025", "", None]) == [None] * 6


def test_months(spark):
    got = apply(spark, dates.month_number, ["mayo ", " Abril", "DICIEMBRE", "setiembre", "", None])
    assert got == [5, 4, 12, None, None, None]


def test_sunday_counts_for_the_next_week(spark):
    got = apply(spark, lambda c: dates.week_start(c.cast("date")), ["2025-04-06", "2025-04-05", "2025-04-07"])
    assert [str(x) for x in got] == ["2025-04-07", "2025-03-31", "2025-04-07"]


def test_text(spark):
    assert apply(spark, text.blank_to_null, ["  ", " a ", " "]) == [None, "a", " "]
    assert apply(spark, text.digits_only, ["12", "", "1x", None]) == [True, True, False, None]
    assert apply(spark, text.yes_flag, [" Si ", "NO", None]) == [True, False, False]
    assert apply(spark, text.tenure_label, ['"1"', "2", None]) == ["Inquilino", "Propietario", "Propietario"]
    assert apply(spark, match_key, ["Acacias ", "ACACIAS"]) == ["acacias", "acacias"]


def test_share_of_nothing_is_zero(spark):
    row = spark.range(1).select(
        numbers.percent_of(F.lit(5), F.lit(0)).alias("a"), numbers.percent_of(F.lit(1), F.lit(3)).alias("b")
    ).first()
    assert row.a == 0 and row.b == Decimal("33.333333333333")


def test_month_bounds():
    assert dates.month_bounds(2025, 12) == (dt.date(2025, 12, 1), dt.date(2025, 12, 31))
    assert dates.month_bounds(2024, 2) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10**12), min_size=1, max_size=40))
def test_amount_shapes_give_the_same_value(spark, cents):
    shapes = []
    for c in cents:
        plain = f"{c / 100:,.2f}" if c < 10**11 else f"{c // 100:,}.{c % 100:02d}"
        swapped = plain.translate(str.maketrans(",.", ".,"))
        shapes += [plain, swapped, plain.replace(".", ",")]
    got = apply(spark, lambda x: numbers.mixed_locale_amount(x, "decimal(18,2)"), shapes)
    want = [Decimal(c).scaleb(-2) for c in cents for _ in range(3)]
    assert got == want


@pytest.mark.parametrize("unit", [0, 7, 90_000_000_000_000])
def test_charge_ids_are_distinct_and_ordered(spark, unit):
    days = ["1995-01-01", "1995-12-01", "1996-01-01", "2099-12-01"]
    got = apply(spark, lambda c: charge_id(F.lit(unit), c.cast("date")), days)
    assert got == sorted(set(got)) and all(g // 100_000 == unit for g in got)
