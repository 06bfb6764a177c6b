from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillstat.fixed_values import CURRENCIES
from quillstat.functions.money import currency_label, split_amounts, token_amount
from quillstat.plans.stage import exchange_rates, revenue_v2

ADDRESS = {c.label: c.address for c in CURRENCIES}
WETH, USDC = ADDRESS["WETH"], ADDRESS["USDC"]


def scaled(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "currency string, amount string")
    out = df.select(token_amount(F.col("currency"), F.col("amount")).alias("v"))
    assert out.schema["v"].dataType.simpleString() == "decimal(38,2)"
    return [r.v for r in out.collect()]


@pytest.mark.parametrize(
    ("currency", "amount", "value"),
    [
        (WETH, "4999999600000000", "0.00"),  # dividing before rounding would give 0.01
        (WETH, "5000000000000000", "0.01"),
        (WETH, "1235000000000000000", "1.24"),
        (WETH, "125000000000000000", "0.13"),
        (USDC, "5000", "0.01"),
        (USDC, "4999", "0.00"),
        ("0xother", "7", "7.00"),
        ("0xother", "1" + "0" * 28, "1" + "0" * 28 + ".00"),
        ("0xother", "1" + "0" * 31, "1" + "0" * 31 + ".00"),
        ("0xother", "9" * 36, "9" * 36 + ".00"),
        (USDC.lower(), "5000", "5000.00"),  # another case is another currency
    ],
)
def test_scaling(spark, currency, amount, value):
    assert scaled(spark, (currency, amount)) == [Decimal(value)]


def test_listed_and_unlisted_amounts_share_a_column(spark):
    both = scaled(spark, (WETH, "1250000000000000000"), ("0xother", "7"))
    assert both == [Decimal("1.25"), Decimal("7.00")]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(0, 10**30), min_size=1, max_size=40))
def test_scaling_equals_integer_rounding(spark, amounts):
    want = [Decimal((a + 5 * 10**15) // 10**16) / 100 for a in amounts]
    assert scaled(spark, *[(WETH, str(a)) for a in amounts]) == want


@pytest.mark.parametrize("amount", ["1" + "0" * 77, "abc"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_amounts_stop_the_job(spark, amount, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="amount out of range"):
            scaled(spark, (WETH, amount))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_quarantine_keeps_every_row(spark, raw):
    modules = raw(
        "action_module",
        {"publication_id": "a", "currency": WETH, "amount": "9" * 78},
        {"publication_id": "b", "currency": WETH, "amount": "abc"},
        {"publication_id": "c", "currency": WETH, "amount": None},
        {"publication_id": "d", "currency": WETH, "amount": "1"},
    )
    good, bad = split_amounts(modules)
    assert rows(good, "publication_id") == [("c",), ("d",)]
    assert rows(bad, "publication_id") == [("a",), ("b",)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("digits", "usable", "valued"),
    [(28, True, True), (30, True, True), (31, False, True), (32, False, False), (36, False, False),
     (38, False, False)],
)
def test_range_of_amounts(spark, raw, ansi, digits, usable, valued):
    """Up to the limit values are exact; beyond it the rows are set aside, and never NULL."""
    modules = raw(
        "action_module", {"publication_id": "p", "currency": "0xother", "amount": "1" + "0" * digits}
    )
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good, bad = split_amounts(modules)
        assert (good.count(), bad.count()) == ((1, 0) if usable else (0, 1))
        if valued:
            (row,) = revenue_v2(modules).collect()
            assert row.amount == row.amount_USD == Decimal(10) ** digits
        else:
            with pytest.raises(PySparkException, match="amount out of range|out of range|overflow"):
                revenue_v2(modules).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_sum_out_of_range_stops_the_job(spark, raw, ansi):
    row = {"publication_id": "p", "currency": "0xother", "amount": "9" * 36}
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="out of range|overflow"):
            revenue_v2(raw("action_module", row, row, row)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_labels(spark):
    df = spark.createDataFrame([(WETH,), (WETH.lower(),), (None,)], "a string")
    assert [r[0] for r in df.select(currency_label(F.col("a"))).collect()] == [
        "WETH",
        WETH.lower(),
        None,
    ]


def test_rates(spark):
    assert rows(exchange_rates(spark), "currency", "value", "factor") == sorted(
        [
            ("WMATIC", Decimal("0.800000"), 10**18),
            ("WETH", Decimal("1939.000000"), 10**18),
            ("NCT", Decimal("1.140000"), 10**18),
            ("DAI", Decimal("1.000000"), 10**18),
            ("USDC", Decimal("1.000000"), 10**6),
        ],
        key=repr,
    )


def test_revenue_rounds_rows_before_summing(spark, raw):
    module = {"publication_id": "p", "currency": ADDRESS["NCT"]}
    revenue = revenue_v2(
        raw(
            "action_module",
            {**module, "amount": "1245000000000000000"},
            {**module, "amount": "5000000000000000"},
            {"publication_id": "p", "currency": "0xother", "amount": "7"},
            {"publication_id": "q", "currency": WETH, "amount": None},
        )
    )
    assert rows(revenue) == sorted(
        [
            ("p", "NCT", Decimal("1.26"), Decimal("1.436400")),
            ("p", "0xother", Decimal("7.00"), Decimal("7.000000")),
            ("q", "WETH", None, None),
        ],
        key=repr,
    )
