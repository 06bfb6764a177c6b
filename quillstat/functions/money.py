"""Token amounts: labels, exact scaling and USD value.

Raw amounts are integers as text, in units of 10^-6 or 10^-18 of a token. Each
row is rounded to cents BEFORE it is summed, half away from zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.fixed_values import CURRENCIES, Currency
from quillstat.schemas import MONEY, USD

RAW_TYPE = "decimal(38,0)"
# Raw amounts from here on are set aside. A decimal holds 38 digits; a USD value keeps six
# decimals and a cent amount two, so ten amounts just below this can still be summed and
# valued one to one, which is what unlisted currencies are.
LIMIT = Decimal(10) ** 31


def currency_label(address: Column, currencies: Sequence[Currency] = CURRENCIES) -> Column:
    """Label of a listed address; any other address is its own label.

    The comparison is exact, so a listed address in another case is unlisted.
    """
    label = address
    for c in currencies:
        label = F.when(address == c.address, c.label).otherwise(label)
    return label


def raw_amount(amount: Column) -> Column:
    """Text to integer; text that is no number below 10^38 stops the job."""
    return _strict(amount.try_cast(RAW_TYPE), amount, RAW_TYPE)


def _strict(value: Column, source: Column, kind: str) -> Column:
    """``value``, or an error where it is NULL although ``source`` is not.

    The functions that give NULL on overflow plus ``raise_error`` keep this strict in
    sessions without ANSI mode too, where plain ones would quietly give NULL.
    """
    told = F.concat(F.lit("amount out of range: "), source.cast("string"))
    bad = F.raise_error(told).cast(kind)
    return F.coalesce(value, F.when(source.isNotNull(), bad))


def exact_sum(amount: Column) -> Column:
    """Sum of amounts; an overflow stops the job instead of giving NULL.

    A count tells that there was something to sum: it takes less of a shuffle than an amount.
    """
    summed = F.nullif(F.count(amount), F.lit(0))
    return _strict(F.try_sum(amount), F.concat(F.lit("sum of "), summed.cast("string")), MONEY)


def token_amount(
    address: Column, amount: Column, currencies: Sequence[Currency] = CURRENCIES
) -> Column:
    """Raw amount in tokens, rounded to cents; unlisted currencies stay raw.

    Rounds first and shifts the point after: Spark's product or quotient keeps only
    six decimals, so the other way would round twice (4999999600000000 of 10^18
    would give 0.01).
    """
    raw = raw_amount(amount)
    scaled = _strict(raw.try_cast(MONEY), raw, MONEY)
    for decimals in sorted({c.decimals for c in currencies}):
        listed = [c.address for c in currencies if c.decimals == decimals]
        tokens = F.round(raw, 2 - decimals) * F.lit(Decimal(1).scaleb(-decimals))
        scaled = F.when(address.isin(listed), tokens.cast(MONEY)).otherwise(scaled)
    return scaled


def usd(amount: Column, rate: Column) -> Column:
    """Value in USD, below 10^32; a currency without a rate counts one to one."""
    known = F.coalesce(rate, F.lit(1).cast("decimal(18,6)"))
    return _strict(F.try_multiply(amount, known), amount, USD)


def split_amounts(modules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantined rows) of a table with an ``amount`` text column.

    Amounts are 256-bit on chain while decimals hold 38 digits. Use the first
    table where one bad row must not stop the job, and keep the second for
    inspection, as the refresh does.
    """
    value = F.col("amount").try_cast(RAW_TYPE)
    usable = F.col("amount").isNull() | F.coalesce(F.abs(value) < F.lit(LIMIT), F.lit(False))
    return modules.filter(usable), modules.filter(~usable)
