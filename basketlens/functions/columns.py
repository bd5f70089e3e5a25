"""Column expressions shared by the operators. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.fixed_values import ADJUSTMENT_DESCRIPTIONS, NON_PRODUCT_CODES, TINY, WEEKDAYS


def trimmed(text: Column) -> Column:
    """Text without outer white space; a blank cell is a missing one."""
    return F.nullif(F.btrim(text, F.lit(" \t\n\x0b\f\r")), F.lit(""))


def is_cancellation(invoice: Column) -> Column:
    """The invoice number holds a C anywhere. A missing number is not a cancellation."""
    return F.coalesce(invoice.contains("C"), F.lit(False))


def is_non_product(stock_code: Column) -> Column:
    """One of the non-product codes occurs anywhere in the stock code."""
    return F.coalesce(stock_code.rlike("|".join(NON_PRODUCT_CODES)), F.lit(False))


def is_adjustment(description: Column) -> Column:
    """The description is one of the adjustment texts. A missing one is not."""
    return F.coalesce(description.isin(ADJUSTMENT_DESCRIPTIONS), F.lit(False))


def is_rated(value: Column) -> Column:
    """Presence mask as a number: 1 for a value, 0 for none. A value of 0 stands for a missing one."""
    return F.when(value.isNotNull() & (value != 0), 1.0).otherwise(0.0)


def plain_number(text: Column) -> Column:
    """A text as double where it is a plain decimal number, with or without an exponent; else missing.

    The cast alone would also take a trailing D or F.
    """
    return F.when(text.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), text.try_cast("double"))


def nonzero(value: Column) -> Column:
    return F.when(value == 0, F.lit(TINY)).otherwise(value)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def stable(value: Column) -> Column:
    """Ten decimals. A sum of doubles depends on the order of its terms in the last bits;
    cutting those off lets equal similarities tie, as they must for a top-k with ties."""
    return F.rint(value * F.lit(1e10)) / F.lit(1e10)


def pasted(*parts: Column) -> Column:
    """Values joined by a blank, a missing one written as NA."""
    texts = [F.coalesce(p.cast("string"), F.lit("NA")) for p in parts]
    return F.concat_ws(" ", *texts)


def hashed_number(seed: int, *keys: Column) -> Column:
    """Repeatable pseudo-random number below 2^32 for a key."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def weekday_number(date: Column) -> Column:
    """Monday is 1."""
    return F.weekday(date) + 1


def weekday_name(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), number)


def hour_of(time_text: Column) -> Column:
    """Hour of an HH:MM:SS text."""
    return F.split(time_text, ":")[0].cast("int")


def mean_or_null(value: Column) -> Column:
    """Mean that is missing as soon as one value is."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.avg(value))
