"""Check-digit arithmetic on digit strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digit_sum(digits: Column, doubled_parity: Column) -> Column:
    """Sum of the digits, those at positions of the given parity (from 1) doubled and cross-summed."""
    spots = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return F.when(F.pmod(i, F.lit(2)) == doubled_parity, F.floor(d * 2 / 10) + F.pmod(d * 2, F.lit(10))).otherwise(
            d.cast("long")
        )

    return F.aggregate(F.transform(spots, value), F.lit(0).cast("long"), lambda a, x: a + x)


def luhn_valid(c: Column | str) -> Column:
    """Whether a text of digits passes the mod-10 check; False for other text, NULL for NULL."""
    text = F.col(c) if isinstance(c, str) else c
    is_digits = text.rlike("^[0-9]+$")
    digits = F.when(is_digits, text).otherwise("0")
    total = _digit_sum(digits, F.pmod(F.length(digits) + 1, F.lit(2)))
    return F.when(text.isNotNull(), is_digits & (F.pmod(total, F.lit(10)) == 0))


def check_digit(c: Column | str) -> Column:
    """The digit that makes ``c`` followed by it pass the mod-10 check."""
    text = F.col(c) if isinstance(c, str) else c
    total = _digit_sum(text, F.pmod(F.length(text), F.lit(2)))
    return F.pmod(-total, F.lit(10)).cast("int")


def with_check_digit(c: Column | str) -> Column:
    """``c`` followed by its check digit."""
    text = F.col(c) if isinstance(c, str) else c
    return F.concat(text, check_digit(text).cast("string"))
