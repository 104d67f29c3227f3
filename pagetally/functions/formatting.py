"""Numbers to report text.

``format_string`` rounds the shortest decimal form of a double half up; the reports round
the exact binary value half to even, as ``format_number`` with a pattern does.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fixed_point(value: Column, digits: int) -> Column:
    """``value`` with ``digits`` decimals, correctly rounded, no thousands separators."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", value, F.lit(pattern))


def fmt_money(value: Column) -> Column:
    """``$62,350`` or ``?``."""
    return F.when(value.isNull(), "?").otherwise(F.format_string("$%,d", value))


def fmt_magnitude(count: Column) -> Column:
    """``1.1M``, ``4K``, plain digits, or ``?``."""
    return (
        F.when(count.isNull(), "?")
        .when(count >= 1_000_000, F.concat(fixed_point(count / F.lit(1e6), 1), F.lit("M")))
        .when(count >= 1_000, F.concat(fixed_point(count / F.lit(1e3), 0), F.lit("K")))
        .otherwise(count.cast("string"))
    )


def fmt_signed(percent: Column) -> Column:
    """``+7%``, ``-3%``, ``+0%`` or ``?``."""
    return F.when(percent.isNull(), "?").otherwise(F.format_string("%+d%%", percent))
