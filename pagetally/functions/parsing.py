"""Typed values out of free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pagetally import fixed
from pagetally.functions.formatting import fixed_point
from pagetally.functions.text import strip


def parse_pay(text: Column) -> Column:
    """Struct of annual and hourly pay text; ``""`` where the text names none.

    Amounts are taken by position, so a text with both phrases but one amount gives that
    amount as annual pay.
    """
    amounts = F.regexp_extract_all(text, F.lit(fixed.AMOUNT), 1)

    def amount(index: int) -> Column:
        plain = F.replace(F.get(amounts, F.lit(index)), F.lit(","), F.lit(""))
        return F.coalesce(plain, F.lit(""))

    first, second = amount(0), amount(1)
    yearly, hourly = text.contains("per year"), text.contains("per hour")
    return F.struct(
        F.when(yearly, first).otherwise("").alias("annual"),
        F.when(yearly & hourly, second).when(~yearly & hourly, first).otherwise("").alias("hourly"),
    )


def parse_outlook(text: Column) -> Column:
    """Struct of percentage text and description."""
    with_note = text.rlike(fixed.PERCENT_WITH_NOTE)
    plain = text.rlike(fixed.PERCENT)
    return F.struct(
        F.when(plain, F.regexp_extract(text, fixed.PERCENT, 1)).otherwise("").alias("pct"),
        F.when(with_note, F.regexp_extract(text, fixed.PERCENT_WITH_NOTE, 2))
        .when(plain, "")
        .otherwise(text)
        .alias("desc"),
    )


def parse_number(text: Column) -> Column:
    """Digits without thousands commas, or the trimmed text when it is no whole number."""
    digits = strip(F.replace(text, F.lit(","), F.lit("")))
    return F.when(digits.rlike(fixed.WHOLE_NUMBER), digits).otherwise(strip(text))


def impute_pay(annual: Column, hourly: Column) -> Column:
    """Fill the missing one of annual and hourly pay text at full-time hours."""
    hours = F.lit(float(fixed.HOURS_PER_YEAR))
    from_annual = fixed_point(annual.try_cast("double") / hours, 2)
    from_hourly = F.rint(hourly.try_cast("double") * hours).cast("bigint").cast("string")
    return F.struct(
        F.when((annual == "") & (hourly != ""), from_hourly).otherwise(annual).alias("annual"),
        F.when((hourly == "") & (annual != ""), from_annual).otherwise(hourly).alias("hourly"),
    )


def to_int(text: Column, strict: bool = False) -> Column:
    """Whole number from text, null for empty text.

    Text that is no whole number raises when ``strict`` and is null otherwise.
    """
    filled = F.nullif(strip(text), F.lit(""))
    return filled.cast("bigint") if strict else filled.try_cast("bigint")


def integral(text: Column) -> Column:
    """Whole number from numeric text that may carry a zero fraction (``7.0``)."""
    number = strip(text).try_cast("double")
    whole = strip(text).try_cast("bigint")
    return F.coalesce(whole, F.when(number == F.rint(number), number.try_cast("bigint")))
