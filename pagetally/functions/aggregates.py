"""Aggregate expressions. Sums treat null as zero and are never null themselves."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pagetally.functions.predicates import truthy_number


def sum0(value: Column) -> Column:
    """Sum with null as zero; an empty input gives zero."""
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def product0(left: Column, right: Column) -> Column:
    """Product with a null factor as zero."""
    zero = F.lit(0)
    return F.coalesce(left, zero) * F.coalesce(right, zero)


def sum_product(left: Column, right: Column) -> Column:
    """Sum of products, a null factor counting as zero."""
    return sum0(product0(left, right))


def weighable(value: Column, weight: Column) -> Column:
    """Rows that enter a weighted mean: a value, and a weight that is neither null nor zero."""
    return value.isNotNull() & truthy_number(weight)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of ``value`` weighted by ``weight``; zero when nothing has weight."""
    counted = weighable(value, weight)
    total = F.sum(F.when(counted, value * weight))
    return F.coalesce(F.try_divide(total, F.sum(F.when(counted, weight))), F.lit(0.0))
