"""Array helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_value(items: str) -> Column:
    """An array column as an expression, for exploding it.

    Of a column that is exploded Spark tests the size first and moves that test below the column,
    where all that the column is made of is computed a second time for it.
    """
    return F.transform(F.col(items), lambda item: item)


def zip_short(left: Column, right: Column, pair: Callable[[Column, Column], Column]) -> Column:
    """Combine two arrays by position, cut to the shorter one."""
    length = F.least(F.size(left), F.size(right))
    return F.zip_with(F.slice(left, F.lit(1), length), F.slice(right, F.lit(1), length), pair)


def drop_blank_rows(rows: Column) -> Column:
    """Rows of a text table that have at least one non-empty cell."""
    return F.filter(rows, lambda row: F.exists(row, lambda cell: cell != ""))


def table_width(rows: Column) -> Column:
    """Cells of the widest row."""
    return F.array_max(F.transform(rows, lambda row: F.size(row)))


def pad_rows(rows: Column) -> Column:
    """Pad every row with empty cells to the widest row."""
    return let(table_width(rows), lambda width: F.transform(
        rows, lambda row: F.concat(row, F.array_repeat(F.lit(""), width - F.size(row)))))


def pipe_row(cells: Column) -> Column:
    """``| a | b |``"""
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
