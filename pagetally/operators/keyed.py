"""One row per key, and keyed updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_wins(df: DataFrame, key: str, ord: str = "ord") -> DataFrame:
    """First row of each key in list order. Partial aggregation absorbs repeated keys."""
    row = F.struct(*[F.col(name) for name in df.columns if name != key])
    return df.groupBy(key).agg(F.min_by(row, ord).alias("_row")).select(key, "_row.*").select(
        *df.columns)


def last_wins(df: DataFrame, key: str, ord: str = "ord") -> DataFrame:
    """Last row of each key, at the list position of the first."""
    kept = [name for name in df.columns if name not in (key, ord)]
    row = F.struct(*[F.col(name) for name in kept])
    return df.groupBy(key).agg(
        F.min(ord).alias(ord), F.max_by(row, ord).alias("_row")
    ).select(key, ord, *[F.col("_row")[name].alias(name) for name in kept]).select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, key: str = "slug") -> DataFrame:
    """Old rows whose key has no new row, plus the new rows; keys are unique on each side."""
    kept = old.join(new.select(key), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)
