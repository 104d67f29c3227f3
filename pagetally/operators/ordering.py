"""Order is data: every order ends in the list position ``ord``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pagetally.session import durable, written

BROADCAST_ROWS = 100_000    # a few MB; a longer offset table is joined by shuffle
PART_ROWS, MOST_PARTS = 100_000, 4096    # rows of a placed partition, about, and partitions
SAMPLED = 32                # keys looked at for each split point, about


def record_order() -> list[Column]:
    """Rating down, weight down (null as zero), then list position."""
    zero = F.lit(0)
    return [F.coalesce("exposure", zero).desc(), F.coalesce("jobs", zero).desc(), F.col("ord").asc()]


def decline_order() -> list[Column]:
    """Outlook up; ties keep record order."""
    return [F.col("outlook").asc(), *record_order()]


def growth_order() -> list[Column]:
    """Outlook down; ties keep record order."""
    return [F.col("outlook").desc(), *record_order()]


def title_order() -> list[Column]:
    """Lower-cased title in code point order; ties keep list position."""
    return [F.lower("title").asc(), F.col("ord").asc()]


def number_rows(df: DataFrame, order: list[Column], within: str | None = None,
                name: str = "n") -> DataFrame:
    """1-based row number in ``order``, restarting per ``within`` value (never null there).

    A window over ``within`` would bring a whole group into one task. Here rows are range
    partitioned and numbered inside their partition; each partition then adds the number of
    rows that earlier partitions hold of the same group. The placed rows are written as a
    table, because the numbers depend on where rows landed: select what is needed first.
    """
    group = [F.col(within)] if within else []
    keys = [*group, *order]
    placed = written(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33)), "placed"
    )
    return _shifted(placed, [within] if within else [], df.columns, name)


def _shifted(placed: DataFrame, group: list[str], columns: list[str], name: str) -> DataFrame:
    """Row numbers of ``placed`` rows: their place plus the rows that earlier partitions hold."""
    # one row per partition and group: at most partitions + groups rows
    runs = durable(placed.groupBy(*group, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = runs.select(
        *group, "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) + 1 - F.col("_first")).alias("_shift"))
    if runs.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, [*group, "_part"]).select(
        *columns, (F.col("_at") + F.col("_shift")).alias(name))


def falling(df: DataFrame, column: str) -> Column:
    """A number whose ascending order is the descending order of ``column``, null as zero."""
    kind = df.schema[column].dataType
    value = F.coalesce(F.col(column), F.lit(0).cast(kind))
    return F.bitwise_not(value) if isinstance(kind, T.IntegralType) else -value


@dataclass(frozen=True)
class Ranking:
    """A list of the rows that ``member`` holds for, in ascending order of ``keys``.

    Numbers restart per value of ``group``, a whole number never null, whose rows the order keeps
    together. ``columns`` are what the list needs of a row.
    """

    member: Column
    keys: list[Column]
    columns: list[str]
    group: Column | None = None


def number_lists(df: DataFrame, rankings: list[Ranking], name: str = "n") -> DataFrame:
    """``list, group``, the columns, and the row number, for all rankings in one placement.

    A row appears once for each ranking it is in; ``list`` is the ranking's position, and columns
    that it does not need are null. Keys at the same position have one type in all rankings; a
    key that a ranking lacks is a null of that type.

    One scan of the keys counts, one takes a share of them by hash that bounds the sample by
    ``SAMPLED`` keys a split point. The split points of all lists together are searched
    by bisection on each row, so that all lists are placed by one exchange, which needs no
    sampling of its own. Whatever the sample, numbers are exact.
    """
    width = len(rankings[0].keys)
    names = [f"_k{i}" for i in range(width)]
    columns = [c for c in df.columns if any(c in r.columns for r in rankings)]
    lists = F.array_compact(F.array(*(F.when(r.member, F.lit(i)) for i, r in enumerate(rankings))))
    rows = df.withColumn("list", F.explode(lists))

    def chosen(values: list[Column]) -> Column:
        picked = F.when(F.col("list") == 0, values[0])
        for i, value in enumerate(values[1:], 1):
            picked = picked.when(F.col("list") == i, value)
        return picked

    rows = rows.select(
        "list", chosen([F.lit(0) if r.group is None else r.group for r in rankings])
        .cast("bigint").alias("group"),
        *(chosen([r.keys[i] for r in rankings]).alias(k) for i, k in enumerate(names)),
        *(F.when(F.col("list").isin([i for i, r in enumerate(rankings) if c in r.columns]),
                 F.col(c)).alias(c) for c in columns))
    keys = rows.select("list", *names)
    count = keys.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(MOST_PARTS, max(-(-count // PART_ROWS), min(cores, count // 1000))))
    key = F.struct("list", *names)
    if parts > 1:
        share = min(1.0, SAMPLED * parts / count)
        sample = keys.filter(F.pmod(F.xxhash64("list", *names), F.lit(1 << 40))
                             < int(share * (1 << 40)))
        # quantiles of at most about SAMPLED * MOST_PARTS keys
        place = F.row_number().over(Window.orderBy("list", *names))
        step = max(1, int(share * count) // parts)
        splits = [r[0] for r in sample.select(F.to_json(key, {"ignoreNullFields": "false"}), (
            place % step == 0).alias("_cut")).filter("_cut").collect()]
        ends = F.from_json(F.lit("[" + ",".join(splits) + "]"),
                           T.ArrayType(rows.select(key.alias("k")).schema["k"].dataType))
        jumps = [1 << bit for bit in reversed(range(max(1, len(splits)).bit_length()))]
        part = F.aggregate(
            F.array(*map(F.lit, jumps)), F.lit(0),
            lambda at, jump: F.when((at + jump <= len(splits)) & (
                F.get(ends, at + jump - 1) <= key), at + jump).otherwise(at))
        rows = rows.withColumn("_to", part).repartitionById(len(splits) + 1, "_to").drop("_to")
    else:
        rows = rows.coalesce(1)
    placed = written(
        rows.sortWithinPartitions("list", *names).drop(*names)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33)), "lists")
    return _shifted(placed, ["list", "group"], ["list", "group", *columns], name)


def slice_rows(df: DataFrame, start: int | None = 0, end: int | None = None,
               ord: str = "ord") -> DataFrame:
    """Rows ``[start:end)`` of list positions ``0..n-1``; negative bounds count from the end."""
    if (start or 0) < 0 or (end or 0) < 0:
        length = df.agg(F.count(F.lit(1))).scalar()

    def bound(edge: int) -> Column:
        return F.lit(edge) if edge >= 0 else length + edge

    rows = df if not start else df.filter(F.col(ord) >= bound(start))
    return rows if end is None else rows.filter(F.col(ord) < bound(end))


def head_tail(df: DataFrame, head: int, tail: int, order: str = "ord") -> DataFrame:
    """First ``head`` and last ``tail`` rows, marked in ``part``."""
    first = df.orderBy(F.col(order).asc()).limit(head)
    last = df.orderBy(F.col(order).desc()).limit(tail)
    return first.withColumn("part", F.lit("head")).unionByName(
        last.withColumn("part", F.lit("tail")))
