"""Keyed joins that keep their balance when one key holds much of the left side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagetally.functions.parsing import to_int
from pagetally.functions.predicates import in_closed, in_half_open
from pagetally.operators.keyed import last_wins
from pagetally.session import durable

MIN_HOT_ROWS = 1_000_000    # smaller keys are never split
HOT_SHARE = 1 / 65_536      # nor are keys below this share, so there are 65,536 hot keys at most
SAMPLE = 0.001              # part of the rows that is counted to find them
SALTS = 64                  # pieces a hot key is split into


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS,
             sample: float = SAMPLE) -> DataFrame:
    """Keys that hold many rows of ``df``, a null key included.

    They are found in a sample of the key column. The result only steers how a join is
    spread, but both sides of the join must see the same keys: hence the checkpoint.
    """
    counts = df.select(key).sample(sample, seed=1).groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()
    return durable(
        counts.filter((F.col("_rows") >= min_rows * sample) & (F.col("_rows") >= total * HOT_SHARE))
        .select(key, F.lit(True).alias("_hot")))


def skew_joins(left: DataFrame, rights: list[tuple[DataFrame, str]], key: str,
               min_rows: int = MIN_HOT_ROWS, sample: float = SAMPLE) -> DataFrame:
    """Join ``left`` with each ``(right, how)`` on ``key``.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. Without hot keys these
    are plain joins. Otherwise rows of hot left keys are spread over ``SALTS`` pieces and
    the matching right rows are copied to each piece; rows with a null key, which never
    match, are spread too. All joins use one partitioning of the left side. Left rows
    should be distinct (carry a position or id) and cheap to read: their keys are sampled
    first.
    """
    hot = hot_keys(left, key, min_rows, sample)
    joined, keys = left, [key]
    if not hot.isEmpty():
        hot = F.broadcast(hot)
        piece = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
        joined = left.join(hot, key, "left").withColumn("_salt", F.when(
            F.col("_hot") | F.col(key).isNull(), piece).otherwise(0)).drop("_hot")
        copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
            F.array(F.lit(0)))
        rights = [
            (right.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot"), how)
            for right, how in rights]
        keys = [key, "_salt"]
    for right, how in rights:
        joined = joined.join(right, keys, how)
    rest = [name for name in joined.columns if name not in (*left.columns, "_salt")]
    return joined.select(*left.columns, *rest)


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "left",
              min_rows: int = MIN_HOT_ROWS, sample: float = SAMPLE) -> DataFrame:
    """One join of :func:`skew_joins`."""
    return skew_joins(left, [(right, how)], key, min_rows, sample)


def with_corpus(master: DataFrame, corpus: DataFrame, key: str = "slug") -> DataFrame:
    """Master rows that have a document."""
    return skew_join(master, corpus.select(key).distinct(), key, "left_semi")


def without_corpus(master: DataFrame, corpus: DataFrame, key: str = "slug") -> DataFrame:
    """Master rows that have none."""
    return skew_join(master, corpus.select(key).distinct(), key, "left_anti")


def pending(todo: DataFrame, done: DataFrame, key: str = "slug", force: bool = False) -> DataFrame:
    """Rows whose key is not done yet; every row when ``force``."""
    return todo if force else skew_join(todo, done.select(key).distinct(), key, "left_anti")


def band_join(df: DataFrame, value: str, bands: list[tuple], closed: bool) -> DataFrame:
    """Each row with every band ``(name, low, high)`` its value lies in; others drop out.

    The bands are literals of the plan, so this is a projection: no join and no shuffle.
    """
    inside = in_closed if closed else in_half_open
    labels = [
        F.when(inside(F.col(value), low, high),
               F.struct(F.lit(i).alias("band_ord"), F.lit(name).alias("band")))
        for i, (name, low, high) in enumerate(bands)
    ]
    return df.select("*", F.inline(F.array_compact(F.array(*labels))))


def group_join(df: DataFrame, value: str, groups: list[tuple[str, list]]) -> DataFrame:
    """Each row with every group ``(name, members)`` that lists its value; others drop out."""
    labels = [
        F.when(F.col(value).isin(members),
               F.struct(F.lit(i).alias("group_ord"), F.lit(name).alias("group")))
        for i, (name, members) in enumerate(groups)
    ]
    return df.select("*", F.inline(F.array_compact(F.array(*labels))))


def _current(df: DataFrame, *columns: str) -> DataFrame:
    """The listed columns of each slug's last row; without ``ord`` slugs are unique already."""
    if "ord" in df.columns:
        return last_wins(df.select("slug", "ord", *columns), "slug")
    return df.select("slug", *columns)


def build_compact(stats: DataFrame, scores: DataFrame, strict: bool = False) -> DataFrame:
    """Structured table with the rating of each row, narrowed and typed.

    A row without a rating keeps null. When ``scores`` has ``ord``, the last of several
    ratings of a slug counts. Text that is no whole number is null, or raises if ``strict``.
    """
    rated = _current(scores, "exposure", "rationale").select(
        "slug", "exposure", F.col("rationale").alias("exposure_rationale"))
    url = F.coalesce(F.col("url"), F.lit("")) if "url" in stats.columns else F.lit("")

    def number(name: str) -> Column:
        return to_int(F.col(name), strict)

    narrow = stats.select(
        "title", "slug", "category",
        number("median_pay_annual").alias("pay"),
        number("num_jobs_2024").alias("jobs"),
        number("outlook_pct").alias("outlook"),
        "outlook_desc",
        F.col("entry_education").alias("education"),
        url.alias("url"),
    )
    return skew_join(narrow, rated, "slug", "left").select(
        "title", "slug", "category", "pay", "jobs", "outlook", "outlook_desc", "education",
        "exposure", "exposure_rationale", "url")


def build_records(master: DataFrame, stats: DataFrame, scores: DataFrame,
                  strict: bool = False) -> DataFrame:
    """Report records: the master list with its statistics and ratings.

    ``master`` has ``ord``. Repeated slugs in ``stats`` and ``scores`` resolve to the last
    one when they have ``ord`` too. The category comes from the statistics whenever that row exists, even if
    it is empty there.
    """
    figures = _current(
        stats, "category", "median_pay_annual", "num_jobs_2024", "outlook_pct", "outlook_desc",
        "entry_education",
    ).select(
        "slug",
        F.lit(True).alias("_found"),
        F.col("category").alias("_category"),
        to_int(F.col("median_pay_annual"), strict).alias("pay"),
        to_int(F.col("num_jobs_2024"), strict).alias("jobs"),
        to_int(F.col("outlook_pct"), strict).alias("outlook"),
        F.col("outlook_desc").alias("_outlook_desc"),
        F.col("entry_education").alias("_education"),
    )
    rated = _current(scores, "exposure", "rationale").select(
        "slug", "exposure", F.col("rationale").alias("_rationale"))
    keyed = skew_joins(master, [(figures, "left"), (rated, "left")], "slug")

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return keyed.select(
        "ord", "title", "slug",
        F.when(F.col("_found"), F.col("_category")).otherwise(text("category")).alias("category"),
        "pay", "jobs", "outlook",
        text("_outlook_desc").alias("outlook_desc"),
        text("_education").alias("education"),
        "exposure",
        text("_rationale").alias("rationale"),
        text("url").alias("url"),
    )
