"""Report aggregates over records ``(ord, title, pay, jobs, outlook, education, exposure, ...)``.

Bands and groups are a handful of plan literals, so their tables are conditional sums: one
pass, one row out of each task, no shuffle of records, and rows may fall in several bands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagetally import fixed
from pagetally.functions.aggregates import (
    product0, sum0, sum_product, weighable, weighted_mean)
from pagetally.functions.predicates import in_closed, in_half_open, member_of, truthy_number


def pay() -> Column:
    return F.col("pay")


def weight() -> Column:
    return F.col("jobs")


def rating() -> Column:
    return F.col("exposure")


def headline_columns() -> list[Column]:
    """Rows, weight, wages and weighted mean rating."""
    return [
        F.count(F.lit(1)).alias("n"),
        sum0(weight()).alias("jobs"),
        sum_product(weight(), pay()).alias("wages"),
        weighted_mean(rating(), weight()).cast("double").alias("mean_exposure"),
    ]


def headline(records: DataFrame) -> DataFrame:
    """One row of totals."""
    return records.agg(*headline_columns())


def _slots(groups: list[tuple[str, Column]], measures: dict[str, Column]) -> Column:
    """Array with one struct per group: position, name, row count and summed measures.

    ``weighted`` measures are sums of products with a rating, which may have fractions.
    """
    def total(test: Column, label: str, value: Column) -> Column:
        chosen = F.when(test, value)
        if label == "weighted":
            return F.coalesce(F.sum(chosen), F.lit(0)).cast("double")
        return sum0(chosen)

    return F.array(*[
        F.struct(
            F.lit(i).alias("ord"), F.lit(name).alias("name"), F.count_if(test).alias("n"),
            *[total(test, label, value).alias(label) for label, value in measures.items()])
        for i, (name, test) in enumerate(groups)
    ])


def tier_slots(tiers: list[tuple] = fixed.TIERS) -> Column:
    return _slots(
        [(name, rating().isNotNull() & in_closed(rating(), low, high)) for name, low, high in tiers],
        {"jobs": weight(), "wages": product0(weight(), pay())})


def band_slots(bands: list[tuple] = fixed.PAY_BANDS) -> Column:
    rated = weighable(rating(), weight()) & truthy_number(pay())
    return _slots(
        [(name, rated & in_half_open(pay(), low, high)) for name, low, high in bands],
        {"weighted": rating() * weight(), "jobs": weight()})


def group_slots(groups: list[tuple] = fixed.EDUCATION_GROUPS) -> Column:
    rated = weighable(rating(), weight())
    return _slots(
        [(name, rated & member_of(F.col("education"), members)) for name, members in groups],
        {"weighted": rating() * weight(), "jobs": weight()})


def share_of_total(part: Column, total: Column) -> Column:
    """Percentage of a grand total; null when the total is zero."""
    return F.try_divide(part, total) * 100


def tiers_from(totals: DataFrame) -> DataFrame:
    """Tier table out of one row ``(tiers, jobs, wages)``; empty tiers stay."""
    jobs, wages = F.col("jobs"), F.col("wages")
    average = F.coalesce(F.try_divide(wages, jobs), F.lit(0)).cast("bigint")
    return totals.select(
        F.inline("tiers"), F.col("jobs").alias("all_jobs"), F.col("wages").alias("all_wages"),
    ).select(
        "ord", "name", "n", "jobs",
        share_of_total(jobs, F.col("all_jobs")).alias("jobs_share"),
        "wages",
        share_of_total(wages, F.col("all_wages")).alias("wages_share"),
        average.alias("avg_pay"))


def means_from(totals: DataFrame, slots: str) -> DataFrame:
    """Weighted means out of one row of slots; empty groups are dropped."""
    return totals.select(F.inline(slots)).filter("n > 0").select(
        "ord", "name", (F.col("weighted") / F.col("jobs")).alias("mean_exposure"), "jobs")


def tier_summary(records: DataFrame, tiers: list[tuple] = fixed.TIERS) -> DataFrame:
    """Count, weight, wages, their shares of all records and average pay per closed tier."""
    return tiers_from(records.agg(
        tier_slots(tiers).alias("tiers"), sum0(weight()).alias("jobs"),
        sum_product(weight(), pay()).alias("wages")))


def band_means(records: DataFrame, bands: list[tuple] = fixed.PAY_BANDS) -> DataFrame:
    """Weighted mean rating and weight per half-open pay band."""
    return means_from(records.agg(band_slots(bands).alias("slots")), "slots")


def group_means(records: DataFrame, groups: list[tuple] = fixed.EDUCATION_GROUPS) -> DataFrame:
    """Weighted mean rating and weight per education group."""
    return means_from(records.agg(group_slots(groups).alias("slots")), "slots")


def is_declining() -> Column:
    return F.col("outlook") < fixed.DECLINING_BELOW


def is_growing() -> Column:
    return F.col("outlook") >= fixed.GROWING_FROM


def is_on_scale() -> Column:
    """Whether the rating equals a point of the scale; null and fractional ratings do not."""
    return rating().isin(list(range(fixed.RATING_LOW, fixed.RATING_HIGH + 1)))


def declining(records: DataFrame) -> DataFrame:
    """Records with a negative outlook."""
    return records.filter(is_declining())


def growing(records: DataFrame) -> DataFrame:
    """Records with a strong positive outlook."""
    return records.filter(is_growing())


def on_scale(records: DataFrame) -> DataFrame:
    """Records whose rating equals a point of the scale; null and fractional ratings are not."""
    return records.filter(is_on_scale())


def rating_groups(records: DataFrame) -> DataFrame:
    """Count and weight per rating; ratings nobody has are absent."""
    return on_scale(records).groupBy(rating().cast("int").alias("exposure")).agg(
        F.count(F.lit(1)).alias("n"), sum0(weight()).alias("jobs"))


def mean_of(df: DataFrame, column: str) -> DataFrame:
    """Unweighted mean; nulls are left out."""
    return df.agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"))


def histogram(df: DataFrame, column: str, rows_per_mark: int | None = None) -> DataFrame:
    """Rows per value, and with ``rows_per_mark`` a ``bar`` of one mark for that many rows or part.

    Counts are always exact. A bar of one mark per row is as long as the count.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if rows_per_mark is None:
        return counts
    marks = F.ceil(F.col("n") / rows_per_mark).cast("int")
    return counts.withColumn("bar", F.repeat(F.lit("█"), marks))


def run_stats(statuses: DataFrame, status: str = "status") -> DataFrame:
    """Items per outcome of a run."""
    return statuses.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
