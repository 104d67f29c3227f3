"""The weighted report as ordered lines ``(section, row, line)``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagetally import fixed
from pagetally.functions.formatting import fixed_point, fmt_magnitude, fmt_money, fmt_signed
from pagetally.functions.text import abbreviate, sanitize_cell
from pagetally.operators import summaries
from pagetally.operators.ordering import (
    Ranking, decline_order, falling, growth_order, number_lists, number_rows, record_order)

# Section numbers; listings of rating r are section LISTING + (10 - r).
HEAD, TOTALS, TIERS, BANDS, GROUPS, DOWN, UP, ALL, LISTING = range(9)
END = 2 ** 62   # row of a section's closing line


_LISTED = ["ord", "title", "exposure", "pay", "jobs", "outlook", "education", "rationale"]
_MOVED = ["title", "exposure", "jobs", "outlook"]


def _listing_cells(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        F.col("exposure").cast("int").alias("exposure"), "n", "title",
        fmt_money(F.col("pay")).alias("pay_text"),
        fmt_magnitude(F.col("jobs")).alias("jobs_text"),
        fmt_signed(F.col("outlook")).alias("outlook_text"),
        abbreviate(F.col("education"), fixed.EDUCATION_SHORT).alias("education_text"),
        sanitize_cell(F.coalesce("rationale", F.lit(""))).alias("rationale"),
    )


def _mover_cells(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "n", "title", "exposure", "outlook", fmt_signed(F.col("outlook")).alias("outlook_text"),
        fmt_magnitude(F.col("jobs")).alias("jobs_text"))


def rating_listing(records: DataFrame) -> DataFrame:
    """Rows of each rating in record order, numbered from 1, with their report cells."""
    rated = summaries.on_scale(records).withColumn("exposure", F.col("exposure").cast("int")).select(
        *_LISTED)
    return _listing_cells(number_rows(rated, record_order(), within="exposure"))


def movers(records: DataFrame, up: bool) -> DataFrame:
    """Growing or declining records in report order, numbered from 1."""
    narrow = records.select("ord", *_MOVED)
    chosen = summaries.growing(narrow) if up else summaries.declining(narrow)
    return _mover_cells(number_rows(chosen, growth_order() if up else decline_order()))


def ranked_lists(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rating listing, the declining and the growing records, from one placement."""
    records = records.select(*_LISTED)
    tail = [falling(records, "exposure"), falling(records, "jobs"), F.col("ord")]
    outlook = records.schema["outlook"].dataType
    lists = number_lists(records, [
        Ranking(summaries.is_on_scale(), [F.lit(None).cast(outlook), *tail], _LISTED,
                F.col("exposure").cast("int")),
        Ranking(summaries.is_declining(), [F.col("outlook"), *tail], _MOVED),
        Ranking(summaries.is_growing(), [falling(records, "outlook"), *tail], _MOVED)])
    part = lambda i: lists.filter(F.col("list") == i)
    return _listing_cells(part(0)), _mover_cells(part(1)), _mover_cells(part(2))


def _row(*cells) -> Column:
    """Pipe table row."""
    parts = [F.lit("| ")]
    for i, cell in enumerate(cells):
        parts += ([F.lit(" | ")] if i else []) + [cell]
    return F.concat(*parts, F.lit(" |"))


def _one_decimal(value: Column) -> Column:
    return fixed_point(value, 1)


def _table_lines(df: DataFrame, section: int, row: str, line: Column) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"), (F.col(row) + 100).cast("bigint").alias("row"),
        line.alias("line"))


def summary_lines(records: DataFrame) -> DataFrame:
    """Totals, tiers, bands, groups and the listing's heading: one pass, a few dozen lines."""
    totals = records.agg(
        *summaries.headline_columns(),
        summaries.tier_slots().alias("tiers"),
        summaries.band_slots().alias("bands"),
        summaries.group_slots().alias("groups"),
    )
    head = totals.select(F.posexplode(F.array(
        F.concat(F.lit("- Total occupations: "), F.col("n")),
        F.concat(F.lit("- Total jobs: "), F.format_string("%,d", "jobs"), F.lit(" ("),
                 fixed_point(F.col("jobs") / F.lit(1e6), 0), F.lit("M)")),
        F.concat(F.lit("- Total annual wages: $"), _one_decimal(F.col("wages") / F.lit(1e12)),
                 F.lit("T")),
        F.concat(F.lit("- Job-weighted average AI exposure: "),
                 _one_decimal(F.col("mean_exposure")), F.lit("/10")),
    )).alias("row", "line"))
    listed = totals.select(F.posexplode(F.array(
        F.concat(F.lit("## All "), F.col("n"), F.lit(" occupations")), F.lit(""),
        F.lit(fixed.HEADINGS["order"]), F.lit(""))).alias("row", "line"))
    tiers = summaries.tiers_from(totals)
    share = lambda name: F.concat(_one_decimal(F.col(name)), F.lit("%"))
    tier_line = _row(
        F.col("name"), F.col("n"), fmt_magnitude(F.col("jobs")), share("jobs_share"),
        F.concat(F.lit("$"), _one_decimal(F.col("wages") / F.lit(1e12)), F.lit("T")),
        share("wages_share"), fmt_money(F.col("avg_pay")))
    mean_line = _row(
        F.col("name"), _one_decimal(F.col("mean_exposure")), fmt_magnitude(F.col("jobs")))
    return (
        _table_lines(head, TOTALS, "row", F.col("line"))
        .unionByName(_table_lines(tiers, TIERS, "ord", tier_line))
        .unionByName(_table_lines(
            summaries.means_from(totals, "bands"), BANDS, "ord", mean_line))
        .unionByName(_table_lines(
            summaries.means_from(totals, "groups"), GROUPS, "ord", mean_line))
        .unionByName(_table_lines(listed, ALL, "row", F.col("line")))
    )


def heading_lines(spark: SparkSession, title: str, intro: list[str]) -> DataFrame:
    """Headings and table heads of the report, and the blank line that closes each section."""
    tables = {TIERS: "tiers", BANDS: "bands", GROUPS: "groups", DOWN: "movers", UP: "movers"}
    headings = {DOWN: "down", UP: "up"}
    heads = {HEAD: [f"# {title}", "", *intro], TOTALS: [fixed.HEADINGS["totals"], ""]}
    for section, table in tables.items():
        heads[section] = [fixed.HEADINGS[headings.get(section, table)], "",
                          *fixed.TABLE_HEADS[table]]
    places = [(section, row, line) for section, texts in heads.items()
              for row, line in enumerate(texts)]
    places += [(section, END, "") for section in heads if section != HEAD]
    sections, rows, texts = zip(*places)
    return spark.createDataFrame(pa.table({
        "section": pa.array(sections, pa.int32()), "row": pa.array(rows, pa.int64()),
        "line": pa.array(texts, pa.string())}))


def mover_lines(down: DataFrame, up: DataFrame) -> DataFrame:
    """Declining and growing tables of ``movers``; a missing rating prints as ``?``, a whole one without fraction."""
    rating = F.col("exposure")
    whole = F.when(rating == F.floor(rating), rating.cast("bigint").cast("string"))
    line = _row(
        F.col("title"),
        F.concat(F.coalesce(whole, rating.cast("string"), F.lit("?")), F.lit("/10")),
        F.col("outlook_text"), F.col("jobs_text"))
    return _table_lines(down, DOWN, "n", line).unionByName(_table_lines(up, UP, "n", line))


def listing_lines(records: DataFrame, listing: DataFrame) -> DataFrame:
    """Per-rating tables of ``rating_listing``, highest rating first."""
    section = (F.lit(LISTING + fixed.RATING_HIGH) - F.col("exposure")).alias("section")
    head = summaries.rating_groups(records).select(section, F.array(
        F.concat(F.lit("### Exposure "), F.col("exposure"), F.lit("/10 ("), F.col("n"),
                 F.lit(" occupations, "), fmt_magnitude(F.col("jobs")), F.lit(" jobs)")),
        F.lit(""),
        *map(F.lit, fixed.TABLE_HEADS["listing"]),
    ).alias("lines"))
    ends = head.select("section", F.lit(END).cast("bigint").alias("row"), F.lit("").alias("line"))
    heads = head.select("section", F.posexplode("lines").alias("row", "line")).withColumn(
        "row", F.col("row").cast("bigint"))
    rows = listing.select(
        section, (F.col("n") + 100).alias("row"),
        _row(F.col("n"), F.col("title"), F.col("pay_text"), F.col("jobs_text"),
             F.col("outlook_text"), F.col("education_text"), F.col("rationale")).alias("line"))
    return heads.unionByName(rows).unionByName(ends)


def report_lines(records: DataFrame, title: str = fixed.HEADINGS["title"],
                 intro: list[str] = ()) -> DataFrame:
    """The whole report. Pass a written or cached frame: it is read whole once, and four times
    for a few columns each.

    Lines are placed by ``(section, row)``; ``sources.corpus.write_report`` writes them in order.
    """
    listing, down, up = ranked_lists(records)
    return (
        heading_lines(records.sparkSession, title, list(intro))
        .unionByName(summary_lines(records))
        .unionByName(mover_lines(down, up))
        .unionByName(listing_lines(records, listing))
    )


def summary_text(lines: DataFrame) -> DataFrame:
    """One text per summary section; for lines of summary sections only.

    These sections have a few lines each. Mover tables and listings grow with the data and go to
    ``write_report``; their lines are an error here.
    """
    ordered = F.array_sort(F.collect_list(F.struct("row", "line")))
    section = F.when(F.col("section") < DOWN, F.col("section")).otherwise(
        F.raise_error(F.lit("not a line of a summary section")))
    return lines.withColumn("section", section).groupBy("section").agg(
        F.array_join(F.transform(ordered, lambda pair: pair["line"]), "\n").alias("text"))
