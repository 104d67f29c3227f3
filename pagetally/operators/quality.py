"""Data checks. A check is one row: ``(check, is_valid, message, details)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from pagetally import fixed
from pagetally.functions.text import label_case

RESULT_SCHEMA = "check string, is_valid boolean, message string, details map<string,string>"
SAMPLE = 5


def first_offenders(df: DataFrame, bad: Column, name: Column, order: str) -> Column:
    """Names of the first five bad rows as one text; only five rows leave the tasks."""
    few = df.filter(bad).select(name.alias("_name"), F.col(order).alias("_order")).orderBy(
        "_order").limit(SAMPLE)
    return few.agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_order", "_name"))),
        lambda pair: pair["_name"]), ", ")).scalar()


def _details(**values: Column) -> Column:
    pairs = [part for key, value in values.items() for part in (
        F.lit(key), value.cast("string"))]
    return F.create_map(*pairs)


def _result(counts: DataFrame, name: str, verdicts: list[tuple[Column, str | Column, Column | None]],
            message: Column, details: Column) -> DataFrame:
    """First failing verdict ``(failed, message, details)``, else the given success."""
    valid, text, more = F.lit(True), message, details
    for failed, reason, evidence in reversed(verdicts):
        reason = F.lit(reason) if isinstance(reason, str) else reason
        evidence = F.create_map().cast("map<string,string>") if evidence is None else evidence
        valid = F.when(failed, False).otherwise(valid)
        text = F.when(failed, reason).otherwise(text)
        more = F.when(failed, evidence).otherwise(more)
    return counts.select(
        F.lit(name).alias("check"), valid.alias("is_valid"), text.alias("message"),
        more.alias("details"))


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1)


def failure(spark: SparkSession, name: str, message: str) -> DataFrame:
    """A failed check without evidence."""
    return one_row(spark).select(
        F.lit(name).alias("check"), F.lit(False).alias("is_valid"), F.lit(message).alias("message"),
        F.create_map().cast("map<string,string>").alias("details"))


@dataclass(frozen=True)
class Check:
    """A check as aggregates over its table and what follows from them.

    ``offenders`` names the first bad rows of a table; they are looked for only where the measure
    ``wrong`` is above zero. ``finish`` makes the result from one row of measures and those names.
    """

    name: str
    measures: dict[str, Column]
    finish: Callable[[DataFrame, Column], DataFrame]
    wrong: str | None = None
    offenders: Callable[[DataFrame], Column] | None = None

    def of(self, df: DataFrame) -> DataFrame:
        """The result as a lazy row."""
        named = self.offenders(df) if self.offenders else F.lit("")
        return self.finish(df.agg(*(c.alias(n) for n, c in self.measures.items())), named)


def _missing_fields(df: DataFrame, columns: list[str], nulls_fail: bool) -> Column:
    """Array of the required fields a row lacks."""
    def lacking(name: str) -> Column:
        if name not in df.columns:
            return F.lit(name)
        return F.when(F.col(name).isNull(), F.lit(name)) if nulls_fail else F.lit(None).cast("string")
    return F.array_compact(F.array(*[lacking(name) for name in columns]))


def required_fields(df: DataFrame, name: str = "master_list", label: str = "Master list",
                    columns: list[str] = fixed.MASTER_COLUMNS, key: str = "slug",
                    order: str = "ord", per_field: bool = False, nulls_fail: bool = False,
                    rated: str | None = None) -> Check:
    """Rows exist and each has the required fields.

    Fields are required to be columns; ``nulls_fail`` also requires values. By default the
    first bad key is named; ``per_field`` counts every missing field and lists the first
    five. ``rated`` adds the number of rows with that value.
    """
    lacks = _missing_fields(df, columns, nulls_fail)
    slug = F.coalesce(F.col(key), F.lit("unknown")) if key in df.columns else F.lit("unknown")
    bad = F.size(lacks) > 0
    measures = {
        "n": F.count(F.lit(1)),
        "n_fields": F.coalesce(F.sum(F.size(lacks)), F.lit(0)).cast("bigint"),
        "first_bad": F.min_by(slug, F.when(bad, F.col(order))),
        "n_rated": F.count(rated) if rated else F.lit(None).cast("bigint"),
    }

    def named(df: DataFrame) -> Column:
        each = df.select(slug.alias("_slug"), F.col(order).alias(order), F.posexplode(lacks).alias(
            "_at", "_field"))
        return first_offenders(each.withColumn("_place", F.struct(order, "_at")), F.lit(True),
                               F.concat_ws(": ", "_slug", "_field"), "_place")

    def finish(counts: DataFrame, names: Column) -> DataFrame:
        if per_field:
            evidence = _details(missing=names)
            wrong = F.concat(F.lit(f"{label} missing required fields: "), F.col("n_fields"),
                             F.lit(" items"))
        else:
            evidence = None
            wrong = F.concat(F.lit("Missing required fields in row: "), F.col("first_bad"))
        shown, details = F.concat(F.lit(f"{label} valid: "), F.col("n")), _details(count=F.col("n"))
        if rated:
            shown = F.concat(shown, F.lit(" entries ("), F.col("n_rated"), F.lit(f" with {rated})"))
            details = _details(**{"count": F.col("n"), f"with_{rated}": F.col("n_rated")})
        else:
            shown = F.concat(shown, F.lit(" rows"))
        return _result(counts, name, [
            (F.col("n") == 0, f"{label} is empty", None),
            (F.col("n_fields") > 0, wrong, evidence),
        ], shown, details)

    return Check(name, measures, finish, *(("n_fields", named) if per_field else ()))


def check_required(df: DataFrame, *args, **options) -> DataFrame:
    """Result of :func:`required_fields`."""
    return required_fields(df, *args, **options).of(df)


def no_empty_texts(df: DataFrame, name: str, label: str, key: str = "slug",
                   text: str = "text") -> Check:
    """Documents exist and none is empty; the first five empty ones are named."""
    empty = F.coalesce(F.octet_length(text), F.lit(0)) == 0

    def finish(counts: DataFrame, names: Column) -> DataFrame:
        return _result(counts, name, [
            (F.col("n") == 0, f"No {label} files found", None),
            (F.col("n_empty") > 0,
             F.concat(F.lit("Found "), F.col("n_empty"), F.lit(f" empty {label} files")),
             _details(empty_files=names)),
        ], F.concat(F.lit(f"{label} files valid: "), F.col("n"), F.lit(" files")),
            _details(count=F.col("n")))

    return Check(name, {"n": F.count(F.lit(1)), "n_empty": F.count_if(empty)}, finish, "n_empty",
                 lambda df: first_offenders(df, empty, F.col(key).cast("string"), key))


def check_corpus(df: DataFrame, *args, **options) -> DataFrame:
    """Result of :func:`no_empty_texts`."""
    return no_empty_texts(df, *args, **options).of(df)


def has_columns(df: DataFrame, name: str = "csv", label: str = "CSV",
                columns: list[str] = ("title", "slug", "category")) -> Check:
    """Rows exist and the required columns are there."""
    absent = [column for column in columns if column not in df.columns]
    held = ", ".join(df.columns)

    def finish(counts: DataFrame, names: Column) -> DataFrame:
        return _result(counts, name, [
            (F.col("n") == 0, f"{label} is empty", None),
            (F.lit(bool(absent)), f"{label} missing required columns: {absent}", None),
        ], F.concat(F.lit(f"{label} valid: "), F.col("n"), F.lit(" rows")),
            _details(count=F.col("n"), columns=F.lit(held)))

    return Check(name, {"n": F.count(F.lit(1))}, finish)


def check_columns(df: DataFrame, *args, **options) -> DataFrame:
    """Result of :func:`has_columns`."""
    return has_columns(df, *args, **options).of(df)


def in_range(df: DataFrame, column: str = "exposure", name: str = "scores",
             label: str = "Scores", low=fixed.RATING_LOW, high=fixed.RATING_HIGH,
             key: str = "slug", order: str = "slug") -> Check:
    """Rows exist and values lie in a closed range; nulls pass, the first five bad keys are named."""
    outside = F.coalesce(~F.col(column).between(low, high), F.lit(False))

    def finish(counts: DataFrame, names: Column) -> DataFrame:
        return _result(counts, name, [
            (F.col("n") == 0, f"{label} is empty", None),
            (F.col("n_bad") > 0,
             F.concat(F.lit("Found "), F.col("n_bad"), F.lit(f" scores with invalid {column} values")),
             _details(invalid=names)),
        ], F.concat(F.lit(f"{label} valid: "), F.col("n"), F.lit(" entries ("), F.col("n_rated"),
                    F.lit(f" with {column})")),
            _details(**{"count": F.col("n"), f"with_{column}": F.col("n_rated")}))

    return Check(name, {"n": F.count(F.lit(1)), "n_bad": F.count_if(outside),
                        "n_rated": F.count(column)}, finish, "n_bad",
                 lambda df: first_offenders(df, outside, F.col(key).cast("string"), order))


def check_range(df: DataFrame, *args, **options) -> DataFrame:
    """Result of :func:`in_range`."""
    return in_range(df, *args, **options).of(df)


def _judged(df: DataFrame, checks: list[Check], values: dict) -> DataFrame:
    """Results from the measures of all checks; only failed ones look for their offenders."""
    spark, results = df.sparkSession, None
    for position, check in enumerate(checks):
        own = {name: values[f"{position} {name}"] for name in check.measures}
        counts = one_row(spark).select(*(
            F.lit(value).cast("string" if isinstance(value, str) else "bigint").alias(name)
            for name, value in own.items()))
        names = F.lit("")
        if check.offenders and own[check.wrong]:
            names = F.lit(one_row(spark).select(check.offenders(df).alias("names")).first().names)
        row = check.finish(counts, names).withColumn("ord", F.lit(position))
        results = row if results is None else results.unionByName(row)
    return results


def _all_measures(checks: list[Check]) -> list[Column]:
    return [column.alias(f"{position} {name}") for position, check in enumerate(checks)
            for name, column in check.measures.items()]


def _one_by_one(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Each check as a job of its own, so that one that fails while it runs is its own row."""
    return validate_all(df.sparkSession, {check.name: lambda c=check: c.of(df) for check in checks})


def check_table(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Results of all checks of one table, with their position, from one pass over it.

    A check that fails is followed by one search for its first offenders. Where the pass itself
    fails, the checks run one after the other and the one at fault is a failed row.
    """
    try:
        values = df.agg(*_all_measures(checks)).first().asDict()
        return _judged(df, checks, values)
    except PySparkException:
        return _one_by_one(df, checks)


def check_while(df: DataFrame, checks: list[Check], write: Callable[[DataFrame], None],
                read: Callable[[], DataFrame] | None = None) -> DataFrame:
    """Results of the checks, measured in the pass in which ``write`` writes ``df``.

    ``read`` gives the table back as it was written, for offenders; without it they are looked for
    in ``df``. A check that fails while it runs does not stop the write: the table is then written
    without checks, and they run one after the other.
    """
    seen = Observation(f"checks-{uuid.uuid4().hex}")
    try:
        write(df.observe(seen, *_all_measures(checks)))
    except PySparkException:
        write(df)
        return _one_by_one(read() if read else df, checks)
    return _judged(read() if read else df, checks, seen.get)


def validate_all(spark: SparkSession, checks: dict[str, Callable[[], DataFrame | tuple]]) -> DataFrame:
    """All checks in order, with their position; one that fails, or cannot be set up, is a failed row.

    A check gives its row, or a table and a :class:`Check` of it; the checks of one table are
    measured in one pass. All run here, so that a failure while one runs is its own.
    """
    rows: dict[int, DataFrame] = {}
    tables: dict[int, tuple[DataFrame, list[tuple[int, Check]]]] = {}
    for position, (name, check) in enumerate(checks.items()):
        try:
            made = check()
            if isinstance(made, tuple):
                tables.setdefault(id(made[0]), (made[0], []))[1].append((position, made[1]))
                continue
            rows[position] = spark.createDataFrame(made.collect(), made.schema)
        except PySparkException as problem:
            rows[position] = failure(
                spark, name, f"Failed to load {name}: {problem.getCondition()}")
    for df, own in tables.values():
        found = check_table(df, [check for _, check in own])
        for row in found.collect():     # one row a check
            rows[own[row.ord][0]] = spark.createDataFrame([row], found.schema).drop("ord")
    results = None
    for position in sorted(rows):
        row = rows[position].withColumn("ord", F.lit(position))
        results = row if results is None else results.unionByName(row)
    return results


def quality_report(results: DataFrame, title: str = "Data Validation Report") -> DataFrame:
    """Report lines ``(section, row, line)``: a heading, then each check with its details."""
    mark = F.when(F.col("is_valid"), "[OK] ").otherwise("[FAIL] ")
    head = F.concat(mark, label_case(F.col("check")), F.lit(": "), F.col("message"))
    details = F.transform(F.array_sort(F.map_entries("details")), lambda entry: F.concat(
        F.lit("    "), entry["key"], F.lit(": "), entry["value"]))
    body = results.select(
        (F.col("ord") + 1).alias("section"),
        F.posexplode(F.concat(F.array(head), details)).alias("row", "line"))
    spark = results.sparkSession
    heading = one_row(spark).select(
        F.lit(0).alias("section"),
        F.posexplode(F.array(F.lit(title), F.lit("=" * 50))).alias("row", "line"))
    return heading.unionByName(body).withColumn("row", F.col("row").cast("bigint"))


def status(components: list[tuple[str, DataFrame | None, str, str | None]]) -> DataFrame:
    """State and size of each component ``(label, frame or None, unit, rated column)``.

    A component that could not be loaded has no frame and is reported as such.
    """
    spark = next(frame for _, frame, _, _ in components if frame is not None).sparkSession
    rows = None
    for position, (label, frame, unit, rated) in enumerate(components):
        if frame is None:
            row = one_row(spark).select(
                F.lit("FAIL").alias("state"), F.lit("not found").alias("details"))
        else:
            with_rated = F.concat(F.lit(" ("), F.count(rated), F.lit(f" with {rated})")) if rated \
                else F.lit("")
            row = frame.agg(
                F.concat(F.count(F.lit(1)), F.lit(f" {unit}"), with_rated).alias("details")
            ).select(F.lit("OK").alias("state"), "details")
        row = row.select(
            F.lit(position).alias("ord"), F.lit(label).alias("component"), "state", "details")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def typed_records(df: DataFrame, texts: list[str], whole: list[str], decimals: list[str],
                  ranges: dict[str, tuple]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the record type, typed, and rejected rows with their ``problems``.

    ``texts`` are required; ``whole`` and ``decimals`` are optional numbers that may come as
    text; ``ranges`` are closed. A zero fraction is accepted for whole numbers.
    """
    def number(name: str) -> Column:
        return F.col(name).try_cast("double")

    exact_types = ("string", "tinyint", "smallint", "int", "bigint")

    def as_whole(name: str) -> Column:
        whole = F.when(number(name) == F.rint(number(name)), number(name).try_cast("bigint"))
        if df.schema[name].dataType.simpleString() in exact_types:
            return F.coalesce(F.col(name).try_cast("bigint"), whole)
        return whole

    typed = {name: as_whole(name) for name in whole} | {name: number(name) for name in decimals}
    tests = [F.when(F.col(name).isNull(), F.lit(f"{name} is missing")) for name in texts]
    tests += [
        F.when(F.col(name).isNotNull() & value.isNull(), F.lit(f"{name} is no valid number"))
        for name, value in typed.items()]
    tests += [
        F.when(~number(name).between(low, high), F.lit(f"{name} is out of range"))
        for name, (low, high) in ranges.items()]
    judged = df.withColumn("problems", F.array_compact(F.array(*tests)))
    good = judged.filter(F.size("problems") == 0).withColumns(typed).drop("problems")
    return good, judged.filter(F.size("problems") > 0)
