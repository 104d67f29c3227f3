"""Checks, status and record types."""

from pyspark.sql import functions as F

from pagetally.operators import quality

MASTER = "ord bigint, title string, slug string, category string, url string"


def verdict(frame):
    row = frame.first()
    return row.is_valid, row.message, row.details


def test_required_fields(spark):
    good = spark.createDataFrame([(0, "A", "a", "c", "u"), (1, "B", "b", "c", "u")], MASTER)
    assert verdict(quality.check_required(good)) == (True, "Master list valid: 2 rows", {"count": "2"})
    assert verdict(quality.check_required(good.limit(0)))[:2] == (False, "Master list is empty")
    assert verdict(quality.check_required(good.drop("url")))[:2] == (
        False, "Missing required fields in row: a")
    gaps = spark.createDataFrame([(0, "A", "a", "c", "u"), (1, None, "b", None, "u"), (2, "C", None, "c", "u")], MASTER)
    assert verdict(quality.check_required(gaps))[0] is True      # presence is about columns
    assert verdict(quality.check_required(gaps, nulls_fail=True))[:2] == (
        False, "Missing required fields in row: b")
    valid, message, details = verdict(quality.check_required(gaps, per_field=True, nulls_fail=True))
    assert (valid, message) == (False, "Master list missing required fields: 3 items")
    assert details == {"missing": "b: title, b: category, unknown: slug"}


def test_corpus(spark):
    docs = spark.createDataFrame([(f"s{i}", "" if i % 2 else "x") for i in range(20)] + [("z", None)],
                                 "slug string, text string")
    assert verdict(quality.check_corpus(docs, "html_files", "HTML")) == (
        False, "Found 11 empty HTML files", {"empty_files": "s1, s11, s13, s15, s17"})
    assert verdict(quality.check_corpus(docs.filter("text = 'x'"), "html_files", "HTML")) == (
        True, "HTML files valid: 10 files", {"count": "10"})
    assert verdict(quality.check_corpus(docs.limit(0), "html_files", "HTML"))[:2] == (False, "No HTML files found")


def test_columns_and_range(spark):
    table = spark.createDataFrame([("A", "a")], "title string, slug string")
    assert verdict(quality.check_columns(table))[:2] == (False, "CSV missing required columns: ['category']")
    assert verdict(quality.check_columns(table, columns=["title"])) == (
        True, "CSV valid: 1 rows", {"count": "1", "columns": "title, slug"})
    scores = spark.createDataFrame([("a", 0.0), ("b", 10.0), ("c", None)], "slug string, exposure double")
    assert verdict(quality.check_range(scores)) == (
        True, "Scores valid: 3 entries (2 with exposure)", {"count": "3", "with_exposure": "2"})
    bad = scores.union(spark.createDataFrame([("e", 11.0), ("d", -1.0)], scores.schema))
    assert verdict(quality.check_range(bad)) == (
        False, "Found 2 scores with invalid exposure values", {"invalid": "d, e"})


def test_report_and_missing_inputs(spark, tmp_path):
    scores = spark.createDataFrame([("a", 5.0)], "slug string, exposure double")
    results = quality.validate_all(spark, {
        "master_list": lambda: quality.check_required(spark.read.parquet(str(tmp_path / "none"))),
        "scores": lambda: quality.check_range(scores)})
    lines = [r.line for r in quality.quality_report(results).orderBy("section", "row").collect()]
    assert lines == [
        "Data Validation Report", "=" * 50, "[FAIL] Master List: Failed to load master_list: PATH_NOT_FOUND",
        "[OK] Scores: Scores valid: 1 entries (1 with exposure)", "    count: 1", "    with_exposure: 1"]
    status = quality.status([("Scores", scores, "entries", "exposure"), ("CSV", None, "rows", None)])
    assert [(r.component, r.state, r.details) for r in status.orderBy("ord").collect()] == [
        ("Scores", "OK", "1 entries (1 with exposure)"), ("CSV", "FAIL", "not found")]


def test_typed_records(spark):
    rows = [("T", "a", "5", "7.0", "1.5"), ("T", "b", "11", None, None), (None, "c", "1", "x", ""),
            ("T", "d", None, "7.5", "9"), ("T", "e", "9007199254740993", "1", "2")]
    frame = spark.createDataFrame(rows, "title string, slug string, exposure string, jobs string, hourly string")
    good, bad = quality.typed_records(frame, ["title", "slug"], ["exposure", "jobs"], ["hourly"], {"exposure": (0, 10)})
    assert [(r.slug, r.exposure, r.jobs, r.hourly) for r in good.collect()] == [("a", 5, 7, 1.5)]
    assert {r.slug: r.problems for r in bad.collect()} == {
        "b": ["exposure is out of range"],
        "c": ["title is missing", "jobs is no valid number", "hourly is no valid number"],
        "d": ["jobs is no valid number"], "e": ["exposure is out of range"]}
    assert dict(good.dtypes)["exposure"] == "bigint" and dict(good.dtypes)["hourly"] == "double"


def _as_rows(results):
    return [(r.check, r.is_valid, r.message, r.details) for r in results.orderBy("ord").collect()]


def test_checks_of_a_table_in_one_pass(spark, tmp_path):
    """The same rows as one job a check, while the table is written; bad rows are named."""
    rows = [(i, f"s{i:02}", "T" if i % 7 else None, 11.0 if i % 4 == 0 else 5.0) for i in range(40)]
    frame = spark.createDataFrame(rows, "ord int, slug string, title string, exposure double")
    checks = [quality.in_range(frame), quality.has_columns(frame),
              quality.required_fields(frame, columns=["title", "slug"], nulls_fail=True, per_field=True),
              quality.required_fields(frame, "first", columns=["title"], nulls_fail=True),
              quality.required_fields(frame, "fine", columns=["slug"], rated="exposure")]
    alone = _as_rows(quality.validate_all(spark, {c.name: lambda c=c: c.of(frame) for c in checks}))
    assert [valid for _, valid, _, _ in alone] == [False, False, False, False, True]
    assert alone[0][3] == {"invalid": "s00, s04, s08, s12, s16"}
    assert _as_rows(quality.check_table(frame, checks)) == alone
    path = str(tmp_path / "table")
    written = quality.check_while(frame, checks, lambda f: f.write.parquet(path),
                                  lambda: spark.read.parquet(path))
    assert _as_rows(written) == alone and spark.read.parquet(path).count() == 40
    assert _as_rows(quality.check_table(frame.limit(0), checks))[0][2] == "Scores is empty"


def test_passing_checks_are_one_job(spark):
    frame = spark.createDataFrame([(i, f"s{i}", 5.0) for i in range(9)], "ord int, slug string, exposure double")
    checks = [quality.in_range(frame), quality.required_fields(frame, columns=["slug"])]
    context = spark.sparkContext
    context.setJobGroup("one pass", "checks")
    try:
        results = quality.check_table(frame, checks)
        jobs = len(context.statusTracker().getJobIdsForGroup("one pass"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # the aggregate is one query, whose exchange and result AQE runs as two jobs
    assert jobs <= 2 and [r.is_valid for r in results.collect()] == [True, True]


def test_a_check_that_fails_while_it_runs(spark, tmp_path):
    frame = spark.createDataFrame([(0, "a", "5"), (1, "b", "x")], "ord int, slug string, exposure string")
    typed = F.col("exposure").cast("int")
    bad = quality.Check("typed", {"n": F.sum(typed)}, lambda counts, names: counts)
    checks = [bad, quality.required_fields(frame, columns=["slug"])]
    path = str(tmp_path / "table")
    for results in (quality.check_table(frame, checks), quality.check_while(
            frame, checks, lambda f: f.write.mode("overwrite").parquet(path))):
        rows = _as_rows(results)
        assert [(name, valid) for name, valid, _, _ in rows] == [("typed", False), ("master_list", True)]
        assert rows[0][2].startswith("Failed to load typed: CAST_INVALID_INPUT")
    assert spark.read.parquet(path).count() == 2
