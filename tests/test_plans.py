"""The report against a plain Python rendering, incremental steps, and file arrivals."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagetally import fixed
from pagetally.operators import extract, joins, scoring, summaries
from pagetally.operators.extract import pages_to_markdown
from pagetally.operators.outline import html_nodes
from pagetally.plans import report, steps
from pagetally.session import durable
from pagetally.sources.corpus import write_report
from pagetally.streaming.arrivals import run_arrivals
from tests.test_tables import RECORD_SCHEMA, make_records


def test_small_report(spark):
    rows = [(0, "Alpha", 40_000, 1_000, -5, "Bachelor's degree", 7.0, "a|b"),
            (1, "Beta", 120_000, 3_000, 12, "High school diploma or equivalent", 2.5, "c"),
            (2, "Gamma", None, None, -1, "", None, "")]
    frame = spark.createDataFrame(rows, RECORD_SCHEMA.replace("exposure bigint", "exposure double")
                                  .replace("exposure int", "exposure double"))
    lines = [r.line for r in report.report_lines(frame, title="T", intro=["Hello.", ""])
             .orderBy("section", "row").collect()]
    assert lines[:4] == ["# T", "", "Hello.", ""]
    shown = [
        "- Total occupations: 3", "- Total jobs: 4,000 (0M)", "- Total annual wages: $0.0T",
        "- Job-weighted average AI exposure: 3.6/10", "| <$35K | ", "| Alpha | 7/10 | -5% | 1K |",
        "| Gamma | ?/10 | -1% | ? |", "| Beta | 2.5/10 | +12% | 3K |",
        "## All 3 occupations", "### Exposure 7/10 (1 occupations, 1K jobs)",
        "| 1 | Alpha | $40,000 | 1K | -5% | Bachelor's | a/b |"]
    shown.remove("| <$35K | ")
    places = [lines.index(line) for line in shown]
    assert places == sorted(places)
    means = {line.split(" | ")[1] for line in lines if line.startswith("| $") or "K+" in line}
    assert means == {"7.0", "2.5"}


def test_summary_sections_as_text(spark):
    frame = spark.createDataFrame(make_records(50), RECORD_SCHEMA)
    lines = report.heading_lines(spark, "T", []).unionByName(report.summary_lines(frame))
    with pytest.raises(PySparkException):
        report.summary_text(lines).collect()
    texts = {r.section: r.text for r in report.summary_text(
        lines.filter(F.col("section") < report.DOWN)).collect()}
    assert set(texts) == {report.HEAD, report.TOTALS, report.TIERS, report.BANDS, report.GROUPS}
    assert texts[report.TIERS].split("\n")[0] == fixed.HEADINGS["tiers"]
    assert len(texts[report.TIERS].split("\n")) == 10


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "slug string, text string")


def test_incremental_step(spark):
    todo, done = frame(spark, ("a", "1"), ("b", "2")), frame(spark, ("a", "old"), ("c", "old"))
    step = lambda rows: rows.withColumn("text", F.concat("text", F.lit("!")))
    run = lambda force: {(r.slug, r.text) for r in steps.run_incremental(todo, done, step, force=force).collect()}
    assert run(False) == {("a", "old"), ("c", "old"), ("b", "2!")}
    assert run(True) == {("a", "1!"), ("b", "2!"), ("c", "old")}
    statuses = steps.run_statuses(frame(spark, ("a", ""), ("b", ""), ("x", "")), todo, done)
    assert {r.slug: r.status for r in statuses.collect()} == {"a": "cached", "b": "processed", "x": "missing"}
    forced = steps.run_statuses(frame(spark, ("a", ""), ("x", "")), todo, done, force=True)
    assert {r.slug: r.status for r in forced.collect()} == {"a": "processed", "x": "missing"}


def test_named_steps(spark):
    plan = {"double": lambda t: t["base"].withColumn("text", F.concat("text", "text")),
            "count": lambda t: t["double"].groupBy().count()}
    tables, unknown = steps.run_steps({"base": frame(spark, ("a", "x"))}, plan, ["double", "nope", "count"])
    assert unknown == ["nope"] and tables["double"].first().text == "xx" and tables["count"].first()[0] == 1


def test_forced_steps_are_told(spark):
    plan = {"made": lambda t, force: t["base"].withColumn("forced", F.lit(force)),
            "plain": lambda t: t["made"]}
    for force in (False, True):
        tables, _ = steps.run_steps({"base": frame(spark, ("a", "x"))}, plan, force=force)
        assert tables["plain"].first().forced is force


def test_arrivals_are_processed_once(spark, tmp_path):
    source, target = str(tmp_path / "pages"), str(tmp_path / "texts")
    step = lambda pages: pages_to_markdown(html_nodes(pages))

    def arrive(*rows):
        spark.createDataFrame(list(rows), "slug string, html string").coalesce(1).write.mode("append").parquet(source)
        run_arrivals(spark, source, "slug string, html string", step, target, "markdown")
        return {(r.slug, r.text) for r in spark.read.parquet(target).collect()}

    assert arrive(("a", "<h1>A</h1>")) == {("a", "# A\n")}
    assert arrive(("b", "<h1>B</h1>"), ("c", "")) == {
        ("a", "# A\n"), ("b", "# B\n"), ("c", "# Unknown Occupation\n")}
    assert spark.read.parquet(target).count() == 3


def test_pages_to_report(spark, tmp_path):
    """The whole way: pages, table, texts, ratings, records, report files."""
    master = spark.createDataFrame(
        [(i, f"Job {i}", f"j{i}", "cat", f"u{i}") for i in range(12)],
        "ord bigint, title string, slug string, category string, url string")
    page = ('<h1>{t}</h1><table id="quickfacts"><tbody><tr><th>Median Pay</th><td>${p} per year</td></tr>'
            "<tr><th>Number of Jobs</th><td>{j}</td></tr><tr><th>Job Outlook</th><td>{o}% (x)</td></tr>"
            "<tr><th>Entry-level Education</th><td>Master's degree</td></tr></tbody></table>")
    html = [(f"j{i}", page.format(t=f"Job {i}", p=f"{30 + i},000", j=f"{i},500", o=i - 3)) for i in range(11)]
    nodes = html_nodes(spark.createDataFrame(html, "slug string, html string"))
    table = extract.pages_to_table(master, nodes)
    old = spark.createDataFrame([], "slug string, title string, exposure double, rationale string, extras string")
    run = scoring.score_incremental(master, pages_to_markdown(nodes), old, scoring.length_scorer)
    assert {r.status: r.n for r in summaries.run_stats(run.statuses).collect()} == {"scored": 11, "no_input": 1}
    assert joins.build_compact(table, run.scores).count() == 11
    records = durable(joins.build_records(master, table, run.scores))
    write_report(report.report_lines(records), str(tmp_path / "report"))
    text = "".join(part.read_text() for part in sorted((tmp_path / "report").glob("part-*")))
    lines = text.splitlines()
    assert "- Total occupations: 12" in lines and "- Total jobs: 60,500 (0M)" in lines
    assert "| Job 0 | " in text and "-3% | 500 |" in text and "10K | +7% | Master's |" in text
    assert lines.index("## Aggregate statistics") < lines.index("## All 12 occupations")
