"""Markup to nodes, sections, Markdown and table rows."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagetally import fixed
from pagetally.catalogue import queries
from pagetally.operators import extract, outline
from pagetally.operators.outline import Outline, html_nodes, node_rows
from pagetally.session import spread

PAGE = (
    "<html><head><title>Bakers at work</title><link rel=canonical href='https://example.org/baker'>"
    "</head><body><h1>Baker</h1>"
    "<table id=quickfacts><tbody><tr><th>Median Pay</th><td>$31,200 per year</td></tr>"
    "<tr><th>Entry-Level Education</th><td>No formal credential</td></tr></tbody></table>"
    "<div id=panes><div id=tab-2><article><h2><span>Tasks</span></h2>"
    "<p>Bakers mix dough<br>and bake it.</article></div></div>"
    "<p class=update>Checked: May 2023</p></body></html>")


@pytest.fixture
def pages(spark):
    def make(*texts):
        frame = spark.createDataFrame(list(enumerate(texts)), "slug int, html string")
        return html_nodes(frame)
    return make


def one(frame):
    return frame.first()


def test_page_becomes_markdown(pages):
    text = one(extract.pages_to_markdown(pages(PAGE))).text
    lines = [line for line in text.split("\n") if line]
    assert lines == [
        "# Baker", "**Source:** https://example.org/baker", "## Quick Facts",
        "| Field | Value |", "|-------|-------|", "| Median Pay | $31,200 per year |",
        "| Entry-Level Education | No formal credential |", "## Tasks",
        lines[8], "---", "*Checked: May 2023*"]
    assert lines[8].split() == "Bakers mix dough and bake it.".split() or \
        lines[8] == "Bakers mix doughand bake it."


def test_empty_and_missing_pages(pages):
    rows = extract.pages_to_markdown(pages("<html><body></body></html>", "", None)).collect()
    assert {row.slug: row.text for row in rows} == {
        0: "# Unknown Occupation\n", 1: "# Unknown Occupation\n", 2: None}


def test_facts(pages):
    got = one(extract.facts(pages(PAGE))).facts
    assert [(f.field, f.value) for f in got] == [
        ("Median Pay", "$31,200 per year"), ("Entry-Level Education", "No formal credential")]
    no_body = "<table id=quickfacts><tr><th>a</th><td>b</td></tr></table>"
    halves = "<table id=quickfacts><tbody><tr><th>a</th></tr><tr><td>b</td></tr>" \
             "<tr><th>c</th><td></td></tr></tbody></table>"
    rows = {row.slug: row.facts for row in extract.facts(pages(no_body, halves)).collect()}
    assert rows[0] == [] and [(f.field, f.value) for f in rows[1]] == [("c", "")]


def fact_page(*facts):
    body = "".join(f"<tr><th>{field}</th><td>{value}</td></tr>" for field, value in facts)
    return f'<table id="quickfacts"><tbody>{body}</tbody></table>'


def test_facts_to_wide(pages):
    page = fact_page(
        ("2024 Median Pay", "$41,600 per year"), ("Typical Entry-level Education", "None"),
        ("Work experience", "5 years"), ("On-the-job Training", "Long"), ("Number of Jobs", "1,234"),
        ("Job Outlook", "4% (As fast)"), ("Employment Change", "-12"),
        ("Number of Jobs, later", "See notes"), ("ON-THE-JOB TRAINING", ""),
        ("Job outlook and employment change", "9%"))
    row = one(extract.facts_to_wide(extract.facts(pages(page))))
    assert (row.median_pay_annual, row.median_pay_hourly) == ("41600", "20.00")
    assert (row.entry_education, row.work_experience) == ("None", "5 years")
    assert row.num_jobs_2024 == "See notes"      # a later row of the kind counts
    assert row.training == ""                    # even if it is empty
    assert (row.outlook_pct, row.outlook_desc) == ("9", "")     # first phrase of the chain decides
    assert row.employment_change == "-12"


def test_first_row_cells(pages):
    def table(*cells):
        return ('<table id="outlook-table"><tbody><tr>' + "".join(f"<td>{c}</td>" for c in cells)
                + "</tr><tr><td>9</td></tr></tbody></table>")
    rows = extract.first_row_cells(pages(
        table("T", "15-1", "1", "2,000"), table("T", "—", "1", "x "), table("T", "15-1", "1"),
        "<p>")).orderBy("slug").collect()
    assert [(r.soc_code, r.projected_employment_2034) for r in rows] == [
        ("15-1", "2000"), ("", "x"), ("", ""), ("", "")]


def test_sections(pages):
    page = """<div id="panes">
      <div id="tab-5"><h2>Late</h2><p>no article</p></div>
      <div id="tab-1"><article><h2>Summary</h2></article></div>
      <div id="tab-2"><h2>outer</h2><article><h2>More <span> Inner </span></h2></article></div>
      <div id="tab-3"><article><p>no heading</p></article></div>
      <div id="tab-4"></div>
      <div id="tab-7"><h2>Skipped</h2></div></div>
      <div id="tab-6"><h2>Outside</h2></div>"""
    found = one(extract.sections(pages(page))).sections
    assert [(s.tab, s.title) for s in found] == [("tab-2", "Inner"), ("tab-5", "Late")]


def section_text(pages, inner, tab="tab-4"):
    page = f'<div id="panes"><div id="{tab}"><article><h2>S</h2>{inner}</article></div></div>'
    text = one(extract.pages_to_markdown(pages(page))).text
    head = "# Unknown Occupation\n\n## S\n\n"
    assert text.startswith(head) or text == head[:-1]
    return text[len(head):]


def test_blocks_are_direct_children(pages):
    inner = ("<p> a  b</p><p> </p><div><p>deep</p></div><h3>Sub</h3><h2>again</h2>"
             "<ul><li>x<ul><li>y</li></ul></li></ul><ol><li>z</li></ol>"
             '<div class="big ooh_right_img"><p>img</p></div>')
    assert section_text(pages, inner) == "a b\n\n### Sub\n\n- xy\n- y\n"


def test_generic_tables(pages):
    inner = ("<table><thead><tr><th>a</th><th>b</th><th>c</th></tr></thead><tr><td></td><td> </td></tr>"
             "<tr><td>1</td></tr><tr></tr></table><table><tr><td></td></tr></table>"
             '<table id="outlook-table"><tbody><tr><td>no</td></tr></tbody></table>')
    assert section_text(pages, inner) == "| --- | --- | --- |\n| a | b | c |\n| 1 |  |  |\n"


def test_charts(pages):
    chart = ('<div class="x ooh-chart"><p>Pay</p><dl><dt>A</dt><dt>B</dt><dt>C</dt>'
             "<dd><span>n</span><span>$5</span><span>$6</span></dd><dd><span>7%</span></dd></dl></div>")
    assert section_text(pages, "<p>after</p><section>" + chart + "</section>") == (
        "*Pay*\n\n- **A**: $5\n- **B**: 7%\n\nafter\n")
    assert section_text(pages, '<div class="ooh-chart"><p>no list</p></div>') == ""
    assert section_text(pages, '<div class="ooh-chart"><dl><dt>A</dt><dd><span>5%</span></dd></dl></div>') == (
        "- **A**: 5%\n")


def test_projections_only_in_their_tab(pages):
    table = ('<table id="outlook-table"><tbody><tr><th>T</th><td>1</td><td></td><td>Get data</td>'
             "<td>5</td><td>6</td><td>7</td></tr><tr></tr></tbody></table>")
    assert section_text(pages, table, "tab-6") == (
        "### Employment Projections\n\n- **Occupational Title:** T\n- **SOC Code:** 1\n"
        "- **Change % 2024-34:** 5\n- **Change Numeric 2024-34:** 6\n")
    assert section_text(pages, table, "tab-5") == ""
    assert section_text(pages, '<table id="outlook-table"></table>', "tab-6") == (
        "### Employment Projections\n")


def test_rough_markup(pages):
    page = ("<!DOCTYPE html><h1 class=big>A &amp; B<br>C<!-- no --></h1><script>var x='<h1>no</h1>';</script>"
            "<p class='note update'>un<b>closed<p>x</p><style>p{}</style></div>&copy; &#233;")
    row = one(extract.page_footer(extract.page_header(pages(page))))
    assert row.title == "A & BC"
    assert row.updated == "unclosedx© é"


def test_node_positions(pages):
    rows = {r.pos: r for r in node_rows(pages("<div><p>a<b>c</b></p><br>d</div>e")).collect()}
    shape = [(rows[i].parent, rows[i].last, rows[i].tag, rows[i].text) for i in sorted(rows)]
    assert shape == [
        (0, 7, "div", None), (1, 5, "p", None), (2, 3, None, "a"), (2, 5, "b", None),
        (4, 5, None, "c"), (1, 6, "br", None), (1, 7, None, "d"), (0, 8, None, "e")]


class Standard(Outline):
    """Reads every page with the standard parser only."""

    def read_plain(self, html):
        return 0


def joined_text(outline):
    nodes = []
    for node, last in zip(outline.nodes, outline.lasts):
        if node[1] is None and nodes and nodes[-1][1] is None and nodes[-1][0] == node[0]:
            nodes[-1] = (*nodes[-1][:-1], nodes[-1][-1] + node[-1])
        else:
            nodes.append(node)
    return [node[1:] for node in nodes]


def test_plain_pattern_agrees_with_the_standard_parser():
    random.seed(7)
    pieces = [
        "<p>", "</p>", "<b>", "</b>", "text", "a &amp; b", "&foo; x", "<br>", "<br/>", "<p/>", "<!-- c -->",
        "<!---->", "<!-->", "<script>", "</script>", 'var x="</p>";', "<style>", "</style>", "<title>",
        "</title>", '<a href="x">', "<a href='y'>", "<a href=z>", '<A HREF="q" CLASS="b  c">', "</A>", "<",
        " < 3", ">", "&", "<!DOCTYPE html>", "<![CDATA[x]]>", "<?php x ?>", "<textarea>", "</textarea>",
        '<div id="a" id="b">', "</div >", "</ div>", '<script src="a"/>', '<td\nclass="x y">', "é", "<x-y>",
        "<script ", "</script x>", "--", "-->", '"', '<a b="<c>">', "\n", "<template>", "</template>",
        "<noscript>", "</noscript>", "<p class>", "</p", "<p", "<title/>"]
    for _ in range(20_000):
        html = "".join(random.choice(pieces) for _ in range(random.randint(1, 14)))
        fast, standard = Outline(), Standard()
        assert fast.read(html) == standard.read(html), html
        assert joined_text(fast) == joined_text(standard), html


def test_index_entries_and_aliases(spark, pages):
    page = """<div class="big a-z-list"><ul>
      <li><a href="/b">Beta</a></li>
      <li><a href="/x">Bee <b> keeper </b></a>, see: <a href="/b">Beta two</a></li>
      <li>Lost, see nothing <a href="/y">one</a></li>
      <li>no link</li>
      <li><a href="/a">alpha</a></li></ul></div><ul><li><a href="/n">outside</a></li></ul>"""
    entries = extract.index_entries(pages(page)).withColumn("ord", F.col("entry").cast("bigint"))
    rows = {row.entry: row for row in entries.collect()}
    assert len(rows) == 5 and rows[1].names == ["Beekeeper", "Beta two"] and rows[3].hrefs == []
    canonical, aliases = extract.resolve_aliases(entries)
    assert {(r.url, r.title, r.ord) for r in canonical.collect()} == {("/b", "Beta", 0), ("/a", "alpha", 4)}
    assert [(r.alias, r.canonical, r.url) for r in aliases.collect()] == [("Beekeeper", "Beta two", "/b")]


def test_unknown_declarations_do_not_lose_a_page(pages):
    text = one(extract.pages_to_markdown(pages(
        '<h1>T</h1><![foo[bar]]><div id="panes"><div id="tab-2"><h2>A</h2><p>kept</p></div></div>'))).text
    assert "kept" in text and text.startswith("# T")


def test_large_pages_are_batches_of_their_own():
    import pyarrow as pa
    from pagetally.operators import outline
    big = "<p>" + "x" * outline.BYTES_AT_ONCE + "</p>"
    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 3, 4, 5], "html": ["a", big, None, "b", ""]})
    parts = list(outline._outline_batches([batch]))
    assert [p.column(0).to_pylist() for p in parts] == [[1], [2], [3, 4, 5]]
    assert list(outline._outline_batches([batch.slice(0, 0)])) == []


def test_structured_table_columns_and_missing_pages(spark, pages):
    master = spark.createDataFrame(
        [(0, "Dev", "0", "tech", "u0"), (1, "None", "9", "x", "u9")],
        "ord bigint, title string, slug string, category string, url string")
    nodes = pages(PAGE).withColumn("slug", F.col("slug").cast("string"))
    table = extract.pages_to_table(master, nodes)
    assert table.columns == ["ord", *fixed.TABLE_COLUMNS]
    row = table.collect()
    assert len(row) == 1 and (row[0].title, row[0].median_pay_annual, row[0].median_pay_hourly,
                              row[0].entry_education, row[0].soc_code) == (
        "Dev", "31200", "15.00", "No formal credential", "")


def test_large_pages_keep_their_whole_text(pages):
    words = " ".join(f"w{i}" for i in range(60_000))
    text = one(extract.pages_to_markdown(pages(
        f'<div id="panes"><div id="tab-2"><h2>T</h2><p>{words}</p></div></div>'))).text
    assert text.split("\n")[4] == words


def test_pages_read_together_equal_pages_read_one_by_one():
    random.seed(11)
    pieces = [
        "<p>", "</p>", "<P class=\"a  b\">", "<br>", "<br/>", "<p/>", "<li>", "<ul>", "</ul>", "text", " ", "é &amp; x",
        "&lt", "<!-- c -->", "<!--a>b-->", "<!--", "-->", "<script>", "</script>", "</SCRIPT>", "<SCRIPT src=\"a\">",
        "<script ", "var x='</p>';", "x > y", "<title>", "</title>", "</Title>", "<title/>", "<style>", "</style>",
        "<textarea>", "</textarea>", "<template>", "</template>", "<rt>", "</rt>", "<a href=\"u>v\">",
        "<a href=\"u<v\">", "<a href='q'>", "<a href=\"r&amp;s\">", "<a rel=\"x  y\" rel=\"z\" href=\"\">", "</a>",
        "<!doctype html>", "<?php", "<", ">", "</", "</ p>", "<script/>", "\x00", "</br>", "</p >", "日本"]
    for _ in range(1_000):
        pages = pa.array([
            None if random.random() < 0.03 else "".join(
                random.choice(pieces) for _ in range(random.randint(0, random.choice([3, 8, 25]))))
            for _ in range(random.randint(0, 20))], pa.string())
        one_by_one = outline._read_each(pages.to_pylist())
        assert outline._node_arrays(pages).equals(one_by_one), pages.to_pylist()
        assert outline._node_arrays(pages.slice(1)).to_pylist() == one_by_one.to_pylist()[1:]


def test_plain_pages_are_not_read_one_by_one(monkeypatch):
    monkeypatch.setattr(outline, "_read_each", None)
    page = '<title>a</title><script>if (a < b) "</p>"</script><ul><li>a &amp; b<li><b>c</ul><!-- d -->e'
    lists = outline._node_arrays(pa.array([page, "", page])).to_pylist()
    assert lists[0] == lists[2] and lists[1] == []
    assert [node["text"] or node["tag"] for node in lists[0]] == [
        "title", "a", "script", "ul", "li", "a & b", "li", "b", "c", "e"]


def test_facts_are_computed_once(spark, monkeypatch):
    nodes = spark.createDataFrame([("a", PAGE)], "slug string, html string")
    monkeypatch.setattr(queries.standins, "order_pages", lambda spark, folder: nodes)
    rows = queries.QUERIES["facts"](spark, "")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("quickfacts") == 1
    assert [tuple(row) for row in rows.collect()] == [
        ("a", 0, "Median Pay", "$31,200 per year"), ("a", 1, "Entry-Level Education", "No formal credential")]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the given tables are not here")
def test_rows_are_dealt_out_before_they_become_pages(spark):
    for make in (queries.standins.order_pages, queries.standins.part_pages):
        pages = spread(make(spark, "/root/testdata/sf0.001"))
        plan = pages._jdf.queryExecution().optimizedPlan().toString()
        assert "html" in plan.split("Repartition")[0] and "html" not in plan.split("Repartition")[1]
        assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_white_space_class_is_the_unicode_property(spark):
    marks = spark.range(0x110000).filter("id not between 55296 and 57343").select(
        F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("mark"))
    differ = F.col("mark").rlike(f"^{fixed.WHITESPACE}$") != F.col("mark").rlike(r"^(?U)[\s\x1c-\x1f]+$")
    assert marks.filter(differ).count() == 0
