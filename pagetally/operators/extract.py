"""Page content from node arrays, as expressions on the page's own row.

Every function takes a frame with a ``nodes`` column (see ``outline.html_nodes``) and adds
columns, so a page never leaves its task between markup and result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagetally import fixed
from pagetally.functions.arrays import (
    as_value, drop_blank_rows, let, pad_rows, pipe_row, table_width, zip_short)
from pagetally.functions.parsing import impute_pay, parse_number, parse_outlook, parse_pay
from pagetally.functions.predicates import contains_any, has_token, money_or_percent, truthy_text
from pagetally.functions.text import clean_text, dash_to_missing, strip
from pagetally.operators.joins import skew_join
from pagetally.operators.keyed import first_wins
from pagetally.operators.ordering import number_rows, title_order


def page_nodes() -> Column:
    return F.col("nodes")


def no_lines() -> Column:
    return F.array().cast("array<string>")


# --- finding nodes ----------------------------------------------------------------

def within(node: Column) -> Column:
    """Descendants of a node, in document order."""
    return F.slice(page_nodes(), node["pos"] + 1, node["last"] - node["pos"])


def within_scope(node: Column, scope: Column) -> Column:
    """As :func:`within`, out of consecutive nodes that hold the node, such as those within another.

    A slice takes time in proportion to the array it is cut from, so cut from a small one.
    """
    first = F.get(scope, F.lit(0))["pos"]
    return F.slice(scope, node["pos"] - first + 2, node["last"] - node["pos"])


def children(node: Column) -> Column:
    """Direct children of a node."""
    return F.filter(within(node), lambda child: child["parent"] == node["pos"])


def tagged(*tags: str):
    return lambda node: node["tag"].isin(*tags) if len(tags) > 1 else node["tag"] == tags[0]


def identified(tag: str, value: str):
    return lambda node: (node["tag"] == tag) & (node["id"] == value)


def classed(tag: str, token: str):
    return lambda node: (node["tag"] == tag) & has_token(node["class"], token)


def find(nodes: Column, test) -> Column:
    """First matching node, or null."""
    return F.get(F.filter(nodes, test), F.lit(0))


def raw_text(node: Column) -> Column:
    """All text below a node."""
    return F.array_join(within(node)["text"], "")


def text_of(node: Column) -> Column:
    """All text below a node, whitespace collapsed."""
    return clean_text(raw_text(node))


def text_in(node: Column, scope: Column) -> Column:
    """As :func:`text_of`, out of consecutive nodes that hold the node."""
    return clean_text(F.array_join(within_scope(node, scope)["text"], ""))


def link_text(node: Column) -> Column:
    """Text pieces below a node, each stripped, joined without separator."""
    return F.array_join(F.transform(within(node)["text"], strip), "")


def cell_texts(inner: Column) -> Column:
    """Texts of the cells among the descendants of a table row."""
    return F.transform(F.filter(inner, tagged("td", "th")), lambda cell: text_in(cell, inner))


def row_cells(row: Column) -> Column:
    """Texts of the cells of a table row."""
    return let(within(row), cell_texts)


# --- header, facts, footer -----------------------------------------------------------

def page_header(pages: DataFrame) -> DataFrame:
    """Adds ``title`` (first heading, or a stand-in) and ``canonical`` (link target or null)."""
    found = pages.withColumns({
        "_h1": find(page_nodes(), tagged("h1")),
        "_link": find(page_nodes(), lambda node: (node["tag"] == "link") & has_token(
            node["rel"], "canonical")),
    })
    return found.withColumns({
        "title": F.when(F.col("_h1").isNull(), fixed.UNTITLED).otherwise(text_of(F.col("_h1"))),
        "canonical": F.col("_link.href"),
    }).drop("_h1", "_link")


def _table_body(table_id: str) -> Column:
    """Descendants of the body of a table."""
    table = let(find(page_nodes(), identified("table", table_id)), within)
    return let(table, lambda inner: let(
        find(inner, tagged("tbody")), lambda body: within_scope(body, inner)))


def facts(pages: DataFrame, table_id: str = fixed.FACT_TABLE) -> DataFrame:
    """Adds ``facts``: label and value of each body row that has both a ``th`` and a ``td``."""
    def fact(inner: Column) -> Column:
        return let(F.struct(find(inner, tagged("th")).alias("th"),
                            find(inner, tagged("td")).alias("td")),
                   lambda pair: F.when(
                       pair["th"].isNotNull() & pair["td"].isNotNull(),
                       F.struct(text_in(pair["th"], inner).alias("field"),
                                text_in(pair["td"], inner).alias("value"))))

    def all_facts(body: Column) -> Column:
        return F.array_compact(F.transform(
            F.filter(body, tagged("tr")), lambda row: let(within_scope(row, body), fact)))

    return pages.withColumn("facts", F.coalesce(
        let(_table_body(table_id), all_facts),
        F.array().cast("array<struct<field:string,value:string>>")))


def page_footer(pages: DataFrame) -> DataFrame:
    """Adds ``updated``: text of the last-modified paragraph, or null."""
    return pages.withColumn("_update", find(page_nodes(), classed("p", fixed.UPDATE_CLASS))).withColumn(
        "updated", F.when(F.col("_update").isNotNull(), text_of(F.col("_update")))
    ).drop("_update")


# --- sections -------------------------------------------------------------------------

def sections(pages: DataFrame) -> DataFrame:
    """Adds ``sections``: tab, title and container node of each tab that has a heading."""
    def section(tab: Column) -> Column:
        pane = find(within(F.col("_panes")), lambda node: (node["tag"] == "div") & (
            node["id"] == tab))
        return let(pane, lambda pane: let(
            F.coalesce(find(within(pane), tagged("article")), pane),
            lambda box: let(find(within(box), tagged("h2")), lambda heading: let(
                F.coalesce(find(within(heading), tagged("span")), heading),
                lambda named: F.when(heading.isNotNull(), F.struct(
                    tab.alias("tab"), text_of(named).alias("title"), box.alias("box")))))))

    tabs = F.array(*[F.lit(tab) for tab in fixed.SECTION_TABS])
    return pages.withColumn("_panes", find(page_nodes(), identified("div", fixed.PANES))).withColumn(
        "sections", F.array_compact(F.transform(tabs, section))
    ).drop("_panes")


def chart_parts(chart: Column) -> Column:
    """Subtitle and labelled amounts of a chart node."""
    def amount(node: Column) -> Column:
        texts = F.transform(F.filter(within(node), tagged("span")), text_of)
        return F.get(F.filter(texts, lambda text: (text != "") & money_or_percent(text)), F.lit(0))

    def items(box: Column) -> Column:
        pairs = zip_short(
            F.filter(within(box), tagged("dt")), F.filter(within(box), tagged("dd")),
            lambda label, value: F.struct(
                text_of(label).alias("label"), amount(value).alias("value")))
        return F.filter(pairs, lambda item: item["value"].isNotNull())

    none = F.array().cast("array<struct<label:string,value:string>>")
    return F.struct(
        F.coalesce(let(find(within(chart), tagged("p")), text_of), F.lit("")).alias("subtitle"),
        F.coalesce(let(find(within(chart), tagged("dl")), items), none).alias("items"))


def chart_of(box: Column) -> Column:
    """Chart parts of a section container; no items when it has no chart."""
    return let(find(within(box), classed("div", fixed.CHART_CLASS)), chart_parts)


def table_rows(table: Column) -> Column:
    """Rows of a table as text cells: blank rows dropped, short rows padded."""
    rows = F.transform(F.filter(within(table), tagged("tr")), row_cells)
    return let(drop_blank_rows(rows), pad_rows)


def projection_rows(table: Column) -> Column:
    """Labelled cells per body row of a projections table; rows without cells are dropped."""
    labels = F.array(*[F.lit(label) for label in fixed.PROJECTION_LABELS])

    def labelled(cells: Column) -> Column:
        pairs = zip_short(labels, cells, lambda label, value: F.struct(
            label.alias("label"), value.alias("value")))
        return F.filter(pairs, lambda cell: (cell["value"] != "") & (
            cell["value"] != fixed.NO_DATA))

    def rows(body: Column) -> Column:
        cells = F.transform(F.filter(within(body), tagged("tr")), row_cells)
        return F.transform(F.filter(cells, lambda row: F.size(row) > 0), labelled)

    return let(find(within(table), tagged("tbody")), rows)


def block_parts(box: Column) -> Column:
    """Text blocks that are direct children of a container: kind, node and text."""
    def block(node: Column) -> Column:
        kind = (
            F.when(node["tag"].isin("h3", "p", "ul"), node["tag"])
            .when((node["tag"] == "table") & ~F.coalesce(
                node["id"] == fixed.PROJECTION_TABLE, F.lit(False)), "table")
        )
        return F.when(kind.isNotNull(), F.struct(kind.alias("kind"), node.alias("node")))

    return F.array_compact(F.transform(children(box), block))


# --- Markdown --------------------------------------------------------------------------

def lines(*texts) -> Column:
    return F.array(*[F.lit(text) if isinstance(text, str) else text for text in texts])


def _chart_lines(box: Column) -> Column:
    def drawn(chart: Column) -> Column:
        subtitle = F.when(truthy_text(chart["subtitle"]), lines(
            F.concat(F.lit("*"), chart["subtitle"], F.lit("*")), "")).otherwise(no_lines())
        items = F.transform(chart["items"], lambda item: F.concat(
            F.lit("- **"), item["label"], F.lit("**: "), item["value"]))
        return F.when(F.size(chart["items"]) > 0, F.concat(subtitle, items, lines("")))
    return F.coalesce(let(chart_of(box), drawn), no_lines())


def _table_lines(table: Column) -> Column:
    def drawn(rows: Column) -> Column:
        rule = pipe_row(F.array_repeat(F.lit("---"), table_width(rows)))
        return F.when(F.size(rows) > 0, F.concat(
            F.array(rule), F.transform(rows, pipe_row), lines("")))
    return F.coalesce(let(table_rows(table), drawn), no_lines())


def _block_lines(block: Column) -> Column:
    node, kind = block["node"], block["kind"]
    bullets = F.transform(F.filter(within(node), tagged("li")), lambda item: F.concat(
        F.lit("- "), text_of(item)))
    paragraph = let(text_of(node), lambda text: F.when(text != "", lines(text, "")).otherwise(
        no_lines()))
    return (
        F.when(kind == "h3", lines(F.concat(F.lit("### "), text_of(node)), ""))
        .when(kind == "p", paragraph)
        .when(kind == "ul", F.concat(bullets, lines("")))
        .otherwise(_table_lines(node))
    )


def _projection_lines(box: Column) -> Column:
    def drawn(table: Column) -> Column:
        rows = F.coalesce(projection_rows(table), F.array().cast(
            "array<array<struct<label:string,value:string>>>"))
        body = F.flatten(F.transform(rows, lambda row: F.concat(
            F.transform(row, lambda cell: F.concat(
                F.lit("- **"), cell["label"], F.lit(":** "), cell["value"])), lines(""))))
        return F.when(table.isNotNull(), F.concat(lines("### Employment Projections", ""), body))
    return F.coalesce(
        let(find(within(box), identified("table", fixed.PROJECTION_TABLE)), drawn), no_lines())


def _section_lines(section: Column) -> Column:
    box = section["box"]
    projections = F.when(section["tab"] == fixed.PROJECTION_TAB, _projection_lines(box)).otherwise(
        no_lines())
    return F.concat(
        lines(F.concat(F.lit("## "), section["title"]), ""),
        _chart_lines(box),
        F.flatten(F.transform(block_parts(box), _block_lines)),
        projections,
    )


def pages_to_markdown(pages: DataFrame, name: str = "text") -> DataFrame:
    """Adds the page as Markdown text; a page that could not be read gives null."""
    parts = page_footer(sections(facts(page_header(pages))))
    fact_rows = F.transform("facts", lambda fact: F.concat(
        F.lit("| "), fact["field"], F.lit(" | "), fact["value"], F.lit(" |")))
    fact_lines = F.concat(
        lines("## Quick Facts", "", "| Field | Value |", "|-------|-------|"), fact_rows, lines(""))
    has_facts = F.exists(page_nodes(), identified("table", fixed.FACT_TABLE))
    text = F.concat(
        lines(F.concat(F.lit("# "), F.col("title")), ""),
        F.when(F.col("canonical").isNotNull(), lines(
            F.concat(F.lit("**Source:** "), F.col("canonical")), "")).otherwise(no_lines()),
        F.when(has_facts, fact_lines).otherwise(no_lines()),
        F.flatten(F.transform(F.coalesce("sections", F.array().cast(
            parts.schema["sections"].dataType)), _section_lines)),
        F.when(F.col("updated").isNotNull(), lines(
            "---", F.concat(F.lit("*"), F.col("updated"), F.lit("*")), "")).otherwise(no_lines()),
    )
    keep = [F.col(column) for column in pages.columns if column not in ("nodes", name)]
    return parts.select(*keep, F.when(page_nodes().isNotNull(), F.array_join(text, "\n")).alias(name))


# --- structured table -------------------------------------------------------------------

def fact_kind(field: Column) -> Column:
    """Kind of a fact label: the first phrase its lower-cased text contains."""
    def kind_of(label: Column) -> Column:
        kind = F.lit(None).cast("string")
        for phrase, name in reversed(fixed.FACT_KINDS):
            kind = F.when(label.contains(phrase), name).otherwise(kind)
        return kind

    return let(F.lower(field), kind_of)


def facts_to_wide(pages: DataFrame) -> DataFrame:
    """Adds the table columns that the ``facts`` array gives; the last fact of a kind counts."""
    kinds = pages.withColumn("_kinds", F.transform("facts", lambda fact: F.struct(
        fact_kind(fact["field"]).alias("kind"), fact["value"].alias("value"))))

    def value(kind: str) -> Column:
        of_kind = F.filter("_kinds", lambda fact: fact["kind"] == kind)
        return F.coalesce(F.try_element_at(of_kind, F.lit(-1))["value"], F.lit(""))

    raw = kinds.withColumns({f"_{kind}": value(kind) for _, kind in fixed.FACT_KINDS}).drop("_kinds")
    parsed = raw.withColumn("_pay", parse_pay(F.col("_pay"))).withColumn(
        "_outlook", parse_outlook(F.col("_outlook"))
    ).withColumn("_pay", impute_pay(F.col("_pay.annual"), F.col("_pay.hourly")))
    return parsed.select(
        *[F.col(name) for name in pages.columns],
        F.col("_pay.annual").alias("median_pay_annual"),
        F.col("_pay.hourly").alias("median_pay_hourly"),
        F.col("_education").alias("entry_education"),
        F.col("_experience").alias("work_experience"),
        F.col("_training").alias("training"),
        parse_number(F.col("_jobs")).alias("num_jobs_2024"),
        F.col("_outlook.pct").alias("outlook_pct"),
        F.col("_outlook.desc").alias("outlook_desc"),
        parse_number(F.col("_change")).alias("employment_change"),
    )


def first_row_cells(pages: DataFrame, table_id: str = fixed.PROJECTION_TABLE) -> DataFrame:
    """Adds code and projection from the first body row of a table with at least four cells."""
    rows = pages.withColumn("_cells", let(_table_body(table_id), lambda body: let(
        let(find(body, tagged("tr")), lambda row: within_scope(row, body)), cell_texts)))
    enough = F.size("_cells") >= 4
    return rows.select(
        *[F.col(name) for name in pages.columns],
        F.when(enough, dash_to_missing(F.get("_cells", F.lit(1)))).otherwise("").alias("soc_code"),
        F.when(enough, parse_number(F.get("_cells", F.lit(3)))).otherwise("").alias(
            "projected_employment_2034"),
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """Page key and the twelve table columns that come from the page."""
    wide = first_row_cells(facts_to_wide(facts(pages)))
    return wide.drop("nodes", "facts")


def pages_to_table(master: DataFrame, pages: DataFrame) -> DataFrame:
    """Structured table: master rows that have a page, in the fixed column order.

    ``pages`` has ``slug`` (unique) and ``nodes``. Pages are narrowed to their row before
    the join, so no markup is shuffled.
    """
    rows = page_rows(pages.select("slug", "nodes"))
    return skew_join(master, rows, "slug", "inner").select("ord", *fixed.TABLE_COLUMNS)


# --- index pages -------------------------------------------------------------------------

def index_entries(pages: DataFrame, box=classed("div", fixed.INDEX_CLASS)) -> DataFrame:
    """One row per list item of the index box: link texts, link targets and full text.

    ``entry`` is the item's position on its page.
    """
    def entry(item: Column) -> Column:
        return let(F.filter(within(item), tagged("a")), lambda links: F.struct(
            F.transform(links, link_text).alias("names"),
            links["href"].alias("hrefs"),
            raw_text(item).alias("text")))

    keep = [F.col(name) for name in pages.columns if name != "nodes"]
    return pages.withColumn("_box", find(page_nodes(), box)).withColumn(
        "_items", F.transform(F.filter(within(F.col("_box")), tagged("li")), entry)
    ).select(*keep, F.posexplode(as_value("_items")).alias("entry", "_item")).select(
        *keep, "entry", "_item.*")


def index_to_master(pages: DataFrame, page: str = "page",
                    box=classed("div", fixed.INDEX_CLASS)) -> tuple[DataFrame, DataFrame]:
    """Master list ``(ord, title, url)`` sorted by title, and aliases, of whole index pages.

    Pages are taken in the order of ``page``, their entries as they stand.
    """
    entries = index_entries(pages, box).withColumn("ord", F.struct(page, "entry"))
    canonical, aliases = resolve_aliases(entries)
    numbered = number_rows(canonical, title_order())
    return numbered.select((F.col("n") - 1).alias("ord"), "title", "url"), aliases.drop("ord")


def resolve_aliases(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Canonical pages ``(title, url, ord)`` and aliases ``(alias, canonical, url)``.

    ``entries`` has ``ord``, ``names``, ``hrefs`` and ``text``. An entry that says "see"
    stands for its second link and is dropped when it has none; any other entry stands for
    its first link. The first title seen for a target is kept.
    """
    is_alias = contains_any(F.col("text"), fixed.ALIAS_MARKS)
    link = F.when(is_alias, 1).otherwise(0)
    chosen = entries.filter(F.size("hrefs") > link).select(
        "ord", is_alias.alias("is_alias"),
        F.get("names", F.lit(0)).alias("alias"),
        F.get("names", link).alias("title"),
        F.get("hrefs", link).alias("url"),
    )
    canonical = first_wins(chosen.select("url", "title", "ord"), "url")
    aliases = chosen.filter("is_alias").select(
        "ord", "alias", F.col("title").alias("canonical"), "url")
    return canonical, aliases
