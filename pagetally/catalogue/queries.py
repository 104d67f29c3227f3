"""One query per operator over the given tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pagetally import fixed
from pagetally.catalogue import standins
from pagetally.catalogue.standins import table
from pagetally.functions.arrays import as_value
from pagetally.functions.formatting import fmt_magnitude, fmt_money, fmt_signed
from pagetally.functions.parsing import impute_pay, parse_number, parse_outlook, parse_pay
from pagetally.functions.text import clean_text, corpus_key, corpus_path, strip_fence, text_sizes
from pagetally.operators import extract, joins, keyed, ordering, quality, scoring, summaries
from pagetally.operators.calls import CallPolicy, Retry
from pagetally.operators.outline import html_nodes, node_rows
from pagetally.plans import report, steps
from pagetally.plans.changes import ReportTotals, changes
from pagetally.session import scratch_path, spread, written
from pagetally.sources import corpus, state, tables
from pagetally.sources.keyed_table import KeyedTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name, less a trailing underscore."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# --- report aggregates -------------------------------------------------------------

@query
def headline(spark, folder):
    return summaries.headline(standins.records(spark, folder)).withColumn(
        "mean_exposure", F.round("mean_exposure", 6))


@query
def tier_summary(spark, folder):
    return _rounded(summaries.tier_summary(standins.records(spark, folder)),
                    "jobs_share", "wages_share")


@query
def band_means(spark, folder):
    return _rounded(summaries.band_means(standins.records(spark, folder)), "mean_exposure")


@query
def group_means(spark, folder):
    return _rounded(summaries.group_means(standins.records(spark, folder)), "mean_exposure")


def _totals_from_changes(spark: SparkSession, folder: str) -> ReportTotals:
    """Totals after a load with mistakes, their revision, and the removal of repeated records."""
    records = standins.records(spark, folder)
    wrong = records.filter("ord % 7 = 0").withColumns({
        "pay": F.col("pay") + 20000, "exposure": F.lit(3.3), "education": F.lit("unknown")})
    twice = records.filter("ord % 5 = 0")
    totals = ReportTotals(spark, scratch_path(spark, "totals"))
    totals.apply("load", changes(inserted=records.filter("ord % 7 <> 0").unionByName(wrong)))
    totals.apply("again", changes(inserted=twice))
    totals.compact()
    fix = changes(deleted=twice, revised=(wrong, records.filter("ord % 7 = 0")))
    for _ in range(2):
        totals.apply("fix", fix)
    return totals


@query
def headline_from_changes(spark, folder):
    return _totals_from_changes(spark, folder).headline().withColumn(
        "mean_exposure", F.round("mean_exposure", 6))


@query
def tiers_from_changes(spark, folder):
    return _rounded(_totals_from_changes(spark, folder).tier_summary(), "jobs_share", "wages_share")


@query
def bands_from_changes(spark, folder):
    return _rounded(_totals_from_changes(spark, folder).band_means(), "mean_exposure")


@query
def groups_from_changes(spark, folder):
    return _rounded(_totals_from_changes(spark, folder).group_means(), "mean_exposure")


@query
def band_join(spark, folder):
    banded = joins.band_join(standins.records(spark, folder), "pay", fixed.PAY_BANDS, closed=False)
    return banded.select("ord", "band_ord", "band")


@query
def group_join(spark, folder):
    grouped = joins.group_join(
        standins.records(spark, folder), "education", fixed.EDUCATION_GROUPS)
    return grouped.select("ord", "group_ord", F.col("group").alias("group_name"))


@query
def movers_down(spark, folder):
    return report.movers(standins.records(spark, folder), up=False)


@query
def movers_up(spark, folder):
    return report.movers(standins.records(spark, folder), up=True)


@query
def rating_groups(spark, folder):
    return summaries.rating_groups(standins.records(spark, folder))


@query
def rating_listing(spark, folder):
    return report.rating_listing(standins.records(spark, folder))


@query
def histogram(spark, folder):
    rated = standins.records(spark, folder).filter("exposure is not null")
    return summaries.histogram(rated, "exposure", rows_per_mark=1)


@query
def mean_rating(spark, folder):
    return summaries.mean_of(standins.records(spark, folder), "exposure").withColumn(
        "mean", F.round("mean", 6))


@query
def report_lines(spark, folder):
    return report.report_lines(written(spread(standins.records(spark, folder)), "records"))


@query
def report_text(spark, folder):
    records = standins.records(spark, folder)
    heads = report.heading_lines(spark, "Report", []).filter(F.col("section") < report.DOWN)
    lines = report.summary_lines(records).filter(F.col("section") < report.DOWN)
    return report.summary_text(heads.unionByName(lines))


# --- joins and keyed rows -------------------------------------------------------------

@query
def build_compact(spark, folder):
    return joins.build_compact(
        standins.document_stats(spark, folder), standins.label_scores(spark, folder))


@query
def build_records(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_custkey").cast("string").alias("slug"),
        F.col("o_orderstatus").alias("category"),
        F.col("o_orderpriority").alias("url"))
    building = F.col("c_mktsegment") == "BUILDING"
    stats = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("ord"), F.col("c_custkey").cast("string").alias("slug"),
        F.when(building, "").otherwise(F.col("c_mktsegment")).alias("category"),
        F.floor("c_acctbal").cast("string").alias("median_pay_annual"),
        F.when(building, "").otherwise(F.col("c_nationkey").cast("string")).alias("num_jobs_2024"),
        F.concat(F.lit("-"), F.col("c_nationkey").cast("string")).alias("outlook_pct"),
        F.col("c_name").alias("outlook_desc"),
        F.col("c_mktsegment").alias("entry_education"))
    scores = table(spark, folder, "events").select(
        F.col("event_id").alias("ord"), F.col("user_id").cast("string").alias("slug"),
        (F.floor("value") % 11).alias("exposure"), F.col("event_type").alias("rationale"))
    return joins.build_records(orders, stats, scores)


@query
def with_corpus(spark, folder):
    return joins.with_corpus(
        standins.document_master(spark, folder), standins.label_scores(spark, folder))


@query
def without_corpus(spark, folder):
    return joins.without_corpus(
        standins.document_master(spark, folder), standins.label_scores(spark, folder))


@query
def pending(spark, folder):
    return joins.pending(
        standins.document_master(spark, folder), standins.label_scores(spark, folder))


@query
def first_wins(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return keyed.first_wins(events, "user_id", "event_id")


@query
def last_wins(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return keyed.last_wins(events, "user_id", "event_id")


@query
def upsert(spark, folder):
    old = standins.document_master(spark, folder).select(
        "slug", F.lit(None).cast("double").alias("exposure"), F.col("title").alias("note"))
    new = standins.label_scores(spark, folder).select("slug", "exposure")
    return keyed.upsert(old, new)


@query
def merge_on_read(spark, folder):
    """The same update into a table that is appended to and merged when it is read."""
    old = standins.document_master(spark, folder).select(
        "slug", F.lit(None).cast("double").alias("exposure"), F.col("title").alias("note"))
    scores = KeyedTable(spark, scratch_path(spark, "keyed"), "slug", old.schema)
    scores.upsert(old)
    scores.compact()
    new = standins.label_scores(spark, folder).select("slug", "exposure")
    scores.upsert(new.withColumn("exposure", F.lit(-1.0)))
    scores.upsert(new)
    return scores.read()


@query
def resolve_aliases(spark, folder):
    canonical, _ = extract.resolve_aliases(standins.index_page_entries(spark, folder))
    return ordering.number_rows(canonical, ordering.title_order())


@query
def alias_entries(spark, folder):
    _, aliases = extract.resolve_aliases(standins.index_page_entries(spark, folder))
    return aliases


@query
def index_to_master(spark, folder):
    """From the markup of index pages to the sorted list."""
    pages = html_nodes(standins.index_pages(spark, folder))
    return extract.index_to_master(pages)[0]


@query
def index_to_aliases(spark, folder):
    pages = html_nodes(standins.index_pages(spark, folder))
    return extract.index_to_master(pages)[1]


# --- order, slices, samples ---------------------------------------------------------------

def _parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_partkey").alias("ord"), "p_name", "p_size")


@query
def slice_rows(spark, folder):
    return ordering.slice_rows(_parts(spark, folder), 25, 175)


@query
def slice_from_end(spark, folder):
    return ordering.slice_rows(_parts(spark, folder), -150, -25)


@query
def head_tail(spark, folder):
    return ordering.head_tail(_parts(spark, folder), 20, 10)


@query
def with_defaults(spark, folder):
    """Row template over the documents: absent columns and values become empty text."""
    rows = standins.document_stats(spark, folder).withColumn(
        "outlook_desc", F.nullif(F.col("outlook_desc"), F.lit("src3")))
    return tables.with_defaults(rows, fixed.TABLE_COLUMNS).select("ord", *fixed.TABLE_COLUMNS)


# --- text and number rules --------------------------------------------------------------------

@query
def clean_text_(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", clean_text(F.col("text")).alias("clean"))


@query
def document_sizes(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", text_sizes(F.col("text")).alias("s"))
    return docs.select("doc_id", "s.*")


@query
def parse_pay_(spark, folder):
    texts = standins.pay_texts(spark, folder)
    return texts.select("o_orderkey", parse_pay(F.col("pay_text")).alias("pay")).select(
        "o_orderkey", "pay.*")


@query
def parse_outlook_(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", parse_outlook(standins.outlook_text()).alias("outlook")).select(
        "o_orderkey", "outlook.pct", F.col("outlook.desc").alias("outlook_desc"))


@query
def parse_number_(spark, folder):
    orders = table(spark, folder, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit(" See "), "o_orderpriority")).otherwise(
        F.format_string(" %,d ", F.floor("o_totalprice") - 9000))
    return orders.select("o_orderkey", parse_number(text).alias("number"))


@query
def impute_pay_(spark, folder):
    orders = table(spark, folder, "orders")
    annual = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.floor("o_totalprice").cast("string"))
    hourly = F.when(F.col("o_orderstatus") == "P", F.format_string(
        "%d.%02d", F.col("o_custkey") % 180 + 7, F.floor("o_totalprice") % 100)).otherwise("")
    return orders.select("o_orderkey", impute_pay(annual, hourly).alias("pay")).select(
        "o_orderkey", "pay.*")


@query
def fmt_money_(spark, folder):
    records = standins.records(spark, folder)
    return records.select("ord", fmt_money(F.col("pay")).alias("pay_text"))


@query
def fmt_magnitude_(spark, folder):
    """Pay reaches the thousands; wages in steps of 50 reach the millions and hit ties."""
    records = standins.records(spark, folder)
    return records.select(
        "ord", fmt_magnitude(F.col("pay")).alias("pay_size"),
        fmt_magnitude(F.col("jobs") * F.floor(F.col("pay") / 100) * 50).alias("wage_size"))


@query
def fmt_signed_(spark, folder):
    records = standins.records(spark, folder)
    return records.select("ord", fmt_signed(F.col("outlook")).alias("outlook_text"))


@query
def typed_records(spark, folder):
    good, _ = _typed_events(spark, folder)
    return good


@query
def rejected_records(spark, folder):
    _, bad = _typed_events(spark, folder)
    return bad.select("event_id", F.array_join("problems", "; ").alias("problems"))


def _typed_events(spark, folder):
    kind = F.col("event_type")
    events = table(spark, folder, "events").select(
        "event_id",
        F.when(kind != "error", kind).alias("title"),
        F.when(kind == "view", F.concat(F.col("user_id").cast("string"), F.lit(".0")))
        .when(kind == "click", F.concat(F.col("user_id").cast("string"), F.lit(".5")))
        .otherwise(F.col("user_id").cast("string")).alias("jobs"),
        F.regexp_extract("props", r"(\d+)", 1).alias("exposure"),
        F.col("value").cast("string").alias("hourly"))
    return quality.typed_records(
        events, texts=["title"], whole=["jobs", "exposure"], decimals=["hourly"],
        ranges={"exposure": (0, 80)})


# --- replies and ratings ------------------------------------------------------------------------

@query
def strip_fence_(spark, folder):
    replies = standins.replies(spark, folder)
    return replies.select("event_id", strip_fence(F.col("reply")).alias("body"))


@query
def parse_reply_(spark, folder):
    return scoring.parse_replies(standins.replies(spark, folder)).drop("reply")


@query
def score_requests(spark, folder):
    return scoring.score_requests(
        standins.document_corpus(spark, folder), model="example/model"
    ).select("slug", "request")


@query
def score_table(spark, folder):
    replies = scoring.score_table(spread(standins.document_corpus(spark, folder)), scoring.length_scorer)
    return replies.select("slug", "reply")


@query
def score_documents(spark, folder):
    """Ratings with many calls in flight, equal texts asked once, by a service that fails."""
    policy = CallPolicy(in_flight=32, retries=(Retry((ConnectionError,), first_wait=0.01),))
    return scoring.score_documents(
        standins.document_corpus(spark, folder), scoring.shaky_scorer, policy)


def _scoring_run(spark, folder):
    old = standins.label_scores(spark, folder).select(
        "slug", F.lit("old").alias("title"), "exposure", "rationale",
        F.lit(None).cast("string").alias("extras"))
    return scoring.score_incremental(
        standins.document_master(spark, folder), standins.document_corpus(spark, folder),
        old, scoring.length_scorer, log=scratch_path(spark, "answers"), batches=2)


@query
def score_incremental(spark, folder):
    return _scoring_run(spark, folder).scores


@query
def scoring_stats(spark, folder):
    return summaries.run_stats(_scoring_run(spark, folder).statuses)


# --- steps and state ------------------------------------------------------------------------------

@query
def run_stats(spark, folder):
    docs = standins.document_corpus(spark, folder).filter(F.char_length("text") > 100)
    return summaries.run_stats(steps.run_statuses(
        standins.document_master(spark, folder), docs, standins.label_scores(spark, folder)))


@query
def run_incremental(spark, folder):
    done = standins.label_scores(spark, folder).select("slug", F.col("rationale").alias("text"))
    docs = standins.document_corpus(spark, folder)
    return steps.run_incremental(
        docs, done, lambda rows: rows.select("slug", clean_text(F.col("text")).alias("text")))


@query
def run_into(spark, folder):
    """The step of run_incremental into a table that is merged on read."""
    done = KeyedTable(spark, scratch_path(spark, "done"), "slug", "slug string, text string")
    done.upsert(standins.label_scores(spark, folder).select("slug", F.col("rationale").alias("text")))
    return steps.run_into(done, standins.document_corpus(spark, folder), lambda rows: rows.select(
        "slug", clean_text(F.col("text")).alias("text")))


@query
def run_steps(spark, folder):
    catalog = {
        "master": standins.order_master(spark, folder),
        "html": spread(standins.order_pages(spark, folder)),
        "scores": standins.records(spark, folder).select("slug", "ord", "exposure", "rationale"),
    }
    made, _ = steps.run_steps(catalog, {
        "nodes": lambda t: html_nodes(t["html"]),
        "csv": lambda t: extract.pages_to_table(t["master"], t["nodes"]),
        "build": lambda t: joins.build_compact(t["csv"], t["scores"]),
    })
    return made["build"]


def _event_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("step"), F.col("user_id").cast("string").alias("slug"))


def _saved_state(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "state")
    keys = _event_keys(spark, folder)
    state.save_checkpoint(keys, path)
    # the second save of "view" replaces its first key set
    replaced = keys.filter("step = 'purchase'").withColumn("step", F.lit("view"))
    state.save_checkpoint(replaced, path)
    return path, state.read_state(spark, path)


@query
def checkpoint_save(spark, folder):
    _, saved = _saved_state(spark, folder)
    return saved.select("step", "slug").filter("slug is not null")


@query
def checkpoint_load(spark, folder):
    _, saved = _saved_state(spark, folder)
    return state.load_checkpoint(saved, "view")


@query
def checkpoint_completed(spark, folder):
    _, saved = _saved_state(spark, folder)
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("slug"), "c_name")
    return state.completed(customers, saved, "click")


@query
def checkpoint_summary(spark, folder):
    _, saved = _saved_state(spark, folder)
    return state.state_summary(saved).select("step", "completed")


@query
def checkpoint_clear(spark, folder):
    path, _ = _saved_state(spark, folder)
    state.clear_steps(spark, path, ["click", "unknown"])
    return state.state_summary(state.read_state(spark, path)).select("step", "completed")


# --- pages -------------------------------------------------------------------------------------------

def _page_nodes(spark, folder):
    return html_nodes(spread(table(spark, folder, "pages").select("page_id", "html")))


@query
def html_nodes_(spark, folder):
    nodes = node_rows(_page_nodes(spark, folder))
    return nodes.filter("tag is not null").groupBy("page_id", "tag").agg(
        F.count(F.lit(1)).alias("n"))


@query
def page_header(spark, folder):
    return extract.page_header(_page_nodes(spark, folder)).select("page_id", "title", "canonical")


@query
def page_markdown(spark, folder):
    return extract.pages_to_markdown(_page_nodes(spark, folder))


@query
def index_entries(spark, folder):
    entries = extract.index_entries(_page_nodes(spark, folder), extract.tagged("nav"))
    return entries.select(
        "page_id", "entry", F.array_join("names", " ; ").alias("names"),
        F.array_join("hrefs", " ; ").alias("hrefs"), "text")


@query
def facts(spark, folder):
    pages = extract.facts(html_nodes(spread(standins.order_pages(spark, folder))))
    return pages.select("slug", F.posexplode(as_value("facts")).alias("at", "fact")).select(
        "slug", "at", "fact.*")


@query
def facts_to_wide(spark, folder):
    pages = extract.facts(html_nodes(spread(standins.order_pages(spark, folder))))
    return extract.facts_to_wide(pages).drop("ord", "nodes", "facts")


@query
def first_row_cells(spark, folder):
    pages = html_nodes(spread(standins.order_pages(spark, folder)))
    return extract.first_row_cells(pages).drop("ord", "nodes")


@query
def pages_to_table(spark, folder):
    return extract.pages_to_table(
        standins.order_master(spark, folder), html_nodes(spread(standins.order_pages(spark, folder))))


def _sectioned(spark, folder):
    return extract.sections(html_nodes(spread(standins.part_pages(spark, folder)))).select(
        "p_partkey", "nodes", F.explode(as_value("sections")).alias("section"))


@query
def sections(spark, folder):
    return _sectioned(spark, folder).select("p_partkey", "section.tab", "section.title")


@query
def blocks(spark, folder):
    found = _sectioned(spark, folder).select(
        "p_partkey", "section.tab", "nodes",
        F.posexplode(extract.block_parts(F.col("section.box"))).alias("at", "block"))
    return found.select("p_partkey", "tab", "at", "block.kind",
                        extract.text_of(F.col("block.node")).alias("text"))


@query
def chart_items(spark, folder):
    charts = _sectioned(spark, folder).select(
        "p_partkey", extract.chart_of(F.col("section.box")).alias("chart"))
    return charts.select("p_partkey", "chart.subtitle", F.posexplode("chart.items").alias(
        "at", "item")).select("p_partkey", "subtitle", "at", "item.*")


@query
def table_rows(spark, folder):
    found = _sectioned(spark, folder).select(
        "p_partkey", "nodes", F.explode(extract.block_parts(F.col("section.box"))).alias("block")
    ).filter("block.kind = 'table'")
    rows = found.select("p_partkey", F.posexplode(
        extract.table_rows(F.col("block.node"))).alias("at", "cells"))
    return rows.select("p_partkey", "at", F.array_join("cells", "|").alias("cells"))


@query
def labelled_cells(spark, folder):
    boxes = _sectioned(spark, folder).select("p_partkey", "nodes", extract.find(
        extract.within(F.col("section.box")),
        extract.identified("table", fixed.PROJECTION_TABLE)).alias("node"))
    rows = boxes.select("p_partkey", F.explode(extract.projection_rows(F.col("node"))).alias("row"))
    return rows.select("p_partkey", F.posexplode("row").alias("at", "cell")).select(
        "p_partkey", "at", "cell.*")


@query
def pages_to_markdown(spark, folder):
    return extract.pages_to_markdown(html_nodes(spread(standins.part_pages(spark, folder))))


@query
def documents_to_markdown(spark, folder):
    return extract.pages_to_markdown(html_nodes(spread(standins.document_pages(spark, folder))))


# --- checks --------------------------------------------------------------------------------------------

def _shown(results: DataFrame) -> DataFrame:
    details = F.transform(F.array_sort(F.map_entries("details")), lambda entry: F.concat_ws(
        "=", entry["key"], entry["value"]))
    return results.withColumn("details", F.array_join(details, "; "))


@query
def check_required(spark, folder):
    master = standins.order_master(spark, folder)
    gaps = master.withColumn("category", F.when(F.col("category") != "P", F.col("category")))
    return _shown(quality.check_required(gaps, nulls_fail=True))


@query
def check_required_fields(spark, folder):
    master = standins.order_master(spark, folder).drop("category")
    return _shown(quality.check_required(
        master, "site_data", "Site data", ["title", "slug", "category"], per_field=True))


@query
def check_corpus(spark, folder):
    texts = table(spark, folder, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("slug"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).otherwise("").alias("text"))
    return _shown(quality.check_corpus(texts, "markdown_files", "Markdown"))


@query
def check_columns(spark, folder):
    return _shown(quality.check_columns(standins.order_master(spark, folder)))


@query
def check_range(spark, folder):
    scores = standins.records(spark, folder).select(
        "ord", "slug", (F.col("exposure") + F.when(F.col("category") == "P", 1).otherwise(0)).alias(
            "exposure"))
    return _shown(quality.check_range(scores, order="ord"))


def _checks(spark, folder):
    records = standins.records(spark, folder)
    docs = standins.document_corpus(spark, folder)
    return quality.validate_all(spark, {
        "master_list": lambda: quality.check_required(standins.order_master(spark, folder)),
        "html_files": lambda: quality.check_corpus(
            table(spark, folder, "pages").select(
                F.col("page_id").alias("slug"), F.col("html").alias("text")), "html_files", "HTML"),
        "markdown_files": lambda: quality.check_corpus(docs, "markdown_files", "Markdown"),
        "csv": lambda: quality.check_columns(standins.document_stats(spark, folder)),
        "scores": lambda: (records, quality.in_range(records, order="ord")),
        "site_data": lambda: (records, quality.required_fields(
            records, "site_data", "Site data", ["title", "slug", "category"], per_field=True,
            rated="exposure")),
        "archive": lambda: quality.check_columns(spark.read.parquet(f"{folder}/absent.parquet")),
    })


@query
def validate_all(spark, folder):
    return _shown(_checks(spark, folder))


@query
def checks_while_writing(spark, folder):
    """Two checks of the records, measured in the pass that writes them."""
    path = scratch_path(spark, "checked")
    records = standins.records(spark, folder)
    found = quality.check_while(
        records, [quality.in_range(records, order="ord"), quality.required_fields(
            records, "site_data", "Site data", ["title", "slug", "category"], per_field=True,
            rated="exposure")],
        lambda frame: frame.write.mode("overwrite").parquet(path), lambda: spark.read.parquet(path))
    return _shown(found)


@query
def quality_report(spark, folder):
    return quality.quality_report(_checks(spark, folder))


@query
def status(spark, folder):
    records = standins.records(spark, folder)
    return quality.status([
        ("Master list", standins.order_master(spark, folder), "occupations", None),
        ("HTML files", table(spark, folder, "pages"), "files", None),
        ("Markdown files", standins.document_corpus(spark, folder), "files", None),
        ("CSV", standins.document_stats(spark, folder), "rows", None),
        ("Scores", standins.label_scores(spark, folder), "entries", "exposure"),
        ("Site data", records, "entries", "exposure"),
        ("Archive", None, "files", None),
    ])


@query
def corpus_inventory(spark, folder):
    texts = table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("text"))
    return corpus.corpus_inventory(texts, "markdown").unionByName(
        corpus.corpus_inventory(table(spark, folder, "pages"), "html", "html"))


# --- files ---------------------------------------------------------------------------------------------

@query
def io_roundtrip_json_(spark, folder):
    path = scratch_path(spark, "json")
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("c_name"), "c_mktsegment")
    tables.write_json(customers, path)
    return tables.read_json(spark, path, "c_custkey bigint, c_name string, c_mktsegment string")


@query
def io_roundtrip_csv_(spark, folder):
    path = scratch_path(spark, "csv")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("slug"),
        F.concat(F.lit('say "'), F.col("c_mktsegment"), F.lit('",\n'), F.col("c_name")).alias("title"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("category"))
    tables.write_table(customers, path, ["title", "category", "slug", "url"])
    return tables.read_table(spark, path)


@query
def record_list(spark, folder):
    """Array files of 1,000 parts each, read back with running list positions."""
    path = scratch_path(spark, "records")
    parts = table(spark, folder, "part").select(
        F.lpad(F.floor(F.col("p_partkey") / 1000).cast("string"), 9, "0").alias("file"),
        "p_partkey", F.struct(
            F.col("p_name").alias("title"), F.col("p_partkey").cast("string").alias("slug"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("url")).alias("record"))
    arrays = parts.groupBy("file").agg(F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct("p_partkey", "record"))),
        lambda pair: pair["record"])).alias("value"))
    arrays.write.partitionBy("file").text(path)
    return tables.read_records(spark, f"{path}/*/*.txt")


@query
def compact_output(spark, folder):
    """The compact table written as JSON lines, nulls kept, and read back."""
    path = scratch_path(spark, "compact")
    compact = joins.build_compact(
        standins.document_stats(spark, folder), standins.label_scores(spark, folder))
    tables.write_json(compact, path)
    return tables.read_json(spark, path, compact.schema)


@query
def corpus_paths(spark, folder):
    """Corpus path of each document and the key read back from it."""
    path = corpus_path("/corpus/", F.col("slug"), ".html")
    return standins.document_master(spark, folder).select(
        "ord", path.alias("path"), corpus_key(path, ".html").alias("slug"))


@query
def corpus_table(spark, folder):
    path = scratch_path(spark, "corpus")
    pages = table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("slug"), F.col("html").alias("text"))
    corpus.write_corpus(pages, path)
    return corpus.read_corpus_table(spark, path)


@query
def read_corpus(spark, folder):
    """One file per page, written under its key and read back."""
    path = scratch_path(spark, "pages")
    corpus.write_corpus_files(table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("slug"), F.col("html").alias("text")), path, ".html")
    return corpus.read_corpus(spark, path, ".html").select("slug", "text")


@query
def empty_files(spark, folder):
    """One file per supplier, empty for those without a credit."""
    path = scratch_path(spark, "suppliers")
    corpus.write_corpus_files(table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("slug"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).otherwise("").alias("text")), path, ".md")
    return corpus.read_corpus(spark, path, ".md").select(
        "slug", "text", (F.col("bytes") == 0).alias("empty"))


@query
def report_file(spark, folder):
    """The report written as ordered text files and read back with each line's place."""
    path = scratch_path(spark, "report")
    records = written(spread(standins.records(spark, folder)), "records")
    corpus.write_report(report.report_lines(records), path)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("at"))
    within = Window.partitionBy("file").orderBy("at")
    # one row per file
    sizes = lines.groupBy("file").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    return lines.withColumn("nth", F.row_number().over(within)).join(sizes, "file").select(
        (F.col("before") + F.col("nth")).alias("n"), "line")
