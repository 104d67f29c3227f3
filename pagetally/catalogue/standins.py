"""The engine's inputs derived from the given tables.

The domain data is not among the given tables, so records, texts and pages are computed
from them row by row: each input grows with its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def education() -> Column:
    """Education name from order priority and status."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return (
        F.when(priority == "1-URGENT", "Doctoral or professional degree")
        .when(priority == "2-HIGH", "Master's degree")
        .when(priority == "3-MEDIUM", "Bachelor's degree")
        .when((priority == "4-NOT SPECIFIED") & (status == "F"), "Associate's degree")
        .when((priority == "4-NOT SPECIFIED") & (status == "O"), "Some college, no degree")
        .when(priority == "4-NOT SPECIFIED", "Postsecondary nondegree award")
        .when(status == "F", "No formal educational credential")
        .when(status == "O", "High school diploma or equivalent")
        .otherwise("See How to Become One")
    )


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Report records: one per order, weighted by its quantity."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").cast("bigint").alias("jobs"))
    orders = table(spark, folder, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("Order "), _text("o_orderkey")).alias("title"),
        _text("o_orderkey").alias("slug"),
        F.col("o_orderstatus").alias("category"),
        F.when(F.col("o_totalprice") >= 5000, F.floor("o_totalprice")).alias("pay"),
        "jobs",
        F.when(F.col("o_custkey") % 31 != 0, F.col("o_custkey") % 65 - 15).alias("outlook"),
        education().alias("education"),
        F.when(F.col("o_custkey") % 13 != 0, F.col("o_orderkey") % 11 + F.when(
            (F.col("o_custkey") % 17 == 0) & (F.col("o_orderkey") % 11 < 10), 0.5)
            .otherwise(0.0)).alias("exposure"),
        F.concat("o_orderpriority", F.lit("|"), "o_orderstatus", F.lit("\n"),
                 _text("o_custkey")).alias("rationale"),
    )


def pay_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Pay texts in five phrasings, with the amounts they were made from."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.floor("o_totalprice").alias("annual"),
        (F.floor("o_totalprice") % 20000 + 700).alias("cents"))
    yearly = F.format_string("$%,d", "annual")
    hourly = F.format_string("$%,d.%02d", F.floor(F.col("cents") / 100), F.col("cents") % 100)
    priority = F.col("o_orderpriority")
    return orders.withColumn("pay_text", (
        F.when(priority == "1-URGENT", F.concat(yearly, F.lit(" per year "), hourly, F.lit(" per hour")))
        .when(priority == "2-HIGH", F.concat(hourly, F.lit(" per hour")))
        .when(priority == "3-MEDIUM", F.concat(yearly, F.lit(" or more per year")))
        .when(priority == "4-NOT SPECIFIED", "The annual wage is not available.")
        .otherwise(F.concat(F.lit("This wage is equal to or greater than "), yearly,
                            F.lit(" per year or "), hourly, F.lit(" per hour.")))))


def outlook_text() -> Column:
    """Outlook phrasing by order status."""
    percent = F.col("o_custkey") % 65 - 15
    return (
        F.when(F.col("o_orderstatus") == "F", F.format_string(
            "%d%% (Change (see note %s))", percent, F.col("o_orderpriority")))
        .when(F.col("o_orderstatus") == "O", F.format_string("%d%%", percent))
        .otherwise(F.concat(F.lit("About "), percent.cast("string"), F.lit(" to 70%")))
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of a narrow table dealt out to all cores, before each becomes a page.

    A table may come in few splits, or most splits without rows; pages cost far more to build, to move
    and to sort (as ``repartition`` does) than the rows they are made from.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, rows.rdd.getNumPartitions()))


def _html(*parts) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One fact page per order: a facts table and a projections table."""
    orders = _dealt(table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
    fact = lambda label, value: _html(f"<tr><th>{label}</th><td> ", value, " </td></tr>")
    whole = F.format_string("%,d", F.floor("o_totalprice"))
    pay = F.when(F.col("o_orderstatus") == "F", _html("$", whole, " per year")).otherwise(
        _html("$", F.format_string("%d.%02d", F.floor("o_totalprice") % 150 + 7,
                                   F.col("o_custkey") % 100), " per hour"))
    code = F.when(F.col("o_orderstatus") == "P", "—").otherwise(
        F.concat(F.lit("15-"), _text("o_custkey")))
    html = _html(
        "<html><head><link rel=\"canonical\" href=\"https://example.com/o/", _text("o_orderkey"),
        "\"></head><body><h1>Order\n ", _text("o_orderkey"), "</h1>",
        "<table id=\"quickfacts\"><tbody>",
        fact("2024 Median Pay", pay),
        fact("Typical <i>entry-level</i> education", education()),
        fact("Work experience in a related occupation", F.lit("None &amp; none")),
        fact("On-the-job Training", F.col("o_orderpriority")),
        fact("Number of Jobs, 2024", whole),
        fact("Job Outlook, 2024-34", outlook_text()),
        "<tr><th>Header only</th></tr>",
        fact("Employment Change, 2024-34", F.format_string("-%,d", F.col("o_custkey") * 7)),
        "</tbody></table><div id=\"panes\"></div>",
        "<table id=\"outlook-table\"><tbody><tr><th>Order</th><td>", code, "</td><td>x</td><td>",
        F.format_string("%,d", F.col("o_custkey") * 1000), "</td></tr><tr><td>later</td></tr>",
        "</tbody></table></body></html>",
    )
    return orders.select(
        F.col("o_orderkey").alias("ord"), _text("o_orderkey").alias("slug"), html.alias("html"))


def order_master(spark: SparkSession, folder: str) -> DataFrame:
    """Master list over the orders."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("Order "), _text("o_orderkey")).alias("title"),
        _text("o_orderkey").alias("slug"),
        F.col("o_orderstatus").alias("category"),
        F.concat(F.lit("https://example.com/o/"), _text("o_orderkey")).alias("url"))


def part_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One sectioned page per part: text blocks, a chart and a projections table."""
    key, size = _text("p_partkey"), _text("p_size")
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    html = _html(
        "<html><body><h1>", name, "  no. ", key, "</h1><div id=\"panes\">",
        "<div id=\"tab-1\"><article><h2>Summary</h2><p>skipped</p></article></div>",
        "<div id=\"tab-2\"><article><h2><span>About ", name, "</span> and more</h2>",
        "<p>", brand, " <b>", kind, "</b></p><p> </p>",
        "<div class=\"ooh_right_img\"><p>photo</p></div><script>var p = '<p>no</p>';</script>",
        "<h3>Size ", size, "</h3><ul><li>", brand, "<li>", kind, "</ul>",
        "<table><tr><th>Key</th><th>Value</th></tr><tr><td></td></tr><tr><td>", size,
        "</td></tr></table></article></div>",
        "<div id=\"tab-3\"><article><p>no heading</p></article></div>",
        "<div id=\"tab-5\"><h2>Pay</h2><div class=\"wide ooh-chart\"><p>Price of ", name,
        "</p><dl><dt>", name, "</dt><dd><span>", size, "</span><span>$",
        F.floor("p_retailprice").cast("string"), "</span></dd><dt>share</dt><dd><span>", size,
        "%</span></dd><dt>none</dt><dd><span>n/a</span></dd><dt>extra</dt></dl></div></div>",
        "<div id=\"tab-6\"><article><h2>Outlook</h2><table id=\"outlook-table\"><tbody><tr><th>",
        name, "</th><td>", brand, "</td><td>", F.format_string("%,d", "p_partkey"),
        "</td><td></td><td>", size, "</td><td>Get data</td></tr></tbody></table></article></div>",
        "</div><p class=\"note update\">Last modified ", size, "</p></body></html>",
    )
    return _dealt(table(spark, folder, "part").select(
        "p_partkey", "p_size", "p_name", "p_brand", "p_type", "p_retailprice",
    )).select("p_partkey", html.alias("html"))


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page per document: its whole text, a paragraph per line."""
    text = F.col("text")
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    html = _html(
        "<h1>Document ", _text("doc_id"), "</h1><div id=panes><div id=tab-4><h2>Text</h2><p>",
        F.replace(text, F.lit("\n"), F.lit("</p>\n<p>")), "</p></div></div>")
    return table(spark, folder, "documents").select(_text("doc_id").alias("slug"), html.alias("html"))


def index_page_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Index entries over the parts: parts of one name are aliases of the first page of it."""
    part = table(spark, folder, "part")
    target = F.concat(F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-")))
    is_alias = F.col("p_type") == "PROMO"
    broken = F.col("p_type") == "LARGE"
    return part.select(
        F.col("p_partkey").alias("ord"),
        F.when(is_alias, F.array(F.col("p_brand"), F.col("p_name")))
        .otherwise(F.array(F.col("p_name"))).alias("names"),
        F.when(is_alias, F.array(F.lit("/x"), target)).otherwise(F.array(target)).alias("hrefs"),
        F.when(is_alias, F.concat("p_brand", F.lit(", see: "), "p_name"))
        .when(broken, F.concat("p_name", F.lit(", see elsewhere")))
        .otherwise(F.col("p_name")).alias("text"),
    )


def index_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Index pages of 100 parts each, with the entries of :func:`index_page_entries`."""
    link = lambda place: _html("<a href=\"", F.get("hrefs", F.lit(place)), "\">",
                               F.get("names", F.lit(place)), "</a>")
    two = F.size("names") > 1
    item = _html("<li>", F.when(two, _html(link(0), ", see: ", link(1))).otherwise(
        _html(link(0), F.when(F.col("text").contains("elsewhere"), ", see elsewhere").otherwise(""))),
        "</li>")
    rows = index_page_entries(spark, folder).select(
        F.floor(F.col("ord") / 100).alias("page"), F.struct("ord", item.alias("item")).alias("row"))
    items = F.transform(F.array_sort(F.collect_list("row")), lambda row: row["item"])
    return rows.groupBy("page").agg(_html(
        "<html><body><ul><li><a href=\"/n\">outside</a></li></ul><div class=\"big a-z-list\"><ul>",
        F.array_join(items, "\n"), "</ul></div></body></html>").alias("html"))


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """Model replies in five shapes by event type."""
    kind = F.col("event_type")
    value = F.regexp_extract("props", r'"k": (\d+)', 1)
    reply = _html('{"exposure": ', value, ', "rationale": "', kind, '", "user": ', _text("user_id"), "}")
    return table(spark, folder, "events").select("event_id", (
        F.when(kind == "view", reply)
        .when(kind == "click", _html(" ```json\n", reply, "\n```\n"))
        .when(kind == "purchase", _html(reply, " trailing"))
        .when(kind == "error", _html('{"exposure": "', value, '"}'))
        .otherwise(_html("```", reply, "```"))).alias("reply"))


def document_master(spark: SparkSession, folder: str) -> DataFrame:
    """Master list over the documents."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("ord"), _text("doc_id").alias("slug"),
        F.concat("source", F.lit(" "), _text("doc_id")).alias("title"),
        F.col("lang").alias("category"),
        F.concat(F.lit("https://example.com/d/"), _text("doc_id")).alias("url"))


def document_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Text corpus over the documents."""
    return table(spark, folder, "documents").select(_text("doc_id").alias("slug"), "text")


def document_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Structured string table over the documents."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("ord"),
        F.concat("source", F.lit(" "), _text("doc_id")).alias("title"),
        F.col("lang").alias("category"),
        _text("doc_id").alias("slug"),
        F.concat(F.lit("https://example.com/d/"), _text("doc_id")).alias("url"),
        _text("n_chars").alias("median_pay_annual"),
        F.when(F.col("source") == "src3", "").otherwise(_text("n_chars")).alias("num_jobs_2024"),
        F.when(F.col("n_chars") > 500, "See page").otherwise("-3").alias("outlook_pct"),
        F.col("source").alias("outlook_desc"),
        F.col("lang").alias("entry_education"))


def label_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score table over the labels."""
    return table(spark, folder, "labels").select(
        _text("doc_id").alias("slug"), F.col("doc_id").alias("ord"),
        (F.col("quality") * 7 + F.col("toxic") * 3).cast("double").alias("exposure"),
        F.concat(F.lit("quality "), _text("quality")).alias("rationale"))
