"""Joins, keyed rows, order and summaries against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from pagetally import fixed
from pagetally.operators import joins, keyed, ordering, summaries


def rows_of(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_split_hot_keys_give_the_plain_join(spark, how):
    left = spark.range(1000).select("id", F.when(F.col("id") % 7 == 0, None).when(
        F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("slug"))
    right = spark.createDataFrame(
        [("hot", "H"), ("k1", "one"), ("k2", "two"), (None, "n")], "slug string, v string")
    split = joins.skew_join(left, right, "slug", how, min_rows=10, sample=1.0)
    assert not joins.hot_keys(left, "slug", 10, 1.0).isEmpty()
    assert rows_of(split) == rows_of(left.join(right, "slug", how).select(split.columns))
    assert rows_of(joins.skew_join(left, right, "slug", how)) == rows_of(split)


def test_several_joins_share_the_split(spark):
    left = spark.range(300).select("id", F.when(F.col("id") < 100, "a").otherwise(
        (F.col("id") % 20).cast("string")).alias("slug"))
    one = spark.createDataFrame([("a", 1), ("3", 2)], "slug string, x int")
    two = spark.createDataFrame([("a", "A"), ("4", "B")], "slug string, y string")
    got = joins.skew_joins(left, [(one, "left"), (two, "left")], "slug", min_rows=5, sample=1.0)
    assert rows_of(got) == rows_of(left.join(one, "slug", "left").join(two, "slug", "left").select(
        got.columns))


def test_band_join_edges(spark):
    values = [None, 0.0, 34999.0, 35000.0, 49999.99, 50000.0, 100000.0, -1.0]
    frame = spark.createDataFrame([(v,) for v in values], "pay double")
    got = {(row.pay, row.band) for row in
           joins.band_join(frame, "pay", fixed.PAY_BANDS, closed=False).collect()}
    assert got == {(0.0, "<$35K"), (34999.0, "<$35K"), (35000.0, "$35-50K"), (49999.99, "$35-50K"),
                   (50000.0, "$50-75K"), (100000.0, "$100K+")}
    tiers = joins.band_join(spark.createDataFrame([(1.5,), (1.0,), (10.0,)], "e double"), "e",
                            fixed.TIERS, closed=True).collect()
    assert {(row.e, row.band_ord) for row in tiers} == {(1.0, 0), (10.0, 4)}


def test_overlapping_bands_give_a_row_each(spark):
    frame = spark.createDataFrame([(5,)], "x int")
    got = joins.band_join(frame, "x", [("a", 0, 10), ("b", 5, 6), ("c", 6, 7)], closed=True)
    assert [row.band for row in got.collect()] == ["a", "b"]


def test_category_comes_from_an_existing_row_even_if_empty(spark):
    master = spark.createDataFrame(
        [(0, "A", "a", "list", "u"), (1, "B", "b", "list", "u"), (2, "C", "c", None, None)],
        "ord bigint, title string, slug string, category string, url string")
    stats = spark.createDataFrame(
        [("a", 0, "", "10", "1,5", "", "d", "e"), ("b", 1, "old", "1", "1", "1", "", ""),
         ("b", 2, "new", "", "0", "-4", "", "")],
        "slug string, ord bigint, category string, median_pay_annual string, num_jobs_2024 string,"
        " outlook_pct string, outlook_desc string, entry_education string")
    scores = spark.createDataFrame([("c", 0, 7.0, None)],
                                   "slug string, ord bigint, exposure double, rationale string")
    got = {row.slug: row for row in joins.build_records(master, stats, scores).collect()}
    assert (got["a"].category, got["a"].pay, got["a"].jobs) == ("", 10, None)
    assert (got["b"].category, got["b"].pay, got["b"].jobs, got["b"].outlook) == ("new", None, 0, -4)
    assert (got["c"].category, got["c"].exposure, got["c"].rationale, got["c"].url) == ("", 7.0, "", "")
    with pytest.raises(Exception):
        joins.build_records(master, stats, scores, strict=True).collect()


def test_first_and_last_wins(spark):
    rows = [(0, "a", "x"), (1, "b", "y"), (2, "a", None), (3, "a", "z"), (4, "b", None)]
    frame = spark.createDataFrame(rows, "ord bigint, slug string, v string").repartition(4)
    assert {(r.ord, r.slug, r.v) for r in keyed.first_wins(frame, "slug").collect()} == {
        (0, "a", "x"), (1, "b", "y")}
    assert {(r.ord, r.slug, r.v) for r in keyed.last_wins(frame, "slug").collect()} == {
        (0, "a", "z"), (1, "b", None)}


def test_upsert_replaces_keeps_and_widens(spark):
    old = spark.createDataFrame([("a", 1, "n"), ("b", 2, "m")], "slug string, x int, note string")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "slug string, x int")
    assert {(r.slug, r.x, r.note) for r in keyed.upsert(old, new).collect()} == {
        ("a", 1, "n"), ("b", 9, None), ("c", 3, None)}


@pytest.mark.parametrize("start,end", [(0, 10), (5, None), (-3, None), (0, 10000), (7, 3), (None, -5),
                                       (-8, -2), (-100, 4), (0, 0)])
def test_slices_follow_list_slices(spark, start, end):
    frame = spark.range(20).withColumnRenamed("id", "ord")
    got = sorted(row.ord for row in ordering.slice_rows(frame, start, end).collect())
    assert got == list(range(20))[start:end]


def test_head_and_tail(spark):
    frame = spark.range(50).withColumnRenamed("id", "ord").repartition(5)
    got = {(row.ord, row.part) for row in ordering.head_tail(frame, 3, 2).collect()}
    assert got == {(0, "head"), (1, "head"), (2, "head"), (49, "tail"), (48, "tail")}


def test_row_numbers_in_a_hot_group(spark):
    random.seed(11)
    rows = [(i, 3 if i % 3 else random.randint(0, 10), random.choice([None, 0, 5, random.randint(0, 99)]))
            for i in range(5000)]
    frame = spark.createDataFrame(rows, "ord bigint, exposure int, jobs int")
    got = {row.ord: row.n for row in ordering.number_rows(
        frame, ordering.record_order(), within="exposure").collect()}
    counters, expected = {}, {}
    for ord, exposure, jobs in sorted(rows, key=lambda r: (-r[1], -(r[2] or 0), r[0])):
        counters[exposure] = counters.get(exposure, 0) + 1
        expected[ord] = counters[exposure]
    assert got == expected
    overall = {row.ord: row.n for row in ordering.number_rows(frame, ordering.record_order()).collect()}
    order = sorted(rows, key=lambda r: (-r[1], -(r[2] or 0), r[0]))
    assert overall == {row[0]: i for i, row in enumerate(order, 1)}


def test_lists_placed_at_once_match_plain_sorts(spark, monkeypatch):
    """Three orders with nulls, ties and a value that two thirds share, over many partitions."""
    monkeypatch.setattr(ordering, "PART_ROWS", 500)
    random.seed(9)
    rows = [(i, 3 if i % 3 else random.choice([None, *range(11)]),
             random.choice([None, 0, 5, random.randint(0, 99)]),
             random.choice([None, -2 ** 62, 7, random.randint(-20, 40)]), f"t{i}")
            for i in random.sample(range(4000), 4000)]
    frame = spark.createDataFrame(rows, "ord bigint, exposure int, jobs int, outlook bigint, t string")
    tail = [ordering.falling(frame, "exposure"), ordering.falling(frame, "jobs"), F.col("ord")]
    none = F.lit(None).cast("bigint")
    lists = ordering.number_lists(frame, [
        ordering.Ranking(F.col("exposure").isNotNull(), [none, *tail], ["ord", "exposure", "t"],
                         F.col("exposure")),
        ordering.Ranking(F.col("outlook") < 0, [F.col("outlook"), *tail], ["ord"]),
        ordering.Ranking(F.col("outlook") >= 10, [ordering.falling(frame, "outlook"), *tail], ["ord"])])
    assert lists.columns == ["list", "group", "ord", "exposure", "t", "n"]
    order = lambda r: (-(r[1] or 0), -(r[2] or 0), r[0])
    expected, counters = {}, {}
    for r in sorted((r for r in rows if r[1] is not None), key=order):
        counters[r[1]] = counters.get(r[1], 0) + 1
        expected[0, r[0]] = (counters[r[1]], r[4])
    moved = [(1, lambda r: r[3] < 0, 1), (2, lambda r: r[3] >= 10, -1)]
    for at, member, sign in moved:
        chosen = [r for r in rows if r[3] is not None and member(r)]
        for n, r in enumerate(sorted(chosen, key=lambda r: (sign * r[3], *order(r))), 1):
            expected[at, r[0]] = (n, None)
    assert {(r.list, r.ord): (r.n, r.t) for r in lists.collect()} == expected
    assert ordering.number_lists(frame.limit(0), [
        ordering.Ranking(F.lit(True), [F.col("ord")], ["ord"])]).collect() == []


def test_lists_are_placed_evenly(spark, monkeypatch):
    """Rows that share one rating are spread over partitions, and none holds much more than its share."""
    monkeypatch.setattr(ordering, "PART_ROWS", 500)
    frame = spark.range(8000).select(F.col("id").alias("ord"), F.lit(4).alias("exposure"))
    kept = []
    monkeypatch.setattr(ordering, "_shifted", lambda placed, *_: kept.append(placed) or placed)
    ordering.number_lists(frame, [
        ordering.Ranking(F.lit(True), [F.col("exposure"), F.col("ord")], ["ord"])])
    sizes = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert len(sizes) >= 12 and max(sizes) <= 1200 and sum(sizes) == 8000


RECORD_SCHEMA = ("ord bigint, title string, pay bigint, jobs bigint, outlook bigint, education string,"
                 " exposure bigint, rationale string")


def make_records(n=400, seed=2):
    random.seed(seed)
    names = [m for _, members in fixed.EDUCATION_GROUPS for m in members] + ["Other", ""]
    pick = lambda *options: random.choice(options)
    return [(i, f"T{i}", pick(None, 0, random.randint(1, 200_000)), pick(None, 0, random.randint(1, 9000)),
             pick(None, random.randint(-20, 40)), random.choice(names),
             pick(None, random.randint(0, 10), random.randint(0, 10)), f"r|{i}") for i in range(n)]


def test_summaries_by_hand(spark):
    """Fractional ratings count in full; nulls, zero weights and unknown groups do not."""
    schema = RECORD_SCHEMA.replace("exposure bigint", "exposure double").replace(
        "exposure int", "exposure double")
    frame = spark.createDataFrame([
        (0, "a", 40_000, 100, 1, "Bachelor's degree", 7.5, ""),
        (1, "b", 50_000, 300, 1, "Bachelor's degree", 7.0, ""),
        (2, "c", 34_999, 10, 1, "Master's degree", 1.0, ""),
        (3, "d", 0, 10, 1, "Master's degree", 2.0, ""),
        (4, "e", 90_000, 0, 1, "none of them", 9.0, ""),
        (5, "f", None, None, None, "", None, "")], schema)
    top = summaries.headline(frame).first()
    assert (top.n, top.jobs, top.wages) == (6, 420, 4_000_000 + 15_000_000 + 349_990)
    assert top.mean_exposure == pytest.approx((750 + 2100 + 10 + 20) / 420)
    bands = [(r.jobs, r.mean_exposure) for r in summaries.band_means(frame).orderBy("ord").collect()]
    assert bands == [(10, 1.0), (100, 7.5), (300, 7.0)]
    groups = {r.jobs: r.mean_exposure for r in summaries.group_means(frame).collect()}
    assert groups == {400: pytest.approx(7.125), 20: 1.5}
    counts = {r.exposure: (r.n, r.jobs) for r in summaries.rating_groups(frame).collect()}
    assert counts == {1: (1, 10), 2: (1, 10), 7: (1, 300), 9: (1, 0)}
    tiers = [r.n for r in summaries.tier_summary(frame).orderBy("ord").collect()]
    assert tiers == [1, 1, 0, 1, 1]


def test_empty_groups(spark):
    frame = spark.createDataFrame([(0, "T", 10, 0, None, "x", 5, "")], RECORD_SCHEMA)
    tiers = summaries.tier_summary(frame).collect()
    assert [row.n for row in tiers] == [0, 0, 1, 0, 0]
    assert all(row.jobs_share is None and row.avg_pay == 0 for row in tiers)
    assert summaries.band_means(frame).count() == 0
    assert summaries.group_means(frame).count() == 0
    assert summaries.headline(frame).first().mean_exposure == 0.0


def test_histogram_counts_and_marks(spark):
    frame = spark.createDataFrame([(1,)] * 300 + [(2,)], "e int")
    assert {(r.e, r.n) for r in summaries.histogram(frame, "e").collect()} == {(1, 300), (2, 1)}
    bars = {(r.e, len(r.bar)) for r in summaries.histogram(frame, "e", 1).collect()}
    assert bars == {(1, 300), (2, 1)}
    assert {len(r.bar) for r in summaries.histogram(frame, "e", 7).collect()} == {43, 1}
