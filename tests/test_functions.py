"""Scalar rules against their truth tables and against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pagetally.functions import aggregates, arrays, formatting, parsing, predicates, text

X = lambda: F.col("x")


def test_clean_text_collapses_all_unicode_whitespace(spark, column):
    marks = [" ", "\u0085", " ", "　", "\x1c", "\x1d", "\x1e", "\x1f", "\t", "\n", "\r\n",
             " ", " ", " ", " ", "​"]
    values = ["  hello  world  ", "hello\nworld", "hello\tworld", "", "   "] + [
        f"{mark}a{mark}{mark}b {mark}" for mark in marks]
    expected = [re.sub(r"\s+", " ", value).strip() for value in values]
    assert column(values, "string", text.clean_text(X())) == expected
    assert column(values, "string", text.strip(X())) == [value.strip() for value in values]


def test_parse_pay(spark, column):
    cases = {
        "$62,350 per year $29.98 per hour": ("62350", "29.98"),
        "$23.33 per hour": ("", "23.33"),
        "The annual wage is not available.": ("", ""),
        "$239,200 or more per year": ("239200", ""),
        "This wage is equal to or greater than $239,200 per year or $115.00 per hour.":
            ("239200", "115.00"),
        "62,350 per year $29.98 per hour": ("29.98", ""),
        "$5": ("", ""),
        "per year": ("", ""),
    }
    got = column(list(cases), "string", parsing.parse_pay(X()))
    assert [(row.annual, row.hourly) for row in got] == list(cases.values())


def test_parse_outlook(spark, column):
    cases = {
        "9% (Much faster than average)": ("9", "Much faster than average"),
        "-3% (Decline)": ("-3", "Decline"),
        "5%": ("5", ""),
        "0% (Little or no change (see note))": ("0", "Little or no change (see note)"),
        "N/A": ("", "N/A"),
        "4 to 5%": ("", "4 to 5%"),
        "3%(x)": ("3", "x"),
        "3% (open": ("3", ""),
        "7% ()": ("7", ""),
    }
    got = column(list(cases), "string", parsing.parse_outlook(X()))
    assert [(row.pct, row.desc) for row in got] == list(cases.values())


def test_parse_number(spark, column):
    cases = {"1,234": "1234", "-6,300": "-6300", "See below": "See below", " 12 ": "12",
             "1.5": "1.5", "": "", "1,2,3": "123"}
    assert column(list(cases), "string", parsing.parse_number(X())) == list(cases.values())


def test_impute_pay_fills_only_the_missing_side(spark):
    rows = [("62140", ""), ("260", ""), ("62350", ""), ("", "23.33"), ("10", "20"), ("", ""),
            ("52", "")]
    frame = spark.createDataFrame(rows, "a string, h string").select(
        parsing.impute_pay(F.col("a"), F.col("h")).alias("p"))
    got = [(row.p.annual, row.p.hourly) for row in frame.collect()]
    assert got == [("62140", "29.88"), ("260", "0.12"), ("62350", "29.98"), ("48526", "23.33"),
                   ("10", "20"), ("", ""), ("52", "0.03")]


def test_impute_pay_equals_python(spark):
    random.seed(3)
    annual = [str(random.randint(1, 400_000)) for _ in range(3000)]
    hourly = [f"{random.randint(700, 30_000) / 100:.2f}" for _ in range(3000)]
    rows = [(a, "") for a in annual] + [("", h) for h in hourly]
    frame = spark.createDataFrame(rows, "a string, h string").select(
        "a", "h", parsing.impute_pay(F.col("a"), F.col("h")).alias("p"))
    for row in frame.collect():
        if row.a:
            assert row.p.hourly == f"{float(row.a) / 2080:.2f}"
        else:
            assert row.p.annual == str(round(float(row.h) * 2080))


def test_to_int_tolerant_and_strict(spark, column):
    values = ["12", " 12 ", "+5", "-7", "1,000", "12.0", "See", "", None]
    assert column(values, "string", parsing.to_int(X())) == [12, 12, 5, -7, None, None, None, None, None]
    assert column(["12", " 12 ", ""], "string", parsing.to_int(X(), strict=True)) == [12, 12, None]
    for bad in ("1,000", "12.0", "See"):
        with pytest.raises(Exception):
            column([bad], "string", parsing.to_int(X(), strict=True))
    assert column(["7.0", "7.5", "x", "8"], "string", parsing.integral(X())) == [7, None, None, 8]


def _magnitude(jobs):
    if jobs is None:
        return "?"
    for size, digits, mark in ((10 ** 6, 1, "M"), (10 ** 3, 0, "K")):
        if jobs >= size:
            return f"{jobs / size:.{digits}f}{mark}"
    return str(jobs)


def test_magnitudes_equal_python_on_ties(spark, column):
    values = [None, 0, 999, 1000, 2500, 3500, 999_499, 999_500, 1_000_000, 1_049_999, 1_050_000, 1_150_000]
    values += list(range(50_000, 6_000_000, 50_000)) + list(range(500, 1_000_000, 1000))
    assert column(values, "bigint", formatting.fmt_magnitude(X())) == [_magnitude(v) for v in values]


def test_fixed_point_equals_python(spark, column):
    random.seed(5)
    values = [random.uniform(-1000, 1000) for _ in range(3000)] + [n / 20 for n in range(-400, 400)]
    for digits in (0, 1, 2):
        got = column(values, "double", formatting.fixed_point(X(), digits))
        assert got == [f"{v:.{digits}f}" for v in values]


def test_money_and_signed(spark, column):
    assert column([None, 0, 62350, 1234567], "bigint", formatting.fmt_money(X())) == [
        "?", "$0", "$62,350", "$1,234,567"]
    assert column([None, 7, -3, 0], "bigint", formatting.fmt_signed(X())) == ["?", "+7%", "-3%", "+0%"]


def test_strip_fence(spark, column):
    cases = {
        '```json\n{"a": 1}\n```': '{"a": 1}',
        '{"a": 1}': '{"a": 1}',
        '```{"a": 1}```': None,
        ' \n```json\n{"a": 1}```  ': '{"a": 1}',
        '```\n{"a": 1}': '{"a": 1}',
        "": "",
    }
    assert column(list(cases), "string", text.strip_fence(X())) == list(cases.values())


def test_small_text_rules(spark, column):
    assert column(["a|b\nc", ""], "string", text.sanitize_cell(X())) == ["a/b c", ""]
    assert column(["—", "15-1252"], "string", text.dash_to_missing(X())) == ["", "15-1252"]
    assert column(["master_list", "csv"], "string", text.label_case(X())) == ["Master List", "Csv"]
    assert column(["Bachelor's degree", "Other", "", None], "string",
                  text.abbreviate(X(), {"Bachelor's degree": "Bachelor's"})) == [
        "Bachelor's", "Other", "?", "?"]
    assert column(["a", "b.c"], "string", text.corpus_path("/x/", X(), ".html")) == [
        "/x/a.html", "/x/b.c.html"]
    assert column(["/x/a.html", "file:/y/b.c.html", "/x/a.md", "/x/file=7.html/part-0.txt"], "string",
                  text.corpus_key(X(), ".html")) == ["a", "b.c", "", "7"]


def test_missing_has_three_faces(spark, column):
    numbers = [None, 0, 3]
    assert column(numbers, "int", predicates.truthy_number(X())) == [False, False, True]
    assert column([None, "", "a"], "string", predicates.truthy_text(X())) == [False, False, True]
    assert column([None, 0.0, 1.0, 1.5, 2.0], "double", predicates.in_closed(X(), 0, 1)) == [
        False, True, True, False, False]
    assert column([None, 34999.0, 35000.0, 49999.99, 50000.0], "double",
                  predicates.in_half_open(X(), 35000, 50000)) == [False, False, True, True, False]
    assert column([5, 10 ** 9], "bigint", predicates.in_half_open(X(), 10)) == [False, True]
    assert column(["a, see: b", "a, See b", "sea, see b", "see"], "string",
                  predicates.contains_any(X(), [", see:", ", see "])) == [True, False, True, False]


def test_zip_short_and_padding(spark):
    frame = spark.createDataFrame(
        [(["a", "b", "c"], ["1", "2"]), ([], ["1"]), (["a"], [])], "l array<string>, r array<string>")
    pairs = frame.select(arrays.zip_short(
        F.col("l"), F.col("r"), lambda a, b: F.concat(a, b)).alias("z")).collect()
    assert [row.z for row in pairs] == [["a1", "b2"], [], []]
    rows = spark.createDataFrame([([["x", "y"], ["", ""], ["z"]],)], "t array<array<string>>")
    kept = rows.select(arrays.pad_rows(arrays.drop_blank_rows(F.col("t"))).alias("t")).first().t
    assert kept == [["x", "y"], ["z", ""]]


def test_aggregates_treat_null_as_zero(spark):
    rows = [(3, 10), (None, 5), (7, None), (5, 0), (9, 30)]
    frame = spark.createDataFrame(rows, "v bigint, w bigint")
    v, w = F.col("v"), F.col("w")
    got = frame.agg(aggregates.sum0(w).alias("s"), aggregates.sum_product(v, w).alias("p"),
                    aggregates.weighted_mean(v, w).alias("m")).first()
    assert (got.s, got.p) == (45, 300) and got.m == pytest.approx(300 / 40)
    none = frame.limit(0).agg(aggregates.sum0(w).alias("s"), aggregates.sum_product(v, w).alias("p"),
                              aggregates.weighted_mean(v, w).alias("m")).first()
    assert (none.s, none.p, none.m) == (0, 0, 0.0)
