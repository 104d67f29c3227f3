"""JSON and CSV tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pagetally import fixed
from pagetally.sources.chunks import csv_step, json_step, records

_CSV = {"escape": '"', "multiLine": "true"}
MASTER_SCHEMA = ", ".join(f"{name} string" for name in fixed.MASTER_COLUMNS)


def read_records(spark: SparkSession, path: str, schema: str = MASTER_SCHEMA) -> DataFrame:
    """Records of JSON array files with their 0-based list position ``ord``.

    Files are taken in name order and positions run on from file to file. A file is read in byte
    ranges by many tasks, however large its array and whether or not it has line breaks. A file
    that is no JSON array, or an element that does not fit ``schema``, ends the read with an error.
    """
    found, chunks = records(spark, path, ",", json_step, 1)
    # one row per file: the running offset is over file names, not over records
    nothing = F.col("head") == "[]"
    files = chunks.filter("last").select(
        "file", F.when(nothing, 0).otherwise(F.col("before_end") + 1).alias("n"),
        "end_state", "end_depth")
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    def opened(text: Column) -> Column:
        return F.when(text.rlike(r"\A\s*\["), F.regexp_replace(text, r"\A\s*\[", "")).otherwise(
            _no_array(F.col("file")))

    def closed(text: Column) -> Column:
        return F.when(text.rlike(r"\]\s*\z"), F.regexp_replace(text, r"\]\s*\z", "")).otherwise(
            _no_array(F.col("file")))

    value = F.when(F.col("ord") == 0, opened(F.col("value"))).otherwise(F.col("value"))
    inner = found.withColumn("value", value).withColumn(
        "value", F.when(F.col("last"), closed(F.col("value"))).otherwise(F.col("value")))
    # one row per file; an array of nothing has no element
    elements = inner.join(offsets, "file").filter("n > 0")
    # read as an array of one and as an object of one member: no text after the element closes both
    strict = {"mode": "FAILFAST"}
    boxed = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), f"array<struct<{schema}>>", strict)
    member = F.from_json(F.concat(F.lit('{"a":'), "value", F.lit("}")), "a string", strict)
    sound = (F.col("end_state") == 0) & (F.col("end_depth") == 0) & (F.size("_box") == 1) \
        & F.col("_member").isNotNull()
    return elements.withColumns({"_box": boxed, "_member": member}).select(
        (F.col("offset") + F.col("ord")).cast("bigint").alias("ord"),
        F.when(sound, F.get("_box", F.lit(0))).otherwise(_no_array(F.col("file"))).alias("_record"),
    ).select("ord", "_record.*")


def _no_array(file: Column) -> Column:
    return F.raise_error(F.concat(file, F.lit(" is no JSON array")))


def read_json(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """JSON with a declared schema: splittable JSON lines, or one document per file."""
    return spark.read.schema(schema).json(path, multiLine=multiline)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; null fields are written as ``null``, text stays UTF-8."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               multiline: bool = True) -> DataFrame:
    """CSV with a header, every column a string, ``""`` for a missing cell.

    ``multiline`` allows quoted newlines; files are still read in byte ranges by many tasks, at
    the price of two more scans that find where records start. The first record of each file is
    its header. Records end with a line feed, with or without a carriage return; breaks inside
    quotes stay as they are.
    """
    reader = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    )
    if columns:
        reader = reader.schema(", ".join(f"`{name}` string" for name in columns))
    table = reader.csv(path)
    if not multiline:
        return with_defaults(table, table.columns)
    # the names come from the first record alone
    ddl = ", ".join("`" + name.replace("`", "``") + "` string" for name in table.columns)
    value = F.regexp_replace("value", r"\r\z", "")
    rows = records(spark, path, "\n", csv_step, 0)[0].filter("ord > 0").select(
        value.alias("value")).filter("value <> ''")
    parsed = rows.select(F.from_csv("value", ddl, _CSV).alias("row"))
    return with_defaults(parsed.select("row.*"), table.columns)


def write_table(df: DataFrame, path: str, columns: list[str] | None = None,
                mode: str = "errorifexists") -> None:
    """CSV with a header and fixed column order; missing columns and nulls become ``""``."""
    columns = columns or df.columns
    extra = [name for name in df.columns if name not in columns]
    if extra:
        raise ValueError(f"columns not in the output list: {extra}")
    (
        with_defaults(df, columns).select(*columns).write.mode(mode)
        .option("header", True).option("escape", '"')
        .option("emptyValue", "").option("nullValue", "").csv(path)
    )


def with_defaults(df: DataFrame, columns: list[str], default: str = "") -> DataFrame:
    """Every listed column as text, ``default`` where the column or the value is absent."""
    def filled(name: str) -> Column:
        if name not in df.columns:
            return F.lit(default)
        return F.coalesce(F.col(name).cast("string"), F.lit(default))
    return df.withColumns({name: filled(name) for name in columns})
