"""Conversations rendered with a turn template and read back by a deterministic parser.

Only column expressions are used. A conversation is first rendered as it is; the parser reads
the rendered text, and its turns are compared with the source. Where they differ, the turns
that do not survive on their own are escaped, then all turns; what still differs is an error.

Grammar, one production per turn:
    user       <s>[INST] text [/INST]
    assistant  <s>text</s>
    system     <s><<SYS>>text<</SYS>>
    any other  <s><<ROLE>>role<</ROLE>>text</s>
A text holds no control string. In an escaped text, a backslash is ``\\b``, and the first
character of a control string is ``\\l`` for ``<`` or ``\\q`` for ``[``; the parser always reads
these three back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template.
CONTROL = r"</?s>|\[/?INST\]|<</?SYS>>|<</?ROLE>>"
_ANGLE = r"<(?=/?s>|</?SYS>>|</?ROLE>>)"
_SQUARE = r"\[(?=/?INST\])"
_TURN = "struct<role:string,text:string>"


def escaped(text: Column) -> Column:
    """``text`` without control strings; ``unescaped`` gives it back."""
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    text = F.regexp_replace(text, F.lit(_ANGLE), F.lit(r"\\l"))
    return F.regexp_replace(text, F.lit(_SQUARE), F.lit(r"\\q"))


def unescaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\l"), F.lit("<"))
    text = F.replace(text, F.lit("\\q"), F.lit("["))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn by the grammar. A role that is none of the three named ones is always escaped."""
    return F.concat(
        F.lit("<s>"),
        F.when(role == "user", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
        .when(role == "assistant", F.concat(text, F.lit("</s>")))
        .when(role == "system", F.concat(F.lit("<<SYS>>"), text, F.lit("<</SYS>>")))
        .otherwise(F.concat(F.lit("<<ROLE>>"), escaped(role), F.lit("<</ROLE>>"), text,
                            F.lit("</s>"))))


def rendered(turns: Column) -> Column:
    """The text of an array of (role, text)."""
    return F.array_join(F.transform(turns, lambda t: rendered_turn(t.role, t.text)), "")


def _read_turn(chunk: Column) -> Column:
    """(role, text) of what follows a turn mark; null where it is no production."""
    def inner(before: str, after: str) -> Column:
        return F.substring(chunk, F.lit(len(before) + 1),
                           F.length(chunk) - F.lit(len(before) + len(after)))

    def turn(role: Column, body: Column) -> Column:
        return F.when(~body.rlike(CONTROL), F.struct(role.alias("role"),
                                                     unescaped(body).alias("text")))

    head = F.substring_index(chunk, "<</ROLE>>", 1)
    other = F.substring(chunk, F.length(head) + F.lit(len("<</ROLE>>") + 1),
                        F.length(chunk) - F.length(head) - F.lit(len("<</ROLE>></s>")))
    name = F.substring(head, F.lit(len("<<ROLE>>") + 1), F.length(head))
    return (
        F.when(chunk.startswith("[INST] ") & chunk.endswith(" [/INST]")
               & (F.length(chunk) >= len("[INST]  [/INST]")),
               turn(F.lit("user"), inner("[INST] ", " [/INST]")))
        .when(chunk.startswith("<<SYS>>") & chunk.endswith("<</SYS>>"),
              turn(F.lit("system"), inner("<<SYS>>", "<</SYS>>")))
        .when(chunk.startswith("<<ROLE>>") & chunk.endswith("</s>")
              & chunk.contains("<</ROLE>>") & ~name.rlike(CONTROL),
              turn(unescaped(name), other))
        .when(chunk.endswith("</s>"), turn(F.lit("assistant"), inner("", "</s>"))))


def parsed(formatted: Column) -> Column:
    """The turns of a rendered text as an array of (role, text); an unreadable turn is null.

    A text that does not begin with a turn mark has a null turn in front.
    """
    chunks = F.split(formatted, "<s>", -1)
    turns = F.transform(F.slice(chunks, F.lit(2), F.size(chunks)), _read_turn)
    return F.when(formatted == "", F.array().cast(f"array<{_TURN}>")) \
        .when(F.element_at(chunks, 1) == "", turns) \
        .otherwise(F.concat(F.array(F.lit(None).cast(_TURN)), turns))


def _survives(turns: Column, text: Column) -> Column:
    return F.coalesce(parsed(text) == turns, F.lit(False))


def _escaped_turns(turns: Column, which) -> Column:
    return F.transform(turns, lambda t: F.struct(
        t.role.alias("role"), F.when(which(t), escaped(t.text)).otherwise(t.text).alias("text")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``rounds`` of escaping.

    Turns stand in order of ``turn``, null first; equal turn numbers by role, then text, and
    repeated rows are turns of their own. Null texts and roles are empty. Null ids form one
    conversation. Other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select("conv_id", F.col("turn").alias("at"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    source = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("rows"))
    source = source.select("conv_id", F.transform("rows", lambda r: F.struct(
        r.role.alias("role"), r.text.alias("text"))).alias("turns"))

    turns_, text = F.col("turns"), F.col("text")
    plain = source.withColumn("text", rendered(turns_))
    plain = plain.withColumn("round", F.when(_survives(turns_, text), 0).otherwise(1))

    def conflicts(t: Column) -> Column:
        one = F.array(F.struct(t.role.alias("role"), t.text.alias("text")))
        return ~_survives(one, rendered(one))

    some = plain.withColumn("text", F.when(F.col("round") == 0, text).otherwise(
        rendered(_escaped_turns(turns_, conflicts))))
    some = some.withColumn("round", F.when(
        (F.col("round") == 0) | _survives(turns_, text), F.col("round")).otherwise(2))
    whole = some.withColumn("text", F.when(F.col("round") < 2, text).otherwise(
        rendered(_escaped_turns(turns_, lambda t: F.lit(True)))))
    checked = F.when((F.col("round") == 2) & ~_survives(turns_, text),
                     F.raise_error(F.lit("a conversation cannot be read back"))).otherwise(text)
    return whole.select("conv_id", checked.alias("formatted"),
                        F.col("round").alias("rounds"))


def read_conversations(formatted: DataFrame) -> DataFrame:
    """``turns`` as the parser reads them from ``formatted``, beside the other columns."""
    return formatted.withColumn("turns", parsed(F.col("formatted")))


def loss_texts(turns: Column) -> Column:
    """The texts under the loss mask: those of the assistant, in order."""
    return F.transform(F.filter(turns, lambda t: t.role == "assistant"), lambda t: t.text)


def loss_spans(formatted: DataFrame) -> DataFrame:
    """The loss mask as spans of code points: ``conv_id``, ``turn`` from 0, ``start``, ``length``.

    A span covers the text of an assistant turn as it stands in ``formatted``, escapes included.
    """
    from pyspark.sql import Window
    chunk = F.col("chunk")
    rows = formatted.select("conv_id", F.posexplode(F.split("formatted", "<s>", -1))
                            .alias("at", "chunk"))
    before = Window.partitionBy("conv_id").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length(chunk) + 3).over(before), F.lit(0)))
    return rows.filter((F.col("at") > 0) & (_read_turn(chunk).role == "assistant")).select(
        "conv_id", (F.col("at") - 1).alias("turn"), F.col("start").cast("long").alias("start"),
        (F.length(chunk) - 4).cast("long").alias("length"))
