"""Text rules that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pagetally import fixed

FENCE = "```"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace (all Unicode whitespace)."""
    space = fixed.WHITESPACE
    return F.regexp_replace(text, f"^{space}|{space}$", "")


def clean_text(text: Column) -> Column:
    """Collapse each whitespace run to one space and trim."""
    return F.trim(F.regexp_replace(text, fixed.WHITESPACE, " "))


def sanitize_cell(text: Column) -> Column:
    """Make text safe for a pipe table: bars become slashes, newlines become spaces."""
    return F.translate(text, "|\n", "/ ")


def strip_fence(reply: Column) -> Column:
    """Body of a fenced reply; unfenced text is only trimmed; null when the fence has no newline."""
    trimmed = strip(reply)
    body = F.regexp_replace(trimmed, "^[^\\n]*\\n", "")
    body = strip(F.regexp_replace(body, "```\\z", ""))
    return (
        F.when(~trimmed.startswith(FENCE), trimmed)
        .when(F.instr(trimmed, "\n") > 0, body)
    )


def dash_to_missing(code: Column, missing: str = "") -> Column:
    """The em dash placeholder becomes missing."""
    return F.when(code == fixed.NO_CODE, F.lit(missing)).otherwise(code)


def label_case(name: Column) -> Column:
    """``snake_case`` to ``Title Case``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def corpus_path(folder: str, key: Column, suffix: str) -> Column:
    """Path of a document in a one-file-per-key corpus."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), key, F.lit(suffix))


def corpus_key(path: Column, suffix: str) -> Column:
    """Inverse of :func:`corpus_path`; also for a folder ``<column>=<key><suffix>`` of a writer."""
    escaped = suffix.replace(".", "\\.")
    folder = F.regexp_extract(path, f"/[^/=]*=([^/]+){escaped}/[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(
        F.regexp_extract(path, f"([^/]+){escaped}(?:/[^/]*)?$", 1))


def abbreviate(name: Column, short: dict[str, str], missing: str = "?") -> Column:
    """Short name where one exists, the name itself otherwise, ``missing`` for null or empty."""
    pairs = [F.lit(part) for pair in short.items() for part in pair]
    known = F.coalesce(F.create_map(*pairs)[name], name)
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit(missing)).otherwise(known)


def text_sizes(text: Column) -> Column:
    """Characters, bytes and lines of a text."""
    return F.struct(
        F.char_length(text).cast("bigint").alias("chars"),
        F.octet_length(text).cast("bigint").alias("bytes"),
        F.size(F.split(text, "\n")).cast("bigint").alias("lines"),
    )
