"""Filters. "Missing" is null, zero or the empty string, and the rules differ per use."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def truthy_number(value: Column) -> Column:
    """Neither null nor zero."""
    return F.coalesce(value != 0, F.lit(False))


def truthy_text(value: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(value != "", F.lit(False))


def in_closed(value: Column, low, high) -> Column:
    """``low <= value <= high``; null is outside."""
    return F.coalesce(value.between(low, high), F.lit(False))


def in_half_open(value: Column, low, high=None) -> Column:
    """``low <= value < high``; no upper edge when ``high`` is None; null is outside."""
    inside = value >= low
    if high is not None:
        inside = inside & (value < high)
    return F.coalesce(inside, F.lit(False))


def member_of(value: Column, members: list) -> Column:
    """Value is in the list; null is not."""
    return F.coalesce(value.isin(members), F.lit(False))


def contains_any(text: Column, phrases: list[str]) -> Column:
    """Case-sensitive: text contains at least one phrase."""
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.coalesce(text.contains(phrase), F.lit(False))
    return hit


def has_token(tokens: Column, token: str) -> Column:
    """A space-separated token list holds ``token``."""
    return F.coalesce(F.array_contains(F.split(tokens, " "), token), F.lit(False))


def money_or_percent(text: Column) -> Column:
    """Starts with ``$`` or ends with ``%``."""
    return text.startswith("$") | text.endswith("%")
