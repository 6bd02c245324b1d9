"""Text builders used by the table-cleaning jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowferry.functions.convert import left_trimmed


def full_name(*parts: Column) -> Column:
    """Parts joined by a space; NULL, blank and the word "null" are left out, kept parts stay as they are.

    ``concat_ws`` leaves out NULLs, so a part that does not count is made NULL.
    """
    kept = [F.when((left_trimmed(p) != "") & (F.lower(p) != "null"), p) for p in parts]
    return F.concat_ws(" ", *kept)


def key_text(*parts: Column) -> Column:
    """Key columns as one ``a|b`` text for reports; NULL prints as empty. Never join on it."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def split_key(col: Column, position: int) -> Column:
    """The part at ``position`` (from 1) of an ``a|b`` text."""
    return F.split_part(col, F.lit("|"), F.lit(position))


def fixed2(col: Column) -> Column:
    """A number with exactly two decimals, as text, rounded half away from zero."""
    cents = F.round(F.abs(col) * 100).try_cast("bigint")
    sign = F.when((col < 0) & (cents > 0), F.lit("-")).otherwise(F.lit(""))
    whole = F.call_function("div", cents, F.lit(100)).cast("string")
    return F.concat(sign, whole, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def contains_any(col: Column, words: Sequence[str]) -> Column:
    """True where the upper-cased text holds one of the words."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(F.upper(col), F.lit(word.upper()))
    return hit
