"""Text cleaning as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column, markers: Iterable[str] = ("",)) -> Column:
    """Null for blank text and for listed markers (compared trimmed, any case)."""
    wanted = [m.lower() for m in markers]
    return F.when(~F.lower(F.trim(col)).isin(*wanted), col)


def number_or_null(col: Column, markers: Iterable[str] = ("", ".", "w", "na")) -> Column:
    """Withheld and blank markers become null, the rest a double; bad text is null, not an error."""
    return F.trim(blank_to_null(col, markers)).try_cast("double")


def replace_in_order(col: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements, each applied to the result of the one before."""
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def strip_non_ascii(col: Column, fill: str = "") -> Column:
    """Drop characters outside ASCII, or put ``fill`` for each of them."""
    return F.regexp_replace(col, r"[^\x00-\x7F]", fill)


def repair_utf8(col: Column) -> Column:
    """Text that was UTF-8 but was read as Latin-1. Text that does not decode is left alone."""
    latin = col.rlike(r"^[\x00-\xFF]*$")
    decoded = F.encode(F.when(latin, col), "ISO-8859-1").cast("string")
    return F.when(latin & F.is_valid_utf8(decoded), decoded).otherwise(F.make_valid_utf8(col))


def map_symbols(col: Column, symbols: str = "$%&@", letters: str = "dpna") -> Column:
    """P10: one letter per symbol."""
    return F.translate(col, symbols, letters)


def exact_map(col: Column, mapping: Mapping[str, str | None]) -> Column:
    """Whole-value replacements; other values pass."""
    out = col
    for old, new in mapping.items():
        out = F.when(col == old, F.lit(new)).otherwise(out)
    return out


def key_of(*parts: Column, sep: str = ".", drop: str = "") -> Column:
    """Key from fields and constants, with characters in ``drop`` removed."""
    key = F.concat_ws(sep, *parts)
    return F.translate(key, drop, "") if drop else key


def money(col: Column) -> Column:
    """``$12,345.60`` to a double."""
    return F.regexp_replace(col, r"[$,\s]", "").try_cast("double")


def percent(col: Column) -> Column:
    """``13.5%`` to a share."""
    return F.regexp_replace(col, r"[%\s]", "").try_cast("double") / 100


def first_number(col: Column) -> Column:
    """Leading whole number of a phrase such as ``36 months``."""
    return F.regexp_extract(col, r"(\d+)", 1).try_cast("int")


def tenure_years(col: Column) -> Column:
    """``10+ years`` → 10, ``< 1 year`` → 0, ``n/a`` → null."""
    return F.when(F.ltrim(col).startswith("<"), F.lit(0)).otherwise(first_number(col))


def between_words(col: Column, before: str = "from", after: str = "of") -> Column:
    """Shortest text between two words, null when there is none."""
    found = F.regexp_extract(col, rf"{before} (.+?) {after}", 1)
    return F.when(found != "", found)


def zero_pad(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")
