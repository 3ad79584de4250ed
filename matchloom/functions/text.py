"""Text expressions: blanks, first matches, code parsing, guarded casts. All are built-in expressions and stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """The text without spaces around it; null where nothing is left. Tabs and line breaks are kept: they are not blanks here."""
    return F.nullif(F.trim(c), F.lit(""))


def nonblank(c: Column) -> Column:
    """True or false, never null."""
    return F.coalesce(F.trim(c) != "", F.lit(False))


def stripped(c: Column) -> Column:
    """Without any white space around it, as spreadsheet tools strip."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def first_of(*columns: Column) -> Column:
    """The first that isn't blank."""
    return F.coalesce(*(blank_to_null(c) for c in columns))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """What a group matched; null without a match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def replace_first(c: Column, pattern: str, by: str) -> Column:
    """Replaces the first match only; by must not refer to groups."""
    return F.when(c.rlike(pattern), F.regexp_replace(c, f"^(?s)(.*?)(?:{pattern})", f"$1{by}")).otherwise(c)


def like_any(c: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (c.ilike(p) for p in patterns), F.lit(False))


def number(c: Column) -> Column:
    """Blank counts as 0; what is no number is null. Thousands separators are dropped."""
    return F.when(~nonblank(c), F.lit(0.0)).otherwise(F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("double"))


def whole_number(c: Column) -> Column:
    """Digits alone make a number, all else is null."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("long"))


def truth(c: Column) -> Column:
    return F.lower(F.trim(c)).isin("true", "t", "1", "yes")


def code_prefix(c: Column, sign: str = "-") -> Column:
    return F.substring_index(c, sign, 1)


def option_number(c: Column) -> Column:
    """The digits after the last hyphen, without leading zeros."""
    return extract(c, r"-0*([0-9]+)$")


OWN_CODE = r"[A-Z]{1,5}-[0-9A-Z]+(?:-[0-9A-Z]+)*(?:_[0-9]+)?"


def last_code(*columns: Column, pattern: str = OWN_CODE) -> Column:
    """The last code in the first column that has any."""
    return F.coalesce(*(F.try_element_at(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({pattern})"), 1), F.lit(-1)) for c in columns))


def key(c: Column) -> Column:
    """Upper case, without blanks around it and without a trailing .0 that spreadsheets add."""
    return F.upper(F.regexp_replace(F.trim(c), r"\.0+$", ""))


def compact(c: Column) -> Column:
    """Lower case, letters and digits of any script only."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def words(c: Column, least: int = 2, without: tuple[str, ...] = ()) -> Column:
    """Lower-case words of at least so many characters, bracketed parts dropped, in order, each once."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(c), r"\[[^\]]*\]", " "), r"[^\p{L}\p{N}]+", " ")
    return F.array_distinct(F.filter(F.split(F.trim(plain), " +"), lambda w: (F.length(w) >= least) & ~w.isin(*without) if without else F.length(w) >= least))


def excel_text(c: Column) -> Column:
    """A cell that spreadsheets keep as text; null stays null."""
    return F.concat(F.lit('="'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def stable_id(*columns: Column) -> Column:
    """md5 of the columns joined by |, nulls skipped: the same for the same values wherever it is worked out."""
    return F.md5(F.concat_ws("|", *(c.cast("string") for c in columns)))
