"""Scalar functions: thin names over Spark's built-ins, each pinned to one exact meaning."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.fixed_values import SURROGATE_KEY_NULL

DATE_PARTS = ("year", "quarter", "month", "week", "day")
TIME_PARTS = ("hour", "minute", "second")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once per row however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def compute_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The kept columns beside new ones that later filters do not compute again.

    A filter on a plain computed column is pushed below it with the expression copied in. It stays
    above a generator, so costly text work goes through a one-row ``inline``.
    """
    entry = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(entry)))


# --- text -------------------------------------------------------------------------------------


def concat_text(*parts: Column | str) -> Column:
    """Concatenation that is NULL when any part is."""
    return F.concat(*[_col(p).cast("string") for p in parts])


def position(needle: str, text: Column | str) -> Column:
    """1-based position of ``needle``, 0 when absent."""
    return F.position(F.lit(needle), _col(text))


def replace_text(text: Column | str, old: str, new: str) -> Column:
    return F.replace(_col(text), F.lit(old), F.lit(new))


def right_text(text: Column | str, length: int) -> Column:
    """Last ``length`` characters; '' for 0."""
    return F.right(_col(text), F.lit(length))


def split_part(text: Column | str, delimiter: str, part: int) -> Column:
    """Part ``part`` counted from the left, or from the right when negative; '' past the ends."""
    return F.split_part(_col(text), F.lit(delimiter), F.lit(part))


def strip_space(text: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(_col(text), r"(?U)^\s+|\s+$", "")


def sanitize_label(text: Column | str, default: str = "triage") -> Column:
    """File-name-safe label: letters, digits, '-' and '_' kept in lower case, the rest '_'."""
    lowered = F.lower(strip_space(text))
    safe = F.regexp_replace(lowered, r"[^\p{L}\p{N}_-]", "_")
    bare = F.regexp_replace(safe, "^_+|_+$", "")
    return F.when(bare == "", F.lit(default)).otherwise(bare)


def clean_label(text: Column | str) -> Column:
    """Trim, halve double blanks, drop trailing footnote digits.

    Digits go in ascending order (all 1s, then all 2s, ... 5s), so 'X21' gives 'X' and 'X12'
    gives 'X1'.
    """
    halved = F.replace(strip_space(text), F.lit("  "), F.lit(" "))
    return strip_space(F.regexp_replace(halved, "5*4*3*2*1*$", ""))


def parse_number(text: Column | str, strict: bool = False) -> Column:
    """Number with thousands commas as double; unreadable text is NULL, or an error if strict."""
    bare = F.replace(_col(text), F.lit(","), F.lit(""))
    return bare.cast("double") if strict else bare.try_cast("double")


# --- casts and NULLs --------------------------------------------------------------------------


def safe_cast(value: Column | str, data_type: str) -> Column:
    """Cast that gives NULL for values that do not fit."""
    return _col(value).try_cast(data_type)


def bool_to_text(value: Column | str) -> Column:
    return _col(value).cast("boolean").cast("string")


def equals_null_safe(left: Column | str, right: Column | str) -> Column:
    return _col(left).eqNullSafe(_col(right))


# --- hashes -----------------------------------------------------------------------------------


def hash_text(value: Column | str) -> Column:
    return F.md5(_col(value).cast("string"))


def canonical_time(value: Column | str) -> Column:
    """Timestamp as fixed-width text, so hashes do not depend on an engine's default format."""
    return F.date_format(_col(value), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def surrogate_key(*columns: Column | str, null_text: str = SURROGATE_KEY_NULL) -> Column:
    """md5 over the '-'-joined text of the columns, with a marker in the place of NULL."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null_text)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def version_hash(*columns: Column | str) -> Column:
    """md5 over the '|'-joined text of the columns, NULL as ''."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


# --- dates ------------------------------------------------------------------------------------


def month_end(text: Column | str) -> Column:
    """Month-end date of 'Mon-YY' text; years 69-99 belong to the 1900s, 00-68 to the 2000s.

    NULL stays NULL; any other text that is no such label is an error that names it.
    """
    label = _col(text)
    readable = F.try_to_date(label, "MMM-yy")
    unreadable = F.raise_error(F.concat(F.lit("unreadable month label: "), label)).cast("date")
    first = F.when(label.isNotNull() & readable.isNull(), unreadable).otherwise(readable)
    pivoted = F.when(F.year(first) >= 2069, F.add_months(first, -1200)).otherwise(first)
    return F.last_day(pivoted)


def make_date(year: Column | int, month: Column | int, day: Column | int) -> Column:
    parts = [F.lit(p) if isinstance(p, int) else p for p in (year, month, day)]
    return F.make_date(*parts)


def trunc_to(part: str, value: Column | str) -> Column:
    """Start of the period holding ``value``, as a zone-free timestamp; weeks start on Monday."""
    if part in DATE_PARTS:
        day = _col(value).cast("date")
        return (day if part == "day" else F.trunc(day, part)).cast("timestamp_ntz")
    if part in TIME_PARTS:
        return F.date_trunc(part, _col(value)).cast("timestamp_ntz")
    raise ValueError(f"unknown date part: {part}")


def add_interval(part: str, amount: Column | int, value: Column | str) -> Column:
    """``value`` plus ``amount`` periods; months clamp to the month's last day."""
    count = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(part, count, _col(value).cast("timestamp_ntz"))


def _period_number(part: str, day: Column) -> Column:
    """Consecutive number of the period holding a date."""
    if part == "year":
        return F.year(day)
    if part == "quarter":
        return F.year(day) * 4 + F.quarter(day)
    if part == "month":
        return F.year(day) * 12 + F.month(day)
    # Day 0 is a Thursday; three days on, weeks of seven days start on Mondays.
    return F.unix_date(day) if part == "day" else F.floor((F.unix_date(day) + 3) / 7)


def boundaries_between(part: str, start: Column | str, end: Column | str) -> Column:
    """Number of period boundaries crossed (31 Jan to 1 Feb is one month), not whole periods."""
    if part in DATE_PARTS:
        first, last = [_period_number(part, _col(c).cast("date")) for c in (start, end)]
        return (last - first).cast("bigint")
    return F.timestamp_diff(part, trunc_to(part, start), trunc_to(part, end))


def last_day_of(part: str, value: Column | str) -> Column:
    """Last day of the period holding ``value``."""
    next_start = add_interval(part, 1, trunc_to(part, value))
    return add_interval("day", -1, next_start).cast("date")


# --- arrays -----------------------------------------------------------------------------------


def typed_array(values: list, data_type: str) -> Column:
    """Array literal with a fixed element type, also when empty."""
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{data_type}>")


def array_slice_join(values: Column | str, limit: int, delimiter: str) -> Column:
    """First ``limit`` elements joined to one text."""
    return F.array_join(F.slice(_col(values), 1, limit), delimiter)


# --- predicates -------------------------------------------------------------------------------


def not_equal_keep_null(value: Column | str, unwanted) -> Column:
    """Inequality that keeps NULLs, as a data-frame mask does."""
    return ~_col(value).eqNullSafe(F.lit(unwanted))


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_known(columns: list[str]) -> Column:
    """No column is NULL. (``dropna`` would also take NaN for missing.)"""
    return all_of(*[F.col(c).isNotNull() for c in columns])


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
