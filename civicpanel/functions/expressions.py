"""Column expressions. All are native Spark columns and stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers -------------------------------------------------------------------


def safe_ratio(num: str | Column, den: str | Column, scale: float | None = None) -> Column:
    """num / den, NULL when the denominator is zero."""
    ratio = F.try_divide(col(num), col(den))
    return ratio if scale is None else ratio * F.lit(scale)


def at_least(value: str | Column, floor: float = 0.0) -> Column:
    """Clamp from below. NULL stays NULL (a bare ``greatest`` would return the floor)."""
    value = col(value)
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def number_or_missing(text: str | Column, marks: Iterable[str] = fv.MISSING_MARKS) -> Column:
    """Text to double; missing marks give NULL, any other non-number still raises.

    The cast sits inside the condition, so a filter moved by the optimizer cannot
    make it see a mark.
    """
    text = col(text)
    return F.when(~text.isin(list(marks)), text.cast("double"))


def round_half_even(value: str | Column, digits: int) -> Column:
    return F.bround(col(value), digits)


# --- predicates ----------------------------------------------------------------


def years_between(moment: str | Column, first: int, last: int) -> Column:
    """Inclusive year range on a date or timestamp, in a form parquet can push down."""
    moment = col(moment)
    return (moment >= F.lit(date(first, 1, 1))) & (moment < F.lit(date(last + 1, 1, 1)))


def in_years(moment: str | Column, years: Iterable[int]) -> Column:
    """Some years of a date or timestamp, as ranges that parquet can push down."""
    return reduce(Column.__or__, [years_between(moment, y, y) for y in sorted(set(years))], F.lit(False))


def subtotal_code(code: str | Column, pattern: str, grand_total: str) -> Column:
    """Codes of a hierarchy that are sub-totals, without the grand total."""
    code = col(code)
    return code.like(pattern) & (code != F.lit(grand_total))


def code_between(code: str | Column, first: str, last: str, length: int | None = None) -> Column:
    """String range on the first characters of a code, both ends included."""
    return F.substring(col(code), 1, length or len(first)).between(first, last)


def died_under_one(age: str | Column, born: str | Column, died: str | Column) -> Column:
    """Age 0, or no age but both dates less than 365 days apart.

    A death date before the birth date gives a negative difference and qualifies.
    """
    age, born, died = col(age), col(born), col(died)
    by_dates = born.isNotNull() & died.isNotNull() & (F.datediff(died, born) < 365)
    return (age == 0) | (age.isNull() & by_dates)


def mentions_any(text: str | Column, words: Iterable[str] = fv.POPULATION_WORDS) -> Column:
    """Case-insensitive search for any of the words."""
    lowered = F.lower(col(text))
    return reduce(lambda a, b: a | b, [lowered.contains(w.lower()) for w in words])


def is_value(value: str | Column) -> Column:
    """Neither NULL nor NaN."""
    value = col(value).cast("double")
    return value.isNotNull() & ~F.isnan(value)


# --- dates and periods ---------------------------------------------------------


def period_year(period: str | Column) -> Column:
    """Year of a ``YYYYQQ`` code."""
    return F.substring(col(period), 1, 4).cast("int")


def period_quarter(period: str | Column) -> Column:
    """Quarter of a ``YYYYQQ`` code."""
    return F.substring(col(period), 5, 2).cast("int")


def term_start(election_year: str | Column) -> Column:
    return F.make_date(col(election_year) + 1, F.lit(1), F.lit(1))


def term_end(election_year: str | Column, length: int = 4) -> Column:
    return F.make_date(col(election_year) + length, F.lit(12), F.lit(31))


# --- labels --------------------------------------------------------------------


def label(*parts: str | Column) -> Column:
    """Concatenate; NULL if any part is NULL. Plain strings are literal text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def first_word(text: str | Column) -> Column:
    return F.get(F.split(F.trim(col(text)), r"\s+"), F.lit(0))


def name_and_party(name: str | Column, party: str | Column) -> Column:
    return label(first_word(name), " (", col(party), ")")


def trimmed_list(text: str | Column) -> Column:
    """Comma list to an array of trimmed items."""
    return F.transform(F.split(col(text), ","), lambda item: F.trim(item))


# --- nested values -------------------------------------------------------------


def first_match(array: str | Column, predicate) -> Column:
    """First array element that satisfies the predicate, NULL if none does."""
    return F.get(F.filter(col(array), predicate), F.lit(0))


def first_map_value(mapping: str | Column) -> Column:
    return F.get(F.map_values(col(mapping)), F.lit(0))


# --- checks --------------------------------------------------------------------


def require(value: str | Column, message: str, kind: str = "int") -> Column:
    """The value, or an error at run time when it is NULL.

    The last alternative is never reached; it tells Catalyst that the result is not
    nullable, so joins add no null filter on it.
    """
    return F.coalesce(col(value), F.raise_error(F.lit(message)), F.lit(0).cast(kind))
