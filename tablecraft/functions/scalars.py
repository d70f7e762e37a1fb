"""Scalar building blocks, all native column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL = "9999-12-31 23:59:59"
HASH_SEPARATOR = "||"


def sentinel() -> Column:
    """End of an open interval."""
    return F.lit(SENTINEL).cast("timestamp_ntz")


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def open_end(col: Column) -> Column:
    """NULL also means open."""
    return F.coalesce(col, sentinel())


def differs(a: Column, b: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def band(col: Column, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """First threshold not above the value names the band."""
    result = F.lit(default)
    for limit, label in reversed(list(thresholds)):
        result = F.when(col >= limit, label).otherwise(result)
    return result


def contains_ci(col: Column, text: str) -> Column:
    return F.upper(col).contains(text.upper())


def title_words(col: Column) -> Column:
    """snake_case to Title Case."""
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def words(col: Column) -> Column:
    """Distinct lower-case words, split on underscores and white space."""
    return F.array_distinct(F.split(F.lower(col), r"[_\s]+"))


def word_overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def regex_search(col: Column, pattern: str) -> Column:
    return col.rlike(pattern)


def regex_match(col: Column, pattern: str) -> Column:
    """The pattern must start at the first character."""
    return col.rlike(f"^(?:{pattern})")


def money(col: Column) -> Column:
    """Exact two-decimal money."""
    return col.cast("decimal(18,2)")


def as_double(col: Column) -> Column:
    return col.cast("double")


def cents(col: Column) -> Column:
    """Whole hundredths of a two-decimal double as BIGINT.

    Sums of BIGINT stay in generated code and are exact; DECIMAL sums are not
    needed until totals of many groups meet (``wide_sum``).
    """
    return F.rint(col * 100).cast("long")


def wide_sum(col: Column) -> Column:
    """Sum of BIGINT subtotals that has room for any number of them."""
    return F.sum(col.cast("decimal(20,0)"))


def units(col: Column, digits: int = 2) -> Column:
    """The double value of a whole number of 10^-digits."""
    return col.cast("double") / float(10**digits)


def cents_to_money(col: Column) -> Column:
    """BIGINT cents as DECIMAL(18,2)."""
    return (col.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")


def avg_money(total: Column, n: Column) -> Column:
    """Average of a DECIMAL total with two digits, see ``avg_cents``."""
    return avg_cents(total * 100, n)


def avg_cents(total: Column, n: Column) -> Column:
    """Average of whole cents, half away from zero to cents, NULL for no rows.

    Whole-number division keeps it exact for any number of rows.
    """
    whole = total.cast("decimal(30,0)")
    size = n.cast("decimal(18,0)")
    half_up = F.call_function("div", F.abs(whole) * 2 + size, size * 2)
    signed = F.when(whole < 0, -half_up).otherwise(half_up)
    return F.when(n > 0, (signed.cast("double") / 100.0))


def hash_of(cols: Sequence[str | Column]) -> Column:
    """SHA-256 hex of the columns as text, joined by ``||``.

    Different values never give the same text: NULL is ``\\N``, and a backslash or
    bar within a value gets a backslash before it.
    """
    def text(col: Column) -> Column:
        plain = F.replace(col.cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(plain, F.lit("|"), F.lit("\\|")), F.lit("\\N"))

    texts = [text(F.col(c) if isinstance(c, str) else c) for c in cols]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256)


def mask_hash(col: Column) -> Column:
    return F.sha2(col.cast("string"), 256)


def mask_partial(col: Column, keep: int = 4) -> Column:
    """All but the last ``keep`` characters become ``*``; texts no longer than that, all of them."""
    size = F.length(col)
    shown = F.when(size > keep, F.right(col, F.lit(keep))).otherwise(F.lit(""))
    return F.concat(F.repeat(F.lit("*"), F.when(size > keep, size - keep).otherwise(size)), shown)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("long")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def alternatives(patterns: Sequence[str]) -> str:
    """One regular expression that hits where any of the patterns hits."""
    return "|".join(f"(?:{p})" for p in patterns)


def first_label(col: Column, table: Sequence[tuple[str, Sequence[str]]], anchored: bool) -> Column:
    """Label of the first entry, in table order, with a pattern that hits the column."""
    test = regex_match if anchored else regex_search
    result = F.lit(None).cast("string")
    for label, patterns in reversed(list(table)):
        result = F.when(test(col, alternatives(patterns)), label).otherwise(result)
    return result


def calendar_parts(day: Column, fiscal_month: int = 4) -> dict[str, Column]:
    """Calendar and fiscal attributes of a date; the fiscal year starts in ``fiscal_month``.

    The fiscal year is named after the calendar year in which it ends.
    """
    shifted = F.add_months(day, (13 - fiscal_month) % 12)
    first = F.add_months(F.trunc(shifted, "year"), -((13 - fiscal_month) % 12))
    return {
        "date_sk": F.date_format(day, "yyyyMMdd").cast("long"),
        "day_of_week": (F.weekday(day) + 1).cast("long"),
        "day_of_month": F.dayofmonth(day).cast("long"),
        "day_of_year": F.dayofyear(day).cast("long"),
        "week_of_year": F.weekofyear(day).cast("long"),
        "month_number": F.month(day).cast("long"),
        "month_name": F.date_format(day, "MMMM"),
        "month_name_short": F.date_format(day, "MMM"),
        "quarter_number": F.quarter(day).cast("long"),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "year_number": F.year(day).cast("long"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "year_quarter": F.concat(
            F.date_format(day, "yyyy"), F.lit("-Q"), F.quarter(day).cast("string")
        ),
        "day_name": F.date_format(day, "EEEE"),
        "day_name_short": F.date_format(day, "EEE"),
        "is_weekend": F.weekday(day) >= 5,
        "fiscal_year": F.year(shifted).cast("long"),
        "fiscal_quarter": F.quarter(shifted).cast("long"),
        "fiscal_month": F.month(shifted).cast("long"),
        "fiscal_week": (F.floor(F.datediff(day, first) / 7) + 1).cast("long"),
    }
