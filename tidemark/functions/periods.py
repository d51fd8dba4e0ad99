"""Periods as integers.

A period string (``2026``, ``2026-Q3``, ``2026-07``, ``2026-W30``,
``2026-07-25``) maps to an integer ordinal ``pidx`` within its cadence, so that
"n periods earlier" is a subtraction and calendar-aware look-ups are RANGE
window frames.  All functions are Column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five period grammars, steps per year, minimum history for a
# z-score, and how far a denominator may be carried, per cadence.
PERIOD_GRAMMAR = {
    "annual": r"^\d{4}$",
    "quarterly": r"^\d{4}-Q[1-4]$",
    "monthly": r"^\d{4}-(0[1-9]|1[0-2])$",
    "weekly": r"^\d{4}-W(0[1-9]|[1-4]\d|5[0-3])$",
    "daily": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$",
}
STEPS_PER_YEAR = {"annual": 1, "quarterly": 4, "monthly": 12, "weekly": 52, "daily": 365}
MIN_HISTORY = {"annual": 8, "quarterly": 12, "monthly": 24, "weekly": 52, "daily": 60}
MAX_CARRY = {"annual": 1, "quarterly": 4, "monthly": 12, "weekly": 52, "daily": 365}

# 1970-01-05 was the first Monday after the epoch.
_FIRST_MONDAY = 4


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def by_cadence(cadence, table: dict) -> Column:
    """A per-cadence constant as a ``CASE`` expression."""
    out = None
    for name, value in table.items():
        hit = _c(cadence) == name
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def steps_per_year(cadence) -> Column:
    return by_cadence(cadence, STEPS_PER_YEAR)


def cadence_of(period) -> Column:
    """Cadence of a period string; NULL when it fits no grammar."""
    out = None
    for name, pattern in PERIOD_GRAMMAR.items():
        hit = _c(period).rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def period_is_valid(period, cadence) -> Column:
    return F.coalesce(cadence_of(period) == _c(cadence), F.lit(False))


def month_of(date) -> Column:
    return F.year(date) * 12 + F.month(date) - 1


def week_of(date) -> Column:
    """ISO week ordinal: Monday of the week, counted in weeks."""
    days = F.unix_date(_c(date).cast("date"))
    return F.floor((days - _FIRST_MONDAY) / F.lit(7.0)).cast("int")


def pidx_of_date(date, cadence: str) -> Column:
    if cadence == "annual":
        return F.year(date)
    if cadence == "quarterly":
        return F.year(date) * 4 + F.quarter(date) - 1
    if cadence == "monthly":
        return month_of(date)
    if cadence == "weekly":
        return week_of(date)
    if cadence == "daily":
        return F.unix_date(_c(date).cast("date"))
    raise ValueError(f"unknown cadence: {cadence}")


def _digits(period, start: int, length: int) -> Column:
    return F.substring(_c(period), start, length).try_cast("int")


def _iso_monday(year: Column, week: Column) -> Column:
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    return F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)


def pidx_of_period(period) -> Column:
    """Ordinal of a period string in its own cadence; NULL when malformed."""
    kind = cadence_of(period)
    year = _digits(period, 1, 4)
    return (
        F.when(kind == "annual", year)
        .when(kind == "quarterly", year * 4 + _digits(period, 7, 1) - 1)
        .when(kind == "monthly", year * 12 + _digits(period, 6, 2) - 1)
        .when(kind == "weekly", week_of(_iso_monday(year, _digits(period, 7, 2))))
        .when(kind == "daily", F.unix_date(_c(period).try_cast("date")))
        .cast("int")
    )


def month_text(month) -> Column:
    m = _c(month)
    return F.concat(
        F.lpad(F.floor(m / F.lit(12.0)).cast("int").cast("string"), 4, "0"),
        F.lit("-"),
        F.lpad((F.pmod(m, F.lit(12)) + 1).cast("string"), 2, "0"),
    )


def quarter_text(quarter) -> Column:
    q = _c(quarter)
    return F.concat(
        F.lpad(F.floor(q / F.lit(4.0)).cast("int").cast("string"), 4, "0"),
        F.lit("-Q"),
        (F.pmod(q, F.lit(4)) + 1).cast("string"),
    )


def period_text(pidx, cadence) -> Column:
    """The period string of an ordinal."""
    p, kind = _c(pidx), _c(cadence)
    monday = F.date_from_unix_date(p * 7 + _FIRST_MONDAY)
    return (
        F.when(kind == "annual", F.lpad(p.cast("string"), 4, "0"))
        .when(kind == "quarterly", quarter_text(p))
        .when(kind == "monthly", month_text(p))
        .when(
            kind == "weekly",
            F.concat(
                F.year(F.date_add(monday, 3)).cast("string"),
                F.lit("-W"),
                F.lpad(F.weekofyear(monday).cast("string"), 2, "0"),
            ),
        )
        .when(kind == "daily", F.date_from_unix_date(p).cast("string"))
    )


def _month_end(month: Column) -> Column:
    year = F.floor(month / F.lit(12.0)).cast("int")
    return F.last_day(F.make_date(year, F.pmod(month, F.lit(12)) + 1, F.lit(1)))


def pidx_end(pidx, cadence) -> Column:
    """Last calendar day a period covers."""
    p, kind = _c(pidx), _c(cadence)
    return (
        F.when(kind == "annual", F.make_date(p, F.lit(12), F.lit(31)))
        .when(kind == "quarterly", _month_end(p * 3 + 2))
        .when(kind == "monthly", _month_end(p))
        .when(kind == "weekly", F.date_from_unix_date(p * 7 + _FIRST_MONDAY + 6))
        .when(kind == "daily", F.date_from_unix_date(p))
    )


def period_end(period) -> Column:
    return pidx_end(pidx_of_period(period), cadence_of(period))


def period_shift(period, n) -> Column:
    """Shift a period string by ``n`` steps of its own cadence."""
    return period_text(pidx_of_period(period) + (F.lit(n) if isinstance(n, int) else n), cadence_of(period))


def first_month(pidx, cadence) -> Column:
    p, kind = _c(pidx), _c(cadence)
    return (
        F.when(kind == "annual", p * 12)
        .when(kind == "quarterly", p * 3)
        .when(kind == "monthly", p)
        .otherwise(month_of(pidx_end(p, kind)))
        .cast("int")
    )


def last_month(pidx, cadence) -> Column:
    return first_month(pidx, cadence) + by_cadence(
        cadence, {"annual": 11, "quarterly": 2, "monthly": 0, "weekly": 0, "daily": 0}
    )


# Spanish month names; the three-letter form is their prefix.
SPANISH_MONTHS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
]


def spanish_month(name) -> Column:
    """Month number of a Spanish month name or three-letter abbreviation."""
    text = F.lower(F.trim(_c(name)))
    out = None
    for number, full in enumerate(SPANISH_MONTHS, start=1):
        hit = (text == full) | (F.regexp_replace(text, r"\.$", "") == full[:3])
        if full == "septiembre":
            hit = hit | text.isin("setiembre", "sept")
        out = F.when(hit, number) if out is None else out.when(hit, number)
    return out


def parse_period(text) -> Column:
    """Publisher date spellings to a canonical monthly or quarterly period.

    Accepts ``2026-Marzo``, ``ENE 1999``, ``Marzo 2026``, ``25/07/2026``,
    ``2026/7``, ``26-T1``, ``2026M07``, ``2026T3`` and canonical periods; any
    other text gives NULL.
    """
    t = F.trim(_c(text))

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(t, pattern, group)

    def monthly(year: Column, month: Column) -> Column:
        number = month.try_cast("int")
        return F.when(number.between(1, 12), F.concat(year, F.lit("-"), F.lpad(number.cast("string"), 2, "0")))

    def quarterly(year: Column, quarter: Column) -> Column:
        return F.concat(year, F.lit("-Q"), quarter)

    year_name = r"^(\d{4})[- ]\s*(\p{L}+\.?)$"
    name_year = r"^(\p{L}+\.?)[- ]\s*(\d{4})$"
    slashed_day = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    slashed_month = r"^(\d{4})/(\d{1,2})$"
    short_quarter = r"^(\d{2})-T([1-4])$"
    coded_month = r"^(\d{4})\s*M(\d{2})$"
    coded_quarter = r"^(\d{4})\s*T([1-4])$"
    return (
        F.when(cadence_of(t).isNotNull(), t)
        .when(t.rlike(year_name), monthly(part(year_name, 1), spanish_month(part(year_name, 2)).cast("string")))
        .when(t.rlike(name_year), monthly(part(name_year, 2), spanish_month(part(name_year, 1)).cast("string")))
        .when(t.rlike(slashed_day), monthly(part(slashed_day, 3), part(slashed_day, 2)))
        .when(t.rlike(slashed_month), monthly(part(slashed_month, 1), part(slashed_month, 2)))
        .when(t.rlike(short_quarter), quarterly(F.concat(F.lit("20"), part(short_quarter, 1)), part(short_quarter, 2)))
        .when(t.rlike(coded_month), monthly(part(coded_month, 1), part(coded_month, 2)))
        .when(t.rlike(coded_quarter), quarterly(part(coded_quarter, 1), part(coded_quarter, 2)))
    )


def month_to_quarter(month) -> Column:
    """Fold a month ordinal to its quarter ordinal."""
    return F.floor(_c(month) / F.lit(3.0)).cast("int")


_MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def pretty_period(period) -> Column:
    """``2026-07`` reads as ``July 2026`` and ``2026-Q1`` as ``Q1 2026``."""
    names = F.array(*[F.lit(m) for m in _MONTH_NAMES])
    year, kind = F.substring(_c(period), 1, 4), cadence_of(period)
    month = F.coalesce(_digits(period, 6, 2), F.lit(1))
    return (
        F.when(kind == "monthly", F.concat_ws(" ", F.get(names, month - 1), year))
        .when(kind == "quarterly", F.concat_ws(" ", F.substring(_c(period), 6, 2), year))
        .otherwise(_c(period))
    )
