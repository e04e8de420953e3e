"""Dates, weeks, calendars and timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Zone names allowed in mail-style timestamps, in minutes from UTC.
MAIL_ZONES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -240, "ADT": -180,
    "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420,
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c) -> Column:
    return col(c).cast("date")


def safe_date(c) -> Column:
    """Date, or NULL where the text is not one."""
    return col(c).try_cast("date")


def week_u(c) -> Column:
    """Week of the calendar year, weeks start on Sunday, 0 before the first Sunday."""
    d = col(c)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def iso_year_week(c) -> tuple[Column, Column]:
    d = col(c)
    return F.extract(F.lit("YEAROFWEEK"), d).cast("int"), F.weekofyear(d)


def days_between(end, start) -> Column:
    return F.datediff(col(end), col(start))


def trailing_start(as_of, n: int, unit: str) -> Column:
    """``as_of`` minus n days, months or years."""
    anchor = as_of if isinstance(as_of, Column) else F.lit(as_of)
    anchor = anchor.cast("date")
    if unit == "day":
        return F.date_sub(anchor, n)
    return F.add_months(anchor, -n * {"month": 1, "year": 12}[unit])


def month_start(c) -> Column:
    return F.trunc(col(c), "MM")


def week_end(c) -> Column:
    """The Sunday that closes the week of a date."""
    return F.next_day(F.date_sub(col(c), 1), "SUN")


def decade(c) -> Column:
    return (F.floor(F.year(col(c)) / 10) * 10).cast("int")


def calendar(start, end, step: str = "INTERVAL 1 DAY") -> Column:
    """Array of dates from start to end, both included; NULL when the range is empty."""
    a, b = col(start).cast("date"), col(end).cast("date")
    return F.when(a <= b, F.sequence(a, b, F.expr(step)))


def month_range(after, n: int) -> Column:
    """The n month starts that follow a date."""
    first = F.add_months(month_start(after), 1)
    return F.sequence(first, F.add_months(first, n - 1), F.expr("INTERVAL 1 MONTH"))


def safe_ts(c, fallback) -> Column:
    return F.coalesce(col(c).try_cast("timestamp"), col(fallback))


def parse_any_ts(c) -> Column:
    """UTC instant from ISO-8601 text, else from mail-style text, else NULL."""
    text = F.trim(col(c))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))

    mail = r"(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}):(\d{2})(:\d{2})? *([A-Z]{1,3}|[+-]\d{4})?"
    part = lambda i: F.regexp_extract(text, mail, i)
    seconds = F.when(part(6) == "", ":00").otherwise(part(6))
    wall = F.try_to_timestamp(
        F.concat(part(1), F.lit(" "), F.initcap(part(2)), F.lit(" "), part(3), F.lit(" "),
                 part(4), F.lit(":"), part(5), seconds),
        F.lit("d MMM yyyy HH:mm:ss"),
    )
    zone = part(7)
    named = F.coalesce(F.create_map(*[F.lit(x) for kv in MAIL_ZONES.items() for x in kv])[zone], F.lit(0))
    digits = zone.try_cast("int")
    numeric = F.signum(digits) * (F.floor(F.abs(digits) / 100) * 60 + F.abs(digits) % 100)
    minutes = F.when(zone.rlike(r"^[+-]\d{4}$"), numeric).otherwise(named).cast("int")
    utc = wall - F.make_interval(mins=minutes)
    return F.coalesce(iso, F.when(text.rlike(mail), utc))


def fmt_ts(c, pattern: str = "yyyy-MM-dd HH:mm:ss", missing: str = "–") -> Column:
    return F.coalesce(F.date_format(col(c), pattern), F.lit(missing))


def week_label(year, week) -> Column:
    return F.format_string("%d-W%02d", col(year), col(week))
