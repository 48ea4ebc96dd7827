"""Date and time functions; ``*_diff`` counts calendar boundaries where the dialect does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "business_day",
    "date_diff",
    "datetime_diff",
    "format_time",
    "from_julian",
    "hhmmss",
    "java_pattern",
    "next_monthly",
    "next_occurrence",
    "parse_date",
    "parse_datetime",
    "timestamp_diff",
    "to_julian",
    "try_parse_date",
    "try_parse_datetime",
    "zoned_local",
]

# strftime directive -> java.time pattern letters (fixed values)
_DIRECTIVES = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%j": "DDD",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%F": "yyyy-MM-dd",
    "%T": "HH:mm:ss",
    "%E*S": "ss.SSSSSS",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_pattern(fmt: str) -> str:
    """Translate a strftime format; literal letters are quoted."""
    out, i = [], 0
    while i < len(fmt):
        token = next((d for d in sorted(_DIRECTIVES, key=len, reverse=True) if fmt.startswith(d, i)), None)
        if token:
            out.append(_DIRECTIVES[token])
            i += len(token)
            continue
        if fmt[i] == "%":
            raise ValueError(f"unknown directive {fmt[i:i + 2]!r} in {fmt!r}")
        out.append(f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i])
        i += 1
    return "".join(out)


def parse_date(c: Column | str, fmt: str) -> Column:
    """PARSE_DATE: fails on bad input."""
    return F.to_date(_col(c), java_pattern(fmt))


def try_parse_date(c: Column | str, fmt: str) -> Column:
    """SAFE.PARSE_DATE: NULL on bad input."""
    return F.try_to_timestamp(_col(c), F.lit(java_pattern(fmt))).cast("date")


def parse_datetime(c: Column | str, fmt: str) -> Column:
    return F.to_timestamp_ntz(_col(c), F.lit(java_pattern(fmt)))


def try_parse_datetime(c: Column | str, fmt: str) -> Column:
    return F.try_to_timestamp(_col(c), F.lit(java_pattern(fmt))).cast("timestamp_ntz")


def format_time(c: Column | str, fmt: str) -> Column:
    """FORMAT_DATE / FORMAT_DATETIME / FORMAT_TIMESTAMP."""
    return F.date_format(_col(c), java_pattern(fmt))


def zoned_local(c: Column | str, zone: str = "America/Toronto") -> Column:
    """An instant (UTC wall time or TIMESTAMP) as local wall time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(c).cast("timestamp_ntz"))


def date_diff(end: Column | str, start: Column | str, part: str = "DAY") -> Column:
    """DATE_DIFF: boundaries of ``part`` crossed (MONTH: 31 Jan to 1 Feb is 1)."""
    e, s = _col(end), _col(start)
    part = part.upper()
    if part == "DAY":
        return F.datediff(e, s).cast("long")
    if part == "ISOWEEK":
        return (F.datediff(F.trunc(e, "week"), F.trunc(s, "week")) / 7).cast("long")
    if part == "WEEK":  # weeks begin on Sunday
        sunday = lambda d: F.date_sub(d, (F.dayofweek(d) - 1).cast("int"))
        return (F.datediff(sunday(e), sunday(s)) / 7).cast("long")
    months = {"MONTH": 1, "QUARTER": 3, "YEAR": 12}[part]
    index = lambda d: F.floor((F.year(d) * 12 + F.month(d) - 1) / months)
    return (index(e) - index(s)).cast("long")


def datetime_diff(end: Column | str, start: Column | str, part: str) -> Column:
    """DATETIME_DIFF: boundaries of SECOND, MINUTE, HOUR or a date part crossed."""
    part = part.upper()
    seconds = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600}.get(part)
    if seconds is None:
        return date_diff(_col(end).cast("date"), _col(start).cast("date"), part)
    e = F.date_trunc(part, _col(end)).cast("timestamp_ntz")
    s = F.date_trunc(part, _col(start)).cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", s, e) / F.lit(seconds)).cast("long")


def timestamp_diff(end: Column | str, start: Column | str, part: str) -> Column:
    """TIMESTAMP_DIFF: whole units elapsed."""
    return F.timestamp_diff(part.upper(), _col(start), _col(end)).cast("long")


def from_julian(c: Column | str) -> Column:
    """YYYYDDD integer to date; 0 and NULL give NULL."""
    n = F.nullif(_col(c).cast("long"), F.lit(0))
    first = F.make_date(F.floor(n / 1000).cast("int"), F.lit(1), F.lit(1))
    return F.date_add(first, (F.pmod(n, F.lit(1000)) - 1).cast("int"))


def to_julian(c: Column | str) -> Column:
    """Date to YYYYDDD integer."""
    return (F.year(_col(c)) * 1000 + F.dayofyear(_col(c))).cast("long")


def hhmmss(c: Column | str) -> Column:
    """HHMMSS integer to ``hh:mm:ss`` text; 0 gives NULL."""
    n = F.nullif(_col(c).cast("long"), F.lit(0))
    hours, minutes = F.floor(n / 10000), F.floor(F.pmod(n, F.lit(10000)) / 100)
    text = F.format_string("%02d:%02d:%02d", hours, minutes, F.pmod(n, F.lit(100)))
    return F.when(n.isNotNull(), text)


def business_day(c: Column | str) -> Column:
    """Move Sunday by one day and Saturday by two, to Monday."""
    d = _col(c).cast("date")
    return (
        F.when(F.dayofweek(d) == 1, F.date_add(d, 1)).when(F.dayofweek(d) == 7, F.date_add(d, 2)).otherwise(d)
    )


def next_occurrence(first: Column | str, as_of: Column, every_days: int) -> Column:
    """Next date of a series that starts at ``first`` and repeats every ``every_days`` days."""
    f = _col(first)
    steps = F.ceil(F.datediff(as_of, f) / F.lit(every_days))
    return F.when(f >= as_of, f).otherwise(F.date_add(f, (steps * every_days).cast("int")))


def next_monthly(first: Column | str, as_of: Column, day_of_month: Column | str) -> Column:
    """Next date on ``day_of_month``: in the month of ``as_of`` when not yet past, else one month on."""
    f, day = _col(first), _col(day_of_month).cast("int")
    on = lambda base: F.date_add(base, day - F.dayofmonth(base))
    rolled = F.when(day >= F.dayofmonth(as_of), on(as_of)).otherwise(on(F.add_months(as_of, 1)))
    return F.when(f >= as_of, f).otherwise(rolled)
