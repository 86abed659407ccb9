"""Dates kept as text, and the date words and tokens jobs use."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Format names a job may use, with their Spark patterns.
DATE_FORMATS = {
    "YYYYMM": "yyyyMM",
    "YYYYMMDD": "yyyyMMdd",
    "YYYYMMDDHHMM": "yyyyMMddHHmm",
    "YYYYMMDDHHMMSS": "yyyyMMddHHmmss",
    "YYYY-MM-DD": "yyyy-MM-dd",
    "YYYY/MM/DD": "yyyy/MM/dd",
    "DD/MM/YYYY": "dd/MM/yyyy",
    "MM/DD/YYYY": "MM/dd/yyyy",
}

AsOf = Column | dt.date | str | None


def pattern(name: str) -> str:
    if name not in DATE_FORMATS:
        raise ValueError(f"unknown date format {name!r}; known: {', '.join(DATE_FORMATS)}")
    return DATE_FORMATS[name]


def as_of_date(as_of: AsOf) -> Column:
    """The day a job counts as today: given, or the session's current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def parse_date(c: Column, fmt: str, default: Column | None = None) -> Column:
    """Moment (without time zone) of the text, or ``default`` (NULL) where it does not parse."""
    day_pattern, time_pattern = re.fullmatch(r"(.*?)((?:HH)?(?:mm)?(?:ss)?)", pattern(fmt)).groups()
    if time_pattern:
        # Day and time apart: going through a time zone would bend times in its clock changes.
        clock = r"([01][0-9]|2[0-3])" + r"[0-5][0-9]" * (len(time_pattern) // 2 - 1)
        n = len(day_pattern)
        day = F.when(F.rlike(c, F.lit(f"^.{{{n}}}{clock}$")), F.try_to_date(F.left(c, F.lit(n)), day_pattern))
        part = [F.substring(c, n + 1 + 2 * i, 2).try_cast("int") for i in range(len(time_pattern) // 2)]
        parts = part + [F.lit(0)] * (3 - len(part))
        parsed = day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), *parts)
    else:
        parsed = F.try_to_date(c, day_pattern).cast("timestamp_ntz")
    return parsed if default is None else F.coalesce(parsed, default.cast("timestamp_ntz"))


# Where the text of a moment, yyyy-MM-dd HH:mm:ss, has each part.
PARTS = {"yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}


def render_date(moment: Column, fmt: str) -> Column:
    """Text of a moment without time zone in a named format."""
    shown = moment.cast("timestamp_ntz").cast("string")
    pieces = re.findall(r"yyyy|MM|dd|HH|mm|ss|[^a-zA-Z]", pattern(fmt))
    return F.concat(*[F.substring(shown, *PARTS[p]) if p in PARTS else F.lit(p) for p in pieces])


def is_valid_date(c: Column, fmt: str) -> Column:
    return parse_date(c, fmt).isNotNull()


def date_reformat(c: Column, f_in: str, f_out: str, days_back: int = 0, as_of: AsOf = None) -> Column:
    """Text of a date in another format, ``days_back`` days earlier.

    The words ``today`` and ``yesterday`` stand for days counted from ``as_of``.
    Text that is no date gives NULL.
    """
    day = as_of_date(as_of)
    moment = (
        F.when(c == "today", day.cast("timestamp_ntz"))
        .when(c == "yesterday", F.date_sub(day, 1).cast("timestamp_ntz"))
        .otherwise(parse_date(c, f_in))
    )
    return render_date(moment - F.make_dt_interval(days=F.lit(int(days_back))), f_out)


def date_shift(c: Column, n: int, fmt: str, on_error: str = "keep") -> Column:
    """Text date moved by ``n`` days.  Bad text is kept, made NULL or raised."""
    moved = render_date(parse_date(c, fmt) + F.make_dt_interval(days=F.lit(int(n))), fmt)
    if on_error == "keep":
        return F.coalesce(moved, c)
    if on_error == "null":
        return moved
    if on_error == "raise":
        bad = F.raise_error(F.concat(F.lit("not a date: "), c)).cast("string")
        return F.when(c.isNotNull() & moved.isNull(), bad).otherwise(moved)
    raise ValueError("on_error is keep, null or raise")


def date_list(target: Column, days_back: int) -> Column:
    """Array of the days from ``target - days_back`` to ``target``, ascending."""
    if days_back < 0:
        raise ValueError("days_back must not be negative")
    end = target.cast("date")
    return F.sequence(F.date_sub(end, days_back), end)


def months_back_4w(d: Column, n: int) -> Column:
    """The day ``n`` months ago, counted as four weeks each."""
    return F.date_sub(d.cast("date"), 28 * int(n))


def month_token(d: Column, offset: int = 0) -> Column:
    """``yyyyMM`` of the month ``offset`` months from the day."""
    return F.date_format(F.add_months(d.cast("date"), int(offset)), "yyyyMM")


def format_timestamp(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp, with or without time zone."""
    return F.substring(c.cast("string"), 1, 19)


def format_date(c: Column) -> Column:
    """``yyyy-MM-dd`` of a date or timestamp."""
    return F.substring(c.cast("string"), 1, 10)


def zero_date_guard(c: Column, fmt: str | None = None) -> Column:
    """Moment of the text; zero dates and other impossible dates give NULL."""
    return c.try_cast("timestamp_ntz") if fmt is None else parse_date(c, fmt)


def path_tokens(pattern_text: Column | str, as_of: AsOf = None, original: Column | None = None,
                random: Column | None = None) -> Column:
    """Expand date, month and random tokens, then slices of the original name.

    ``<ORIGINAL_NAME_a:b>`` is characters ``a`` to ``b`` of ``original``, counted from the
    end if negative.  A slice token is looked for in the pattern, so the pattern must be a
    plain string for it.
    """
    c = F.lit(pattern_text) if isinstance(pattern_text, str) else pattern_text
    day = as_of_date(as_of)
    tokens = [
        ("<TODAY>", F.date_format(day, "yyyyMMdd")),
        ("<YESTERDAY>", F.date_format(F.date_sub(day, 1), "yyyyMMdd")),
        ("<RANDOM>", F.uuid() if random is None else random),
        ("<NEXT_MONTH>", month_token(day, 1)),
        ("<THIS_MONTH>", month_token(day, 0)),
        ("<LAST_MONTH>", month_token(day, -1)),
    ]
    if isinstance(pattern_text, str):
        tokens = [(token, value) for token, value in tokens if token in pattern_text]
    for token, value in tokens:
        c = F.replace(c, F.lit(token), value)
    if original is None:
        return c
    if not isinstance(pattern_text, str):
        raise ValueError("slices of the original name need a plain string pattern")
    for start, end in slices_in(pattern_text):
        first, last = _place(original, start), _place(original, end)
        piece = F.substring(original, first + 1, F.greatest(last - first, F.lit(0)))
        c = F.replace(c, F.lit(f"<ORIGINAL_NAME_{start}:{end}>"), piece)
    return c


def _place(original: Column, at: int) -> Column:
    return F.lit(at) if at >= 0 else F.greatest(F.length(original) + at, F.lit(0))


def slices_in(pattern_text: str) -> list[tuple[int, int]]:
    """Bounds of the name slices in a pattern."""
    found = []
    for part in pattern_text.split("<ORIGINAL_NAME_")[1:]:
        start, end = part.split(">")[0].split(":")
        if (int(start), int(end)) not in found:
            found.append((int(start), int(end)))
    return found
