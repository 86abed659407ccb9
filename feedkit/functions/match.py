"""Predicates as Column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_values(c: Column, values: Sequence | None) -> Column:
    """In the list; an empty or missing list lets everything pass."""
    return c.isin(*values) if values else F.lit(True)


def match_range(c: Column, low=None, high=None) -> Column:
    """In the closed range, either bound optional; NULL fails once a bound is set."""
    tests = []
    if low is not None:
        tests.append(c >= low)
    if high is not None:
        tests.append(c <= high)
    return F.coalesce(reduce(and_, tests), F.lit(False)) if tests else F.lit(True)


def match_season(ts: Column, m1, d1, m2, d2) -> Column:
    """Month-day in the range, around New Year if it starts after it ends.

    A missing bound lets everything pass; a NULL timestamp fails otherwise.
    """
    if not (m1 and d1 and m2 and d2):
        return F.lit(True)
    at = F.month(ts) * 100 + F.dayofmonth(ts)
    first, last = m1 * 100 + d1, m2 * 100 + d2
    inside = (at >= first) & (at <= last) if first <= last else (at >= first) | (at <= last)
    return F.coalesce(inside, F.lit(False))


def name_like(c: Column, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None,
              escape: str = "!", names: Sequence[str] | None = None) -> Column:
    """LIKE any of ``include``, none of ``exclude``, and none of the exact ``names``."""
    test = F.lit(True)
    if include:
        test = test & reduce(or_, [F.like(c, F.lit(p), F.lit(escape)) for p in include])
    for p in exclude or ():
        test = test & ~F.like(c, F.lit(p), F.lit(escape))
    if names:
        test = test & ~c.isin(*names)
    return F.coalesce(test, F.lit(False))


def expired_by_suffix(name: Column, days_back: int, as_of: Column | dt.date | str) -> Column:
    """Name ends in ``_YYYYMMDD``, a real date, whose start is over ``days_back`` days before ``as_of``.

    ``as_of`` may have a time of day; a plain date counts as its midnight.
    """
    suffix = F.substring_index(name, "_", -1)
    stamp = F.try_to_date(F.when(F.rlike(name, F.lit(".*_[0-9]{8}$")), suffix), "yyyyMMdd")
    moment = (as_of if isinstance(as_of, Column) else F.lit(str(as_of))).cast("timestamp_ntz")
    return F.coalesce(F.date_add(stamp, int(days_back)).cast("timestamp_ntz") < moment, F.lit(False))


def glob_regex(pattern: Column) -> Column:
    """A shell-style name pattern (``*``, ``?``, ``[..]``) as an anchored regular expression.

    A ``[`` without a ``]`` behind it stands for itself, and so do ``[``, ``^`` and ``&`` inside brackets.
    """
    # sets: an optional "!", a first character that may be "]", others up to "]"
    pieces = F.regexp_extract_all(pattern, F.lit(r"(?s)(\[!?\][^\]]*\]|\[!?[^\]!][^\]]*\]|\[![^\]]+\]|.)"), F.lit(1))

    def piece(p):
        body = F.substring(p, F.lit(2), F.length(p) - 2)
        negated = F.startswith(body, F.lit("!")) & (F.length(body) > 1)
        inner = F.regexp_replace(F.when(negated, F.substring(body, F.lit(2), F.length(body))).otherwise(body), r"([\\\[\]^&])", r"\\$1")
        chosen = F.concat(F.when(negated, "[^").otherwise("["), inner, F.lit("]"))
        plain = F.regexp_replace(p, r"([\\.^$|+(){}\[\]])", r"\\$1")
        return F.when(p == "*", ".*").when(p == "?", ".").when(F.length(p) > 2, chosen).otherwise(plain)

    return F.concat(F.lit("(?s)^"), F.array_join(F.transform(pieces, piece), ""), F.lit("$"))


def glob_literal_prefix(pattern: Column) -> Column:
    """The part of a name pattern before its first wildcard."""
    return F.regexp_extract(pattern, r"^([^*?\[]*)", 1)


def glob_literal_suffix(pattern: Column) -> Column:
    """The part of a name pattern behind its last wildcard."""
    return F.regexp_extract(pattern, r"([^*?\[\]]*)$", 1)


def glob_literal_part(pattern: Column) -> Column:
    """The longest part of a name pattern without wildcards; the first of several."""
    parts = F.split(pattern, r"(?s)\[!?\][^\]]*\]|\[!?[^\]!][^\]]*\]|\[![^\]]+\]|[*?]", -1)
    longest = F.array_max(F.transform(parts, lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("i"), p.alias("part"))))
    return longest["part"]
