"""Joins on keys that may be badly skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.functions import match

# How many rows of one key the matching side of a semi or anti join may keep.
SPREAD = 32


def present_keys(df: DataFrame, keys: Sequence[str], nulls: bool = False) -> DataFrame:
    """The keys of ``df`` for the right side of a semi or anti join.

    Each key comes at most ``SPREAD`` times however often it occurs.  The salt keeps the
    join's own exchange directly below it on both sides, which is the shape in which
    Spark splits a skewed partition of the left side at run time.
    """
    chosen = df.select(*keys)
    if not nulls:
        chosen = chosen.dropna("any")
    salted = chosen.withColumn("_salt", F.spark_partition_id() % SPREAD)
    return salted.distinct().drop("_salt")


def _member(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str, nulls: bool) -> DataFrame:
    right = present_keys(other, keys, nulls)
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) if nulls else F.col(k) == F.col(f"_r_{k}") for k in keys]
    return df.join(named, on, how)


def semi(df: DataFrame, other: DataFrame, keys: Sequence[str], nulls: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``other``; NULL keys only match with ``nulls``."""
    return _member(df, other, keys, "left_semi", nulls)


def anti(df: DataFrame, other: DataFrame, keys: Sequence[str], nulls: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``."""
    return _member(df, other, keys, "left_anti", nulls)


def join_small(df: DataFrame, small: DataFrame, keys: Sequence[str], spread_by: str, how: str = "inner") -> DataFrame:
    """Join a table with one row per key, when a key may hold much of ``df``.

    Each small row comes once per salt, and rows choose a salt by ``spread_by``.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_salt")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int"))
    return salted.join(small.select("*", salts), [*keys, "_salt"], how).drop("_salt")


def delete_by_keys(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows that stay; a NULL key never matches."""
    return anti(target, staged, keys)


def rows_to_replace(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows that ``delete_by_keys`` removes."""
    return semi(target, staged, keys)


def tuple_in_filter(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(a, b) IN (SELECT a, b FROM other)``."""
    return semi(df, other, keys)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Compare two ordered lists: ``(position, keys..., status)``.

    ``same``: both have it at this position.  ``moved``: left has it here, right elsewhere.
    ``only_left`` and ``only_right``: the other list lacks it.  Elements of right that are
    in left at another position are not listed again.

    Positions match by a union and an aggregate, memberships by semi and anti joins, so an
    element that fills much of both lists stays spread out.
    """
    sides = left.select(position, *keys, F.lit(1).alias("_side")).unionAll(
        right.select(position, *keys, F.lit(2).alias("_side"))
    )
    # One column says it all, so that every use below reads the same exchange.
    seen = sides.groupBy(position, *keys).agg(F.bit_or("_side").alias("_in"))
    both, l_only, r_only = seen.where("_in = 3"), seen.where("_in = 1"), seen.where("_in = 2")

    def tagged(rows, status):
        return rows.select(position, *keys, F.lit(status).alias("status"))

    return (
        tagged(both, "same")
        .unionAll(tagged(semi(l_only, right, keys, nulls=True), "moved"))
        .unionAll(tagged(anti(l_only, right, keys, nulls=True), "only_left"))
        .unionAll(tagged(anti(r_only, left, keys, nulls=True), "only_right"))
    )


# Positions of one range whose digests are compared.
RANGE = 1 << 16


def reconcile_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str], position: str, width: int = RANGE) -> DataFrame:
    """``reconcile`` that compares only ranges of positions that differ.  ``position`` is a whole number.

    Each side's rows give a count and two sums of 64-bit hashes for every ``width`` positions, combined before the shuffle.
    Ranges with the same three numbers are the same; their rows are taken from the left as they are.  Only the others go
    through ``reconcile``, and what is in one list alone there is looked for in the whole other list.
    """
    def digests(side, name):
        place = F.floor(F.col(position) / width).alias("_range")
        rows = side.select(place, F.xxhash64(position, *keys).alias("_a"), F.xxhash64(F.lit(1), position, *keys).alias("_b"))
        total = [F.sum(F.col(c).cast("decimal(38,0)")) for c in ("_a", "_b")]
        return rows.groupBy("_range").agg(F.struct(F.count("*").alias("n"), *[t.alias(f"t{i}") for i, t in enumerate(total)]).alias(name))

    both = digests(left, "_l").join(digests(right, "_r"), "_range", "full")
    differ = both.where(~F.col("_l").eqNullSafe(F.col("_r"))).select("_range")
    where = F.floor(F.col(position) / width)

    def split(side):
        placed = side.select(position, *keys, where.alias("_range"))
        return semi(placed, differ, ["_range"], nulls=True).drop("_range"), anti(placed, differ, ["_range"], nulls=True).drop("_range")

    (l_near, l_same), (r_near, _) = split(left), split(right)
    found = reconcile(l_near, r_near, keys, position)
    # the other place of an element may lie in a range that is the same
    alone = {s: found.where(F.col("status") == s).drop("status") for s in ("only_left", "only_right")}
    parts = [
        l_same.withColumn("status", F.lit("same")), found.where("status IN ('same', 'moved')"),
        semi(alone["only_left"], right, keys, nulls=True).withColumn("status", F.lit("moved")),
        anti(alone["only_left"], right, keys, nulls=True).withColumn("status", F.lit("only_left")),
        anti(alone["only_right"], left, keys, nulls=True).withColumn("status", F.lit("only_right")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def list_tests(reconciled: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: are the lists ``equal``, and is left a ``prefix`` of right?"""
    same = reconciled.agg(F.count_if(F.col("status") == "same").alias("same"))
    rows = left.agg(F.count("*").alias("l")).scalar()
    other_rows = right.agg(F.count("*").alias("r")).scalar()
    return same.select(
        ((F.col("same") == rows) & (F.col("same") == other_rows)).alias("equal"),
        (F.col("same") == rows).alias("prefix"),
    )


def schema_pairing(source: DataFrame, target: DataFrame) -> DataFrame:
    """Pair two column lists by ``ordinal``; target's other columns come along.

    Lists of different length raise when the result is read.
    """
    extra = [c for c in target.columns if c != "ordinal"]
    renamed = target.select("ordinal", *[F.col(c).alias(f"target_{c}") for c in extra]).withColumn("_t", F.lit(1))
    paired = source.withColumn("_s", F.lit(1)).join(renamed, "ordinal", "full")
    uneven = F.raise_error(F.lit("source and target have different numbers of columns")).cast("int")
    check = F.when(F.col("_s").isNull() | F.col("_t").isNull(), uneven).otherwise(F.col("ordinal"))
    return paired.withColumn("ordinal", check.cast(source.schema["ordinal"].dataType)).drop("_s", "_t")


def missing_feeds(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected feeds of which nothing is present."""
    return anti(expected, present, on)


def missing_feeds_by_pattern(expected: DataFrame, present: DataFrame, pattern: str = "pattern",
                             name: str = "name") -> DataFrame:
    """Expected rows whose name pattern (``*``, ``?``, ``[..]``; several after commas) no
    present name matches.

    A pattern's literal start is an equi-join key, or its literal end if it has no start, or else its longest literal
    part.  A name is offered under those of its own beginnings, ends and parts that have the length of some pattern's and
    are some pattern's, then tested against that pattern.  Patterns of wildcards alone meet the names in ``SPREAD`` shares, so
    no key holds all names.
    """
    single = expected.select(F.col(pattern).alias("_p"), F.explode(F.split(pattern, ",", -1)).alias("_glob")).distinct()
    start, end = match.glob_literal_prefix(F.col("_glob")), match.glob_literal_suffix(F.col("_glob"))
    inside = match.glob_literal_part(F.col("_glob"))
    shares = F.transform(F.sequence(F.lit(0), F.lit(SPREAD - 1)), lambda k: F.concat(F.lit("any:"), k.cast("string")))
    kinds = {"start": start, "end": end, "in": inside}
    marks = F.when(start != "", F.array(F.concat(F.lit("start:"), start)))
    marks = marks.when(end != "", F.array(F.concat(F.lit("end:"), end))).when(inside != "", F.array(F.concat(F.lit("in:"), inside)))
    patterns = single.select("_p", "_glob", F.explode(marks.otherwise(shares)).alias("_mark"))
    # one row: the literal lengths that occur, at most as many as the longest pattern has characters
    used = single.select(F.when(start != "", "start").when(end != "", "end").otherwise("in").alias("_kind"),
                         F.when(start != "", F.length(start)).when(end != "", F.length(end)).otherwise(F.length(inside)).alias("_n"))
    sizes = used.where("_n > 0").agg(*[F.sort_array(F.collect_set(F.when(F.col("_kind") == k, F.col("_n")))).alias(k) for k in kinds])
    names = present.select(F.col(name).alias("_n")).where(F.col("_n").isNotNull()).distinct()
    names = names.select("_n", *[sizes.select(k).scalar().alias(f"_{k}") for k in kinds])
    share = F.concat(F.lit("any:"), F.pmod(F.xxhash64("_n"), F.lit(SPREAD)).cast("string"))

    def cuts(kind, cut):
        return F.transform(F.filter(f"_{kind}", lambda k: k <= F.length("_n")), cut)

    def parts(k):
        places = F.sequence(F.lit(1), F.length("_n") - k + 1)
        return F.transform(places, lambda at: F.concat(F.lit("in:"), F.substring(F.col("_n"), at, k)))

    offers = F.array_distinct(F.concat(
        cuts("start", lambda k: F.concat(F.lit("start:"), F.substring(F.col("_n"), F.lit(1), k))),
        cuts("end", lambda k: F.concat(F.lit("end:"), F.right(F.col("_n"), k))), F.flatten(cuts("in", parts)), F.array(share)))
    offered = semi(names.select("_n", F.explode(offers).alias("_mark")), patterns, ["_mark"])
    found = (
        offered.join(patterns, "_mark")
        .where(F.rlike("_n", match.glob_regex(F.col("_glob"))))
        .select(F.col("_p").alias(pattern))
    )
    return anti(expected, found, [pattern])
