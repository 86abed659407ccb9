"""From text records to a typed table: stage, reject, merge."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions import text
from feedkit.operators import keys as key_joins
from feedkit.operators.order import with_rank
from feedkit.plans.once import compute_once
from feedkit.plans.storage import materialize

LINE_KEY = ["file", "block", "line_no"]

# Digits of a line's place as one number: up to a million files of 8 TB each in one load.
FILE_BITS, BLOCK_BITS, LINE_BITS = 20, 43, 63
PLACE = "decimal(38,0)"
# Names of files that are broadcast; lines and slices of a table that is dealt out before it is aggregated.
FEW_FILES = 1 << 16
SLICE_LINES, SLICES = 1 << 16, 200
# Copies of one row that are written out at a time.
COPIES = 4096

_DAY = r"[+-]?\d{4,}-\d{2}-\d{2}"
_TIME = r"[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?"


def _problem(field: T.StructField, c: Column, typed: Column) -> Column:
    """What is wrong with the text ``c`` of one field that became ``typed``, or NULL."""
    kind = field.dataType
    if isinstance(kind, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"column {field.name}: {kind.simpleString()} cannot be loaded from text")
    problem = F.lit(None).cast("string")
    if not field.nullable:
        problem = F.when(c == "", f"{field.name}: empty")
    if isinstance(kind, T.StringType):
        width = field.metadata.get("max_length")
        return problem if width is None else F.coalesce(
            problem, F.when(F.length(c) > int(width), f"{field.name}: longer than {width}")
        )
    width = field.metadata.get("max_length")
    if width is not None:
        problem = F.coalesce(problem, F.when(F.length(c) > int(width), f"{field.name}: longer than {width}"))
    unfit = F.when((c != "") & (typed.isNull() | ~_well_formed(kind, c)), f"{field.name}: not {kind.simpleString()}")
    return F.coalesce(problem, unfit)


def _well_formed(kind: T.DataType, c: Column) -> Column:
    """Is the text ``c`` whole, where a cast would fill in, leave out or round something?

    A date has year, month and day.  A timestamp has a time to the second too; a zone only where the type has one.
    A decimal has no digits but zeros beyond its scale.
    """
    if isinstance(kind, T.DateType):
        return F.rlike(c, F.lit(f"^{_DAY}$"))
    if isinstance(kind, T.TimestampNTZType):
        return F.rlike(c, F.lit(f"^{_DAY}{_TIME}$"))
    if isinstance(kind, T.TimestampType):
        return F.rlike(c, F.lit(f"^{_DAY}{_TIME}( ?(Z|UTC|[+-]\\d{{2}}:?\\d{{2}}))?$"))
    if isinstance(kind, T.DecimalType):
        return ~F.rlike(c, F.lit(rf"\.\d{{{kind.scale}}}\d*[1-9]\d*$"))
    return F.lit(True)


def typed_lines(lines: DataFrame, delimiter: str, schema: T.StructType) -> DataFrame:
    """Lines with their fields as typed columns and a ``reason`` where one does not fit.

    All lines stay: ``reason`` is NULL for the good ones, and ``value`` is kept for the others.
    """
    n = len(schema.fields)
    texts = [F.get("_fields", F.lit(i)) for i in range(n)]
    split = compute_once(lines, "_fields", text.split_literal(F.col("value"), delimiter))
    cast = compute_once(split, "_typed", F.struct(*[
        F.nullif(c, F.lit("")).try_cast(f.dataType).alias(f.name) for f, c in zip(schema.fields, texts)
    ]))
    count = F.when(F.size("_fields") != n, F.concat(F.size("_fields").cast("string"), F.lit(f" fields, not {n}")))
    problems = [_problem(f, c, F.col("_typed")[f.name]) for f, c in zip(schema.fields, texts)]
    reason = F.coalesce(count, F.nullif(F.concat_ws("; ", *problems), F.lit("")))
    key = [c for c in (*LINE_KEY, "_id") if c in lines.columns]
    flagged = compute_once(cast, "reason", reason)
    return flagged.select(
        *key, "_typed.*", "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
    )


def stage_typed(lines: DataFrame, delimiter: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the lines that do not convert with their reason."""
    tagged = typed_lines(lines, delimiter, schema)
    key = [c for c in LINE_KEY if c in lines.columns]
    return (
        tagged.where("reason IS NULL").drop("reason", "value"),
        tagged.where("reason IS NOT NULL").select(*key, "value", "reason"),
    )


def numbered(staged: DataFrame, order: Sequence[str], keep: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """Rows in the order of ``order`` with ``_id``, a whole number that grows with it.  Runs at once.

    The rows are written in order once (``keep``), so what computes them runs once, and firsts and equals are
    found by hash aggregates over this one number.
    """
    return keep(staged.sort(*order).withColumn("_id", F.monotonically_increasing_id()))


def first_ids(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_first`` of every key that comes more than once, and the key as ``_k_0, _k_1, ...``."""
    counts = rows.groupBy(*keys).agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    return counts.select("_first", *[F.col(c).alias(f"_k_{i}") for i, c in enumerate(keys)])


def meet_first(rows: DataFrame, firsts: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Adds ``flag``: is this row the first of its key?  Rows of a key that comes once are."""
    same = [F.col(c).eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(keys)]
    met = rows.join(firsts, same, "left")
    return met.select(*rows.columns, (F.coalesce("_first", "_id") == F.col("_id")).alias(flag))


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """About ``n`` rows with ``_id`` in even slices, whatever the splits of the input.

    An aggregate whose keys hardly repeat holds all rows of its task, and a split grows with the files.
    """
    return rows.repartition(max(1, min(SLICES, -(-n // SLICE_LINES))), "_id")


def in_place(staged: DataFrame, keep: Callable[[DataFrame], DataFrame] = materialize) -> tuple[DataFrame, int]:
    """Lines with ``_id``, a number that grows with ``LINE_KEY``, and how many there are.  Runs at once over the files' names and extents.

    The number packs the rank of the file, the block and the line number into one decimal, whose minimum a hash
    aggregate combines before the shuffle; no line is sorted or written.  Only names of files are ranked, and they travel
    to the lines, since one file may hold most of them; beyond ``FEW_FILES`` names, lines meet them in a join that spreads each file's
    lines.  More files or larger ones than the digits hold are numbered through a written table in order (``keep``).
    """
    extents = staged.groupBy("file").agg(
        F.min("block").alias("_low"), F.max("block").alias("_high"), F.min("line_no").alias("_line"), F.count("line_no").alias("_n"),
        F.count("block").alias("_m"), F.count("*").alias("_all"))
    ranked = with_rank(extents, [("file", "asc")], "_rank")
    ends = ranked.agg(F.count("*").alias("files"), F.sum("_all").alias("lines"), F.min("_low").alias("low"), F.max("_high").alias("high"), F.min("_line").alias("line"),
                      F.bool_and(F.col("_n") + F.col("_m") == 2 * F.col("_all")).alias("whole")).first()
    if ends["files"] == 0:
        return staged.withColumn("_id", F.lit(0).cast(PLACE)), 0
    fits = ends["whole"] and ends["files"] < 1 << FILE_BITS and 0 <= ends["low"] and ends["high"] < 1 << BLOCK_BITS and ends["line"] >= 0
    if not fits:
        return numbered(staged, LINE_KEY, keep), ends["lines"]
    of = F.coalesce(F.concat(F.lit("="), "file"), F.lit("")).alias("_of")
    named, ranks = staged.select("*", of), ranked.select(of, "_rank")
    if ends["files"] <= FEW_FILES:
        met = named.join(F.broadcast(ranks), "_of")
    else:
        met = key_joins.join_small(named, ranks, ["_of"], "line_no")
    place = (
        F.col("_rank").cast(PLACE) * F.lit(Decimal(1 << (BLOCK_BITS + LINE_BITS))).cast(PLACE)
        + F.col("block").cast(PLACE) * F.lit(Decimal(1 << LINE_BITS)).cast(PLACE) + F.col("line_no").cast(PLACE)
    )
    return met.select(*staged.columns, place.cast(PLACE).alias("_id")), ends["lines"]


def unique_violations(staged: DataFrame, keys: Sequence[str],
                      order: Sequence[str] = LINE_KEY) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and the rows of a key that is taken already.  Runs at once."""
    marked = mark_first(staged, keys, order)
    return marked.where("_first").drop("_first"), marked.where("NOT _first").drop("_first")


def mark_first(staged: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``_first``: is this row the first of its key in the order of ``order``?  Runs at once for lines and maps only.

    ``LINE_KEY`` tells lines apart.  Of rows that another ``order`` does not tell apart the least by all other columns is
    first.  A key with very many rows stays spread out: its first row is found by an aggregate that combines before
    the shuffle.  Equal rows are counted, not compared.  Rows with maps, which have no order, go through a written table.
    """
    if list(order) == LINE_KEY:
        rows, n = in_place(staged)
        firsts = first_ids(dealt(rows, n), keys)
    elif any(isinstance(f.dataType, T.MapType) for f in staged.schema):
        rows = numbered(staged, order)
        firsts = first_ids(rows, keys)
    else:
        return _mark_counted(staged, keys, order)
    return meet_first(rows, firsts, keys, "_is_first").select(
        *staged.columns, F.col("_is_first").alias("_first"))


def _mark_counted(staged: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``mark_first`` over counts of equal rows; a row with very many copies is counted in shares."""
    names = staged.columns
    # grouping takes -0.0 for 0.0, so its sign is kept beside it
    minus = {c: F.col(c).cast("string") == "-0.0" for c, kind in staged.dtypes if kind in ("float", "double")}
    signs = [m.alias(f"_minus_{c}") for c, m in minus.items()]
    counted = staged.select("*", *signs, (F.spark_partition_id() % key_joins.SPREAD).alias("_share"))
    counted = counted.groupBy(*counted.columns).agg(F.count("*").alias("_n"))
    rest = [c for c in counted.columns if c not in order and c != "_n"]
    counted = counted.withColumn("_place", F.struct(*order, *rest))
    firsts = counted.groupBy(*keys).agg(F.min("_place").alias("_least"), F.sum("_n").alias("_rows")).where("_rows > 1")
    firsts = firsts.select("_least", *[F.col(c).alias(f"_k_{i}") for i, c in enumerate(keys)])
    met = counted.join(firsts, [F.col(c).eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(keys)], "left")
    restored = [F.when(F.col(f"_minus_{c}"), F.lit(-0.0).cast(t)).otherwise(F.col(c)).alias(c) if c in minus else F.col(c) for c, t in staged.dtypes]
    least = F.col("_least").isNull() | F.col("_place").eqNullSafe(F.col("_least"))
    chunks = met.select(*restored, least.alias("_least"), "_n", F.explode(F.expr(f"sequence(0, (_n - 1) div {COPIES})")).alias("_chunk"))
    begin = F.col("_chunk") * COPIES
    copies = chunks.select(*names, "_least", F.explode(F.sequence(begin + 1, F.least(begin + COPIES, F.col("_n")))).alias("_copy"))
    return copies.select(*names, (F.col("_least") & (F.col("_copy") == 1)).alias("_first"))


def duplicate_rows(staged: DataFrame, order: Sequence[str] = LINE_KEY) -> DataFrame:
    """Distinct rows by everything but ``order``, with the first order and the number of copies."""
    data = [c for c in staged.columns if c not in order]
    present = [c for c in order if c in staged.columns]
    copies = F.count("*").alias("copies")
    if len(present) < 2:
        return staged.groupBy(*data).agg(*[F.min(c).alias(c) for c in present], copies).select(*present, *data, "copies")
    counts = staged.groupBy(*data).agg(F.min(F.struct(*present)).alias("_first"), copies)
    return counts.select(*[F.col("_first")[c].alias(c) for c in present], *data, "copies")


def upsert_by_key(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not staged, then all staged rows, columns by name."""
    return key_joins.delete_by_keys(target, staged, keys).unionByName(staged.select(*target.columns))


def full_refresh_rewrite(table: str, staged: DataFrame) -> None:
    """Replace all rows of a table, columns by position.  Runs at once."""
    staged.write.insertInto(table, overwrite=True)


def lob_load(normal: DataFrame, over: DataFrame, lobs: DataFrame, lob_columns: Sequence[str]) -> DataFrame:
    """Rows of normal length, and over-length rows with their contents looked up.

    ``lobs`` is the side table of ``externalize_by_key``: its key columns identify a row, so all
    contents of a row meet it in one join.  A row whose content is missing raises when it is read.
    """
    names = [c for c in lobs.columns if c not in ("lob_id", "column", "field", "content")]
    place = "column" if "column" in lobs.columns else "field"
    found = []
    for i, c in enumerate(lob_columns):
        mine = F.when(F.col(place) == c, F.struct("lob_id", "content"))
        found.append(F.max(mine).alias(f"_c_{i}"))
    contents = lobs.groupBy(*names).agg(*found).select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(names)], *[f"_c_{i}" for i in range(len(lob_columns))])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{i}")) for i, k in enumerate(names)]
    met = over.join(contents, same, "left")
    for i, c in enumerate(lob_columns):
        lost = F.raise_error(F.concat(F.lit("no content for "), F.col(c))).cast("string")
        met = met.withColumn(c, F.when(F.col(f"_c_{i}.lob_id") == F.col(c), F.col(f"_c_{i}.content")).otherwise(lost))
    return normal.unionByName(met.select(*over.columns), allowMissingColumns=True)


KINDS = {"applied": "good", "et": "et", "uv": "uv", "duplicates": "duplicate"}


def load_metrics(tagged: DataFrame, deleted: DataFrame | int | None = None, kind: str = "kind") -> DataFrame:
    """One row of counts over rows tagged good, et, uv or duplicate, and deleted target rows (or their number).

    ``status`` is ``failed`` when anything was rejected, although the good rows count as applied.
    """
    rows = tagged.select(F.col(kind).alias("k"))
    if isinstance(deleted, DataFrame):
        rows = rows.unionAll(deleted.select(F.lit("deleted").alias("k")))
    k = F.col("k")
    counted = rows.agg(
        F.count_if(k != "deleted").alias("rows_read"),
        *[F.count_if(k == tag).alias(name) for name, tag in KINDS.items()],
        (F.lit(deleted).cast("long") if isinstance(deleted, int) else F.count_if(k == "deleted")).alias("deleted"),
    )
    return counted.withColumn("status", F.when(F.col("et") + F.col("uv") > 0, "failed").otherwise("ok"))


def reject_snapshot(spark: SparkSession, rejects: Mapping[str, DataFrame | None], table: str, stamp: str) -> list[str]:
    """Keep each set of rejects as ``<table>_tmp_<kind>_<stamp>``.  Runs at once.

    A set that is not there is no error; a set of the same stamp is replaced.  Returns the table names.
    """
    made = []
    for kind, rows in rejects.items():
        if rows is None:
            continue
        name = f"{table}_tmp_{kind}_{stamp}"
        rows.write.mode("overwrite").saveAsTable(name)
        made.append(name)
    return made


def reject_preview(et: DataFrame, uv: DataFrame, order: Sequence[str], n: int = 200) -> DataFrame:
    """First ``n`` rows of each reject set as ``(kind, total, order..., row)``.

    ``total`` is the size of the whole set; ``row`` is the rejected row as JSON.
    """
    parts = []
    for kind, rows in (("et", et), ("uv", uv)):
        total = rows.agg(F.count("*").alias("n")).scalar()
        first = rows.orderBy(*order).limit(n)
        as_json = F.to_json(F.struct(*[c for c in rows.columns if c not in order]))
        parts.append(first.select(F.lit(kind).alias("kind"), total.alias("total"), *order, as_json.alias("row")))
    return parts[0].unionAll(parts[1])


def batch_stems(df: DataFrame, file: str = "file") -> DataFrame:
    """How many logical inputs there are: file names count up to their first dot."""
    return df.agg(F.countDistinct(F.substring_index(F.col(file), ".", 1)).alias("stems"))


def assert_single_batch(df: DataFrame, file: str = "file") -> None:
    """Full mode takes one logical input.  Runs at once and raises if there are more."""
    stems = batch_stems(df, file).first()["stems"]
    if stems > 1:
        raise ValueError(f"full mode takes one input, found {stems}")


def key_discovery(df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """Which candidate keys could be the key: ``(rank, candidate, rows, keys, null_rows, is_key)``."""
    parts = []
    for i, candidate in enumerate(candidates):
        missing = F.lit(False)
        for c in candidate:
            missing = missing | F.col(c).isNull()
        counts = df.groupBy(*candidate).agg(F.count("*").alias("n")).select("n", missing.alias("missing"))
        parts.append(counts.agg(
            F.lit(i + 1).alias("rank"), F.lit(",".join(candidate)).alias("candidate"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("keys"),
            F.coalesce(F.sum(F.when(F.col("missing"), F.col("n"))), F.lit(0)).alias("null_rows"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.withColumn("is_key", (F.col("rows") == F.col("keys")) & (F.col("null_rows") == 0))


def discover_key(df: DataFrame, candidates: Sequence[Sequence[str]]) -> list[str]:
    """The first candidate that is a key.  Runs at once and raises if there is none."""
    found = key_discovery(df, candidates).where("is_key").orderBy("rank").first()
    if found is None:
        raise ValueError("no candidate is a key: name a primary key or load in full mode")
    return found["candidate"].split(",")
