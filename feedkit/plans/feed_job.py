"""The transform job: named steps over the lines of many files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.functions import text
from feedkit.operators import feed, keys, repair
from feedkit.plans.once import compute_once
from feedkit.plans.storage import materialize


@dataclass(frozen=True)
class FeedSpec:
    """What the steps of a feed take."""

    delimiter: str = text.DEFAULT_DELIMITER
    n_columns: int | None = None
    in_order: bool = False
    chunk_lines: int = repair.CHUNK_LINES
    limits: Mapping[int, int] = field(default_factory=dict)
    replacements: Mapping[text.BytesLike, text.BytesLike] = field(default_factory=dict)
    prefixes: Mapping[text.BytesLike, int] = field(default_factory=dict)


Step = Callable[[DataFrame], DataFrame]

# Steps that make other rows of the lines; all others change or refuse each line by itself.
WIDE = {"repair_linefeeds"}

COLUMNS = ["file", "block", "line_no", "kind", "value", "failed_step"]


def steps_of(spec: FeedSpec) -> dict[str, Step]:
    """The built-in steps.  A step whose result has ``kind`` can refuse lines."""
    return {
        "repair_linefeeds": lambda df: repair.repair_linefeeds(
            df, spec.delimiter, spec.n_columns, spec.chunk_lines, spec.in_order
        ),
        "replace_chars": lambda df: feed.replace_chars(df, "value", spec.replacements),
        "truncate_columns": lambda df: feed.truncate_columns(df, spec.delimiter, spec.limits),
        "remove_mbc": lambda df: feed.remove_mbc(df, "value", spec.prefixes),
        "split_over_length": lambda df: feed.mark_over_length(df, spec.delimiter, spec.limits),
    }


def transform_chain(lines: DataFrame, names: Sequence[str | Step], spec: FeedSpec,
                    keep: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """Apply steps in order -> ``(file, block, line_no, kind, value, failed_step)``.

    A file with a line that a step refuses stops there: its lines come out as that step
    left them, marked with the step's name.  Other files go on.  Over-length lines leave
    the chain where they are found.

    A step is a built-in name or a function of lines that changes ``value``, or adds
    ``kind``, and keeps all other columns and rows.  Neighbouring steps run as one stage:
    each is applied once to each line, which keeps what it was after every step that can refuse lines; where its file
    stops decides afterwards which of these comes out.  ``keep`` is called on what ``repair_linefeeds`` and a stage that
    can refuse lines give and on the list of failed files, since they are read more than once; by default they are
    checkpointed, so these passes run at once.
    """
    spec = replace(spec, delimiter=text.delimiter_of(spec.delimiter))
    built_in = steps_of(spec)
    if "block" not in lines.columns:
        lines = lines.withColumn("block", F.lit(0).cast("bigint"))
    current = lines.select("file", "block", "line_no", "value")
    finished, stage = [], []

    def run_stage():
        nonlocal current
        if stage:
            out = _stage(current, stage, keep)
            finished.append(out.where("kind <> 'good' OR failed_step IS NOT NULL"))
            current = out.where("kind = 'good' AND failed_step IS NULL").select(*current.columns)
            stage.clear()

    for name in names:
        if name not in WIDE:
            stage.append((name, built_in[name]) if isinstance(name, str) else (name.__name__, name))
            continue
        run_stage()
        out = keep(built_in[name](current))
        failed = keep(out.where("kind = 'error'").select("file").distinct())
        passed = out
        if not failed.isEmpty():
            stopped = keys.semi(out, failed, ["file"])
            finished.append(stopped.withColumn("failed_step", F.lit(name)).select(*COLUMNS))
            passed = keys.anti(out, failed, ["file"])
        current = passed.select(*current.columns)
    if stage:
        last = _stage(current, stage, keep)
    else:
        last = current.withColumns({"kind": F.lit("good"), "failed_step": F.lit(None).cast("string")})
    result = last.select(*COLUMNS)
    for part in finished:
        result = result.unionAll(part)
    return result


def _stage(lines: DataFrame, steps: Sequence[tuple[str, Step]],
           keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Row-wise steps on all lines once, then for each file what they gave up to the step that refuses one of its lines."""
    done, refusing = _apply(lines, steps)
    limit = F.lit(None).cast("int")
    if refusing:
        done = keep(done)
        limits = keep(done.where("_kind = 'error'").groupBy("file").agg(F.min("_step").alias("_limit")))
        if not limits.isEmpty():
            done, limit = keys.join_small(done, limits, ["file"], "line_no", "left"), F.col("_limit")
    # a line that was still good at the limit goes back to what it was there
    back = F.coalesce(limit < F.coalesce("_step", F.lit(len(steps))), F.lit(False))
    then = F.filter("_then", lambda s: s["step"] == limit)
    value = F.when(back & (F.size(then) > 0), F.get(then, F.lit(0))["value"]).otherwise(F.col("value"))
    label = F.lit(None).cast("string")
    for k, (name, _) in enumerate(steps):
        label = F.when(limit == k, name).otherwise(label)
    gone = F.coalesce((F.col("_kind") == "over") & (F.col("_step") < limit), F.lit(False))
    return done.select(
        "file", "block", "line_no", F.when(back, "good").otherwise(F.col("_kind")).alias("kind"), value.alias("value"),
        F.when(~gone, label).alias("failed_step"))


def _apply(lines: DataFrame, steps: Sequence[tuple[str, Step]]) -> tuple[DataFrame, bool]:
    """Lines after all steps, and whether any step can refuse lines.

    ``_kind`` and ``_step`` say how and where a line left; no later step changes it.  ``_then`` holds what it was after each
    step that can refuse lines, where that is not what it is in the end.
    """
    rows = lines.withColumns({"_kind": F.lit("good"), "_step": F.lit(None).cast("int")})
    marks: dict[str, int] = {}
    for k, (_, step) in enumerate(steps):
        out = step(rows.withColumn("_before", F.col("value")))
        live = F.col("_kind") == "good"
        value = F.when(live, F.col("value")).otherwise(F.col("_before"))
        kind, at = F.col("_kind"), F.col("_step")
        refuses = "kind" in out.columns
        if refuses:
            kind = F.when(live, F.col("kind")).otherwise(kind)
            at = F.when(live & (F.col("kind") != "good"), F.lit(k)).otherwise(at)
        after = compute_once(out, "_after", F.struct(value.alias("value"), kind.alias("kind"), at.alias("step")))
        rows = after.select(
            "file", "block", "line_no", *marks, F.col("_after.value").alias("value"),
            F.col("_after.kind").alias("_kind"), F.col("_after.step").alias("_step"),
        )
        if refuses:
            marks[f"_mark_{k}"] = k
            rows = rows.withColumn(f"_mark_{k}", F.col("value"))
    if not marks:
        return rows.withColumn("_then", F.array().cast("array<struct<step:int,value:string>>")), False
    then = F.array(*[F.struct(F.lit(k).alias("step"), F.col(m).alias("value")) for m, k in marks.items()])
    changed = F.filter(then, lambda s: ~s["value"].eqNullSafe(F.col("value")))
    return rows.withColumn("_then", changed).drop(*marks), True
