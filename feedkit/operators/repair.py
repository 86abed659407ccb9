"""Re-join records that line feeds inside a field have broken."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.operators import linefold
from feedkit.operators.keys import join_small

# The helpers travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(linefold)

# Lines folded by one task at a time.  Any file, and any stretch of broken lines in it,
# is cut into chunks of this many lines, so no single task sees an unbounded run.
CHUNK_LINES = 1 << 18

# Notes of chunks put together by one task: so many chunks of a block, then all of so many bytes of a file (128 splits
# of 128 MB).  The last step reads one note for each such stretch: 6,400 for a file of 100 TB.
FAN, SPAN = 4096, 1 << 34

KEYS = ["file", "block", "chunk"]
NOTE = "file string, block bigint, chunk bigint, summary string"
STATE = "file string, block bigint, chunk bigint, state string"


def field_count(value: Column, delimiter: str) -> Column:
    """Fields of a line under a literal delimiter, counted on bytes."""
    removed = F.octet_length(value) - F.octet_length(F.replace(value, F.lit(delimiter), F.lit("")))
    return (removed / F.lit(len(delimiter.encode("utf-8")))).cast("int") + 1


def repair_linefeeds(lines: DataFrame, delimiter: str, n_columns: int | None = None,
                     chunk_lines: int = CHUNK_LINES, in_order: bool = False, fan: int = FAN, span: int = SPAN) -> DataFrame:
    """Lines ``(file, [block,] line_no, value)`` -> ``(file, block, line_no, kind, value)``.

    ``kind`` is ``good`` for a record of ``n_columns`` fields (by default as many as the
    first line of its file has) and ``error`` for a line that fits into no record.  Blank
    lines go away.  Lines are in the order of ``(block, line_no)`` within a file.

    Chunks of lines are folded apart: one pass notes what each chunk does to a window
    that comes in, these notes (one per ``chunk_lines`` lines) are put together as a tree
    that tells each chunk what does come in, and a last pass builds the records.  A task of
    the tree reads the notes of ``fan`` chunks, or of ``span`` bytes of a file.  A file without any whole line
    is folded in parallel like any other.  A chunk is a range of ``line_no``, so with sparse
    numbers ``chunk_lines`` should be that much larger.

    ``in_order`` says the rows already come in file order, as ``scan_lines`` gives them;
    the first pass then needs no shuffle.  Lines out of order raise.
    """
    if "block" not in lines.columns:
        lines = lines.withColumn("block", F.lit(0).cast("bigint"))
    counted = lines.select(
        "file", "block", F.expr(f"line_no div {int(chunk_lines)}").alias("chunk"),
        F.col("line_no").cast("bigint").alias("line_no"),
        field_count(F.col("value"), delimiter).alias("n"),
        F.col("value").cast("binary").alias("value"),
    )
    if n_columns:
        counted = counted.withColumn("width", F.lit(int(n_columns)))
    else:
        first = F.min_by("n", F.struct("block", "line_no")).alias("width")
        counted = join_small(counted, counted.groupBy("file").agg(first), ["file"], "line_no")
        in_order = False
    mark = delimiter.encode("utf-8")
    kept = counted.where(F.rlike(F.col("value").cast("string"), F.lit(r"[^ \t\n\r\x0b\f]"))).select(
        F.xxhash64(*KEYS).alias("hash"), *KEYS, "line_no", "n", "width", can_count(mark).alias("edge"), "value"
    )

    counts = kept.withColumn("value", F.lit(None).cast("binary")) if len(mark) == 1 else kept
    if not in_order:
        counts = _sorted(counts)
    notes = counts.mapInArrow(linefold.summarize(mark), NOTE)
    states = _states(notes, mark, fan, span).select(
        F.xxhash64(*KEYS).alias("hash"), *KEYS, F.lit(-1).cast("bigint").alias("line_no"), F.lit(0).alias("n"),
        F.lit(0).alias("width"), F.lit(False).alias("edge"), F.col("state").cast("binary").alias("value"),
    )
    led = _sorted(kept.unionByName(states))
    schema = ("file string, block bigint, line_no bigint, kind string, value binary, "
              "record_block bigint, record_line bigint")
    whole = led.mapInArrow(linefold.fold(mark), schema).where("kind <> 'part'")
    parts = led.mapInArrow(linefold.fold(mark, parts_only=True), schema)
    pieces = F.array_sort(F.collect_list(F.struct("block", "line_no", "value")))
    stitched = (
        parts.groupBy("file", "record_block", "record_line").agg(pieces.alias("p"))
        .select(
            "file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["line_no"].alias("line_no"),
            F.lit("good").alias("kind"),
            F.array_join(F.transform("p", lambda x: x["value"].cast("string")), "").cast("binary").alias("value"),
        )
    )
    columns = ["file", "block", "line_no", "kind", "value"]
    return (
        whole.select(*columns).unionByName(stitched)
        .withColumn("value", F.col("value").cast("string"))
    )


def _states(notes: DataFrame, mark: bytes, fan: int, span: int) -> DataFrame:
    """What comes into every chunk, from notes put together as a tree and read downwards again.

    Up: ``fan`` chunks of a block make one note, the notes of ``span`` bytes of a file one, and these tell what comes
    into each of them.  Down: from there the same groups tell it their members.
    """
    tree = [["file", "block", F.expr(f"chunk div {int(fan)}").alias("part")],
            ["file", F.expr(f"block div {int(span)}").alias("part")]]
    levels = [notes]
    for keys in tree:
        levels.append(levels[-1].groupBy(*keys).applyInArrow(linefold.compose(mark), NOTE))
    states = levels.pop().groupBy("file").applyInArrow(linefold.connect(mark), STATE)
    for keys in reversed(tree):
        states = levels.pop().groupBy(*keys).cogroup(states.groupBy(*keys)).applyInArrow(linefold.connect_inside(mark), STATE)
    return states


def can_count(mark: bytes) -> Column:
    """Can a line change a delimiter count, also together with its neighbours?"""
    test = (F.col("n") > 1) | (F.col("n") >= F.col("width"))
    if len(mark) > 1:
        value = F.col("value")
        starts = [mark[k:k + 1] for k in range(len(mark))]
        test = test | F.substring(value, 1, 1).isin(*sorted(set(starts)))
        for k in range(1, len(mark)):
            test = test | F.endswith(value, F.lit(mark[:k]))
    return test


def _sorted(df: DataFrame) -> DataFrame:
    """Rows of a chunk together and in order; the hash makes most comparisons cheap."""
    return df.repartition(*KEYS).sortWithinPartitions("hash", *KEYS, "line_no")


def good_and_error(repaired: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two outputs of a repair; checkpoint or write ``repaired`` first to run it once."""
    kept = repaired.drop("kind")
    return kept.where(repaired["kind"] == "good"), kept.where(repaired["kind"] == "error")
