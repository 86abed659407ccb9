"""Chat formatting: layouts recognized by a fingerprint of their field paths, one canonical form, one template.

A *layout* says declaratively where a record keeps roles and texts.  Layouts are chosen by a hash of
the record's nested field paths, so records of many sources can stand in one column.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.stored import small_batches

TURNS = "array<struct<role:string,text:string>>"
START, STOP = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLES = ("assistant",)


# Shapes: the nested field paths of a record as one text


def shape(fields) -> str:
    """Shape of nested dicts (objects), one-element lists (arrays) and anything else (values)."""
    if isinstance(fields, dict):
        inside = ",".join(k + (":" + shape(v) if isinstance(v, (dict, list)) else "") for k, v in sorted(fields.items()))
        return f"OBJECT<{inside}>"
    if isinstance(fields, list):
        return f"ARRAY<{shape(fields[0]) if isinstance(fields[0], (dict, list)) else ''}>"
    return ""


def schema_shape(kind: T.DataType):
    """The same for a Spark type."""
    if isinstance(kind, T.StructType):
        return {f.name: schema_shape(f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [schema_shape(kind.elementType)]
    return None


def fingerprint(fields) -> str:
    """Hash of a shape; the order of fields and the types of values do not matter."""
    return hashlib.sha256(shape(fields).encode()).hexdigest()


def record_fingerprint(record: Column) -> Column:
    """``fingerprint`` of a variant value."""
    leaf = r"(: |<)(?:STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|DATE|BINARY|TIMESTAMP(?:_NTZ)?|UUID|DECIMAL\(\d+,\d+\)|VARIANT)(?=[,>])"
    bare = F.regexp_replace(F.schema_of_variant(record), leaf, "$1")
    bare = F.replace(F.regexp_replace(bare, ": (?=[,>])", ""), F.lit(": "), F.lit(":"))
    return F.sha2(F.replace(bare, F.lit(", "), F.lit(",")), 256)


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns.

    ``fields``: the shape, as for ``shape``.  Either ``each`` names an array whose elements have
    ``role`` and ``text`` fields, or ``turns`` lists (role, field, ...): texts of several fields of one turn are
    joined by an empty line, empty ones left out.  ``system`` names a field that is a first turn if it is not
    empty.  ``roles`` renames roles.
    """

    name: str
    fields: dict
    each: str | None = None
    role: str = "role"
    text: str = "content"
    turns: tuple = ()
    system: str | None = None
    roles: tuple = ()

    def canonical(self, record: Column) -> Column:
        """The record's turns as an array of (role, text)."""
        def get(name):
            return F.coalesce(F.try_variant_get(record, f"$.{name}", "string"), F.lit(""))

        def known(role):
            out = F.coalesce(role, F.lit(""))
            named = out
            for old, new in self.roles:
                named = F.when(out == old, new).otherwise(named)
            return named

        if self.each:
            items = F.try_variant_get(record, f"$.{self.each}", f"array<struct<{self.role}:string,{self.text}:string>>")
            out = F.transform(items, lambda x: F.struct(
                known(x[self.role]).alias("role"), F.coalesce(x[self.text], F.lit("")).alias("text")))
        else:
            made = []
            for role, *names in self.turns:
                text = get(names[0]) if len(names) == 1 else F.array_join(
                    F.filter(F.array(*[get(n) for n in names]), lambda x: x != ""), "\n\n")
                made.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
            out = F.array(*made)
        if self.system:
            first = F.array(F.struct(F.lit("system").alias("role"), get(self.system).alias("text")))
            out = F.when(get(self.system) == "", out).otherwise(F.concat(first, out))
        return F.coalesce(out.cast(TURNS), F.array().cast(TURNS))


_SHARED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))
LAYOUTS = (
    Layout("messages", {"messages": [{"role": 0, "content": 0}]}, each="messages"),
    Layout("messages_system", {"system": 0, "messages": [{"role": 0, "content": 0}]}, each="messages", system="system"),
    Layout("conversations", {"conversations": [{"from": 0, "value": 0}]}, each="conversations", role="from", text="value", roles=_SHARED),
    Layout("conversations_system", {"system": 0, "conversations": [{"from": 0, "value": 0}]},
           each="conversations", role="from", text="value", system="system", roles=_SHARED),
    Layout("turns", {"turns": [{"role": 0, "text": 0}]}, each="turns", text="text"),
    Layout("prompt_response", {"prompt": 0, "response": 0}, turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", {"prompt": 0, "completion": 0}, turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", {"question": 0, "answer": 0}, turns=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction", {"instruction": 0, "output": 0}, turns=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", {"instruction": 0, "input": 0, "output": 0},
           turns=(("user", "instruction", "input"), ("assistant", "output"))),
    Layout("system_prompt_response", {"system": 0, "prompt": 0, "response": 0}, system="system",
           turns=(("user", "prompt"), ("assistant", "response"))),
)


@dataclass(frozen=True)
class RowLayout:
    """A table with one row per turn."""

    key: str
    order: str
    role: str
    text: str


ROW_LAYOUTS = {
    fingerprint({"conv_id": 0, "turn": 0, "role": 0, "text": 0}): RowLayout("conv_id", "turn", "role", "text"),
    fingerprint({"conversation_id": 0, "position": 0, "role": 0, "content": 0}): RowLayout("conversation_id", "position", "role", "content"),
}


def turns_of_records(df: DataFrame, column: str, layouts: tuple = LAYOUTS) -> DataFrame:
    """``df`` with ``layout`` and ``turns`` for each JSON text, variant or struct in ``column``.

    A record that is null, no JSON, or of a shape that no layout has keeps its row: both are null.
    Fields that are null or missing in an array's element are empty texts.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        record = F.try_parse_json(column)
    elif isinstance(kind, T.VariantType):
        record = F.col(column)
    else:
        record = F.to_variant_object(column)
    parsed = df.withColumn("_record", record).withColumn("_print", record_fingerprint(F.col("_record")))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        fits = F.col("_print") == fingerprint(layout.fields)
        name = F.when(fits, layout.name).otherwise(name)
        turns = F.when(fits, layout.canonical(F.col("_record"))).otherwise(turns)
    return parsed.withColumns({"layout": name, "turns": turns}).drop("_record", "_print")


def turns_of_rows(df: DataFrame) -> DataFrame:
    """(key, turns) of a table with one row per turn; its columns' fingerprint selects the mapping.

    Turns go by the order column, ties by role and text, a null order first.  Null roles and texts are
    empty; rows of a null key are one conversation.  A conversation becomes one value, so it must fit 2 GB;
    ``format_rows`` formats conversations of any length.
    """
    rows = canonical_rows(df).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    return rows.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def canonical_rows(df: DataFrame) -> DataFrame:
    """(key, at, role, text) of a table with one row per turn; its columns' fingerprint selects the mapping.

    Null roles and texts are empty.  Columns that no row layout has raise.
    """
    layout = ROW_LAYOUTS.get(fingerprint(schema_shape(df.schema)))
    if layout is None:
        raise ValueError(f"no layout has the columns {sorted(df.columns)}; select those of one")
    return df.select(F.col(layout.key).alias("key"), F.col(layout.order).alias("at"), F.coalesce(layout.role, F.lit("")).alias("role"),
                     F.coalesce(layout.text, F.lit("")).alias("text"))


# The template


def escape(text: str) -> str:
    """Break every control string: ``<``, any backslashes and ``|`` get one backslash more."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    """A role stands on one line and holds no control string."""
    return role.replace("%", "%25").replace("\n", "%0A").replace("|", "%7C")


def unescape_role(role: str) -> str:
    return role.replace("%7C", "|").replace("%0A", "\n").replace("%25", "%")


def render(turns: list[dict]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the ranges (code points) of the texts to learn from."""
    parts, mask, at = [], [], 0
    for turn in turns:
        head = f"{START}{escape_role(turn['role'] or '')}\n"
        text = escape(turn["text"] or "")
        if turn["role"] in TRAINED_ROLES:
            mask.append((at + len(head), at + len(head) + len(text)))
        parts += [head, text, STOP]
        at += len(head) + len(text) + len(STOP)
    return "".join(parts), mask


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out = []
    for part in formatted.split(STOP)[:-1]:
        role, _, text = part[len(START):].partition("\n")
        out.append((unescape_role(role), unescape(text)))
    return out


def _format(names: list[str]):
    place = names.index("turns")

    def run(batches):
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                made = [render(t or []) for t in part.column(place).to_pylist()]
                texts = pa.array([m[0] for m in made], pa.string())
                masks = pa.array([[{"first": a, "end": b} for a, b in m[1]] for m in made],
                                 pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([*part.columns, texts, masks], [*names, "formatted", "loss"])

    return run


def format_turns(df: DataFrame) -> DataFrame:
    """``df`` with ``formatted`` and ``loss`` made from ``turns``.

    ``formatted`` marks each turn by control strings; the same strings inside texts and roles are escaped, so
    ``read_turns`` gives back exactly what went in.  ``loss`` has the ranges [first, end) of code points that
    are the texts of the assistant.  Null or no turns format to ''.
    """
    schema = df.select("*", F.lit("").alias("formatted"), F.array().cast("array<struct<first:int,end:int>>").alias("loss")).schema
    return df.mapInArrow(_format(df.columns), schema)


def _read(names: list[str]):
    text_at, loss_at = names.index("formatted"), names.index("loss")
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches):
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                texts = part.column(text_at).to_pylist()
                turns = [[{"role": r, "text": t} for r, t in read(x)] for x in texts]
                learned = [[unescape(x[m["first"]: m["end"]]) for m in mask]
                           for x, mask in zip(texts, part.column(loss_at).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(turns, turn), pa.array(learned, pa.list_(pa.string()))],
                    [*names, "read_turns", "learned"])

    return run


def read_turns(df: DataFrame) -> DataFrame:
    """``df`` with what its ``formatted`` and ``loss`` say: ``read_turns``, and ``learned``, the unescaped texts under the mask."""
    schema = df.select("*", F.array().cast(TURNS).alias("read_turns"), F.array().cast("array<string>").alias("learned")).schema
    return df.mapInArrow(_read(df.columns), schema)


def _format_rows(batches):
    """(key, at, role, text) -> (key, at, formatted, first, end)."""
    for batch in batches:
        made = [render([{"role": r, "text": t}]) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        first, end = ([m[1][0][k] if m[1] else None for m in made] for k in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.string()), pa.array(first, pa.int32()), pa.array(end, pa.int32())],
            ["key", "at", "formatted", "first", "end"])


def format_rows(df: DataFrame) -> DataFrame:
    """(key, at, formatted, first, end): every turn of a table with one row per turn, formatted by itself.

    A conversation's pieces, joined with nothing in between, are what ``format_turns`` makes of it.  ``first`` and ``end``
    bound the code points of a piece under the loss mask, null where nothing is learned.  All pieces of a conversation
    are in one partition, in the order of ``turns_of_rows``; Spark's sort spills, so no conversation is held as a whole.
    """
    rows = small_batches(canonical_rows(df)).repartition("key").sortWithinPartitions("key", "at", "role", "text")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_format_rows, f"key {kinds['key']}, at {kinds['at']}, formatted string, first int, end int")


class _Digest:
    """What a conversation's pieces say, read one after the other."""

    def __init__(self):
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, piece: str, first: int | None, end: int | None) -> None:
        self.chars += len(piece)
        for role, text in read(piece):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if first is not None:
            learned = unescape(piece[first:end])
            self.loss_chars += len(learned)
            self.learned.update(learned.encode())

    def row(self, key) -> tuple:
        return key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars


def _digests(batches):
    """Pieces in order -> one row for each conversation."""
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    held, now, digest, kind = [], None, None, None

    def output():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), [kind, *types])], names)

    for batch in batches:
        kind = batch.column(0).type
        for key, *piece in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4))):
            if digest is None or key != now:
                if digest is not None:
                    held.append(digest.row(now))
                now, digest = key, _Digest()
            digest.add(*piece)
        if len(held) > 1000:
            yield output()
            held = []
    if digest is not None:
        held.append(digest.row(now))
        yield output()


def read_rows(pieces: DataFrame) -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of conversations, read back from ``format_rows``.

    ``turns_sha256`` is the digest of role, line feed, text, line feed of each turn; ``loss_sha256`` that of all text under
    the mask, unescaped.  Both are streams over the pieces: a task holds one piece at a time and a digest, however
    long the conversation is.
    """
    named = "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return pieces.mapInArrow(_digests, f"key {dict(pieces.dtypes)['key']}, n_turns long, {named}")
