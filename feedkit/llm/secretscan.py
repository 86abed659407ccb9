"""Secret scans: fixed shapes of keys, and literals that source or configuration text gives to sensitive names."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.llm import words
from feedkit.llm.assignments import THRESHOLD, sensitive_literals
from feedkit.llm.stored import small_batches

# Kinds of spans in the order that equal starts take.
KINDS = ["assign", "access", "hex", "literal"]
HEX_DIGITS = 32

# Fixed shapes, on the bytes of a text; the characters named are ASCII ones.
_ASSIGN = re.compile(rb"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{%d,}" % HEX_DIGITS)
# What every sensitive name holds, and what must follow it for a pair, on lower-cased bytes: a sign, a comma after a quoted name,
# or a value of the same record.  An option may be followed by anything.
_STEMS = rb"(?:pass|pwd|secret|token|key|cred|auth|bearer)"
_NAMED = re.compile(
    rb"--[\w-]*" + _STEMS + rb"|" + _STEMS + rb"""(?=[\w.$\x80-\xff-]*(?:["'`\]]*[\s\x80-\xff]*[:=>]|["'`]\s*,|(?s:.{0,300}?)\bval))""")

_SPAN = pa.struct([("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
SPANS = "array<struct<kind:string,first:bigint,last:bigint,name:string,score:double>>"


def _hex_digits() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(b"0123456789abcdef")] = True
    return table


def fixed_spans(raw: bytes) -> list[tuple[str, int, int]]:
    """(kind, first, last) by byte of the fixed shapes, leftmost and not overlapping for each kind; too short ones are dropped."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(raw) if len(m.group(2)) >= 8]
    out += [("access", *m.span()) for m in _ACCESS.finditer(raw) if m.end() - m.start() >= 16]
    return out + [("hex", *m.span()) for m in _HEX.finditer(raw)]


def _code_points(raw: bytes, places: list[int]) -> list[int]:
    """How many code points lie before each byte place."""
    if raw.isascii():
        return places
    begins = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [int(begins[p - 1]) if p else 0 for p in places]


def text_secrets(raw: bytes, threshold: float, names_too: bool) -> list[dict]:
    """All spans of one text, by start, then kind."""
    fixed = fixed_spans(raw)
    at = _code_points(raw, [p for _, *both in fixed for p in both])
    found = [(low, KINDS.index(kind), high, None, None) for (kind, *_), low, high in zip(fixed, at[::2], at[1::2])]
    if names_too:
        found += [(low, 3, high, name, score) for low, high, name, score in sensitive_literals(raw.decode("utf-8", "replace"), threshold)]
    keys = ("first", "kind", "last", "name", "score")
    return [dict(zip(keys, (low, KINDS[k], *rest))) for low, k, *rest in sorted(found, key=lambda x: x[:3])]


def _candidates(piece: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of a piece that may hold any span, and those that may hold a sensitive name."""
    lower = words._fold(piece).tobytes()
    stems = np.fromiter((m.start() for m in _NAMED.finditer(lower)), np.int64)
    access = np.fromiter((m.start() for m in re.finditer(b"AKIA", piece.tobytes())), np.int64)
    mask = np.concatenate([[0], HEX_TABLE[piece], [0]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(mask))
    runs = edges[::2][edges[1::2] - edges[::2] >= HEX_DIGITS]
    named = np.unique(np.searchsorted(offsets, stems, side="right") - 1)
    # a run of digits may reach over the end of a text, so each text that it touches is looked at
    ends = edges[1::2][edges[1::2] - edges[::2] >= HEX_DIGITS]
    touched = [np.arange(a, b + 1) for a, b in zip(np.searchsorted(offsets, runs, side="right") - 1, np.searchsorted(offsets, ends - 1, side="right") - 1)]
    return np.unique(np.concatenate([named, np.searchsorted(offsets, access, side="right") - 1, *touched])).astype(np.int64), named


HEX_TABLE = _hex_digits()


def _scan(names: list[str], column: str, threshold: float):
    def run(batches):
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(names.index(column)))
            for low, high in words.pieces(offsets):
                at = offsets[low: high + 1]
                some, named = _candidates(data[at[0]: at[-1]], at - at[0])
                named = set(named.tolist())
                spans: list[list[dict]] = [[] for _ in range(high - low)]
                for k in some.tolist():
                    spans[k] = text_secrets(data[at[k]: at[k + 1]].tobytes(), threshold, k in named)
                yield pa.RecordBatch.from_arrays([*batch.slice(low, high - low).columns, pa.array(spans, pa.list_(_SPAN))], [*names, "secrets"])

    return run


def find_secrets(docs: DataFrame, column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``secrets``: spans of the whole text in ``column`` by start, then kind; null and empty texts have none.

    ``first`` and ``last`` (exclusive) count code points.  Kinds ``assign``, ``access`` and ``hex`` are fixed shapes: a secret's
    name with a value of 8 or more characters, an access key id of 16 or more, 32 or more hex digits.  ``literal`` is what the
    text's own syntax gives to a sensitive name, directly or through other names, with that ``name`` and a ``score``
    from 0 to 1; those below ``threshold`` are left out.  A literal may lie in a fixed shape; both are listed.

    Rows stay as they are and none is shuffled; repeated rows have equal spans.  A column ``secrets`` must not be there.
    A task holds about a megabyte of text, or one longer text with its pairs of names and literals.
    """
    if "secrets" in docs.columns:
        raise ValueError("column secrets is taken")
    schema = docs.select("*", F.lit(None).cast(SPANS).alias("secrets")).schema
    return small_batches(docs).mapInArrow(_scan(docs.columns, column, threshold), schema)


def span_list(spans: Column) -> Column:
    """Spans as ``kind:first:last``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")


def redact(found: DataFrame, column: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``found`` with every span of ``column`` replaced by ``mark``, spans that overlap or touch by one."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state, span):
        plain = F.substring(F.col(column), (state["at"] + 1).cast("int"), (span["first"] - state["at"]).cast("int"))
        fresh = (span["first"] > state["at"]) | (state["out"] == "")
        out = F.when(fresh, F.concat(state["out"], plain, F.lit(mark))).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], span["last"]).alias("at"))

    rest = F.aggregate("secrets", begin, step, lambda s: F.concat(s["out"], F.substring(F.col(column), (s["at"] + 1).cast("int"), (1 << 31) - 1)))
    return found.withColumn(column, rest)
