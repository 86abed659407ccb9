"""Small helpers that run inside tasks of ``repair_linefeeds``.

A record broken by line feeds is a run of lines that, joined, have the wanted
number of delimiters.  While reading on, a *window* of lines is kept; it grows
with each line, loses lines at its front when it holds too many delimiters, and
becomes a record when it holds just enough.

A window is named by the position it starts *after*.  Windows that can no longer
behave differently share one class ``[after, count, carry]``: the delimiters
counted so far and how many leading bytes of a delimiter its end matches.  There
are about as many classes as a record has columns, so what a chunk of lines does to any
window that comes in is a small table.  Tables of neighbouring chunks make one for both,
of the same size.  That lets chunks be folded apart from each other and put together
as a tree, with the same result as one long pass.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections import deque
from itertools import chain, groupby

import numpy as np
import pyarrow as pa

START = (-1, -1)


class Line:
    """A short line: its place, its own delimiter count, and its effect on a carry."""

    __slots__ = ("pos", "count", "text", "delimiter", "table")

    def __init__(self, pos, count, text, delimiter, table=None):
        self.pos, self.count, self.text, self.delimiter = pos, count, text, delimiter
        self.table = table or {}

    def effect(self, carry):
        """Delimiters found and carry left when the line follows ``carry`` matched bytes."""
        if len(self.delimiter) == 1:
            return self.count, 0
        if carry not in self.table:
            pieces = (self.delimiter[:carry] + self.text).split(self.delimiter)
            rest = pieces[-1]
            left = next(
                (k for k in range(len(self.delimiter) - 1, 0, -1) if rest.endswith(self.delimiter[:k])), 0
            )
            self.table[carry] = (len(pieces) - 1, left)
        return self.table[carry]


def extend(classes, prev, line):
    """Add a line to every class, and a class for the window that starts with it."""
    if not classes or classes[-1][1] or classes[-1][2]:
        classes.append([prev, 0, 0])
    for c in classes:
        found, c[2] = line.effect(c[2])
        c[1] += found


def rest_line(classes, prev):
    """The effect of any number of plain lines: carries end, counts stay."""
    if not classes or classes[-1][1] or classes[-1][2]:
        classes.append([prev, 0, 0])
    if any(c[2] for c in classes):
        for c in classes:
            c[2] = 0
        merge(classes)


def settle(classes, want, pos, after):
    """Where a window goes at this line, and what it starts after if it became a record."""
    at = bisect_right(classes, after, key=lambda c: c[0]) - 1
    while classes[at][1] > want:
        at += 1
        after = classes[at][0]
    return (pos, after) if classes[at][1] == want else (after, None)


def merge(classes, want=None):
    """Drop windows that are done and join classes that act alike."""
    kept = []
    for c in classes:
        if want is not None and c[1] >= want:
            continue
        if not kept or kept[-1][1:] != c[1:]:
            kept.append(c)
    classes[:] = kept


def pieces(batches):
    """Sorted Arrow batches -> ``(key, columns)``: rows of one chunk, in one or more pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        hashes, blocks, chunks = (batch.column(c).to_numpy() for c in ("hash", "block", "chunk"))
        changes = (np.diff(hashes) != 0) | (np.diff(blocks) != 0) | (np.diff(chunks) != 0)
        cuts = (np.flatnonzero(changes) + 1).tolist()
        for at, to in zip([0, *cuts], [*cuts, batch.num_rows]):
            for name, first, end in same_file(batch.column("file"), at, to):
                part = batch.slice(first, end - first)
                key = (name, int(blocks[at]), int(chunks[at]))
                yield key, [part.column(c) for c in ("line_no", "n", "width", "edge", "value")]


def same_file(files, at, to):
    """Stretches of one file in sorted rows; more than one only if two files share a hash."""
    if files[at].as_py() == files[to - 1].as_py():
        return [(files[at].as_py(), at, to)]
    out = []
    for name, group in groupby(range(at, to), key=lambda i: files[i].as_py()):
        rows = list(group)
        out.append((name, rows[0], rows[-1] + 1))
    return out


def grouped(batches):
    """Pieces of one chunk after the other: ``(key, iterator of columns)``."""
    for key, group in groupby(pieces(batches), key=lambda p: p[0]):
        yield key, (columns for _, columns in group)


def output(rows, schema):
    """Rows as an Arrow batch."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema.names)


NOTES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("summary", pa.string())])
STATES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()), ("state", pa.string())])
RECORDS = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("line_no", pa.int64()), ("kind", pa.string()),
    ("value", pa.binary()), ("record_block", pa.int64()), ("record_line", pa.int64()),
])


def in_batches(rows, schema, size=8192, size_bytes=1 << 24):
    """Rows in Arrow batches of at most so many rows, and about so many bytes of values."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= size or weight >= size_bytes:
            yield output(held, schema)
            held, weight = [], 0
    yield output(held, schema)


def summarize(delimiter):
    """Lines -> one row per chunk: what the chunk does to an incoming window."""

    def run(batches):
        yield from in_batches(((*key, chunk_summary(parts, key[1], delimiter)) for key, parts in grouped(batches)), NOTES)

    return run


def edges(columns, last):
    """The lines of a piece that can change a count, as ``(index, line_no, n, gap before)``.

    All lines in between are plain: no delimiter, and no part of one at either end.
    """
    numbers = columns[0].to_numpy()
    if numbers[0] <= last or (np.diff(numbers) <= 0).any():
        raise ValueError("lines of a chunk are not in order")
    at = np.flatnonzero(columns[3].to_numpy(zero_copy_only=False))
    plain_before = np.diff(at, prepend=-1) > 1
    return zip(at.tolist(), numbers[at].tolist(), columns[1].to_numpy()[at].tolist(), plain_before.tolist())


class Effect:
    """What a run of lines does to any window that comes in, built line by line or from the effects of its parts.

    ``head`` holds the lines that a window from outside can still meet, ``groups`` the entries into the run by the
    window they have led to, ``classes`` the windows that start inside.  ``START`` stands for the place before the run.
    """

    def __init__(self, delimiter):
        self.delimiter = delimiter
        self.classes, self.prev, self.last = [], START, START
        self.groups = {START: [START]}
        self.head, self.in_head, self.gap, self.want = [], True, False, 0

    def rest(self):
        """Any number of plain lines."""
        rest_line(self.classes, self.prev)
        self.gap = True

    def whole(self, pos, count):
        """A line with enough delimiters of its own, which no window outlives."""
        if self.in_head:
            self.head.append([*pos, self.gap, count, None])
            self.groups.setdefault(START, []).append(pos)
        self.groups = {pos: [e for entries in self.groups.values() for e in entries]}
        self.classes, self.prev, self.in_head, self.gap = [], pos, False, False

    def line(self, pos, line):
        extend(self.classes, self.prev, line)
        moved = {}
        for after, entries in self.groups.items():
            moved.setdefault(settle(self.classes, self.want, pos, after)[0], []).extend(entries)
        self.groups = moved
        if self.in_head:
            table = None if len(self.delimiter) == 1 else [line.effect(k) for k in range(len(self.delimiter))]
            self.head.append([*pos, self.gap, line.count, table])
            self.groups.setdefault(pos, []).append(pos)
        merge(self.classes, self.want)
        self.in_head = self.in_head and bool(self.classes) and self.classes[0][0] == START
        self.prev, self.gap = pos, False

    def follow(self, s):
        """The part that comes next, by its summary."""
        start, self.want = self.prev, s["want"]
        for block, line_no, gap, count, table in s["head"]:
            if gap:
                self.rest()
            if count >= self.want:
                self.whole((block, line_no), count)
            else:
                self.line((block, line_no), headline(block, line_no, count, table, self.delimiter))
        if s["through"]:
            if s["gap"]:
                self.rest()
        else:
            leave, moved = leaving(s, start), {}
            for after, entries in self.groups.items():
                moved.setdefault(leave(after), []).extend(entries)
            self.groups, self.classes = moved, windows(s, start)
            self.in_head = self.gap = False
        self.prev = self.last = tuple(s["last"])

    def summary(self):
        return json.dumps({
            "want": self.want,
            "head": self.head,
            "through": self.in_head,
            "gap": self.gap,
            "out": [[e, after] for after, entries in self.groups.items() for e in entries],
            "classes": self.classes,
            "last": self.last,
        })


def headline(block, line_no, count, table, delimiter):
    """A line of a summary's head."""
    return Line((block, line_no), count, None, delimiter, dict(enumerate(tuple(e) for e in table)) if table else None)


def leaving(s, start):
    """Where a window that has entered a part is at the part's end."""
    out = {tuple(e): tuple(a) for e, a in s["out"]}

    def leave(after):
        left = out[after if after > start else START]
        return left if left != START else start

    return leave


def windows(s, start):
    """The windows that start inside a part, at its end."""
    return [[tuple(a) if tuple(a) != START else start, c, m] for a, c, m in s["classes"]]


def chunk_summary(parts, block, delimiter):
    effect, last = Effect(delimiter), START[1]
    for columns in parts:
        width, texts = columns[2][0].as_py(), columns[4]
        effect.want, index = width - 1, -1
        for index, line_no, n, plain in edges(columns, last):
            pos = (block, line_no)
            if plain:
                effect.gap = True
            if n >= width:
                effect.whole(pos, n - 1)
                continue
            if effect.gap:
                effect.rest()
            effect.line(pos, Line(pos, n - 1, None if len(delimiter) == 1 else texts[index].as_py(), delimiter))
        if index < len(texts) - 1:
            effect.gap = True
        last = columns[0][-1].as_py()
    if effect.gap:
        effect.rest()
    effect.last = (block, last)
    return effect.summary()


def in_file_order(notes):
    """Rows ``(file, block, chunk, text)`` of an Arrow table by block and chunk; a chunk noted twice raises."""
    rows = sorted(zip(*(notes.column(c).to_pylist() for c in range(4))), key=lambda r: r[1:3])
    if any(x[1:3] == y[1:3] for x, y in zip(rows, rows[1:])):
        raise ValueError("a chunk of lines came in two parts; sort the lines first")
    return rows


def compose(delimiter):
    """Notes of neighbouring parts of a file -> the note of them all, named by the first."""

    def run(notes):
        rows, effect = in_file_order(notes), Effect(delimiter)
        for *_, text in rows:
            effect.follow(json.loads(text))
        return pa.Table.from_batches([output([(*rows[0][:3], effect.summary())], NOTES)])

    return run


def connect(delimiter):
    """Notes of all parts of a file -> one row per part: the window that comes in, and what
    becomes of the lines still open at its end."""

    def run(notes):
        rows = in_file_order(notes)
        return pa.Table.from_batches([output([(rows[0][0], *s) for s in part_states(rows, delimiter)], STATES)])

    return run


def connect_inside(delimiter):
    """As ``connect``, for the parts of one part whose own state is known."""

    def run(notes, states):
        rows, known = in_file_order(notes), json.loads(states.column(3)[0].as_py())
        return pa.Table.from_batches([output([(rows[0][0], *s) for s in part_states(rows, delimiter, known)], STATES)])

    return run


def part_states(rows, delimiter, known=None):
    """``(block, chunk, state)`` of parts in order; ``known`` is the state of what they are parts of."""
    known = known or {"start": START, "after": START, "classes": [], "tail": None}
    after, prev = tuple(known["after"]), tuple(known["start"])
    classes = [[tuple(a), c, m] for a, c, m in known["classes"]]
    waiting = []  # parts whose open lines are not decided yet

    def decide(tail):
        for state in waiting:
            state[2]["tail"] = tail
            yield state[0], state[1], json.dumps(state[2])
        waiting.clear()

    for _, block, chunk, text in rows:
        s = json.loads(text)
        want, start = s["want"], prev
        state = {"start": start, "after": after, "classes": [list(c) for c in classes], "tail": None}
        entered = after >= start
        for line_block, line_no, gap, count, table in s["head"]:
            if entered and not s["through"]:
                break
            pos = (line_block, line_no)
            if gap:
                rest_line(classes, prev)
            if count >= want:
                yield from decide(None)
                after, entered, prev = pos, True, pos
                break
            extend(classes, prev, headline(line_block, line_no, count, table, delimiter))
            after, record = settle(classes, want, pos, after)
            if record is not None:
                yield from decide(record)
            elif after >= start:
                yield from decide(None)
            entered = entered or after >= start
            merge(classes, want)
            prev = pos
        if s["through"]:
            if s["gap"]:
                rest_line(classes, prev)
        else:
            after, classes = leaving(s, start)(after), windows(s, start)
        prev = tuple(s["last"])
        if after < prev:
            waiting.append((block, chunk, state))
        else:
            yield block, chunk, json.dumps(state)
    yield from decide(known["tail"])


def fold(delimiter, parts_only=False):
    """Lines, each chunk led by its state -> records, refused lines, and the parts of
    records that reach over a chunk's end (or these parts only)."""

    def run(batches):
        rows = (
            (file, block, *row)
            for (file, block, _), parts in grouped(batches)
            for row in chunk_records(parts, block, delimiter, parts_only)
        )
        yield from in_batches(rows, RECORDS)

    return run


def open_from(numbers, block, tail):
    """Index of the first of these lines that lies after ``tail``."""
    if tail is None or tail[0] > block:
        return len(numbers)
    return bisect_right(numbers, tail[1]) if tail[0] == block else 0


def chunk_records(parts, block, delimiter, parts_only):
    columns = next(parts)
    if columns[0][0].as_py() != -1:
        raise ValueError("a chunk of lines has no state")
    state = json.loads(columns[4][0].as_py())
    start, after = tuple(state["start"]), tuple(state["after"])
    classes = [[tuple(a), c, m] for a, c, m in state["classes"]]
    tail = tuple(state["tail"]) if state["tail"] is not None else None
    prev, last, gap, held = start, START[1], False, deque()  # held: this chunk's lines in the window

    def refused(limit):
        while held and (limit is None or (block, held[0][0]) <= limit):
            line_no, text = held.popleft()
            if not parts_only:
                yield line_no, "error", text, -1, -1

    def joined(kind, record):
        row = (held[0][0], kind, b"".join(text for _, text in held), *record)
        held.clear()
        return row

    for columns in chain([[c[1:] for c in columns]], parts):
        if not len(columns[0]):
            continue
        numbers, texts = columns[0].to_pylist(), columns[4]
        width, done = columns[2][0].as_py(), 0
        values = texts.to_numpy(zero_copy_only=False)
        for index, line_no, n, plain in edges(columns, last):
            pos, gap = (block, line_no), gap or plain
            if parts_only and after >= start:
                break
            held.extend(zip(numbers[done:index], values[done:index]))
            done = index + 1
            if n >= width:
                yield from refused(None)
                if not parts_only:
                    yield line_no, "good" if n == width else "error", values[index], -1, -1
                after, classes, prev, gap = pos, [], pos, False
                continue
            held.append((line_no, values[index]))
            if gap:
                rest_line(classes, prev)
            extend(classes, prev, Line(pos, n - 1, values[index], delimiter))
            after, record = settle(classes, width - 1, pos, after)
            if record is not None:
                yield from refused(record)
                row = joined("part", record) if record < start else joined("good", (-1, -1))
                if row[1] == "part" or not parts_only:
                    yield row
            else:
                yield from refused(after)
            merge(classes, width - 1)
            prev, gap = pos, False
        if parts_only and after >= start:
            # Of the rest only the lines still open at the end matter: those after ``tail``.
            done = max(done, open_from(numbers, block, tail))
        gap = gap or done < len(numbers)
        held.extend(zip(numbers[done:], values[done:]))
        last = numbers[-1]
    if held and tail is not None:
        yield from refused(tail)
        if held:
            yield joined("part", tail)
    else:
        yield from refused(None)
