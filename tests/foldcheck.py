"""Runs the fold helpers of ``repair_linefeeds`` without Spark, the way Spark calls them."""

import pyarrow as pa

from feedkit.operators import linefold

SCHEMA = pa.schema([
    ("hash", pa.int64()), ("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int64()),
    ("line_no", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("edge", pa.bool_()), ("value", pa.binary()),
])


def is_edge(line, n, width, delimiter):
    if n > 1 or n >= width:
        return True
    if len(delimiter) == 1:
        return False
    starts = {delimiter[k:k + 1] for k in range(len(delimiter))}
    return line[:1] in starts or any(line.endswith(delimiter[:k]) for k in range(1, len(delimiter)))


def batches(rows, size):
    for at in range(0, len(rows), size):
        columns = list(zip(*rows[at:at + size]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SCHEMA.types)], SCHEMA.names)


def tree(notes, delimiter, fan, span):
    """States of all chunks, by the steps that ``repair_linefeeds`` has Spark group."""
    def table(rows):
        return pa.Table.from_batches([linefold.output(rows, linefold.NOTES)])

    def grouped(rows, key):
        out = {}
        for row in rows:
            out.setdefault(key(row), []).append(row)
        return out

    keys = [lambda r: (r[1], r[2] // fan), lambda r: r[1] // span]
    levels = [notes]
    for key in keys:
        levels.append([r for g in grouped(levels[-1], key).values() for r in rows_of([linefold.compose(delimiter)(table(g))])])
    top = levels.pop()
    states = rows_of([linefold.connect(delimiter)(table(top))]) if top else []
    for key in reversed(keys):
        known = grouped(states, key)
        states = [r for k, g in grouped(levels.pop(), key).items()
                  for r in rows_of([linefold.connect_inside(delimiter)(table(g), table(known[k]))])]
    return states


def rows_of(out):
    return [tuple(r.values()) for batch in out for r in batch.to_pylist()]


def repair(lines, delimiter, width, chunk_lines, blocks=1, batch=7, fan=4096, span=1 << 34):
    """(good, error) by the chunked fold, both sorted."""
    width = width or (len(lines[0].split(delimiter)) if lines else 0)
    per_block = max(1, -(-len(lines) // blocks))
    rows = []
    for i, line in enumerate(lines):
        if line.strip(b" \t\n\r\x0b\x0c"):
            n, block, chunk = len(line.split(delimiter)), i // per_block * 1000, i // chunk_lines
            edge = is_edge(line, n, width, delimiter)
            rows.append((hash((block, chunk)), "f", block, chunk, i, n, width, edge, line))
    rows.sort(key=lambda r: r[:5])
    notes = rows_of(linefold.summarize(delimiter)(batches(rows, batch)))
    states = tree(notes, delimiter, fan, span)
    led = rows + [
        (hash((block, chunk)), file, block, chunk, -1, 0, 0, False, state.encode())
        for file, block, chunk, state in states
    ]
    led.sort(key=lambda r: r[:5])
    out = rows_of(linefold.fold(delimiter)(batches(led, batch)))
    parts = rows_of(linefold.fold(delimiter, parts_only=True)(batches(led, batch)))
    assert sorted(parts) == sorted(r for r in out if r[3] == "part")
    good = [r[4] for r in out if r[3] == "good"]
    records = {}
    for _, block, line_no, _, value, *record in parts:
        records.setdefault(tuple(record), []).append((block, line_no, value))
    good += [b"".join(v for _, _, v in sorted(p)) for p in records.values()]
    return sorted(good), sorted(r[4] for r in out if r[3] == "error")
