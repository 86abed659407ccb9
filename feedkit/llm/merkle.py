"""Merkle manifest of a table: digests of records, a tree for each group of them, and a tree over the groups.

Nodes are appended from left to right.  Every three of a level complete their parent, and that extends the witnesses
of all leaves below at once.  A task appends one aligned block of leaves after another; the roots of the blocks are
appended in the same way, block by block, until one node is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.llm.stored import Scratch

# Nodes that become one parent, and levels of the subtree that one task appends before it hands on.
ARITY = 3
BLOCK_LEVELS = 8

STEP = "array<struct<left:binary,right:binary>>"
MADE = ["position", "count", "path", "subroot", "root"]


def record_digest(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of a record: ``-`` for each null, else UTF-8 byte count, ``:``, value as text."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def parent_digest(children: Sequence[bytes]) -> bytes:
    """SHA-256 of the children's digests, which are hashed as hex text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


class OpenTree:
    """A subtree that takes nodes from left to right.

    ``open[l]`` holds the nodes of level l whose parent is not complete yet.  ``steps[l]`` holds, for each node whose
    parent is, its siblings to the left and to the right.  A leaf's witness is the steps of the subtrees that it is
    in, one for each level; they hang on the subtrees, so completing a parent extends the witnesses of all its leaves.
    """

    def __init__(self, arity: int = ARITY):
        self.arity, self.size = arity, 0
        self.open: list[list[bytes]] = [[]]
        self.steps: list[tuple[list[bytes], list[bytes]]] = []

    def append(self, digest: bytes) -> None:
        self.size += 1
        self._push(0, digest)

    def _push(self, level: int, digest: bytes) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(digest)
        if len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        if level == len(self.steps):
            self.steps.append(([], []))
        lefts, rights = self.steps[level]
        for k in range(len(run)):
            lefts.append(b"".join(run[:k]))
            rights.append(b"".join(run[k + 1:]))
        self._push(level + 1, parent_digest(run))

    def _nodes(self, level: int) -> int:
        done = len(self.steps[level][0]) if level < len(self.steps) else 0
        return done + len(self.open[level])

    def close(self, height: int | None = None) -> bytes:
        """Complete the runs that are open, up to ``height`` levels or (None) until one node remains, and return that."""
        level = 0
        while level < height if height is not None else self._nodes(level) > 1:
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0]

    def paths(self) -> pa.Array:
        """The witness of every leaf, after ``close``."""
        leaf = np.arange(self.size)
        first = np.cumsum([0, *[len(lefts) for lefts, _ in self.steps]])
        at = [first[level] + leaf // self.arity ** level for level in range(len(self.steps))]
        flat = pa.array(np.stack(at, axis=1).ravel() if at else np.zeros(0, np.int64))
        sides = [pa.array([x for step in self.steps for x in step[k]], pa.binary()).take(flat) for k in (0, 1)]
        offsets = pa.array(np.arange(self.size + 1) * len(self.steps), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(sides, ["left", "right"]))


def _append_blocks(names: list[str], keys: list[str], levels: int):
    """Over rows sorted by group and position: adds ``path`` within the block and ``top``, the block's root."""
    size = ARITY ** levels

    def finish(tree: OpenTree, count: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_batches(held)
        # a group of one block ends at its root; a block of several goes up to the height of its full neighbours
        top = tree.close(None if count <= size else levels)
        tops = pa.array([top]).take(pa.array(np.zeros(tree.size, np.int64)))
        return pa.RecordBatch.from_arrays([*rows.columns, tree.paths(), tops], [*names, "path", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, block, count = None, [], None, 0
        for batch in batches:
            columns = [batch.column(names.index(c)).to_pylist() for c in (*keys, "position", "count", "digest")]
            low = 0
            for k, (*group, position, n, digest) in enumerate(zip(*columns)):
                here = (*group, position // size)
                if here != block:
                    if tree is not None:
                        yield finish(tree, count, [*held, batch.slice(low, k - low)])
                    tree, held, block, count, low = OpenTree(), [], here, n, k
                tree.append(digest)
            if low < batch.num_rows:
                held.append(batch.slice(low))
        if tree is not None:
            yield finish(tree, count, held)

    return run


def _blocks(nodes: DataFrame, keys: list[str], levels: int) -> DataFrame:
    """One aligned block of nodes in one task; no group is in one task as a whole, but those of one block."""
    block = F.expr(f"position div {ARITY ** levels}")
    dealt = nodes.repartition(*keys, block).sortWithinPartitions(*keys, "position")
    schema = dealt.select("*", F.lit(None).cast(STEP).alias("path"), F.lit(None).cast("binary").alias("top")).schema
    return dealt.mapInArrow(_append_blocks(dealt.columns, keys, levels), schema)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys], F.lit(True))


def in_order(rows: DataFrame, keys: list[str], order: Sequence[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``position`` (from 0, in the order of ``order``, nulls first) and ``count`` within their group.  Runs at once.

    Rows are split into ranges of group and order, so a large group lies in many ranges.  The number of rows of a
    group in a range gives where the next range goes on.  Equal rows may lie in several ranges.
    """
    spread = rows.withColumn("_spread", F.rand(5)).repartitionByRange(*keys, *order, "_spread")
    placed = spread.sortWithinPartitions(*keys, *order).drop("_spread").select(
        "*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
    written = scratch.write(placed)
    sizes = written.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*keys)
    before = F.sum("_n").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("__range"),
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(group).alias("count"))
    met = written.join(offsets, _same(written, offsets, [*keys, "_range"]))
    return met.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("position"), "count")


def _grow(first: DataFrame, most: int, keys: list[str], scratch: Scratch, levels: int) -> list[DataFrame]:
    """Written tables of nodes with their block's witness: ``first``, then the roots of its blocks, until groups are of one block."""
    tables = [first]
    size = ARITY ** levels
    while most > size:
        below = tables[-1].where(F.col("position") % size == 0)
        roots = below.select(
            *keys, F.expr(f"position div {size}").alias("position"), F.expr(f"(count + {size - 1}) div {size}").alias("count"),
            F.col("top").alias("digest"))
        tables.append(scratch.write(_blocks(roots, keys, levels)))
        most = -(-most // size)
    return tables


def _down(tables: list[DataFrame], last: DataFrame, keys: list[str], extra: list[str], levels: int) -> DataFrame:
    """Nodes of the first table with the steps of every table above; ``last`` stands for the last table."""
    for table in reversed(tables[:-1]):
        above = last.select(
            *[F.col(k).alias(f"_{k}") for k in keys], F.col("position").alias("__block"), F.col("path").alias("_above"), *extra)
        here = table.withColumn("_block", F.expr(f"position div {ARITY ** levels}"))
        met = here.join(above, _same(here, above, [*keys, "_block"]))
        last = met.select(*[c for c in table.columns if c != "path"], F.concat("path", "_above").alias("path"), *extra)
    return last


def _most(rows: DataFrame) -> int:
    return rows.agg(F.max("count")).first()[0] or 0


def _manifest(first: DataFrame, group: str, scratch: Scratch, levels: int) -> DataFrame:
    """The whole witnesses of written leaf blocks: through their group's tree, then through the tree of groups."""
    tables = _grow(first, _most(first), [group], scratch, levels)
    tops = tables[-1].where("position = 0").select(group, F.col("top").alias("digest"))
    ranked = in_order(tops, [], [group], scratch)
    upper = _grow(scratch.write(_blocks(ranked, [], levels)), _most(ranked), [], scratch, levels)
    last = upper[-1].withColumn("root", F.col("top"))
    groups = _down(upper, last, [], ["root"], levels).select(F.col(group).alias(f"_{group}"), F.col("path").alias("_above"), "root")
    met = tables[-1].join(groups, _same(tables[-1], groups, [group]))
    steps = F.concat("path", "_above").alias("path")
    last = met.select(*[c for c in tables[-1].columns if c != "path"], steps, F.col("top").alias("subroot"), "root")
    return _down(tables, last, [group], ["subroot", "root"], levels).drop("top")


def _checked(rows: DataFrame, leaf: str) -> DataFrame:
    taken = {*MADE, "digest", "top"} & set(rows.columns) | {c for c in rows.columns if c.startswith("_")}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    return rows.withColumn("digest", F.unhex(leaf))


def _texts(nodes: DataFrame) -> DataFrame:
    return nodes.drop("digest").withColumns({c: F.lower(F.hex(c)) for c in ("subroot", "root")})


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str = "leaf", levels: int = BLOCK_LEVELS) -> DataFrame:
    """``rows`` with their place in the Merkle tree and their witness.  Runs at once.

    ``leaf`` holds hex digests.  In each ``group`` (null is one) leaves follow ``order``, nulls first, equal ones by
    digest; every three nodes of a level, fewer at its end, become their hash while several remain.  The
    roots of the groups, in the order of ``group`` (null first, texts by bytes), are hashed likewise.

    Added: ``position`` and ``count`` in the group, ``path`` (a step for each level: the raw digests of the siblings to the
    left and to the right), ``subroot`` and ``root``.  Rows that are equal in ``order`` and ``leaf`` take neighbouring places.
    An empty table gives no rows.  Rows must have none of the added names, nor names that begin with ``_``.

    A task works on blocks of ``3 ** levels`` nodes, so one large group spreads over the cluster.
    """
    rows = _checked(rows, leaf)
    scratch = Scratch(rows.sparkSession, "merkle")
    ranked = in_order(rows, [group], [*order, "digest"], scratch)
    return _texts(_manifest(scratch.write(_blocks(ranked, [group], levels)), group, scratch, levels))


def append(made: DataFrame, more: DataFrame, group: str, order: Sequence[str], leaf: str = "leaf", levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest ``made`` with ``more`` rows after those of their group.  Runs at once.

    Full blocks keep their place and the witnesses within them; only each group's open last block takes leaves.  If
    the new rows come after the old ones by ``order`` the result is that of one ``manifest`` over all rows.
    """
    size = ARITY ** levels
    more = _checked(more, leaf)
    scratch = Scratch(more.sparkSession, "merkle-append")
    had = made.groupBy(group).agg(F.max("count").alias("had")).withColumnRenamed(group, f"_{group}")
    new = in_order(more, [group], [*order, "digest"], scratch)
    new = new.join(had, _same(new, had, [group]), "left").drop(f"_{group}")
    grown = scratch.write(new.withColumn("had", F.coalesce("had", F.lit(0))))
    added = grown.groupBy(group).agg(F.max("count").alias("_more")).withColumnRenamed(group, f"_{group}")
    old = made.join(added, _same(made, added, [group]), "left")
    is_full = F.col("position") < F.col("count") - F.col("count") % size
    count = F.col("count") + F.coalesce("_more", F.lit(0))
    old = old.select(
        *[c for c in made.columns if c not in ("count", "subroot", "root")], count.alias("count"), F.unhex(leaf).alias("digest"), is_full.alias("_full"))
    inside = F.slice("path", 1, levels)
    full = old.where("_full").withColumns({"path": inside, "top": F.unhex(fold(F.col(leaf), inside))})
    grown = grown.withColumns({"position": F.col("position") + F.col("had"), "count": F.col("count") + F.col("had")}).drop("had")
    opened = old.where("NOT _full").drop("path", "_full").unionByName(grown)
    blocks = _blocks(opened, [group], levels)
    first = scratch.write(full.select(*blocks.columns).unionAll(blocks))
    return _texts(_manifest(first, group, scratch, levels))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and a witness give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(_hex(step["left"]), node, _hex(step["right"])), 256))


def siblings(path: Column) -> Column:
    """The digests of a witness as one hex text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(_hex(step["left"]), _hex(step["right"]))), "")
