"""Near-duplicate documents: SetSketch bands find candidates, full shingle sets confirm them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm import setsketch, words
from feedkit.llm.components import connected_components
from feedkit.llm.stored import Scratch, small_batches

# A block of a candidate cluster: documents, and shingles, that it holds on average at most.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 500_000
# Similarity estimates scatter by about 0.025 at 0.8; pairs this far below the limit are not confirmed.
MARGIN = 0.15

_SKETCH = "doc_id {id}, th long, n long, h1 long, h2 long, regs binary, bands array<long>"
_UPPER = np.uint64(0xA0761D6478BD642F)


def _digest(values: np.ndarray, at: np.ndarray, salt: np.uint64) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(values ^ salt), dtype=np.uint64)])
    return (sums[at[1:]] - sums[at[:-1]]).view(np.int64)


def _sketch_batches(width: int):
    def run(batches):
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            for low, high in words.pieces(offsets):
                part = data[offsets[low]: offsets[high]]
                _, _, hashes, word_at = words.hashed_words(part, offsets[low: high + 1] - offsets[low], words.SOLID)
                values, at = words.shingle_sets(hashes, word_at, width)
                regs = setsketch.registers(values, at)
                keys = setsketch.bands(regs)
                flat = pa.array(keys.ravel(), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array(_digest(values, at, np.uint64(0)), pa.int64()), pa.array(_digest(values, at, _UPPER), pa.int64()),
                    pa.array([row.tobytes() for row in regs], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(high - low + 1) * keys.shape[1], pa.int32()), flat),
                ], names=["doc_id", "th", "n", "h1", "h2", "regs", "bands"])

    return run


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: set size, set digest, registers and band keys of its shingles."""
    kind = dict(docs.dtypes)["doc_id"]
    plain = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    return small_batches(plain).mapInArrow(_sketch_batches(width), _SKETCH.format(id=kind))


def _links(left: np.ndarray, right: np.ndarray, regs: np.ndarray, sizes: np.ndarray, sets: list, percent: int):
    """Pairs (positions) of ``left`` x ``right`` that are linked; of one list with itself, each pair once."""
    same = left is right
    found_a, found_b = [], []
    for low in range(0, len(left), 64):
        rows = left[low: low + 64]
        least = np.minimum(sizes[rows][:, None], sizes[right][None, :])
        most = np.maximum(sizes[rows][:, None], sizes[right][None, :])
        near = 100 * least >= percent * most
        if same:
            near &= rows[:, None] < right[None, :]
        i, j = np.nonzero(near)
        for cut in range(0, len(i), 8192):
            a, b = rows[i[cut: cut + 8192]], right[j[cut: cut + 8192]]
            guess = setsketch.estimate(regs[a], regs[b], sizes[a], sizes[b])
            likely = guess >= percent / 100 - MARGIN
            found_a.append(a[likely])
            found_b.append(b[likely])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if not len(a):
        return a, b
    # exact intersection sizes, from the shingles that at least two of these documents have
    used = np.unique(np.concatenate([a, b]))
    place = np.full(len(sizes), -1)
    place[used] = np.arange(len(used))
    common = np.zeros(len(a), np.int64)
    if len(a) < 4 * len(used):
        for x in range(len(a)):
            common[x] = len(np.intersect1d(sets[a[x]], sets[b[x]], assume_unique=True))
    else:
        ids, column, count = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
        renumbered = np.cumsum(count > 1) - 1
        keep = count[column] > 1
        row, column, width = row[keep], renumbered[column[keep]], int((count > 1).sum())
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        total = np.zeros((len(used), len(used)), np.float32)
        for start in range(0, width, 2048):
            low, high = np.searchsorted(column, [start, start + 2048])
            part = np.zeros((len(used), 2048), np.float32)
            part[row[low:high], column[low:high] - start] = 1
            total += part @ part.T
        common = total[place[a], place[b]].astype(np.int64)
    true = 100 * common >= percent * (sizes[a] + sizes[b] - common)
    return a[true], b[true]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least position connected with each of ``n`` positions."""
    parent = np.arange(n)
    while len(a):
        low = np.minimum(parent[a], parent[b])
        np.minimum.at(parent, parent[a], low)
        np.minimum.at(parent, parent[b], low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        open_ = parent[a] != parent[b]
        a, b = a[open_], b[open_]
    return parent


def _confirm(width: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("k", "ascending")])
        keys = table["k"].to_numpy()
        cluster = table["cluster"].to_numpy()
        side = table["side"].to_numpy()
        sizes = table["n"].to_numpy()
        regs = np.frombuffer(b"".join(table["regs"].to_pylist()), np.int16).reshape(len(keys), -1)
        sets: list[np.ndarray] = []
        data, offsets = words.text_bytes(table["text"])
        for low, high in words.pieces(offsets):
            part = data[offsets[low]: offsets[high]]
            _, _, hashes, word_at = words.hashed_words(part, offsets[low: high + 1] - offsets[low], words.SOLID)
            values, at = words.shingle_sets(hashes, word_at, width)
            sets += [values[at[i]: at[i + 1]] for i in range(high - low)]
        out_a, out_b = [], []
        edges = np.flatnonzero(np.diff(cluster)) + 1
        for group in np.split(np.arange(len(keys)), edges):
            first, second = group[side[group] == 0], group[side[group] == 1]
            a, b = _links(first, second if len(second) else first, regs, sizes, sets, percent)
            if len(a):
                base = group[0]
                root = _roots(len(group), a - base, b - base)
                joined = np.flatnonzero(root != np.arange(len(group)))
                out_a.append(keys[joined + base])
                out_b.append(keys[root[joined] + base])
        none = np.zeros(0, np.int64)
        return pa.table({"a": pa.array(np.concatenate(out_a or [none]), pa.int64()),
                         "b": pa.array(np.concatenate(out_b or [none]), pa.int64())})

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for every row of ``docs(doc_id, text)``.  Runs at once.

    Words are what stands between spaces and the line breaks, A to Z lower-cased; a document is
    the set of its ``width``-word shingles (all words, if fewer).  Two documents are linked if
    100 * intersection >= ``percent`` * union.  ``component_id`` is the least doc_id reachable.

    1. One pass makes each set's size, digest, SetSketch registers and band keys.  Documents of
       equal sets form a class of which one goes on, so copies cost one aggregate.
    2. Classes that share a band key are candidates: each is tied to the least of the band, and
       connected components of these ties are the candidate clusters.
    3. A cluster is cut into blocks of bounded size and every two of its blocks meet in one task;
       small clusters share tasks.  There the registers' joint likelihood drops pairs far below
       the limit and full sets decide the rest.  Only the links of a spanning forest leave.
    4. Components of these links, with the classes, give the result.

    A pair at the limit is missed if none of 43 bands agrees: 2 in a million.  Null or wordless
    texts have no shingles and are linked with nothing.  A null doc_id is a document of its own,
    and least of a component only if it is all there is.  Rows that repeat a doc_id count
    as separate documents; ``kept`` holds for one row of each component, the one of least doc_id.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    every = scratch.write(sketches(docs, width).withColumn("k", F.monotonically_increasing_id()))
    classes = every.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("k").alias("rep"))
    classes = classes.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "rep")
    member = every.join(classes, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("n") > 0), "left")
    member = member.select("k", "doc_id", "th", "n", F.coalesce("rep", "k").alias("rep"))
    member = scratch.write(member)
    rep = member.where((F.col("k") == F.col("rep")) & (F.col("n") > 0)).select(F.col("k").alias("r"))

    banded = every.join(rep, F.col("k") == F.col("r"), "left_semi").select("k", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("k").alias("head"), F.count("*").alias("c")).where("c > 1")
    heads = heads.select(F.col("band").alias("shared"), "head")
    ties = banded.join(heads, F.col("band") == F.col("shared")).where("k <> head").select(F.col("k").alias("a"), F.col("head").alias("b"))
    cluster = scratch.write(connected_components(ties, scratch))

    about = cluster.join(every.select("k", "doc_id", "th", "n", "regs"), F.col("node") == F.col("k"))
    about = scratch.write(about.select("k", "doc_id", "th", "n", "regs", F.col("component").alias("cluster")))
    blocks = about.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n").alias("load"))
    blocks = blocks.select(F.col("cluster").alias("of"), F.greatest(
        F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("load") / BLOCK_SHINGLES)).cast("int").alias("nb"))
    small = about.count() // BLOCK_DOCS + 1
    block = F.when(F.col("nb") > 1, F.pmod(F.xxhash64("k"), F.col("nb"))).otherwise(0)
    placed = about.join(blocks, F.col("cluster") == F.col("of")).withColumn("block", block.cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other")
    met = placed.select("*", other).select(
        "k", "doc_id", "th", "n", "regs", "cluster",
        F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
        F.when(F.col("nb") > 1, F.col("cluster")).otherwise(-1 - F.pmod(F.xxhash64("cluster"), F.lit(small))).alias("pack"),
    )
    texts = docs.select(F.col("doc_id").alias("d"), "text", F.xxhash64("text").alias("t"))
    full = met.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    full = full.select("k", "n", "regs", "cluster", "x", "y", "side", "pack", "text")
    links = full.groupBy("pack", "x", "y").applyInArrow(_confirm(width, percent), "a long, b long")
    linked = scratch.write(connected_components(links, scratch))
    scratch.drop_others(member, linked)

    reached = linked.select("node", "component")
    joined = member.join(reached, F.col("rep") == F.col("node"), "left").withColumn("c", F.coalesce("component", "rep"))
    joined = joined.select("k", "doc_id", "th", "n", "c")
    least = joined.groupBy("c").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "k")).alias("first"))
    least = least.select(F.col("c").alias("of"), "component_id", F.col("first.k").alias("first"))
    return joined.join(least, F.col("c") == F.col("of")).select(
        "doc_id", F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"), "component_id",
        (F.col("k") == F.col("first")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those near-duplicates that are not kept; all columns stay.  Runs at once.

    Of rows that agree in doc_id and text at most one stays.
    """
    decided = near_duplicates(docs, width, percent)
    stay = decided.where("kept").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"))
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_t"))
    marked = docs.join(stay, on)
    from pyspark.sql import Window

    first = Window.partitionBy("_d", "_t").orderBy("_d")
    return marked.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*docs.columns)
