"""Exact top-k by inner product: a pivot table bounds every candidate, and the best bounds are evaluated first."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.llm.stored import small_batches

PIVOTS = 256
# Of a query's pivots the bound takes the nearest and the farthest; the others hardly raise the maximum.
NEAR, FAR = 16, 8
# Rows of a block of candidates and of a block of queries; one task takes one block of each at a time.
CANDIDATE_ROWS, QUERY_ROWS = 4096, 1024
# Blocks of candidates that meet one block of queries under one key.
SHARE = 2
# The bound is computed in double precision and widened by this share of the sizes that went in.
SLACK = 1e-9


def usable(vector: Column | str, scale: int = 256) -> Column:
    """floor(scale * x) of each component as an array of longs; null if a component is null or not finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    wide = vector.cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNull() | bad, None).otherwise(F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", matrix, matrix)


def distances(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row to every pivot."""
    squares = _norms(matrix)[:, None] + _norms(pivots)[None, :] - 2 * matrix @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def best_in_block(queries: np.ndarray, query_ids: np.ndarray, query_table: np.ndarray, rows: np.ndarray,
                  row_ids: np.ndarray, row_table: np.ndarray, k: int):
    """(place of the query, place of the row, score) of each query's ``k`` best rows of one block; ties go to smaller ids.

    ``query_table`` has the distances of a query to all pivots by row, ``row_table`` those of a candidate by column.
    The largest difference of distances to a pivot is a lower bound of the distance of query and row, and
    so bounds the inner product from above: (|q|^2 + |r|^2 - bound^2) / 2.  Candidates are taken in
    the order of that bound, in growing portions, until the k-th best score exceeds every bound that is left.
    """
    q_norm, r_norm = _norms(queries), _norms(rows)
    largest = r_norm.max() if len(rows) else 0.0
    out_q, out_id, out_score = [], [], []
    for j in range(len(queries)):
        near = np.argsort(query_table[j], kind="stable")
        telling = near if len(near) <= NEAR + FAR else np.concatenate([near[:NEAR], near[-FAR:]])
        lower = np.abs(row_table[telling] - query_table[j][telling, None]).max(axis=0)
        slack = SLACK * (q_norm[j] + largest) + 1e-6
        upper = (q_norm[j] + r_norm - lower * lower) / 2 + slack + SLACK * lower * (q_norm[j] + largest) ** 0.5
        if len(upper) > 4 * k:
            order = np.argsort(-upper)
        else:
            order = np.arange(len(upper))
            upper = np.full(len(upper), np.inf)
        have_at, have = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 16 * k
        while at < len(order):
            if len(have) >= k and upper[order[at]] < have[-1]:
                break
            part = order[at: at + step]
            at, step = at + step, step * 2
            own = row_ids[part] != query_ids[j]
            part = part[own]
            have_at = np.concatenate([have_at, part])
            have = np.concatenate([have, rows[part] @ queries[j]])
            first = np.lexsort((row_ids[have_at], -have))[:k]
            have_at, have = have_at[first], have[first]
        out_q.append(np.full(len(have), j))
        out_id.append(have_at)
        out_score.append(have)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_id, out_score))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


_PACKED = "size int, block long, ids binary, copies binary, rows binary, pivots binary"


def _block(table: pa.Table, pivots: bytes | None) -> pa.Table:
    """One row for a block: ids, numbers of copies and vectors as bytes; no row for no vectors."""
    table = table.combine_chunks()
    made = []
    if table.num_rows:
        width = table["size"][0].as_py()
        made = [(width, table["block"][0].as_py(), table["id"].to_numpy().astype(np.int64).tobytes(),
                 table["copies"].to_numpy().astype(np.int64).tobytes(), _bytes(table["vector"], width), pivots)]
    types = [pa.int32(), pa.int64()] + [pa.binary()] * 4
    columns = list(zip(*made)) or [[]] * len(types)
    return pa.table({f.split(" ")[0]: pa.array(c, t) for f, c, t in zip(_PACKED.split(", "), columns, types)})


def _bytes(column: pa.ChunkedArray, width: int) -> bytes:
    """Vectors as 32-bit numbers where all fit, else as 64-bit ones; the length tells which."""
    rows = _matrix(column.combine_chunks(), width)
    short = rows.astype(np.int32)
    return (short if (short == rows).all() else rows.astype(np.int64)).tobytes()


def _vectors(data: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int32 if len(data) == 4 * n * width else np.int64).reshape(n, width).astype(np.float64)


def _pack(table: pa.Table) -> pa.Table:
    return _block(table, None)


def _pack_with_pivots(table: pa.Table, pivots: pa.Table) -> pa.Table:
    return _block(table, pivots["pivot"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes())


def _search(k: int):
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                width = r["size"]
                pivots = np.frombuffer(r["q_pivots"], np.int64).reshape(-1, width).astype(np.float64)
                side, ids_of, copies = [], [], []
                for p in ("q_", "r_"):
                    ids = np.frombuffer(r[p + "ids"], np.int64)
                    ids_of.append(ids)
                    copies.append(np.minimum(np.frombuffer(r[p + "copies"], np.int64), k))
                    rows = _vectors(r[p + "rows"], len(ids), width)
                    side += [rows, ids, distances(rows, pivots) if p == "q_" else distances(pivots, rows)]
                q, i, s = best_in_block(*side, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.astype(np.int64), pa.int64()) for x in (ids_of[0][q], ids_of[1][i], s, np.minimum(copies[0][q] * copies[1][i], k))],
                    ["query_id", "id", "score", "copies"])

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of largest inner product for every query.

    ``vectors(id, vector)``: integer vectors, ``queries`` a condition that says which of its rows are queries.
    A candidate is every row of another id; ties go to smaller ids.  Rows with a null id or vector take no part, and
    vectors of different length do not meet.  Each row of a repeated id is a candidate of its own; rows of a
    repeated query id share one ranking, in which each meets every candidate.  Equal rows are held once, with their number.
    Vectors of length 0 score 0 with each other, so that the least ids are their best.  Inner products and squared distances must stay below 2**53.

    Blocks of queries meet blocks of candidates, every pair one row of some task, so no table is held whole anywhere.
    The pivots are the rows with the least hashes of their ids, ``pivots`` for each length.  They travel with each block of
    queries; where it meets a block of candidates, distances of all rows to all pivots come first, then every query uses them.
    """
    whole = vectors.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select(F.col("id").cast("long").alias("id"), "vector")
    every = whole.groupBy("id", "vector").agg(F.count("*").alias("copies")).withColumn("size", F.size("vector"))
    whole = every.where("size > 0")
    place = Window.partitionBy("size").orderBy(F.xxhash64("id"), "id", "vector")
    chosen = whole.withColumn("n", F.row_number().over(place)).where(F.col("n") <= pivots)

    def blocks(df, rows):
        """Rows dealt to blocks of about ``rows``, and the number of blocks for each length."""
        counts = df.groupBy("size").agg(F.count("*").alias("c")).select(F.col("size").alias("s"), F.ceil(F.col("c") / rows).alias("n_blocks"))
        dealt = df.join(counts, F.col("size") == F.col("s"))
        return dealt.select("id", "vector", "copies", "size", F.pmod(F.xxhash64("id", "vector"), "n_blocks").alias("block")).groupBy("size", "block"), counts

    asked, q_counts = blocks(whole.where(queries), QUERY_ROWS)
    stored, r_counts = blocks(whole, CANDIDATE_ROWS)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("for")
    carried = chosen.join(q_counts, F.col("size") == F.col("s")).select(
        F.col("size").alias("of"), F.col("vector").alias("pivot"), each).groupBy("of", "for")
    asked = asked.cogroup(carried).applyInArrow(_pack_with_pivots, _PACKED)
    stored = stored.applyInArrow(_pack, _PACKED)

    def copies(df, counts, each, prefix, mine, other):
        """Each block once for every share of blocks of the other side."""
        met = df.join(counts, F.col("size") == F.col("s"))
        shares = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_blocks") - 1) / each))).alias(other)
        return met.select(F.col("size").alias(f"{prefix}size"), mine.alias(f"{prefix}mine"), shares,
                          *[F.col(c).alias(f"{prefix}{c}") for c in ("ids", "copies", "rows", "pivots")])

    q = copies(asked, r_counts, SHARE, "q_", F.col("block"), "share")
    r = copies(stored, q_counts, 1, "r_", F.floor(F.col("block") / SHARE), "with")
    met = q.join(r, (q.q_size == r.r_size) & (q.q_mine == r["with"]) & (q.share == r.r_mine))
    met = met.drop("r_pivots").withColumnRenamed("q_size", "size")
    found = small_batches(met).mapInArrow(_search(k), "query_id long, id long, score long, copies long")
    # of the vectors of length 0 no query needs more than the least k + 1 ids
    bare = every.where("size = 0").select("id", "copies")
    asking = bare.where(queries).select(F.col("id").alias("query_id"), F.col("copies").alias("asked"))
    met = asking.crossJoin(bare.orderBy("id").limit(k + 1)).where(F.col("id") != F.col("query_id"))
    found = found.unionAll(met.select("query_id", "id", F.lit(0).cast("long").alias("score"), (F.col("asked") * F.col("copies")).alias("copies")))
    found = found.select("query_id", "id", "score", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
