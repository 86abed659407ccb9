"""Merkle manifests."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from feedkit.llm import merkle
from feedkit.llm.queries import QUERIES, SQL
from llmtools import DOCS, SF, odd_documents, rng


BUILD = merkle.manifest


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def climb(nodes):
    """Root of a list of digests, and the siblings of each, level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, k in zip(ways, at):
            low = k - k % 3
            way.append((nodes[low:k], nodes[k + 1:low + 3]))
        nodes = [H(*nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
        at = [k // 3 for k in at]
    return nodes[0], ways


def record(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def fold(leaf, way):
    for left, right in way:
        leaf = H(*left, leaf, *right)
    return leaf


def naive(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of documents, sorted."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        mine = sorted(((r[0], record((r[0], r[3], r[2], r[4], r[1])), r) for r in rows if r[3] == source), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((mine, *climb([x[1] for x in mine])))
    root, above = climb([t[1] for t in trees])
    out = []
    for (mine, subroot, ways), up in zip(trees, above):
        for (doc, leaf, r), way in zip(mine, ways):
            seen = leaf
            if doc is not None and r[1] is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
                seen = record((r[0], r[3], r[2], r[4], r[1].replace("\n", "")))
            proof = H(*[d for left, right in way + up for d in left + right])
            folded = fold(seen, way + up)
            out.append((doc, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def many(n, seed=3):
    r = rng(seed)
    names = [None, "", "a", "b", "é", "Z", "hot", "hot", "hot", "hot"]
    return [(int(k) * 7, f"text {k}\n{k}" if k % 5 else None, "en", names[int(r.integers(10))], k) for k in range(n)]


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, QUERIES["op13_merkle_manifest"], SQL["op13_merkle_manifest"])[1] == ""


def as_query(spark, rows, monkeypatch, levels):
    import feedkit.llm.queries as queries

    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, DOCS))
    monkeypatch.setattr(merkle, "manifest", lambda *a: BUILD(*a, levels=levels))
    return sorted(map(tuple, QUERIES["op13_merkle_manifest"](spark, "").collect()), key=str)


@pytest.mark.parametrize("n,levels", [(1, 8), (300, 8), (300, 1)])
def test_manifest_is_the_naive_one(spark, monkeypatch, n, levels):
    rows = many(n)
    assert as_query(spark, rows, monkeypatch, levels) == naive(rows)


def test_odd_rows(spark, monkeypatch):
    rows = odd_documents() + [(9, None, None, None, None)] * 7 + [(10, "line\n" * 40000, "en", "s", 1)]
    assert as_query(spark, rows, monkeypatch, 1) == naive(rows)
    assert as_query(spark, [], monkeypatch, 8) == []
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame([(1, "s", "00", 3)], "id int, source string, leaf string, position int"), "source", ["id"])


def test_one_changed_digest_breaks_its_witness_only(spark):
    rows = spark.createDataFrame([(k, "s", H(str(k))) for k in range(50)], "id int, source string, leaf string")
    made = merkle.manifest(rows, "source", ["id"], levels=2)
    seen = F.when(F.col("id") == 31, F.lit(H("x"))).otherwise(F.col("leaf"))
    wrong = made.where(merkle.fold(seen, F.col("path")) != F.col("root")).collect()
    assert [r.id for r in wrong] == [31]


@pytest.mark.parametrize("cut", [0, 27, 100])
def test_appending_is_the_same_as_building_at_once(spark, cut):
    rows = [(k, n, H(str(k))) for k, (_, _, _, n, _) in enumerate(many(180))]
    schema = "id int, source string, leaf string"
    whole = merkle.manifest(spark.createDataFrame(rows, schema), "source", ["id"], levels=2)
    first = merkle.manifest(spark.createDataFrame(rows[:cut], schema), "source", ["id"], levels=2)
    both = merkle.append(first, spark.createDataFrame(rows[cut:], schema), "source", ["id"], levels=2)
    assert both.columns == whole.columns
    assert sorted(map(tuple, both.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_open_tree_holds_few_nodes():
    tree = merkle.OpenTree()
    for k in range(1000):
        tree.append(bytes([k % 256]) * 32)
        assert sum(map(len, tree.open)) <= 2 * len(tree.open)
