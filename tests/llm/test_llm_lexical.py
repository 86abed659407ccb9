"""Ranked lexical search."""

import math
from collections import Counter

import numpy as np
import pytest

from checks.compare import compare, connect
from feedkit.llm import lexical
from feedkit.llm.queries import QUERIES, SQL
from llmtools import DOCS, SF, letters, odd_documents, rng


def naive(docs, items, k):
    """(item, rank, doc_id, score) by scoring every document."""
    counts = [(d, Counter(letters(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(letters(text))
    out = []
    for item, mine in terms.items():
        found = []
        for d, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n) // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in mine if c[t])
            if score > 0:
                found.append((-score, d is None, d))
        out += [(item, rank + 1, d, -s) for rank, (s, _, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def table(spark, items, kind="long"):
    return spark.createDataFrame(items, f"item_id {kind}, text string")


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, QUERIES["op12_ranked_search"], SQL["op12_ranked_search"])[1] == ""


def zipf(r, n, size=60):
    return " ".join(f"w{min(int(x), size)}" for x in r.zipf(1.3, n))


@pytest.mark.parametrize("block_terms,shard", [(1 << 19, 8192), (20, 37)])
def test_best_documents_are_those_of_all_scores(spark, monkeypatch, block_terms, shard):
    # shards travel with the task, so their size is set where the tasks are made
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    r = rng(5)
    docs = [(k, zipf(r, int(r.integers(1, 200)))) for k in range(300)]
    docs += [(1000 + k, docs[7][1]) for k in range(40)] + [(7, docs[8][1]), (None, docs[7][1]), (None, docs[7][1])]
    items = [(k, zipf(r, 25)) for k in range(12)] + [(3, "w5 extra"), (None, "w1 W2"), (20, "unknown word"), (21, None), (22, "..."), (23, docs[7][1])]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, score int, item_id int")
    got = lexical.top_documents(df, table(spark, items), k=10, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == naive(docs, items, 10)


def test_odd_rows_and_empty_tables(spark):
    rows = odd_documents() + [(30, "ab" * (1 << 20) + " seven  " + "日" * (1 << 19) + " six", "ja", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    items = [(1, "Six SEVEN one"), (2, "no id"), (2, "a"), (3, "ab" * (1 << 20))]
    got = lexical.top_documents(docs, table(spark, items), k=3).collect()
    assert sorted(map(tuple, got), key=str) == naive([(r[0], r[1]) for r in rows], items, 3)
    assert lexical.top_documents(docs.limit(0), table(spark, items)).collect() == []
    none = lexical.top_documents(docs, table(spark, [], "string"))
    assert none.collect() == [] and dict(none.dtypes)["item_id"] == "string"


def test_words_of_windows_are_those_of_the_whole(monkeypatch):
    r = rng(8)
    monkeypatch.setattr(lexical.words, "WINDOW_BYTES", 16)
    for _ in range(60):
        text = "".join(r.choice(list("aB é."), int(r.integers(0, 400)), p=[0.5, 0.2, 0.1, 0.15, 0.05]))
        data = np.frombuffer(text.encode(), np.uint8)
        count, doc, hashes = lexical.term_hashes(data, np.array([0, len(data)]), 5)
        assert count[0] == len(letters(text)) and (doc == 0).all()
        short = [w for w in letters(text) if len(w.encode()) <= 5]
        want = [lexical.term_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]), 5)[2][0] for w in short]
        assert list(hashes) == want


def shard_of(r, n, n_terms, pairs):
    """A random shard in which the terms of a pair (2k, 2k + 1) meet in few documents, once each, and every document's impacts."""
    dense = np.zeros((n, n_terms), np.int64)
    for t in range(n_terms):
        some = r.random(n) < 0.9 / (t + 1)
        dense[some, t] = r.integers(1, 40, int(some.sum()))
        if t % 2:
            met = (dense[:, t - 1: t + 1] > 0).all(axis=1)
            dense[met, t] = 0
            dense[np.flatnonzero(met)[:20], t - 1: t + 1] = 1
    term = np.flatnonzero(dense.any(axis=0))
    place = [np.flatnonzero(dense[:, t]) for t in term]
    lists = {"length": np.full(n, 50), "term": term, "first": np.cumsum([0, *map(len, place)]), "place": np.concatenate(place),
             "tf": np.concatenate([dense[p, t] for t, p in zip(term, place)])}
    weights = np.array([lexical.term_weight(n, int((dense[:, t] > 0).sum())) for t in range(n_terms)])
    lists |= lexical.pair_lists(lists, weights, pairs, n, 50 * n)
    impact = np.zeros((n, n_terms), np.int64)
    for i, t in enumerate(term):
        here = slice(lists["first"][i], lists["first"][i + 1])
        impact[lists["place"][here], t] = lists["impact"][here]
    return lists, impact


def test_bounds_lose_no_document_and_pairs_touch_fewer():
    r = rng(9)
    pairs = np.array([(k, k + 1) for k in range(0, 24, 2)])
    by_pairs = by_terms = everything = 0
    for _ in range(20):
        lists, impact = shard_of(r, 600, 24, pairs)
        for theta in (1, 100000, int(np.sort(impact.sum(axis=1))[-3])):
            units = [(int(a), int(b), k) for k, (a, b) in enumerate(pairs)]
            single = [(t, -1, -1) for t in range(24)]
            found = []
            for these in (units, single):
                shard = lexical.Shard(lists, 24, len(pairs), 10)
                docs, scores = shard.search(these, theta)
                assert (scores == impact[docs].sum(axis=1)).all()
                found.append((shard.touched, docs, scores))
            tenth = np.sort(impact.sum(axis=1))[-10]
            must = np.flatnonzero(impact.sum(axis=1) >= max(theta, tenth))
            assert set(must) <= set(found[0][1]) and set(must) <= set(found[1][1])
            assert found[0][0] <= found[1][0]
            by_pairs, by_terms, everything = by_pairs + found[0][0], by_terms + found[1][0], everything + len(lists["place"])
    assert by_pairs < by_terms < everything
