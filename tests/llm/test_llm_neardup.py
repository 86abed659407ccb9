import numpy as np
import pytest

from feedkit.llm import neardup, setsketch, words
from feedkit.llm.components import connected_components
from feedkit.llm.queries import QUERIES
from feedkit.llm.stored import Scratch
from llmtools import DOCS, SF, edited, groups, near_groups, odd_documents, rng, shingles


def expected(ids, texts, width, percent=80):
    comp, sets = near_groups(texts, width, percent)
    least = {}
    for k, c in enumerate(comp):
        least[c] = min(least.get(c, ids[k]), ids[k])
    return {i: (len(s), least[c]) for i, s, c in zip(ids, sets, comp)}


def clusters():
    r, out = rng(), []
    for base in range(4):
        text = [f"w{base}_{k}" for k in range(120)]
        out += [edited(r, text, share) for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.08) for _ in range(6)]
    return out + ["short one", "Short ONE", "a b c d e f", "a b c d e g", "", "   "]


@pytest.mark.parametrize("block", [512, 7])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_DOCS", block)
    texts = clusters()
    ids = [int(x) for x in rng(2).permutation(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, 5).collect()}
    assert got == expected(ids, texts, 5)


def test_query_on_the_smallest_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = expected([r.doc_id for r in rows], [r.text for r in rows], 4)
    got = QUERIES["op8_near_duplicates"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    docs = spark.createDataFrame(odd_documents(), DOCS)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()), key=str)
    assert len(got) == 10
    assert sum(kept for *_, kept in got) == 7  # 4, 6, 6 are one group, so are the two without an id
    assert (6, 1, 4, False) in got and (None, 1, None, True) in got and (1, 0, 1, True) in got
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 7


def test_no_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([], DOCS)
    assert neardup.near_duplicates(docs).count() == 0
    wide = spark.createDataFrame([(1, "a b", 5, 6, 7), (2, "a b", 5, 6, 7)], "doc_id long, text string, k long, rep long, cluster long")
    assert [tuple(r) for r in neardup.drop_near_duplicates(wide).collect()] == [(1, "a b", 5, 6, 7)]


def test_components(spark):
    r = rng(5)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (230, 2))] + [(k, k + 1) for k in range(400, 460)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {x.node: x.component for x in connected_components(df, Scratch(spark, "test")).collect()}
    want = groups(461, edges)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: want[x] for x in linked}


def test_shingle_sets_count_distinct_shingles():
    for text in ("", "a", "a b c d e", "x y x y x y x y", "É é\tA a\n"):
        data = np.frombuffer(text.encode(), np.uint8)
        _, _, hashes, at = words.hashed_words(data, np.array([0, len(data)]), words.SOLID)
        for width in (1, 2, 4):
            assert len(words.shingle_sets(hashes, at, width)[0]) == len(shingles(text, width))


def test_word_hashes_do_not_depend_on_windows(monkeypatch):
    text = ("Some words here " + "w" * 90 + " end ").encode() * 20
    data = np.frombuffer(text, np.uint8)
    starts, ends = words.spans(data, np.array([0, len(data)]), words.SOLID)
    whole = words.word_hashes(data, starts, ends)
    monkeypatch.setattr(words, "WINDOW_BYTES", 50)
    assert (words.word_hashes(data, starts, ends) == whole).all()


def test_registers_merge_and_estimate():
    r = rng(3)
    values = np.sort(r.integers(0, 1 << 63, 900, dtype=np.uint64))
    a, b = values[:600], values[300:]
    regs = setsketch.registers(np.concatenate([a, b, values]), np.array([0, 600, 1200, 2100]))
    assert (setsketch.merge(regs[0], regs[1]) == regs[2]).all()
    guess = setsketch.estimate(regs[:1], regs[1:2], np.array([600]), np.array([600]))[0]
    assert abs(guess - 1 / 3) < 0.12
    same = setsketch.estimate(regs[:1], regs[:1], np.array([600]), np.array([600]))[0]
    assert same > 0.99
