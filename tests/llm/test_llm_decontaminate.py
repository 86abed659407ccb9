import hashlib

import numpy as np
import pytest

from checks.compare import compare, connect
from feedkit.llm import decontaminate
from feedkit.llm.fmindex import FMIndex, WaveletMatrix, suffix_order
from feedkit.llm.queries import QUERIES, SQL
from llmtools import DOCS, SF, hits, odd_documents, rng

ITEM = "the quick brown fox jumps over the lazy dog and then some more words follow here"


def test_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, QUERIES["op2_decontamination"], SQL["op2_decontamination"])[1] == ""


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_hits_are_those_of_every_place(spark, block_bytes):
    items = [(1, ITEM), (2, "Short item"), (3, None), (4, "..."), (None, "unnamed thing"), (5, ITEM), (12, "b b b b b b b b b b b b")]
    texts = [
        None, "", "!!", ITEM, "x " + ITEM.upper() + " y", "short, ITEM; short item", "unnamed thing", "the quick brown fox jumps over the lazy dog and",
        "the quick brown fox jumps over the lazy dog", "b " * 40, "short", "item short", f"{ITEM} {ITEM}", "quick " * 30 + ITEM[4:],
    ]
    docs = spark.createDataFrame([(k, t, "e") for k, t in enumerate(texts)], "doc_id long, text string, item_id string")
    found = decontaminate.contaminated_words(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    for r in found.collect():
        words, places, names = hits(r.text, items)
        assert r.n_words == len(words)
        assert {p for h in r.hits for p in range(h["first"], h["last"] + 1)} == places, r.text
        assert r.found == sorted(names)
        assert all(b["first"] > a["last"] + 1 for a, b in zip(r.hits, r.hits[1:]))
    clean = decontaminate.remove_spans(found).collect()
    assert clean[5].text == ", ; " .replace(", ; ", "; ") or "short" not in clean[5].text.lower()
    assert clean[4].text == "x  y" and clean[0].text is None and clean[8].text == texts[8]


def test_odd_rows_and_empty_tables(spark):
    docs = spark.createDataFrame(odd_documents(), DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(docs, none).count() == 10
    some = spark.createDataFrame([(1, "six seven one two"), (2, "no id")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, some)
    assert kept.columns == docs.columns and kept.count() == 7
    assert decontaminate.contaminated_words(docs.limit(0), some).count() == 0
    with pytest.raises(ValueError):
        decontaminate.contaminated_words(docs.withColumnRenamed("lang", "found"), some)


def test_index_finds_every_occurrence():
    r = rng(4)
    for _ in range(30):
        n = int(r.integers(1, 200))
        runs = r.integers(1, 5, n)
        starts = np.unique(np.concatenate([[0], r.integers(0, n, 5)]))
        index = FMIndex(runs, starts, 4, sample=int(r.integers(1, 9)))
        ends = np.append(starts[1:], n)
        for size in (1, 2, 3, 6):
            phrase = r.integers(1, 5, size)
            rows = np.zeros((1, 8), np.int64)
            rows[0, 8 - size:] = phrase
            low, high = index.search(rows, np.array([size]))
            got = sorted(index.locate(np.arange(low[0], high[0])))
            want = [k for a, b in zip(starts, ends) for k in range(a, b - size + 1) if (runs[k:k + size] == phrase).all()]
            assert got == want


def test_suffix_order_and_ranks():
    r = rng(6)
    text = np.append(r.integers(1, 4, 80), 0)
    order = suffix_order(text)
    assert [tuple(text[k:]) for k in order] == sorted(tuple(text[k:]) for k in range(81))
    matrix = WaveletMatrix(text, 2)
    for c in range(4):
        for at in (0, 1, 40, 81):
            assert matrix.rank(np.array([c]), np.array([at]))[0][0] == (text[:at] == c).sum()


def test_digest_of_no_items(spark):
    clean = QUERIES["op2_decontamination"](spark, SF).where("not contaminated").first()
    assert clean.items_sha256 == hashlib.sha256(b"").hexdigest() and clean.n_hit == 0
