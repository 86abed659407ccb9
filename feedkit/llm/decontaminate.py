"""Passages of a benchmark inside documents, found in an FM-index of each shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm import words
from feedkit.llm.fmindex import FMIndex
from feedkit.llm.stored import small_batches

WINDOW = 10
# Bytes of benchmark text that one pass over the documents takes to the tasks.
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 1 << 20


class Phrases:
    """Distinct windows of some benchmark items as symbols of their vocabulary."""

    def __init__(self, texts: list[str], window: int):
        data, offsets = words.text_bytes(pa.array(texts, pa.large_string()))
        _, _, hashes, at = words.hashed_words(data, offsets, words.LETTERS)
        self.vocabulary = np.unique(hashes)
        symbols = np.searchsorted(self.vocabulary, hashes) + 1
        counts = np.diff(at)
        made = np.where(counts >= window, counts - window + 1, (counts > 0).astype(np.int64))
        item = np.repeat(np.arange(len(texts)), made)
        first = at[item] + np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
        length = np.minimum(counts[item], window)
        # right-aligned, filled with 0
        place = first[:, None] + np.arange(window)[None, :] - (window - length)[:, None]
        filled = np.arange(window)[None, :] >= (window - length)[:, None]
        rows = np.where(filled, symbols[np.where(filled, place, 0)] if len(symbols) else 0, 0)
        self.rows, back = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, item)
        back = back.ravel()
        self.lengths = (self.rows > 0).sum(axis=1)
        order = np.argsort(back, kind="stable")
        self.items = item[order]
        self.item_at = np.searchsorted(back[order], np.arange(len(self.rows) + 1))
        self.least = int(self.lengths.min()) if len(self.rows) else 0
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each word, 0 for a word that no item has."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.sieve[(hashes >> np.uint64(44)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            found = self.vocabulary[at] == hashes[maybe]
            out[maybe[found]] = at[found] + 1
        return out

    def occurrences(self, hashes: np.ndarray, word_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of every occurrence in a shard of texts.

        Words that no item has, and text ends, part the shard into runs.  Runs shorter than the
        shortest phrase cannot hold one; the others are indexed.
        """
        none = np.zeros(0, np.int64)
        if not self.least or not len(hashes):
            return none, none
        symbol = self.symbols(hashes)
        known = symbol > 0
        cut = np.zeros(len(known) + 1, bool)
        cut[word_at] = True
        begin = np.flatnonzero(known & (cut[:-1] | ~np.concatenate([[False], known[:-1]])))
        end = np.flatnonzero(known & (cut[1:] | ~np.concatenate([known[1:], [False]]))) + 1
        long = end - begin >= self.least
        begin, end = begin[long], end[long]
        if not len(begin):
            return none, none
        sizes = end - begin
        starts = np.cumsum(sizes) - sizes
        source = np.repeat(begin - starts, sizes) + np.arange(sizes.sum())
        index = FMIndex(symbol[source], starts, len(self.vocabulary))
        low, high = index.search(self.rows, self.lengths)
        hits = np.flatnonzero(high > low)
        count = high[hits] - low[hits]
        phrase = np.repeat(hits, count)
        row = np.repeat(low[hits] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return phrase, source[index.locate(row)]


_STATE = "n_words long, hits array<struct<first:int,last:int>>, found array<string>"


def _merged(covered: np.ndarray, word_at: np.ndarray):
    """Maximal ranges of covered words (first, last), counted within each text, and their offsets by text."""
    cut = np.zeros(len(covered) + 1, bool)
    cut[word_at] = True
    before = np.concatenate([[False], covered[:-1]]) if len(covered) else covered
    after = np.concatenate([covered[1:], [False]]) if len(covered) else covered
    first = np.flatnonzero(covered & (cut[:-1] | ~before))
    last = np.flatnonzero(covered & (cut[1:] | ~after))
    doc = np.searchsorted(word_at, first, side="right") - 1
    return first - word_at[doc], last - word_at[doc], np.searchsorted(doc, np.arange(len(word_at)))


def _scan(phrases: Phrases, ids: list, schema_names: list[str]):
    def run(batches):
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(schema_names.index("text")))
            for low, high in words.pieces(offsets, SHARD_BYTES):
                part, at = data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low]
                starts, ends, hashes, word_at = words.hashed_words(part, at, words.LETTERS)
                phrase, first = phrases.occurrences(hashes, word_at)
                edge = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(edge, first, 1)
                np.add.at(edge, first + phrases.lengths[phrase], -1)
                state = batch.slice(low, high - low)
                old = state.column(schema_names.index("hits"))
                old_at = old.offsets.to_numpy()
                doc = np.repeat(np.arange(high - low), np.diff(old_at))
                spans = old.flatten()
                np.add.at(edge, spans.field(0).to_numpy() + word_at[doc], 1)
                np.add.at(edge, spans.field(1).to_numpy() + word_at[doc] + 1, -1)
                covered = np.cumsum(edge[:-1]) > 0
                head, tail, span_at = _merged(covered, word_at)
                # items of the phrases, once per text
                per = np.diff(phrases.item_at)[phrase] if len(phrase) else np.zeros(0, np.int64)
                which = np.repeat(phrases.item_at[phrase] - (np.cumsum(per) - per), per) + np.arange(per.sum())
                in_doc = np.repeat(np.searchsorted(word_at, first, side="right") - 1, per)
                pairs = np.unique(np.stack([in_doc, phrases.items[which]]), axis=1)
                found = state.column(schema_names.index("found")).to_pylist()
                for d, item in pairs.T:
                    if ids[item] is not None:
                        found[d] = found[d] + [ids[item]]
                made = {
                    "n_words": pa.array(np.diff(word_at), pa.int64()),
                    "hits": pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(head, pa.int32()), pa.array(tail, pa.int32())], ["first", "last"])),
                    "found": pa.array(found, pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays(
                    [made.get(c, state.column(k)) for k, c in enumerate(schema_names)], schema_names)
                del edge, covered

    return run


def _blocks(items: DataFrame, block_bytes: int):
    """Items in blocks of bounded size, one after the other on the driver."""
    sized = items.select(F.col("item_id").cast("string").alias("item_id"), "text", F.octet_length("text").alias("size"))
    sized = sized.where("text is not null")
    total = sized.agg(F.sum("size")).first()[0] or 0
    n = int(total // block_bytes) + 1
    if n == 1:
        yield sized.select("item_id", "text").collect()
        return
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(4 * n)))
    for k in range(4 * n):
        yield dealt.where(F.col("block") == k).select("item_id", "text").collect()


def contaminated_words(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` and ``found`` added.  Reads the benchmark at once.

    Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII.  A phrase is
    ``window`` consecutive words of an item, or all words of a shorter item.  ``hits`` are merged
    ranges [first, last] of words of the document inside any phrase, ``found`` the item_ids (as
    strings, once each) whose phrases occur.

    The benchmark goes to the tasks in blocks of about ``block_bytes``; each is one pass over the rows,
    chained without a shuffle.  A task cuts its texts into shards, and each shard gets an FM-index over
    the words that the benchmark has at all; every phrase of the block is searched in it backwards
    at the same time.  Null or wordless texts and items give no hits; an item without an id hits without
    being named.  Words are told apart by 64-bit hashes.
    """
    clash = {"n_words", "hits", "found"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    out = docs.withColumns({
        "n_words": F.lit(0).cast("long"), "hits": F.array().cast("array<struct<first:int,last:int>>"),
        "found": F.array().cast("array<string>"),
    })
    for block in _blocks(items, block_bytes):
        phrases = Phrases([r[1] for r in block], window)
        out = small_batches(out).mapInArrow(_scan(phrases, [r[0] for r in block], out.columns), out.schema)
    return out.withColumn("found", F.array_sort(F.array_distinct("found")))


def _without(schema_names: list[str]):
    def run(batches):
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(schema_names.index("text")))
            spans = batch.column(schema_names.index("hits"))
            texts = []
            for k in range(batch.num_rows):
                text = data[offsets[k]: offsets[k + 1]]
                hit = spans[k].as_py()
                if hit:
                    starts, ends = words.spans(text, np.array([0, len(text)]), words.LETTERS)
                    keep = np.ones(len(text), bool)
                    for h in hit:
                        keep[starts[h["first"]]: ends[h["last"]]] = False
                    texts.append(text[keep].tobytes().decode())
                else:
                    texts.append(batch.column(schema_names.index("text"))[k].as_py())
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(k) for k, c in enumerate(schema_names)]
            yield pa.RecordBatch.from_arrays(columns, schema_names)

    return run


def remove_spans(found: DataFrame) -> DataFrame:
    """The documents of ``contaminated_words`` with the merged hit ranges cut out of their texts."""
    return small_batches(found).mapInArrow(_without(found.columns), found.schema).drop("n_words", "hits", "found")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no phrase of the benchmark occurs; all columns stay."""
    return contaminated_words(docs, items, window).where(F.size("hits") == 0).select(*docs.columns)
