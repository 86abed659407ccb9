"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

A shard holds a bounded number of documents: their postings of the terms asked for and, for chosen pairs of terms, the
list of documents that hold both with the joint impact of the two.  No document can take more from a pair than its
greatest joint impact or, without both terms, than the greater of their own.  That is less than the sum of two
independent maxima, so more terms fall below the score that a document must reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm import words
from feedkit.llm.stored import Scratch, small_batches

# A shard is closed at so many documents or postings.
SHARD_DOCS = 1024
SHARD_POSTINGS = 1 << 17
# Pairs of item and term that one pass over the documents takes, the terms of one item excepted.
BLOCK_TERMS = 1 << 19
# Shards are written in pages of one or two: the writer would else gather a hundred rows before it looks at their size.
PAGES = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false", "parquet.block.size": str(32 << 20)}


# words of whole texts


def _windows(data: np.ndarray, size: int) -> Iterator[tuple[int, int, bool]]:
    """Cuts of one text between words; True marks one word that is longer than a window."""
    low = 0
    while low < len(data):
        high = min(low + size, len(data))
        if high < len(data) and words.LETTERS[data[high - 1]] and words.LETTERS[data[high]]:
            gaps = np.flatnonzero(~words.LETTERS[data[low:high]])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
            else:
                while high < len(data) and words.LETTERS[data[high: high + size]].all():
                    high = min(high + size, len(data))
                if high < len(data):
                    high += int(np.argmin(words.LETTERS[data[high: high + size]]))
                yield low, high, True
                low = high
                continue
        yield low, high, False
        low = high


def term_hashes(data: np.ndarray, offsets: np.ndarray, longest: int):
    """(number of words of each text, text of each word, hash of each word); words of more than ``longest`` bytes are only counted.

    Texts of one piece go together; one longer text goes in windows, so memory follows the window and not the text.
    """
    n_docs = len(offsets) - 1
    size = max(words.WINDOW_BYTES, 2 * longest)
    if n_docs != 1 or len(data) <= size:
        starts, ends = words.spans(data, offsets, words.LETTERS)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        counts = np.bincount(doc, minlength=n_docs)
        fits = ends - starts <= longest
        return counts, doc[fits], words.word_hashes(data, starts[fits], ends[fits])
    count, hashes = 0, []
    for low, high, single in _windows(data, size):
        if single:
            count += 1
            continue
        part, _, found = term_hashes(data[low:high], np.array([0, high - low]), longest)
        count += int(part[0])
        hashes.append(found)
    found = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return np.array([count]), np.zeros(len(found), np.int64), found


def _item_terms(names: list[str], item: str, column: str):
    def run(batches):
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(names.index(column)))
            for low, high in words.pieces(offsets):
                at = offsets[low: high + 1]
                piece = data[at[0]: at[-1]]
                starts, ends = words.spans(piece, at - at[0], words.LETTERS)
                doc = np.searchsorted(at - at[0], starts, side="right") - 1
                hashes = words.word_hashes(piece, starts, ends).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(names.index(item)).take(pa.array(doc + low)), pa.array(hashes), pa.array(ends - starts, pa.int64())],
                    ["item", "term", "size"])

    return run


def query_blocks(items: DataFrame, item: str, column: str, scratch: Scratch, most: int = BLOCK_TERMS) -> Iterator[list[tuple]]:
    """Blocks of (item, [(term, bytes), ...]); rows of one item are one item, the terms of which count once each.

    The driver holds one block at a time: ``most`` pairs of item and term, or the terms of a single larger item.
    """
    pair = items.select(item, column)
    schema = T.StructType([T.StructField("item", pair.schema[item].dataType), T.StructField("term", T.LongType()), T.StructField("size", T.LongType())])
    found = small_batches(pair).mapInArrow(_item_terms(pair.columns, item, column), schema)
    stored = scratch.write(found.groupBy("item", "term").agg(F.max("size").alias("size")))
    block, held, last = [], 0, object()
    for row in stored.sort("item", "term").toLocalIterator():
        if not block or row["item"] != last:
            if held >= most:
                yield block
                block, held = [], 0
            block.append((row["item"], []))
            last = row["item"]
        block[-1][1].append((row["term"], row["size"]))
        held += 1
    if block:
        yield block


# postings, shard by shard

POSTING_LISTS = {"length": np.int64, "term": np.int32, "first": np.int32, "place": np.int32, "tf": np.int32}
PAIR_LISTS = {"impact": np.int64, "pair": np.int32, "pair_first": np.int32, "pair_place": np.int32, "joint": np.int64}
SHARD_LISTS = {c: POSTING_LISTS[c] for c in ("length", "term", "first", "place")}
COUNTED = "shard binary, n long, words long, term array<int>, df array<int>"


def _packed(ids: pa.Array, values: dict[str, np.ndarray], kinds: dict[str, type]) -> bytes:
    """A shard as one value, which the JVM only passes on: an Arrow stream of one row of lists."""
    lists = [ids, *[pa.array(values[c].astype(k)) for c, k in kinds.items()]]
    rows = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in lists]
    row = pa.RecordBatch.from_arrays(rows, ["id", *kinds])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema) as out:
        out.write_batch(row)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: pa.Scalar) -> tuple[pa.Array, dict[str, np.ndarray]]:
    """The ids and the lists of a packed shard."""
    with pa.ipc.open_stream(blob.as_buffer()) as source:
        row = source.read_next_batch()
    lists = {c: row.column(i)[0].values.to_numpy(zero_copy_only=False).astype(np.int64) for i, c in enumerate(row.schema.names) if c != "id"}
    return row.column(0)[0].values, lists


def _postings(names: list[str], key: str, column: str, vocabulary: np.ndarray, longest: int):
    """One row for each shard: its documents with their lengths, and the postings of the vocabulary by term and document."""

    def shard(ids: list, lengths: list, held: list) -> pa.RecordBatch:
        term, place, tf = (np.concatenate([h[k] for h in held]) for k in range(3))
        order = np.lexsort((place, term))
        term, place, tf = term[order], place[order], tf[order]
        terms, first = np.unique(term, return_index=True)
        values = {"length": np.concatenate(lengths), "term": terms, "first": np.append(first, len(term)), "place": place, "tf": tf}
        blob = _packed(pa.concat_arrays(ids), values, POSTING_LISTS)
        counted = [[blob], [int((values["length"] > 0).sum())], [int(values["length"].sum())], [terms], [np.diff(values["first"])]]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(counted, kinds)], ["shard", "n", "words", "term", "df"])

    def run(batches):
        ids, lengths, held, docs, size = [], [], [], 0, 0
        for batch in batches:
            keys = batch.column(names.index(key))
            data, offsets = words.text_bytes(batch.column(names.index(column)))
            for low, high in words.pieces(offsets):
                at = offsets[low: high + 1]
                counts, doc, hashes = term_hashes(data[at[0]: at[-1]], at - at[0], longest)
                spot = np.searchsorted(vocabulary, hashes)
                known = (spot < len(vocabulary)) & (vocabulary[np.minimum(spot, len(vocabulary) - 1)] == hashes)
                pair, tf = np.unique(doc[known] * len(vocabulary) + spot[known], return_counts=True)
                held.append((pair % len(vocabulary), docs + pair // len(vocabulary), tf))
                ids.append(keys.slice(low, high - low))
                lengths.append(counts)
                docs, size = docs + high - low, size + len(pair)
                if docs >= SHARD_DOCS or size >= SHARD_POSTINGS:
                    yield shard(ids, lengths, held)
                    ids, lengths, held, docs, size = [], [], [], 0, 0
        if docs:
            yield shard(ids, lengths, held)

    return run


def postings(docs: DataFrame, key: str, column: str, vocabulary: np.ndarray, longest: int) -> DataFrame:
    """The packed shards of ``docs``, each with its documents that have terms, its terms, and its documents of each term.

    In a shard, term k has the postings first[k] to first[k + 1].
    """
    return small_batches(docs.select(key, column)).mapInArrow(_postings([key, column], key, column, vocabulary, longest), COUNTED)


# impacts and pairs


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def pair_lists(rows: dict[str, np.ndarray], weights: np.ndarray, pairs: np.ndarray, n: int, words_in_all: int) -> dict[str, np.ndarray]:
    """Impacts of a shard's postings, and the intersection list of each of ``pairs`` (two terms a row) with its joint impacts."""
    length, term, first, place, tf = (rows[c] for c in ("length", "term", "first", "place", "tf"))
    m = 10 + (90 * length * n) // max(words_in_all, 1)
    impact = np.repeat(weights[term], np.diff(first)) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[place])) if len(tf) else tf
    there = np.full(len(weights), -1)
    there[term] = np.arange(len(term))
    slot = np.full(len(length), -1)
    number, places, joint, sizes = [], [], [], []
    for k in np.flatnonzero((there[pairs] >= 0).all(axis=1)) if len(pairs) else []:
        a, b = there[pairs[k]]
        one, two = slice(first[a], first[a + 1]), slice(first[b], first[b + 1])
        slot[place[one]] = np.arange(first[a], first[a + 1])
        at = slot[place[two]]
        slot[place[one]] = -1
        both = at >= 0
        if both.any():
            number.append(k)
            places.append(place[two][both])
            joint.append(impact[two][both] + impact[at[both]])
            sizes.append(int(both.sum()))
    none = np.zeros(0, np.int64)
    return {"impact": impact, "pair": np.array(number, np.int64), "pair_first": np.cumsum([0, *sizes]),
            "pair_place": np.concatenate(places) if places else none, "joint": np.concatenate(joint) if joint else none}


def _index(weights: np.ndarray, pairs: np.ndarray, n: int, words_in_all: int):
    def run(batches):
        for batch in batches:
            for blob in batch.column(0):
                ids, have = _unpacked(blob)
                have |= pair_lists(have, weights, pairs, n, words_in_all)
                yield pa.RecordBatch.from_arrays([pa.array([_packed(ids, have, SHARD_LISTS | PAIR_LISTS)], pa.binary())], ["shard"])

    return run


# search


class Shard:
    """The postings and pair lists of one shard, asked item by item."""

    def __init__(self, lists: dict[str, np.ndarray], n_terms: int, n_pairs: int, k: int):
        self.lists, self.size = lists, len(lists["length"])
        self.term = np.full(n_terms, -1)
        self.term[lists["term"]] = np.arange(len(lists["term"]))
        self.pair = np.full(n_pairs, -1)
        self.pair[lists["pair"]] = np.arange(len(lists["pair"]))
        self.most, self.kth = self._tops(lists["impact"], lists["first"], k)
        self.joint_most, self.joint_kth = self._tops(lists["joint"], lists["pair_first"], k)
        self.touched = self.looked_up = 0

    @staticmethod
    def _tops(values: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The greatest and the k-th greatest value of each list; 0 where there is none."""
        most = np.maximum.reduceat(values, first[:-1]) if len(values) else np.zeros(len(first) - 1, np.int64)
        kth = np.zeros(len(first) - 1, np.int64)
        for i in np.flatnonzero(np.diff(first) >= k):
            part = values[first[i]: first[i + 1]]
            kth[i] = np.partition(part, len(part) - k)[len(part) - k]
        return most, kth

    def _most_of(self, t: int) -> int:
        return int(self.most[self.term[t]]) if self.term[t] >= 0 else 0

    def _pair_most(self, unit: tuple[int, int, int]) -> int:
        """The most that a document takes from a pair: with both terms the joint maximum, else the greater of their own."""
        i = self.pair[unit[2]]
        return max(self._most_of(unit[0]), self._most_of(unit[1]), int(self.joint_most[i]) if i >= 0 else 0)

    def _reached(self, unit: tuple[int, int, int]) -> int:
        """A score that k documents reach by this unit alone."""
        by_term = [int(self.kth[self.term[t]]) for t in unit[:2] if t >= 0 and self.term[t] >= 0]
        i = self.pair[unit[2]] if unit[2] >= 0 else -1
        return max([0, *by_term, *([int(self.joint_kth[i])] if i >= 0 else [])])

    def _postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        i = self.term[t] if t >= 0 else -1
        if i < 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        here = slice(self.lists["first"][i], self.lists["first"][i + 1])
        return self.lists["place"][here], self.lists["impact"][here]

    def _look_up(self, places: np.ndarray, values: np.ndarray, docs: np.ndarray) -> np.ndarray:
        self.looked_up += len(docs)
        if not len(places):
            return np.zeros(len(docs), np.int64)
        at = np.minimum(np.searchsorted(places, docs), len(places) - 1)
        return np.where(places[at] == docs, values[at], 0)

    def _left_out(self, units: Sequence[tuple[int, int, int]], theta: int) -> list[tuple[int, tuple[int, int, int]]]:
        """Terms that all together cannot reach ``theta``, as (bound, unit): pairs where both terms are among them, single terms else.

        Terms come in the order of their own maxima.  One whose partner is in already adds only what their joint bound
        exceeds the partner's own.
        """
        home = {t: u for u in units for t in u[:2] if t >= 0}
        inside, bound = {}, 0
        for t in sorted(home, key=self._most_of):
            unit = home[t]
            if unit in inside:
                mine = self._pair_most(unit)
                more, whole = mine - inside[unit][0], unit
            else:
                mine = more = self._most_of(t)
                whole = (t, -1, -1)
            if bound + more < theta:
                bound += more
                inside[unit] = mine, whole
        return sorted(inside.values())

    def search(self, units: Sequence[tuple[int, int, int]], theta: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places) that may score ``theta`` or more, with their scores.

        ``units`` are (term, term, pair), disjoint, or (term, -1, -1).  Terms that cannot reach the threshold together make
        no candidate; what is found by the others is looked up in them, the highest bound first.
        """
        theta = max([theta, 1, *[self._reached(u) for u in units]])
        rest = self._left_out(units, theta)
        below = np.cumsum([0, *[bound for bound, _ in rest]])
        skipped = {t for _, unit in rest for t in unit[:2]}
        total = np.zeros(self.size, np.int64)
        for t in (t for u in units for t in u[:2] if t not in skipped):
            places, impacts = self._postings(t)
            total[places] += impacts
            self.touched += len(places)
        docs = np.flatnonzero((total > 0) & (total + below[-1] >= theta))
        scores = total[docs]
        for j in range(len(rest) - 1, -1, -1):
            if not len(docs):
                break
            docs, scores = self._add_unit(rest[j][1], docs, scores, theta - int(below[j]))
        return docs, scores

    def _add_unit(self, unit: tuple[int, int, int], docs: np.ndarray, scores: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """``docs`` that reach ``least`` with what they take from a unit: the joint impact or, without one term, that of the other."""
        taken = np.zeros(len(docs), np.int64)
        i = self.pair[unit[2]] if unit[2] >= 0 else -1
        if i >= 0:
            here = slice(self.lists["pair_first"][i], self.lists["pair_first"][i + 1])
            taken = self._look_up(self.lists["pair_place"][here], self.lists["joint"][here], docs)
        for t in sorted((t for t in unit[:2] if t >= 0), key=self._most_of, reverse=True):
            # a document without the pair has one of its terms at most
            stay = (taken > 0) | (scores + self._most_of(t) >= least)
            docs, scores, taken = docs[stay], scores[stay], taken[stay]
            rest = taken == 0
            taken[rest] = self._look_up(*self._postings(t), docs[rest])
        scores = scores + taken
        stay = scores >= least
        return docs[stay], scores[stay]


def _search(units: list[list[tuple[int, int, int]]], n_terms: int, n_pairs: int, k: int):
    """The ``k`` best of each item among the shards of one task; the k-th score so far is the next shard's threshold."""

    def run(batches):
        best: list[list[tuple]] = [[] for _ in units]
        kind = None
        for batch in batches:
            for blob in batch.column(0):
                ids, lists = _unpacked(blob)
                kind, shard = ids.type, Shard(lists, n_terms, n_pairs, k)
                for item, mine in enumerate(units):
                    theta = -best[item][-1][0] if len(best[item]) == k else 1
                    docs, scores = shard.search(mine, theta)
                    if len(docs) > k:
                        # documents that tie with the k-th stay until their ids are compared
                        stay = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        docs, scores = docs[stay], scores[stay]
                    new = [(-int(s), d is None, d) for s, d in zip(scores, ids.take(pa.array(docs)).to_pylist())]
                    best[item] = sorted(best[item] + new)[:k] if new else best[item]
        if kind is not None:
            rows = [(item, d, -s) for item, found in enumerate(best) for s, _, d in found]
            columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["number", "id", "score"])

    return run


def paired(terms: list[int], weights: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint pairs of neighbours by weight, so that both terms of a pair are about as frequent."""
    by_weight = sorted((t for t in terms if weights[t] > 0), key=lambda t: (weights[t], t))
    return list(zip(by_weight[::2], [*by_weight[1::2], -1][: len(by_weight[::2])]))


def _search_block(docs: DataFrame, key: str, column: str, block: list[tuple], k: int, scratch: Scratch) -> DataFrame:
    """(number of the item, id, score, rank) of one block's items, from one pass over the texts."""
    every = [t for _, terms in block for t in terms]
    vocabulary = np.unique(np.array([t for t, _ in every], np.int64).view(np.uint64))
    longest = max(size for _, size in every)
    found = scratch.write(postings(docs, key, column, vocabulary, longest), **PAGES)
    sums = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    n, words_in_all = sums["n"], sums["words"]
    frequency = np.zeros(len(vocabulary), np.int64)
    held = found.select(F.explode(F.arrays_zip("term", "df")).alias("h"))
    for row in held.groupBy("h.term").agg(F.sum("h.df").alias("df")).toLocalIterator():
        frequency[row["term"]] = row["df"]
    weights = np.array([term_weight(n, int(df)) for df in frequency], np.int64)
    numbers: dict[tuple[int, int], int] = {}
    units = []
    for _, terms in block:
        at = np.searchsorted(vocabulary, np.array([t for t, _ in terms], np.int64).view(np.uint64))
        two = paired(at.tolist(), weights)
        units.append([(a, b, numbers.setdefault((a, b), len(numbers)) if b >= 0 else -1) for a, b in two])
    pairs = np.array(list(numbers), np.int64).reshape(-1, 2)
    index = scratch.write(found.select("shard").mapInArrow(_index(weights, pairs, n, words_in_all), "shard binary"), **PAGES)
    scratch.drop(found)
    out = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("id", docs.schema[key].dataType), T.StructField("score", T.LongType())])
    near = index.mapInArrow(_search(units, len(vocabulary), len(pairs), k), out)
    best_first = [F.desc("score"), F.asc_nulls_last("id")]
    near = near.withColumn("task", F.spark_partition_id() % 64)
    part = Window.partitionBy("number", "task").orderBy(*best_first)
    some = near.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*best_first))).where(F.col("rank") <= k)
    done = scratch.write(ranked.select("number", "id", "score", "rank"))
    scratch.drop(index)
    return done


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item: str = "item_id", column: str = "text",
                  block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item, rank, document, score): the ``k`` documents that score highest for each item, above 0.  Runs at once.

    Terms are the words of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in the whole text, A to Z lower-cased, told apart by
    64-bit hashes.  Of N documents with a term, which have L terms in all, df hold a given one, and its weight is
    ``floor(1000 * ln((2 N + 2) / (2 df + 1)))``.  A document of n terms has ``m = 10 + (90 n N) div L``.  Its score sums
    ``weight * ((10**9 tf) div (1000 tf + 8 m))`` over the item's distinct terms.  Equal scores go by document, nulls last.

    Rows of one item (null is one) are one item with the terms of all of them; an item without terms has no rows.  Null
    and empty texts have no terms; every document row counts, those of a repeated id too.  Other columns play no part.

    Items go in blocks of about ``block_terms`` terms; each block reads the texts once, gathers document frequencies of its own
    terms alone, writes the shards with their pair lists and searches these.  Documents are never gathered: a task
    keeps ``k`` of each item.
    """
    scratch = Scratch(docs.sparkSession, "lexical")
    parts = []
    kind = items.schema[item].dataType
    names = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("item", kind)])
    for block in query_blocks(items, item, column, scratch, block_terms):
        best = _search_block(docs, key, column, block, k, scratch)
        named = docs.sparkSession.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], names)
        parts.append(scratch.write(best.join(named, "number").select(F.col("item").alias(item), "rank", F.col("id").alias(key), "score")))
        scratch.drop(best)
    if not parts:
        none = T.StructType([T.StructField(item, kind), T.StructField("rank", T.IntegerType()), T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], none)
    return docs.sparkSession.read.schema(parts[0].schema).parquet(*[p._scratch for p in parts])
