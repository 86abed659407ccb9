"""Masked pseudo-likelihood: a window network predicts every word from both sides, and documents get the sum."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm import words
from feedkit.llm.stored import Scratch, small_batches

# Frequent words with a symbol of their own, groups of all other words, words on each side, sizes of the layers.
FREQUENT, GROUPS, SIDE = 224, 32, 2
EMBED, HIDDEN = 12, 24
# Words whose counts travel with the tasks; those of all others are met in a join.
SHIPPED = 1 << 16
BATCH, RATE, FIRST_SQUARE = 1024, 0.05, 1e-7


class Places:
    """Places of words among ascending hashes: by leading bits, then step by step through the few hashes that share them."""

    def __init__(self, hashes: np.ndarray):
        bits = max(4, len(hashes).bit_length() + 1)
        self.hashes, self.shift = np.append(hashes, ~np.uint64(0)), np.uint64(64 - bits)
        bounds = np.searchsorted(hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.first, self.most = bounds[:-1], int(np.diff(bounds).max())

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether the word is there) of each word."""
        at = self.first[words >> self.shift]
        for _ in range(self.most - 1):
            at += self.hashes[at] < words
        return at, (self.hashes[at] == words) & (at < len(self.hashes) - 1)


@dataclass
class Symbols:
    """Frequent words by hash, ascending, then groups of all others.

    ``log_words``: log of the number of words of each symbol; ``log_share``: log of its share of the text;
    ``log_used``: log of one more than the occurrences of its words.  ``known`` are the most used words of the groups,
    ascending, with their log of occurrences ``log_known``; ``counts(word, n)`` has every word of the text and stays a table.
    """

    frequent: np.ndarray
    log_words: np.ndarray
    log_share: np.ndarray
    log_used: np.ndarray
    known: np.ndarray
    log_known: np.ndarray
    counts: DataFrame

    def __getstate__(self):
        """Tasks get the arrays only."""
        return {**self.__dict__, "counts": None}

    @property
    def size(self) -> int:
        return len(self.log_words)

    @cached_property
    def _frequent_places(self) -> Places:
        return Places(self.frequent)

    @cached_property
    def _known_places(self) -> Places:
        return Places(self.known)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = (self.size - GROUPS + (hashes >> np.uint64(1)) % np.uint64(GROUPS).astype(np.uint64)).astype(np.int64)
        at, met = self._frequent_places.find(hashes)
        return np.where(met, at, out)

    def log_within(self, hashes: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log p(word | its symbol ``found``) of each word, 0 where only the table ``counts`` tells it; and where that is."""
        out = np.zeros(len(hashes))
        rest = np.flatnonzero(found >= len(self.frequent))
        at, met = self._known_places.find(hashes[rest])
        out[rest[met]] = self.log_known[at[met]] - self.log_used[found[rest[met]]]
        rare = np.zeros(len(hashes), bool)
        rare[rest[~met]] = True
        return out, rare


def _text_words(batches):
    for batch in batches:
        data, offsets = words.text_bytes(batch.column(0))
        for low, high in words.pieces(offsets):
            _, _, hashes, _ = words.hashed_words(data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low], words.LETTERS)
            word, count = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count.astype(np.int64))], ["word", "n"])


def learn_symbols(docs: DataFrame) -> Symbols:
    """Counts of all words of ``docs(text)``; the driver gets the ``SHIPPED`` most frequent and one row per group.  Runs at once.

    The counts of all words are written once; what a word adds to a score is its own count, however rare it is.
    """
    counts = small_batches(docs).select("text").mapInArrow(_text_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = Scratch(docs.sparkSession, "vocabulary").write(counts)
    top = counts.orderBy(F.desc("n"), "word").limit(SHIPPED).toArrow()
    hashes, often = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy().astype(np.float64)
    order = np.argsort(hashes[:FREQUENT])
    frequent, own = hashes[:FREQUENT][order], often[:FREQUENT][order]
    others = FREQUENT + np.argsort(hashes[FREQUENT:])
    group = _group().alias("g")
    kinds, used = np.zeros(GROUPS), np.zeros(GROUPS)
    for r in counts.groupBy(group).agg(F.count("*").alias("c"), F.sum("n").alias("n")).collect():
        kinds[r["g"]], used[r["g"]] = r["c"], r["n"]
    for h, n in zip(frequent, own):
        kinds[int(h >> np.uint64(1)) % GROUPS] -= 1
        used[int(h >> np.uint64(1)) % GROUPS] -= n
    share = np.concatenate([own, np.maximum(used, 0)]) + 1
    return Symbols(
        frequent, np.log(np.concatenate([np.ones(len(frequent)), np.maximum(kinds, 1)])), np.log(share / share.sum()),
        np.log(share), hashes[others], np.log(often[others]), counts)


def _group():
    return F.pmod(F.shiftrightunsigned("word", 1), F.lit(GROUPS))


class Network:
    """Embeddings of the words around, one hidden layer, a softmax over all symbols.  All parameters in one array."""

    def __init__(self, symbols: int, values: np.ndarray | None = None, bias: np.ndarray | None = None):
        self.symbols = symbols
        shapes = [(symbols + 1, EMBED), (2 * SIDE * EMBED, HIDDEN), (HIDDEN,), (HIDDEN, symbols), (symbols,)]
        sizes = [int(np.prod(s)) for s in shapes]
        if values is None:
            rng = np.random.default_rng(7)
            values = np.concatenate([rng.normal(0, 0.1, n) if len(s) > 1 else np.zeros(n) for n, s in zip(sizes, shapes)])
            values[-symbols:] = 0 if bias is None else bias
        self.values = values.astype(np.float32)
        at = np.concatenate([[0], np.cumsum(sizes)])
        self.parts = [self.values[a:b].reshape(s) for a, b, s in zip(at[:-1], at[1:], shapes)]
        self.bounds, self.shapes = at, shapes
        self.cells = np.arange(sizes[0]).reshape(shapes[0])
        self.rows, self.room = 0, []

    def _room(self, rows: int) -> list[np.ndarray]:
        """Arrays to work in: hidden layer, all symbols, hidden errors, slopes, input errors.  Kept, so that no step asks for new memory."""
        if self.rows < rows:
            widths = (HIDDEN, self.symbols, HIDDEN, HIDDEN, 2 * SIDE * EMBED)
            self.rows, self.room = rows, [np.empty((rows, w), np.float32) for w in widths]
        return [r[:rows] for r in self.room]

    def _forward(self, around: np.ndarray):
        embed, w1, b1, w2, b2 = self.parts
        x = embed.take(around, axis=0).reshape(len(around), -1)
        h, z, _, _, _ = self._room(len(around))
        np.matmul(x, w1, out=h)
        h += b1
        np.tanh(h, out=h)
        np.matmul(h, w2, out=z)
        z += b2
        z -= z.max(axis=1, keepdims=True)
        return x, h, z

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log p(target | words around) of each row."""
        _, _, z = self._forward(around)
        chosen = z[np.arange(len(target)), target]
        return chosen - np.log(np.exp(z, out=z).sum(axis=1))

    def step(self, around: np.ndarray, target: np.ndarray, squares: np.ndarray, rate: float) -> None:
        """One descent step with Adagrad's scales."""
        embed, w1, _, w2, _ = self.parts
        x, h, z = self._forward(around)
        _, _, dh, slope, dx = self._room(len(around))
        p = np.exp(z, out=z)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(target)), target] -= 1
        p /= len(target)
        np.matmul(p, w2.T, out=dh)
        np.subtract(1, np.multiply(h, h, out=slope), out=slope)
        dh *= slope
        np.matmul(dh, w1.T, out=dx)
        d_embed = np.zeros(embed.size, np.float32)
        np.add.at(d_embed, self.cells.take(around, axis=0).ravel(), dx.ravel())
        gradient = np.concatenate([d_embed, (x.T @ dh).ravel(), dh.sum(axis=0), (h.T @ p).ravel(), p.sum(axis=0)])
        squares += gradient * gradient
        self.values -= rate * gradient / (np.sqrt(squares) + 1e-6)


def windows(symbols: np.ndarray, word_at: np.ndarray, edge: int) -> np.ndarray:
    """The symbols on both sides of each word; ``edge`` stands beyond the ends of a text."""
    n = len(symbols)
    out = np.empty((n, 2 * SIDE), np.int64)
    for k in range(1, SIDE + 1):
        before, after = out[:, SIDE - k], out[:, SIDE + k - 1]
        before[k:], after[:-k] = symbols[:-k], symbols[k:]
        first = (word_at[:, None] + np.arange(k)).ravel()
        before[first[first < n]] = edge
        last = (word_at[:, None] - np.arange(1, k + 1)).ravel()
        after[last[last >= 0]] = edge
    return out


def _pieces_of_words(symbols: Symbols, column: pa.Array):
    """(texts low to high, symbols, word offsets, hashes of the words) of bounded pieces."""
    data, offsets = words.text_bytes(column)
    for low, high in words.pieces(offsets):
        _, _, hashes, word_at = words.hashed_words(data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low], words.LETTERS)
        yield low, high, symbols.of(hashes), word_at, hashes


def _train(symbols: Symbols, start: np.ndarray, rate: float):
    def run(batches):
        net = Network(symbols.size, start)
        squares = np.full(len(net.values), FIRST_SQUARE, np.float32)
        seen = 0
        for batch in batches:
            for _, _, found, word_at, _ in _pieces_of_words(symbols, batch.column(0)):
                around = windows(found, word_at, symbols.size)
                for low in range(0, len(found), BATCH):
                    net.step(around[low: low + BATCH], found[low: low + BATCH], squares, rate)
                seen += len(found)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen], pa.int64()), pa.array([net.values.astype(np.float64)], pa.list_(pa.float64()))], ["seen", "values"])

    return run


def train(docs: DataFrame, symbols: Symbols, rounds: int = 1, rate: float = RATE) -> Network:
    """Fit the network on every word of ``docs(text)``.  Runs at once.

    In a round every task starts from the common parameters, learns from all words of its rows, and
    gives its parameters and its number of words; their weighted mean, summed by parameter over the
    cluster, is the next common state.  The driver holds one network of fixed size.
    """
    net = Network(symbols.size, bias=symbols.log_share)
    for _ in range(rounds):
        made = docs.select("text").mapInArrow(_train(symbols, net.values, rate), "seen long, values array<double>")
        flat = made.select("seen", F.posexplode("values").alias("place", "value"))
        mean = flat.groupBy("place").agg((F.sum(F.col("value") * F.col("seen")) / F.sum("seen")).alias("value"))
        rows = mean.orderBy("place").toArrow()
        if rows.num_rows:
            net = Network(symbols.size, rows["value"].to_numpy())
    return net


def _score(symbols: Symbols, values: np.ndarray, names: list[str]):
    """Sums of all words but the rare ones, whose number follows; a text without them needs no sum and gets any ``_text``."""

    def run(batches):
        net = Network(symbols.size, values)
        for batch in batches:
            for low, high, found, word_at, hashes in _pieces_of_words(symbols, batch.column(names.index("text"))):
                around = windows(found, word_at, symbols.size)
                each = np.empty(len(found))
                for a in range(0, len(found), BATCH):
                    each[a: a + BATCH] = net.log_probability(around[a: a + BATCH], found[a: a + BATCH])
                within, rare = symbols.log_within(hashes, found)
                doc = np.repeat(np.arange(high - low), np.diff(word_at))
                total = np.bincount(doc, weights=each + within, minlength=high - low)
                n_rare = np.bincount(doc[rare], minlength=high - low)
                part = batch.slice(low, high - low)
                at = names.index("_text")
                text = np.where(n_rare > 0, part.column(at).to_numpy(), np.arange(low, high))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(text, pa.int64()), *part.columns[at + 1:],
                     pa.array(np.diff(word_at), pa.int64()), pa.array(total, pa.float64()), pa.array(n_rare, pa.int64())],
                    [*names, "n_words", "log_likelihood", "_rare"])

    return run


def _rare_words(symbols: Symbols):
    """Each text's words that are not ``known``, and how often they come."""

    def run(batches):
        for batch in batches:
            for low, high, found, word_at, hashes in _pieces_of_words(symbols, batch.column(2)):
                _, rare = symbols.log_within(hashes, found)
                doc, word = np.repeat(np.arange(high - low), np.diff(word_at))[rare], hashes[rare]
                order = np.lexsort((word, doc))
                doc, word = doc[order], word[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(word)))
                key = batch.slice(low, high - low).select([0, 1]).take(pa.array(doc[first]))
                yield pa.RecordBatch.from_arrays([*key.columns, pa.array(word[first].view(np.int64)), pa.array(count, pa.int64())],
                                                 ["_text", "_check", "word", "times"])

    return run


def score(docs: DataFrame, symbols: Symbols, net: Network) -> DataFrame:
    """``docs`` with ``n_words`` and ``log_likelihood``, the sum over all words of log p(word | both sides).

    A word's probability is that of its symbol times the word's share of the symbol's occurrences in the text learned from;
    a word that did not occur there counts as one more occurrence.  Null and wordless texts have 0 words and the sum 0.

    Shares of the ``SHIPPED`` most used words are looked up in the tasks.  All others meet the table of counts in a join, in
    which none of them is frequent, and their sums meet the texts by two 64-bit hashes of the text; a text that
    comes more than once has the mean of its copies, which are equal.
    """
    taken = {"n_words", "log_likelihood", "_text", "_check", "_rare"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    marked = docs.withColumns({"_text": F.xxhash64("text"), "_check": F.xxhash64(F.lit(1), "text")})
    schema = marked.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0.0).alias("log_likelihood"), F.lit(0).cast("long").alias("_rare")).schema
    scored = small_batches(marked).mapInArrow(_score(symbols, net.values, marked.columns), schema)
    rare = marked.select("_text", "_check", "text").mapInArrow(_rare_words(symbols), "_text long, _check long, word long, times long")
    used = F.array(*[F.lit(float(v)) for v in symbols.log_used[-GROUPS:]])
    within = F.ln(F.coalesce("n", F.lit(1)).cast("double")) - F.get(used, _group().cast("int"))
    sums = rare.join(symbols.counts, "word", "left").groupBy("_text", "_check").agg(
        (F.sum(F.col("times") * within) / F.sum("times")).alias("_mean"))
    total = F.col("log_likelihood") + F.when(F.col("_rare") > 0, F.col("_rare") * F.col("_mean")).otherwise(0.0)
    return scored.join(sums, ["_text", "_check"], "left").select(*docs.columns, "n_words", total.alias("log_likelihood"))
