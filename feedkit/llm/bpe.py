"""Byte-pair encoding of whole texts with a fixed vocabulary file, as numpy merge rounds over many words."""

from __future__ import annotations

import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm import words
from feedkit.llm.stored import small_batches

# Words that a task remembers before it starts a new memory.
MEMORY_WORDS = 200_000
END = "</w>"
_FAR = np.int64(1 << 62)


def _number_marks() -> str:
    """Characters of category N that are not decimal digits."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1))
                   if unicodedata.category(c) in ("No", "Nl"))


class Splitter:
    """Contractions, runs of letters, single numbers, runs of anything else but white space.

    Three patterns for the same rule: ASCII texts, texts whose numbers are decimal digits, all texts.
    """

    def __init__(self, numbers: str):
        other = re.escape(numbers)
        space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
        short = "'s|'t|'re|'ve|'m|'ll|'d"
        rest = rf"(?:[^\w{space}]|_)+"
        self.ascii = re.compile(rf"[a-z]+|{short}|[0-9]|[^a-z0-9\t-\r ]+").findall
        self.usual = re.compile(rf"[^\W\d_]+|{short}|\d|{rest}").findall
        self.full = re.compile(rf"[^\W\d_{other}]+|{short}|[\d{other}]|{rest}").findall
        self.usual_only = frozenset(numbers).isdisjoint

    def __call__(self, text: str) -> list[str]:
        """Words of a normalized text."""
        if text.isascii():
            return self.ascii(text)
        return self.usual(text) if self.usual_only(text) else self.full(text)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary's tokens."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class WordBpe:
    """Vocabulary and merges of a tokenizer file, as arrays.  The driver reads the file, tasks get the arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END:
            raise ValueError(f"{path} is no word BPE with {END}")
        vocab: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(*vocab.values(), *added.values()) + 1
        self.tokens = [""] * size
        for text, k in [*vocab.items(), *added.items()]:
            self.tokens[k] = text
        self.special, self.numbers = added, _number_marks()
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + END] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # a pair that is listed twice has its later rank
        order = np.lexsort((-np.arange(len(keys)), keys))
        order = order[np.concatenate([[True], np.diff(keys[order]) > 0])] if len(order) else order
        self.size, self.keys, self.ranks, self.made = size, keys[order], order.astype(np.int64), made[order]

    def merge_words(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in one array, and where each word begins and the last one ends.

        The symbols of all words stand in one array.  In a round every adjacent pair is looked up by
        binary search in the sorted pair keys; in each word the pairs of its lowest rank merge, from the
        left where they overlap.  Words without a known pair leave the array.
        """
        raw = [w.encode("utf-8") for w in new]
        sizes = np.array([len(b) for b in raw], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self.inner[data]
        symbol[ends - 1] = self.final[data[ends - 1]]
        home = np.repeat(np.arange(len(new)), sizes)
        done_symbol, done_home = [], []
        while len(symbol):
            inside = np.zeros(len(symbol), bool)
            inside[:-1] = home[1:] == home[:-1]
            key = symbol * self.size
            key[:-1] += symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = inside & (self.keys[at] == key)
            rank = np.where(known, self.ranks[at], _FAR)
            first = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]]))
            least = np.minimum.reduceat(rank, first)
            spread = np.repeat(least, np.diff(np.append(first, len(symbol))))
            ended = spread == _FAR
            if ended.any():
                done_symbol.append(symbol[ended])
                done_home.append(home[ended])
            chosen = known & (rank == spread)
            begin = chosen.copy()
            begin[1:] &= ~chosen[:-1]
            place = np.arange(len(symbol))
            chosen &= (place - np.maximum.accumulate(np.where(begin, place, 0))) % 2 == 0
            symbol = np.where(chosen, self.made[at], symbol)
            stay = ~ended
            stay[1:] &= ~chosen[:-1]
            symbol, home = symbol[stay], home[stay]
        if not done_home:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        home = np.concatenate(done_home)
        order = np.argsort(home, kind="stable")
        return (np.concatenate(done_symbol)[order].astype(np.int32),
                np.searchsorted(home[order], np.arange(len(new) + 1)))


def normalized(text: str) -> str:
    """NFC and lower case, character by character (a final sigma is no special case)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class _Memory:
    """Token ids of words met before."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.ids, self.at, self.used = [np.zeros(0, np.int32)], [0], 0
        for text, k in self.bpe.special.items():
            self._append([text], np.array([k], np.int32), np.array([0, 1]))
        self.flat = None

    def _append(self, new, ids, at):
        base = len(self.place)
        for k, w in enumerate(new):
            self.place[w] = base + k
        self.at.extend((at[1:] + self.used).tolist())
        self.ids.append(ids)
        self.used += len(ids)
        self.flat = None

    def learn(self, seen: list[str]):
        new = sorted(set(seen).difference(self.place))
        if len(new) + len(self.place) > MEMORY_WORDS and len(self.place) > len(self.bpe.special):
            self.clear()
            new = sorted(set(seen).difference(self.place))
        if new:
            ids, at = self.bpe.merge_words(new)
            self._append(new, ids, at)

    def tokens(self, seen: list[str], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and their offsets; a text is the next ``counts`` words."""
        self.learn(seen)
        if self.flat is None:
            self.flat, self.bounds = np.concatenate(self.ids), np.array(self.at, np.int64)
            self.ids = [self.flat]
        word = np.fromiter(map(self.place.__getitem__, seen), np.int64, len(seen))
        size = self.bounds[word + 1] - self.bounds[word]
        total = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(self.bounds[word] - total[:-1], size) + np.arange(total[-1])
        return self.flat[source], total[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]


def _encode(bpe: WordBpe, names: list[str], column: str):
    def run(batches):
        memory, find = _Memory(bpe), Splitter(bpe.numbers)
        special = re.compile("(" + "|".join(map(re.escape, bpe.special)) + ")") if bpe.special else None

        def words_of(text: str) -> list[str]:
            if special is None or not special.search(text):
                return find(normalized(text))
            out = []
            for k, part in enumerate(special.split(text)):
                out += [part] if k % 2 else find(normalized(part))
            return out

        for batch in batches:
            texts = batch.column(names.index(column))
            _, offsets = words.text_bytes(texts)
            for low, high in words.pieces(offsets):
                seen, counts = [], []
                for text in texts.slice(low, high - low).to_pylist():
                    found = words_of(text) if text else []
                    seen += found
                    counts.append(len(found))
                ids, at = memory.tokens(seen, counts)
                made = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.slice(low, high - low).columns, made], [*names, "ids"])

    return run


def encode(docs: DataFrame, bpe: WordBpe, column: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the tokens of the whole text in ``column``; null and empty texts have none.

    As the public tokenizers library encodes without added special tokens: the special strings
    themselves, where they stand in a text, are one token each.  A task works piece by piece, of a bounded
    number of bytes or one text, and remembers the words it has met up to a fixed number.
    """
    if "ids" in docs.columns:
        raise ValueError("column ids is taken")
    schema = docs.select("*", F.array().cast("array<int>").alias("ids")).schema
    return small_batches(docs).mapInArrow(_encode(bpe, docs.columns, column), schema)


def _decode(tokens: list[str], names: list[str], column: str):
    def run(batches):
        known = pa.array(tokens, pa.string())
        for batch in batches:
            lists = batch.column(names.index(column))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(sizes)])
            flat = lists.flatten()
            for low, high in words.pieces(at, 1 << 19):
                texts = known.take(flat.slice(at[low], at[high] - at[low]))
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(at[low: high + 1] - at[low], pa.int32()), texts), " ")
                yield pa.RecordBatch.from_arrays([*batch.slice(low, high - low).columns, joined], [*names, "decoded"])

    return run


def decode(encoded: DataFrame, bpe: WordBpe, column: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the tokens of ``column`` with one space between them.

    The file names no decoder, so word ends stay visible and bytes stand as their letters, as in
    the library.  ``plain_text`` turns such a text back into words.  A null list decodes to ''.
    """
    if "decoded" in encoded.columns:
        raise ValueError("column decoded is taken")
    schema = encoded.select("*", F.lit("").alias("decoded")).schema
    return small_batches(encoded).mapInArrow(_decode(bpe.tokens, encoded.columns, column), schema)


def encode_and_decode(docs: DataFrame, bpe: WordBpe, column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``: both steps in one pass of one Python worker, piece by piece."""
    taken = {"ids", "decoded"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    schema = docs.select("*", F.array().cast("array<int>").alias("ids"), F.lit("").alias("decoded")).schema
    there, back = _encode(bpe, docs.columns, column), _decode(bpe.tokens, [*docs.columns, "ids"], "ids")
    return small_batches(docs).mapInArrow(lambda batches: back(there(batches)), schema)


def plain_text(decoded: str) -> str:
    """The normalized words of a decoded text, one space after each word but the last."""
    back = {c: b for b, c in enumerate(byte_letters())}
    parts = decoded.replace(" ", "").split(END)
    return " ".join(bytes(back[c] for c in p).decode("utf-8", "replace") for p in parts if p)
