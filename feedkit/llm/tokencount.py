"""Token counts of whole texts: Arrow batches in, lengths out."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm import words
from feedkit.llm.stored import small_batches

# Bytes of text that one call of the encoder gets; longer texts go in parts.
CALL_BYTES = 1 << 20

# A space with a character on both sides that is no space, where no piece of the vocabulary crosses.
_SAFE_PIECE = re.compile("(?<=[^ ▁]) (?=[^ ▁])")
# For pre-tokenized vocabularies: a space between two plain letters starts a new word.
_SAFE_WORD = re.compile("(?<=[a-z])(?= [a-z])")


class PieceCounter:
    """Counts for a sentencepiece model.  Each part between safe boundaries is encoded once per call."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.encoder.id_to_piece(k) for k in range(self.encoder.vocab_size())]
        # safe only if white space is kept as it is and no piece holds it behind another character
        self.safe = not any("▁" in p.lstrip("▁") for p in pieces) \
            and self.encoder.encode("a b", out_type=str) == self.encoder.encode("a", out_type=str) + self.encoder.encode("b", out_type=str) \
            and len(self.encoder.encode("a  b")) > len(self.encoder.encode("a b"))

    def parts(self, text: str) -> list[str]:
        if not self.safe:
            return [text]
        if "  " in text or "▁" in text or text[:1] == " " or text[-1:] == " ":
            return _SAFE_PIECE.split(text)
        return text.split(" ")

    def lengths(self, parts: list[str]) -> list[int]:
        return [len(x) for x in self.encoder.encode(parts, num_threads=1)]


class WordCounter:
    """Counts for a file of the tokenizers library."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_str(model.decode("utf-8"))
        self.encoder.no_truncation()
        self.encoder.no_padding()

    def parts(self, text: str) -> list[str]:
        if len(text) <= CALL_BYTES // 4:
            return [text]
        cut, out = 0, []
        for found in _SAFE_WORD.finditer(text):
            if found.start() - cut >= CALL_BYTES // 8:
                out.append(text[cut: found.start()])
                cut = found.start()
        return [*out, text[cut:]]

    def lengths(self, parts: list[str]) -> list[int]:
        return [len(x) for x in self.encoder.encode_batch_fast(parts, add_special_tokens=False)]


def _count(model: bytes, kind: type, names: list[str], column: str):
    def run(batches):
        counter = kind(model)
        for batch in batches:
            texts = batch.column(names.index(column))
            _, offsets = words.text_bytes(texts)
            for low, high in words.pieces(offsets, CALL_BYTES):
                number: dict[str, int] = {}
                place, home = [], []
                for k, text in enumerate(texts.slice(low, high - low).to_pylist()):
                    if text:
                        found = counter.parts(text)
                        place += [number.setdefault(p, len(number)) for p in found]
                        home.append((k, len(found)))
                sizes = np.array(counter.lengths(list(number)) if number else [], np.int64)
                doc = np.repeat([k for k, _ in home], [n for _, n in home]).astype(np.int64)
                total = np.bincount(doc, weights=sizes[np.array(place, np.int64)], minlength=high - low).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns, pa.array(np.diff(offsets[low: high + 1]), pa.int64()), pa.array(total, pa.int64())],
                    [*names, "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text in ``column``.

    ``path`` is a ``.model`` file of sentencepiece or a ``.json`` file of tokenizers; the driver reads it and
    its bytes go with the tasks.  No begin, end or added special tokens are counted; special strings inside texts
    are treated as the library does by default.  Null and empty texts have 0 of both.

    Calls of the encoder get texts of about ``CALL_BYTES`` together, so their work is balanced by bytes.  Texts are
    split at boundaries that no token crosses; equal parts of one call are encoded once.
    """
    taken = {"n_bytes", "n_tokens"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    with open(path, "rb") as f:
        model = f.read()
    kind = PieceCounter if path.endswith(".model") else WordCounter
    schema = docs.select("*", F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens")).schema
    return small_batches(docs).mapInArrow(_count(model, kind, docs.columns, column), schema)
