"""Language of a text by blended-spectrum string kernels, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.llm import words
from feedkit.llm.stored import small_batches

# Labelled rows per language that the fit takes at most (least hashes of their ids), and landmarks per language.
FIT_ROWS = 200
LANDMARKS, RIDGE = 40, 1e-3
# A text stays if its language's score is at least this share of 1 / languages (what a text of all languages alike
# gets), or at least FLOOR; 0.5 is a machine that says neither yes nor no.
FLOOR_SHARE, FLOOR = 1.5, 0.4
# Sizes of the n-grams, in bytes of UTF-8, and how they weigh in the kernel.
ORDERS = {1: 0.15, 2: 0.35, 3: 0.5}
UNKNOWN = "und"

_SYMBOLS = 156
_BATCH_BYTES, _BATCH_TEXTS = 1 << 20, 512
# Cells of a dense block of text by n-gram, in the fit and in a batch of texts.
_CELLS = 1 << 24


def _alphabet() -> np.ndarray:
    """Symbol of each byte: letters without case, bytes beyond ASCII one by one, all else as one gap."""
    table = np.zeros(256, np.int32)
    for k in range(26):
        table[ord("a") + k] = table[ord("A") + k] = 1 + k
    table[128:] = 27 + np.arange(128)
    return table


_TABLE = _alphabet()


def gram_codes(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code and text of every n-gram; each text stands between two gaps."""
    sizes = np.diff(offsets)
    n = len(sizes)
    place = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, sizes)
    symbols = np.zeros(len(data) + 2 * n, np.int32)
    symbols[place] = _TABLE[data]
    home = np.repeat(np.arange(n, dtype=np.int32), sizes + 2)
    # a run of gaps is one gap
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0) | (home[1:] != home[:-1])
    symbols, home = symbols[keep], home[keep]
    code = symbols[: len(symbols) - order + 1].copy()
    for k in range(1, order):
        code = code * _SYMBOLS + symbols[k: len(symbols) - order + 1 + k]
    whole = home[: len(code)] == home[order - 1:]
    return code[whole], home[: len(code)][whole]


def _presence(data, offsets, codes: dict[int, np.ndarray], lookup: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each order, which of the known n-grams each text holds (0 or 1)."""
    out = {}
    for order in codes:
        code, home = gram_codes(data, offsets, order)
        at = lookup[order][code]
        there = at >= 0
        flags = np.zeros((len(offsets) - 1, len(codes[order])), np.float32)
        flags[home[there], at[there]] = 1
        out[order] = flags
    return out


def _lookup(codes: np.ndarray, order: int) -> np.ndarray:
    table = np.full(_SYMBOLS**order, -1, np.int32)
    table[codes] = np.arange(len(codes), dtype=np.int32)
    return table


@dataclass
class Model:
    """Kernel machine for ``languages``; ``weights[n]`` folds landmarks, Nyström map and regression.

    A text's kernel row with the landmarks is a sum over n-gram orders of ``presence @ landmark
    presence`` over norms, and its scores are that row times fixed coefficients.  Both products are linear
    in the presence, so they are kept multiplied out: known n-grams x languages.
    """

    languages: list[str]
    codes: dict[int, np.ndarray]
    weights: dict[int, np.ndarray]

    def scorer(self):
        lookup = {n: _lookup(c, n) for n, c in self.codes.items()}

        def score(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
            total = np.zeros((len(offsets) - 1, len(self.languages)))
            for n, flags in _presence(data, offsets, self.codes, lookup).items():
                norm = np.sqrt(np.maximum(flags.sum(axis=1, keepdims=True), 1))
                total += (flags @ self.weights[n]) / norm
            return total

        return score


def fit(texts_codes: list[dict[int, np.ndarray]], labels: list[str]) -> Model:
    """Kernel ridge regression, one language against the rest, on n-gram sets of labelled texts."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], {}, {})
    n = len(labels)
    # landmarks: the first of every language
    turn = {x: 0 for x in languages}
    rank = []
    for x in labels:
        rank.append(turn[x])
        turn[x] += 1
    marks = np.array([k for k in range(n) if rank[k] < LANDMARKS])
    kernel, codes = np.zeros((n, len(marks))), {}
    for order, weight in ORDERS.items():
        codes[order] = np.unique(np.concatenate([texts_codes[k][order] for k in marks]))
        there, norm = _known(texts_codes, codes[order], order)
        # n-grams in blocks, so that no dense table of texts by all n-grams is held
        for low, high, flags in _flag_blocks(there, n, len(codes[order])):
            kernel += (flags @ flags[marks].T) * (weight / (norm[:, None] * norm[None, marks]))
    among = kernel[marks]
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    place = {x: k for k, x in enumerate(languages)}
    target = np.full((n, len(languages)), -1.0)
    target[np.arange(n), [place[x] for x in labels]] = 1
    features = kernel @ root
    solved = np.linalg.solve(features.T @ features + RIDGE * n * np.eye(features.shape[1]), features.T @ target)
    coefficients = root @ solved
    weights = {}
    for order, weight in ORDERS.items():
        there, norm = _known([texts_codes[k] for k in marks], codes[order], order)
        weights[order] = np.zeros((len(codes[order]), len(languages)), np.float32)
        for low, high, flags in _flag_blocks(there, len(marks), len(codes[order])):
            weights[order][low:high] = flags.T @ (weight * coefficients / norm[:, None])
    return Model(languages, codes, weights)


def _known(texts_codes, codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of the known n-grams that each text holds, ordered by place, and the root of each text's number of them."""
    pairs = []
    for k, sets in enumerate(texts_codes):
        at = np.minimum(np.searchsorted(codes, sets[order]), max(len(codes) - 1, 0))
        at = at[codes[at] == sets[order]] if len(codes) else at[:0]
        pairs.append(np.stack([at, np.full(len(at), k)]).astype(np.int32))
    there = np.concatenate(pairs, axis=1)
    norm = np.sqrt(np.maximum(np.bincount(there[1], minlength=len(texts_codes)), 1))
    return there[:, np.argsort(there[0], kind="stable")], norm


def _flag_blocks(there: np.ndarray, n: int, n_codes: int):
    """(low, high, flags of n texts by the n-grams low to high), block after block."""
    step = max(1, _CELLS // n)
    for low in range(0, n_codes, step):
        high = min(low + step, n_codes)
        a, b = np.searchsorted(there[0], [low, high])
        flags = np.zeros((n, high - low), np.float32)
        flags[there[1, a:b], there[0, a:b] - low] = 1
        yield low, high, flags


def _fit_sets(batches):
    for batch in batches:
        data, offsets = words.text_bytes(batch.column(1))
        for low, high in words.pieces(offsets, _BATCH_BYTES):
            part, at = data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low]
            made = []
            for order in ORDERS:
                code, home = gram_codes(part, at, order)
                pair = np.unique(home.astype(np.int64) << 32 | code)
                ends = np.searchsorted(pair >> 32, np.arange(high - low + 1))
                made.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((pair & 0xFFFFFFFF).astype(np.int32))))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *made], ["lang", *[f"g{o}" for o in ORDERS]])


def held_out(doc_id: Column | str) -> Column:
    """Is crc32 of the id as text 2 modulo 4?  A null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))


def train(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on labelled rows of ``docs(doc_id, text, lang)`` that are not held out.  Runs at once.

    Every label that occurs is learned.  At most ``fit_rows`` rows of each language take part, those of the least hashes
    of id and text, so the driver gets that many sets of n-grams for each language.  Their texts are used whole.
    """
    known = _labelled(docs)
    place = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = known.select("doc_id", "lang", "text")
    ranked = ranked.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= fit_rows)
    schema = ", ".join(["lang string", *[f"g{o} array<int>" for o in ORDERS]])
    # ordered, so that the same rows give the same model however they arrive
    rows = ranked.select(F.col("lang").cast("string"), "text").mapInArrow(_fit_sets, schema).orderBy("lang", *[f"g{o}" for o in ORDERS])
    table = rows.toArrow()
    sets = [{o: np.asarray(table[f"g{o}"][k].values) for o in ORDERS} for k in range(table.num_rows)]
    return fit(sets, table["lang"].to_pylist())


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = _TABLE[data]
    sums = np.concatenate([[0], np.cumsum((plain > 0) & (plain < 27))])
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for k in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        text = data[offsets[k]: offsets[k + 1]]
        if (text >= 128).any():
            found[k] = any(c.isalpha() for c in text.tobytes().decode("utf-8", "replace"))
    return found


def _predict(model: Model, names: list[str]):
    def run(batches):
        score = model.scorer() if model.languages else None
        # flags of a batch are a dense table, so more n-grams leave fewer texts
        step = int(np.clip(_CELLS // max([1, *map(len, model.codes.values())]), 1, _BATCH_TEXTS))
        languages = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(names.index("text")))
            picks, sure = [], []
            for low, high in words.pieces(offsets, _BATCH_BYTES):
                for start in range(low, high, step):
                    stop = min(start + step, high)
                    part, at = data[offsets[start]: offsets[stop]], offsets[start: stop + 1] - offsets[start]
                    pick, value = np.full(stop - start, len(model.languages)), np.zeros(stop - start)
                    letter = _has_letter(part, at)
                    if score is not None:
                        scores = score(part, at)
                        pick[letter] = scores.argmax(axis=1)[letter]
                        value[letter] = np.clip((scores.max(axis=1) + 1) / 2, 0, 1)[letter]
                    picks.append(pick)
                    sure.append(value)
            pick, value = (np.concatenate(x) if x else np.zeros(0, int) for x in (picks, sure))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages[pick], pa.string()), pa.array(value.astype(np.float64), pa.float64())],
                [*names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the whole ``text`` alone.

    The language with the highest score (ties to the first by name); ``und`` with score 0 if the
    text is null or has no letter, or if no language was learned.
    """
    taken = {"lang_pred", "score"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return small_batches(docs).mapInArrow(_predict(model, docs.columns), schema)


def _lettered(names: list[str]):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_has_letter(*words.text_bytes(batch.column(names.index("text"))))))

    return run


def floors(docs: DataFrame, model: Model) -> dict[str, float]:
    """The least score with which a text of each language stays.  Runs at once.

    ``FLOOR_SHARE`` by the number of languages, ``FLOOR`` at most, and less where a labelled row that is not held out
    and is given its own label has less.
    """
    known = _labelled(docs).select(F.col("lang").cast("string").alias("lang"), "text")
    right = predict(known, model).where(F.col("lang") == F.col("lang_pred"))
    least = {r["lang"]: r["least"] for r in right.groupBy("lang").agg(F.min("score").alias("least")).collect()}
    most = min(FLOOR, FLOOR_SHARE / max(1, len(model.languages)))
    return {x: min(most, least.get(x, most)) for x in model.languages}


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows whose language can be told; the model is learned from the rows' own labels.  Runs at once.

    A row goes if its text is null or has no letter, or if the score of the language it is given is below that
    language's floor, so that it is of no language more than of all others.  If no language was learned, all rows
    with a letter stay.
    """
    model = train(docs)
    if not model.languages:
        return small_batches(docs).mapInArrow(_lettered(docs.columns), docs.schema)
    limits = F.create_map(*[F.lit(x) for pair in floors(docs, model).items() for x in pair])
    found = predict(docs.select("*"), model)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= limits[F.col("lang_pred")])).select(*docs.columns)
