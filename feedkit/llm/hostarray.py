"""Main text of web pages: markup where it speaks, a suffix array of each host's pages where it does not."""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm import htmlblocks, words
from feedkit.llm.stored import Scratch, small_batches

# A repeated substring has at least this many tokens (a power of two) and stands on this many pages of a host.
LENGTH, PAGES = 8, 2
# Tokens that one part of a host, or one pack of small hosts, holds on average at most.
PART_TOKENS = 400_000

_PARSED = "page_id {id}, url {url}, host string, kinds array<tinyint>, texts array<string>, places array<int>, tokens array<int>"


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """32-bit word hashes of all texts, the first byte of each word, and the number of words before each text."""
    data, offsets = words.text_bytes(pa.array(texts, pa.large_string()))
    starts, ends, hashes, at = words.hashed_words(data, offsets, words.SOLID)
    return (hashes >> np.uint64(33)).astype(np.int32), starts, at


def _parse(names: list[str]):
    place = names.index("html")

    def run(batches):
        for batch in batches:
            _, offsets = words.text_bytes(batch.column(place))
            for low, high in words.pieces(offsets):
                part = batch.slice(low, high - low)
                kinds, texts, streams, firsts = [], [], [], []
                found = [htmlblocks.blocks(p or "") for p in part.column(place).to_pylist()]
                flat = [t for page in found for k, t in page if k != htmlblocks.MAIN]
                tokens, _, at = _tokens(flat)
                n = 0
                for page in found:
                    m = sum(k != htmlblocks.MAIN for k, _ in page)
                    streams.append(tokens[at[n]: at[n + m]])
                    n += m
                    first, seen = [], n - m
                    for k, _ in page:
                        first.append(at[seen] - at[n - m] if k == htmlblocks.OPEN else -1)
                        seen += k != htmlblocks.MAIN
                    kept = [x for x, (k, _) in enumerate(page) if k != htmlblocks.CHROME]
                    kinds.append([page[x][0] for x in kept])
                    texts.append([page[x][1] for x in kept])
                    firsts.append([first[x] for x in kept])
                ends = np.concatenate([[0], np.cumsum([len(s) for s in streams])])
                yield pa.RecordBatch.from_arrays([
                    *[part.column(names.index(c)) for c in ("page_id", "url", "host")],
                    pa.array(kinds, pa.list_(pa.int8())), pa.array(texts, pa.list_(pa.string())), pa.array(firsts, pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32()))],
                    ["page_id", "url", "host", "kinds", "texts", "places", "tokens"])

    return run


def window_groups(tokens: np.ndarray, page: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffix array of a token stream, in order, and the group of each: equal first ``length`` tokens.

    ``page`` numbers the page of every token, ascending.  Suffixes are ordered by prefix doubling up to ``length``,
    which must be a power of two; suffixes with fewer tokens left on their page are left out.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    last = np.searchsorted(page, page, side="right")
    whole = np.arange(n) + length <= last
    width = 1
    while width < length:
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = rank[width:] + 1
        after[np.arange(n) + width >= last] = 0
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        width *= 2
    places = np.flatnonzero(whole)
    places = places[np.argsort(rank[places], kind="stable")]
    group = np.cumsum(np.concatenate([[0], np.diff(rank[places]) > 0])) if len(places) else places
    return places, group


def _stream(table: pa.Table):
    """Tokens of a part as one stream: host and token as one number, the page of each token, the first token of each page."""
    table = table.combine_chunks()
    lists = table["tokens"].combine_chunks()
    at = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    hosts = table["host"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    page = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return (hosts[page] << 32) + (flat & 0xFFFFFFFF), page, at - at[0]


def _window_hashes(stream: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    value = np.zeros(len(places), np.uint64)
    for k in range(length):
        value = words.mix(value + (stream[places + k] & 0xFFFFFFFF).astype(np.uint64) + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return value.view(np.int64)


def _counts(places: np.ndarray, group: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Pages of every group."""
    if not len(places):
        return np.zeros(0, np.int64)
    pair = np.unique(group.astype(np.int64) << 32 | page[places])
    return np.bincount(pair >> 32, minlength=group[-1] + 1)


def _list_windows(length: int):
    """The distinct windows of a part of a large host, with the number of pages that hold each."""
    def run(table: pa.Table) -> pa.Table:
        stream, page, _ = _stream(table)
        places, group = window_groups(stream, page, length)
        count = _counts(places, group, page)
        first = places[np.searchsorted(group, np.arange(len(count)))] if len(count) else places
        same = {c: pa.array([table[c][0].as_py()] * len(first), table[c].type) for c in ("group_host", "pack", "part")}
        return pa.table(same | {"window": pa.array(_window_hashes(stream, first, length), pa.int64()), "pages": pa.array(count, pa.int64())})

    return run


def _cover(length: int, least: int):
    """For each page the tokens (positions) in substrings that ``least`` pages of the host repeat."""
    def run(key, pages: pa.Table, shared: pa.Table) -> pa.Table:
        stream, page, at = _stream(pages)
        places, group = window_groups(stream, page, length)
        repeated = _counts(places, group, page) >= least
        hit = repeated[group] if len(group) else np.zeros(0, bool)
        if shared.num_rows:
            hit |= np.isin(_window_hashes(stream, places, length), shared["window"].to_numpy())
        edge = np.zeros(len(stream) + 1, np.int64)
        np.add.at(edge, places[hit], 1)
        np.add.at(edge, places[hit] + length, -1)
        covered = np.cumsum(edge[:-1]) > 0
        lists = [np.flatnonzero(covered[at[k]: at[k + 1]]).astype(np.int32) for k in range(pages.num_rows)]
        return pa.table({"of1": pages["s1"], "of2": pages["s2"], "covered": pa.array(lists, pa.list_(pa.int32()))})

    return run


def covered_tokens(parsed: DataFrame, length: int = LENGTH, least: int = PAGES, part_tokens: int = PART_TOKENS) -> DataFrame:
    """(of1, of2, covered): positions of a stream inside host boilerplate, for each distinct stream of ``parsed``.

    A host's distinct streams form one text and one suffix array.  The streams of a large host are dealt to parts
    of about ``part_tokens`` with an array each; their distinct windows, counted per part first, are summed over
    the host, and every part learns which of its windows other parts repeat.  So the result is that of
    one array over the host.  Small hosts share tasks.  ``s1`` and ``s2`` name a stream.
    """
    streams = parsed.select("s1", "s2", "host", "tokens").where(F.size("tokens") > 0).distinct()
    hosts = streams.groupBy("host").agg(F.sum(F.size("tokens")).alias("n"))
    hosts = hosts.select(F.col("host").alias("h"), F.ceil(F.col("n") / part_tokens).alias("parts"), "n")
    total = hosts.where("parts = 1").agg(F.sum("n")).first()[0] or 0
    packs = int(total // part_tokens) + 1
    large = F.col("parts") > 1
    dealt = streams.join(hosts, F.col("host").eqNullSafe(F.col("h"))).select(
        "s1", "s2", "host", "tokens", "parts",
        F.when(large, F.coalesce("host", F.lit(""))).otherwise("").alias("group_host"),
        F.when(large, F.lit(-1)).otherwise(F.pmod(F.xxhash64("host"), F.lit(packs))).cast("long").alias("pack"),
        F.when(large, F.pmod("s1", "parts")).otherwise(0).cast("long").alias("part"))
    keys = ["group_host", "pack", "part"]
    listed = dealt.where(large).groupBy(*keys).applyInArrow(
        _list_windows(length), "group_host string, pack long, part long, window long, pages long")
    common = listed.groupBy("group_host", "window").agg(F.sum("pages").alias("all")).where(F.col("all") >= least)
    common = common.select(F.col("group_host").alias("h"), F.col("window").alias("w"))
    shared = listed.join(common, (F.col("group_host") == F.col("h")) & (F.col("window") == F.col("w"))).select(*keys, "window")
    return dealt.groupBy(*keys).cogroup(shared.groupBy(*keys)).applyInArrow(
        _cover(length, least), "of1 long, of2 long, covered array<int>")


def unique_runs(kinds: list[int], texts: list[str], places: list[int], gone: set[int], length: int = LENGTH) -> list[str]:
    """The blocks of a page without the covered words of its open blocks; blocks left empty go.

    Covered words at the edge of a block may only be what two pages share by chance next to a boilerplate
    block, so they go if they are the whole block or ``length`` words in a row.
    """
    out = []
    for kind, text, place in zip(kinds, texts, places):
        if kind == htmlblocks.OPEN:
            found = text.split(" ")
            runs = [(c, list(g)) for c, g in groupby(range(len(found)), lambda k: place + k in gone)]
            stay = [k for c, g in runs for k in g if not c or len(g) < min(length, len(found))]
            text = " ".join(found[k] for k in stay)
        if text:
            out.append(text)
    return out


def _assemble(names: list[str]):
    at = {c: names.index(c) for c in names}

    def run(batches):
        for batch in batches:
            made, removed = [], []
            for kinds, texts, places, gone in zip(*(batch.column(at[c]).to_pylist() for c in ("kinds", "texts", "places", "covered"))):
                out = unique_runs(kinds, texts, places, set(gone)) if gone else texts
                made.append("\n".join(out))
                removed.append(sum(t.count(" ") + 1 for t in texts) - sum(t.count(" ") + 1 for t in out))
            yield pa.RecordBatch.from_arrays(
                [batch.column(at["page_id"]), batch.column(at["url"]), pa.array(made, pa.string()), pa.array(removed, pa.int64())],
                ["page_id", "url", "text", "n_removed"])

    return run


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_removed) for every row of ``pages(page_id, url, html)``.  Runs at once.

    ``text``: blocks of the main text in page order, one line each, character references decoded.  Where the markup
    names the main text (article, main) its blocks are it, but for navigation, forms, notices and the like inside.
    On other pages the blocks that markup does not name as something else are taken, without the words inside
    substrings of ``LENGTH`` or more words that ``PAGES`` or more distinct pages of the host repeat; unique runs stay.

    The suffix arrays run over all text outside marked main text, of every page; ``n_removed`` is the number of words
    that they take from the page.  Pages whose streams are equal count as one.  A null html is empty; pages
    whose url is null or names no host form a host of their own.  Every row stays, also repeated ones.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "host-array")
    kinds = dict(pages.dtypes)
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    schema = _PARSED.format(id=kinds["page_id"], url=kinds["url"])
    named = {"s1": F.xxhash64("host", "tokens"), "s2": F.xxhash64(F.lit(1), "tokens", "host")}
    parsed = scratch.write(small_batches(rows).mapInArrow(_parse(rows.columns), schema).withColumns(named))
    on = (F.col("s1") == F.col("of1")) & (F.col("s2") == F.col("of2"))
    out = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_removed long"
    # only texts of pages that leave something open meet the suffix arrays' result
    undecided = F.array_contains("kinds", F.lit(htmlblocks.OPEN).cast("byte"))
    joined = parsed.where(undecided).drop("tokens", "host").join(covered_tokens(parsed), on, "left")
    joined = joined.select("page_id", "url", "kinds", "texts", "places", "covered").mapInArrow(_assemble(["page_id", "url", "kinds", "texts", "places", "covered"]), out)
    decided = parsed.where(~undecided).select("page_id", "url", F.array_join("texts", "\n").alias("text"), F.lit(0).cast("long").alias("n_removed"))
    return decided.unionAll(joined)
