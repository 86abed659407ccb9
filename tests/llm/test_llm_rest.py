"""Sharding, top-k search, pages, language model, pipeline."""

import html
import re
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from feedkit.llm import hostarray, htmlblocks, pivots, pseudolm, slots
from feedkit.llm.queries import QUERIES, SQL
from llmtools import DOCS, SF, hits, letters, near_groups, odd_documents, rng

# sharding


def test_shards_are_near_equal_and_gapless(spark):
    rows = QUERIES["op6_sharding"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    total = [0] * 8
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1
        total[r.shard] += r.size
    heaviest = max(r.size for r in rows)
    assert max(total) - min(total) <= 2 * heaviest
    for k in range(8):
        mine = sorted(r.slot for r in rows if r.shard == k)
        assert mine == list(range(len(mine)))


def test_map_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    slotted = docs.select("doc_id", slots.record_size("text").alias("size"), slots.slot_of(["doc_id"], 512).alias("slot"))
    loads = slots.slot_loads(slotted, 512)
    path = str(tmp_path / "map")
    slots.save_map(slots.first_map(loads, 8), path)
    old = slots.load_map(spark, path)
    for shards in (9, 5):
        slots.save_map(slots.edited_map(old, loads, shards), path)
        new = slots.load_map(spark, path)
        both = new.join(old.select("slot", F.col("shard").alias("was")), "slot").join(loads, "slot").collect()
        assert len(both) == 512 and {r.version for r in both} == {2}
        total = [sum(r.bytes for r in both if r.shard == k) for k in range(shards)]
        assert max(total) - min(total) <= 2 * max(r.bytes for r in both)
        moved = sum(r.bytes for r in both if r.shard != r.was)
        assert moved <= sum(total) * (0.2 if shards == 9 else 0.5)
    assert slots.load_map(spark, path, 1).count() == 512


def test_sharding_of_odd_rows(spark):
    docs = spark.createDataFrame(odd_documents(), DOCS)
    for df in (docs, docs.limit(0)):
        slotted = df.select("doc_id", slots.record_size("text").alias("size"), slots.slot_of(["doc_id", "text"]).alias("slot"))
        loads = slots.slot_loads(slotted)
        placed = slots.place(slotted, slots.first_map(loads, 3), loads, ["doc_id"]).collect()
        assert len(placed) == df.count()
        for k in range(3):
            mine = sorted(r.position for r in placed if r.shard == k)
            assert mine == list(range(len(mine)))
    with pytest.raises(ValueError):
        slots.slot_of(["doc_id"], 1 << 20)


# top-k


def test_top_k_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, QUERIES["op5_top_k"], SQL["op5_top_k"])[1] == ""


def brute_top(rows, queries, k):
    out = set()
    for q in queries:
        scored = sorted((-int(np.dot(rows[q], v)), i) for i, v in rows.items() if i != q and len(v) == len(rows[q]))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("sizes", [(4096, 1024), (7, 3)])
def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch, sizes):
    monkeypatch.setattr(pivots, "CANDIDATE_ROWS", sizes[0])
    monkeypatch.setattr(pivots, "QUERY_ROWS", sizes[1])
    r = rng(8)
    rows = {int(k): [int(x) for x in r.integers(-2, 3, 4)] for k in range(60)} | {k: [1, 2] for k in range(60, 64)}
    listed = [(k, v) for k, v in rows.items()] + [(None, [1, 1, 1, 1]), (99, None), (3, rows[3])]
    df = spark.createDataFrame(listed, "id long, vector array<long>")
    got = {tuple(x) for x in pivots.top_k(df, F.col("id") % 5 == 0, 3).collect()}
    assert got == brute_top(rows, [k for k in rows if k % 5 == 0], 3)
    assert pivots.top_k(df.limit(0), F.col("id") % 5 == 0).count() == 0


@pytest.mark.parametrize("name", ["repeated", "empty"])
def test_top_k_query_of_odd_rows_agrees_with_sql(spark, tmp_path, name):
    r = rng(13)
    if name == "repeated":
        ids = [*range(101), 0, 0, 50, 7, 7, 8, 100, 9]
        rows = [(k, [float(x) for x in r.integers(-2, 3, 3)]) for k in ids] + [(3, [2.0, 2.0, 2.0])] * 7 + [(50, [1.0, 1.0, 1.0])] * 2
    else:
        rows = [(k, []) for k in [*range(101), 0, 2, 2, 2]] + [(None, []), (102, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = sorted(tuple(x) for x in QUERIES["op5_top_k"](spark, str(tmp_path)).collect())
    assert got == sorted(con.sql(SQL["op5_top_k"]).fetchall()) and len(got) == 15


def test_top_k_of_mixed_lengths(spark):
    df = spark.createDataFrame([(0, []), (1, [1]), (2, [3]), (5, []), (6, [2])], "id long, vector array<long>")
    got = sorted(tuple(x) for x in pivots.top_k(df, F.col("id") < 2, 2).collect())
    assert got == [(0, 1, 5, 0), (1, 1, 2, 3), (1, 2, 6, 2)]


def test_unusable_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -0.001]), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, None), (5, [float("inf"), 0.0]), (6, [])],
                               "id long, v array<float>")
    got = {r.id: r.x for r in df.select("id", pivots.usable("v").alias("x")).collect()}
    assert got == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


# pages


def test_articles_of_the_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op3_html_text"](spark, SF).collect():
        inside = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


PAGE = """<html><body><div id="top"><a href=x>Home</a> <a href=y>About us</a></div><div class="cookie-notice">We use cookies</div>
<div><p>This site is brought to you by the friendly people of example dot com since 1999</p></div>
<div class=post><h2>T &amp; X{0}</h2><p>Unique text number {0} about <b>thi</b>ngs {1}</p></div><footer>c</footer>
<div id=comments><p>first!</p></div><form><p>q</p></form></body></html>"""


@pytest.mark.parametrize("part", [400_000, 20])
def test_boilerplate_of_unmarked_pages(spark, monkeypatch, part):
    monkeypatch.setattr(hostarray.covered_tokens, "__defaults__", (hostarray.LENGTH, hostarray.PAGES, part))
    rows = [(k, f"http://A.com/{k}", PAGE.format(k, " ".join(f"w{k}_{j}" for j in range(9)))) for k in range(6)]
    rows += [(9, "http://b.com/", PAGE.format(9, "")), (10, None, None), (11, "zz", "<p>x"), (12, "http://a.com/0?x", rows[0][2]),
             (None, "http://a.com", "<main>m<aside>no</aside><ul><li>a<li>b</ul></main><p>out"), (11, "zz", "<p>x")]
    got = {}
    for r in hostarray.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        got.setdefault(r.page_id, []).append(r.text)
    for k in range(6):
        assert got[k] == [f"T & X{k}\nUnique text number {k} about things " + " ".join(f"w{k}_{j}" for j in range(9))]
    assert got[12] == got[0] and got[10] == [""] and got[11] == ["x", "x"] and got[None] == ["m\na\nb"]
    assert got[9][0].startswith("This site is brought")


def test_no_pages(spark):
    assert hostarray.main_text(spark.createDataFrame([], "page_id long, url string, html string, text int, key int")).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<article>a<script>x</p></script><p>b &lt;i&gt; &#233;&eacute; &amp", "a\nb <i> éé &"),
    ("<article><header><h1>t</h1></header><p>a  \n b<nav>n</nav><footer>f</footer></article>", "t\na b"),
    ("<header>h</header><main><p class='ad'>ad</p><p>x<br>y</p></main>", "x y"),
    ("<article>1 < 2 <!-- c --> and <b title='>'>bold</b></article><p>out", "1 < 2 and bold"),
    ("<div hidden>h</div><p>a</p><div style='display:none'>n</div><textarea>t</textarea>", "a"),
    ("<article>a</article><article class=comment>c</article>", "a"),
    ("<p title=\"x>never closed", "never closed"), ("<p class=ad>no<p>yes", "yes"), ("", ""), ("plain", "plain"), ("<article", ""),
])
def test_blocks(page, want):
    assert "\n".join(t for k, t in htmlblocks.blocks(page) if k != htmlblocks.CHROME) == want


@pytest.mark.parametrize("page, want", [
    ("<html class='has-banner'><body class='no-sidebar search'><main class='search-results'><p>a</p></main>", "a"),
    ("<body id=search><p>a</p>", "a"), ("<main class=comments><p>a</p></main>", "a"),
    ("<p>o</p><article class='post comments-open'><p>a</p></article>", "a"),
    ("<article class=comments><p>a</p></article>", "a"), ("<main><p>a</p><article class=comments>b</article></main>", "a\nb"),
    ("<article>a<article class=comment>c</article>b</article>", "a\nb"),
    ("<article><h2 id=share-prices>a</h2><section id=related-work>b</section><h2 id=login>c</h2><section id=notice>d</section></article>", "a\nb\nc\nd"),
    ("<h1 class=header>t</h1><p>a</p><div class='share-box'>s</div><div class=siteFooter>f</div>", "t\na"),
    ("<h2><a href=x>only a link</a></h2><div><a href=x>one</a> <a href=y>two</a></div><p>a</p>", "only a link\na"),
])
def test_class_names_close_no_article(page, want):
    assert "\n".join(t for k, t in htmlblocks.blocks(page) if k != htmlblocks.CHROME) == want


@pytest.mark.parametrize("name", [
    "share-buttons", "related-posts", "ad-container", "comment-list", "user-comments", "social-links", "cookie-message",
    "wp-block-comments", "disqus_thread", "advert-wrapper", "promo-block", "comment-12 depth", "sidebarWidget", "newsletter_form",
])
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_parts_inside_an_article(name, attribute):
    name = name if attribute == "class" else name.split(" ")[0]
    page = f"<article><h1>t</h1><p>a</p><div {attribute}='{name}'><p>no</p><div><ul><li>no</ul></div></div><p>b</p></article><p>out"
    assert [t for k, t in htmlblocks.blocks(page) if k != htmlblocks.CHROME] == ["t", "a", "b"]


@pytest.mark.parametrize("page, want", [
    ("<h1>T</h1><dl><dt class=social>Social<dd>policy</dl><p>rest", "T policy rest"),
    ("<dl><dd class=ad>x<dd>y<dt class=ads>z</dl>w", "y w"),
    ("<table><tr><td class=ad>x<td>y</table>z", "y z"), ("<table><tr><th class=ad><p>x<td>y</table>z", "y z"),
    ("<table><tr class=ad><td>x<td>x<tr><td>y</table>z", "y z"), ("<table><thead class=ad><tr><td>x<tbody><tr><td>y</table>z", "y z"),
    ("<table><tr class=ad><td><table><tr><td>x</table>x<tr><td>y</table>z", "y z"),
    ("<ul><li class=ad>x<ul><li>x</ul>x<li>y</ul>z", "y z"), ("<ul><li class=ad><div>x<li>y</ul>z", "y z"),
    ("<ul><li class=ad><p class=ad>x<li>y</ul>z", "y z"), ("<ol><li>a<dl><dt>b<dd>c</dl><li>d</ol>", "a b c d"),
])
def test_elements_without_end_tags(page, want):
    for whole in (f"<article>{page}</article>", page):
        assert " ".join(t for k, t in htmlblocks.blocks(whole) if k != htmlblocks.CHROME) == want


def test_windows_of_a_stream():
    r = rng(9)
    tokens, page = r.integers(0, 3, 120), np.sort(r.integers(0, 6, 120))
    places, group = hostarray.window_groups(tokens, page, 4)
    want = {}
    for k in range(117):
        if page[k] == page[k + 3]:
            want.setdefault(tuple(tokens[k:k + 4]), set()).add(k)
    got = {}
    for p, g in zip(places, group):
        got.setdefault(g, set()).add(int(p))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


# language model


def test_gradient_and_likelihood():
    r = rng(10)
    net = pseudolm.Network(9)
    net.values[:] = r.normal(0, 0.5, len(net.values))
    around, target = r.integers(0, 10, (6, 4)), r.integers(0, 9, 6)
    before = net.log_probability(around, target).mean()
    every = np.stack([net.log_probability(around[:1], np.array([t]))[0] for t in range(9)])
    assert abs(np.exp(every).sum() - 1) < 1e-4
    squares = np.full(len(net.values), 1e-7, np.float32)
    for _ in range(50):
        net.step(around, target, squares, 0.02)
    assert net.log_probability(around, target).mean() > before + 0.5


def test_windows_stop_at_text_ends():
    got = pseudolm.windows(np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4]), 9)
    assert got.tolist() == [[9, 9, 6, 7], [9, 5, 7, 9], [5, 6, 9, 9], [9, 9, 9, 9]]


def test_windows_are_those_of_every_word():
    r = rng(13)
    for _ in range(40):
        sizes = r.integers(0, 6, int(r.integers(0, 9)))
        at = np.concatenate([[0], np.cumsum(sizes)])
        own = r.integers(0, 50, at[-1])
        want = [[own[p + k] if low <= p + k < high else 99 for k in (-2, -1, 1, 2)]
                for low, high in zip(at[:-1], at[1:]) for p in range(low, high)]
        assert pseudolm.windows(own, at, 99).tolist() == want


def test_places_of_hashes():
    r = rng(14)
    top = np.uint64(2**64 - 1)
    near = np.uint64(7 << 60) + np.arange(0, 60, 2, dtype=np.uint64)
    for some in ([], [0], [5, top], near, np.unique(np.append(r.integers(0, 2**64, 3000, np.uint64), near))):
        some = np.array(some, np.uint64)
        asked = np.concatenate([some, near, near + np.uint64(1), r.integers(0, 2**64, 500, np.uint64), np.array([0, top], np.uint64)])
        at, met = pseudolm.Places(some).find(asked)
        assert met.tolist() == np.isin(asked, some).tolist() and (some[at[met]] == asked[met]).all()


def peak_of(call):
    call()
    tracemalloc.start()
    call()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_batches_share_their_work_arrays():
    r = rng(15)
    net = pseudolm.Network(256)
    net.values[:] = r.normal(0, 0.3, len(net.values))
    around, target = r.integers(0, 257, (pseudolm.BATCH, 4)), r.integers(0, 256, pseudolm.BATCH)
    embed, w1, b1, w2, b2 = net.parts
    z = np.tanh(embed[around].reshape(len(around), -1) @ w1 + b1) @ w2 + b2
    z = z.astype(float)
    want = z[np.arange(len(z)), target] - np.log(np.exp(z).sum(axis=1))
    for n in (5, pseudolm.BATCH, 3, 700):
        assert np.allclose(net.log_probability(around[:n], target[:n]), want[:n], atol=1e-4)
    # no array of all symbols by all rows of a batch is asked for again
    squares = np.full(len(net.values), 1e-7, np.float32)
    assert peak_of(lambda: net.log_probability(around, target)) < 4 * 256 * pseudolm.BATCH
    assert peak_of(lambda: net.step(around, target, squares, 0.02)) < 4 * 256 * pseudolm.BATCH


def test_words_are_hashed_in_small_windows():
    r = rng(16)
    data = np.frombuffer(b" ".join(b"Word%d" % n for n in r.integers(0, 10**6, 90000)), np.uint8)
    got = pseudolm.words.hashed_words(data, np.array([0, len(data)]), pseudolm.words.LETTERS)[2]
    for k in (0, 1, 44444, 89999):
        word = np.frombuffer(data.tobytes().split(b" ")[k].lower(), np.uint8)
        assert pseudolm.words.hashed_words(word, np.array([0, len(word)]), pseudolm.words.LETTERS)[2].tolist() == [got[k]]
    peak = peak_of(lambda: pseudolm.words.hashed_words(data, np.array([0, len(data)]), pseudolm.words.LETTERS))
    assert len(data) > 900_000 and peak < 12 * len(data)


def test_scores_follow_the_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(odd_documents(), DOCS).select("doc_id", "text")
    symbols = pseudolm.learn_symbols(docs)
    net = pseudolm.train(docs, symbols)
    counts = {}
    for r in docs.collect():
        for w in letters(r.text):
            counts[w] = counts.get(w, 0) + 1
    assert len(symbols.frequent) == pseudolm.FREQUENT
    assert round(np.exp(symbols.log_words[pseudolm.FREQUENT:]).sum()) == len(counts) - pseudolm.FREQUENT
    plain = pseudolm.Network(symbols.size, bias=symbols.log_share)
    mean = F.sum("log_likelihood") / F.sum("n_words")
    learned = pseudolm.score(docs, symbols, net).agg(mean).first()[0]
    assert learned > pseudolm.score(docs, symbols, plain).agg(mean).first()[0] + 0.05
    for r in pseudolm.score(odd, symbols, net).collect():
        assert r.n_words == len(letters(r.text)) and (r.n_words > 0 or r.log_likelihood == 0)
    nothing = docs.limit(0)
    empty = pseudolm.learn_symbols(nothing)
    assert pseudolm.score(odd, empty, pseudolm.train(nothing, empty)).count() == 10


@pytest.mark.parametrize("shipped", [230, 1 << 16])
def test_every_word_has_its_own_count(spark, monkeypatch, shipped):
    monkeypatch.setattr(pseudolm, "SHIPPED", shipped)
    r = rng(12)
    texts = [" ".join(f"w{n}" for n in r.zipf(1.3, 60) % 700) for _ in range(90)]
    texts += [None, "", "?!", "\u00fc w1 seldom seldom", "seldom w3 w699", "W650 Seldom once"] + [texts[0]] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    symbols = pseudolm.learn_symbols(docs)
    net = pseudolm.Network(symbols.size, bias=symbols.log_share)
    net.values[:] = r.normal(0, 0.3, len(net.values))
    counts = {}
    for text in texts:
        for w in letters(text):
            counts[w] = counts.get(w, 0) + 1
    assert len(counts) > 300 and {r.n for r in symbols.counts.collect()} == set(counts.values())

    def symbol(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return int(symbols.of(pseudolm.words.hashed_words(data, np.array([0, len(data)]), pseudolm.words.LETTERS)[2])[0])

    used = {}
    for w, n in counts.items():
        used[symbol(w)] = used.get(symbol(w), 0) + n
    others = ["never met w1 w2", "seldom never seldom seldom", None, texts[5]]
    rows = list(enumerate(texts + others + [texts[0], texts[0]])) + [(0, texts[0])]
    got = pseudolm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), symbols, net).collect()
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted((i, t or "") for i, t in rows)
    for row in got:
        found = letters(row.text)
        own = np.array([symbol(w) for w in found], np.int64)
        want = 0.0
        if found:
            want = net.log_probability(pseudolm.windows(own, np.array([0, len(own)]), symbols.size), own).astype(float).sum()
        want += sum(np.log(counts.get(w, 1) / (used[s] + 1)) for w, s in zip(found, own) if s >= pseudolm.FREQUENT)
        assert row.n_words == len(found) and abs(row.log_likelihood - want) < 1e-3


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.createDataFrame([(100001, None, None, None, 0), (100002, "12 3", "en", "s", 4)], DOCS))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    known = corpus_pipeline.language(spark, docs, SF)
    assert known.columns == docs.columns
    left = {r.doc_id for r in known.collect()}
    assert left == {k for k, t in rows.items() if t and any(c.isalpha() for c in t)}
    ids = sorted(left)
    comp, _ = near_groups([rows[k] for k in ids], 5, 80)
    single = corpus_pipeline.near_duplicates(spark, known, SF)
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == [k for n, k in enumerate(ids) if comp[n] == n]
    clean = corpus_pipeline.decontamination(spark, single, SF)
    assert clean.columns == docs.columns
    want = sorted(k for n, k in enumerate(ids) if comp[n] == n and not hits(rows[k], items)[1])
    assert sorted(r.doc_id for r in clean.collect()) == want
    last = corpus_pipeline.tokens(spark, clean, SF)
    assert last.columns == [*docs.columns, "ids", "decoded"] and last.count() == len(want)


def test_pipeline_run_and_names(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None
    n = corpus_pipeline.run(spark, SF).count()
    assert 0 < n < 200
