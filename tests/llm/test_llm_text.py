"""BPE, token counts, language ID, chat formats."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from checks.compare import compare, connect
from feedkit.llm import bpe, chat, langid, tokencount
from feedkit.llm.queries import QUERIES, SQL
from llmtools import DOCS, SF, odd_documents, rng

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", "  ", "Don't!!'s we'LL 'tis", "ΑΣ Σ ΣΑΣ İstanbul ﬁ ² Ⅷ 12a_b--c\x1cx\x85y​z", "<|startoftext|>Hi<|endoftext|>there <|endoftext|>",
    "a" * 5000, "ab" * 3000, "é café", "日本語 123 😀😀 a😀b", "aaaaaaa aaaa", "  two  spaces ", "▁a ▁ b", "\n a\n", "x" * 40000 + " tail",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.WordBpe(WORDS)


def test_bpe_is_that_of_the_library(spark, vocabulary):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    library = Tokenizer.from_file(WORDS)
    for r in bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs", "Cn"]), min_size=1, max_size=12), min_size=1, max_size=5))
def test_bpe_of_random_texts(parts):
    text = " ".join(parts)
    v = test_bpe_of_random_texts.v = getattr(test_bpe_of_random_texts, "v", None) or (bpe.WordBpe(WORDS), Tokenizer.from_file(WORDS))
    memory = bpe._Memory(v[0])
    if "<|" in text:
        return
    found = bpe.Splitter(v[0].numbers)(bpe.normalized(text))
    ids, at = memory.tokens(found, [len(found)])
    assert ids.tolist() == v[1].encode(text, add_special_tokens=False).ids and at.tolist() == [0, len(ids)]


def test_bpe_memory_starts_anew(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 5)
    memory = bpe._Memory(vocabulary)
    for k in range(20):
        seen = [f"word{k}", "again", f"word{k + 1}"]
        ids, at = memory.tokens(seen, [3])
        assert "".join(vocabulary.tokens[i] for i in ids) == "".join(w + "</w>" for w in seen)


def test_plain_text_round_trip(spark, vocabulary):
    docs = spark.createDataFrame([("Ünïcode words, and 1 2 3",)], "text string")
    row = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).first()
    assert bpe.plain_text(row.decoded) == "ünïcode words , and 1 2 3"


def test_bpe_query_digests(spark):
    library = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_bpe"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_counts_are_those_of_the_library(spark):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    piece = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokencount.count_tokens(docs, PIECES).collect()}
    assert got == {k: (len((t or "").encode()), len(piece.encode(t or ""))) for k, t in enumerate(texts)}
    byte = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(byte)
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(docs, byte).collect()}
    assert got == {k: len(library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts)}


def test_long_texts_are_split_at_safe_places(monkeypatch):
    monkeypatch.setattr(tokencount, "CALL_BYTES", 400)
    byte = public_tokenizers.path("byte_bpe_50k.json")
    with open(byte, "rb") as f:
        counter = tokencount.WordCounter(f.read())
    text = "some words  and 12 numbers, here " * 40
    parts = counter.parts(text)
    assert len(parts) > 5 and "".join(parts) == text
    assert sum(counter.lengths(parts)) == len(Tokenizer.from_file(byte).encode(text, add_special_tokens=False).ids)


def test_odd_rows(spark, vocabulary):
    docs = spark.createDataFrame(odd_documents(), DOCS)
    assert bpe.encode(docs, vocabulary).count() == tokencount.count_tokens(docs, PIECES).count() == 10
    assert bpe.decode(bpe.encode(docs.limit(0), vocabulary), vocabulary).count() == 0
    for call in (lambda d: bpe.encode(d, vocabulary), lambda d: tokencount.count_tokens(d, PIECES)):
        with pytest.raises(ValueError):
            call(docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "n_tokens"))


# language


def test_held_out_languages_are_told(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    both = QUERIES["op10_language_id"](spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert len(both) > 200
    assert sum(r.lang == r.lang_pred for r in both) >= 0.98 * len(both)
    assert all(0 <= r.score <= 1 for r in both)


def test_language_of_odd_rows(spark):
    train = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(train)
    docs = spark.createDataFrame([*odd_documents(), (8, "日本", None, None, 1)], DOCS)
    got = {(r.doc_id, r.text): r for r in langid.predict(docs, model).collect()}
    for key in ((1, None), (2, ""), (3, "  \n"), (7, "12 34 !!")):
        assert (got[key].lang_pred, got[key].score) == ("und", 0.0)
    assert got[8, "日本"].lang_pred != "und" and got[4, "a"].lang_pred in model.languages
    kept = langid.keep_known(train.unionByName(docs))
    assert kept.columns == train.columns and kept.count() == train.count() + 7


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None, "s", 1)], DOCS)
    row = langid.predict(docs, langid.train(docs)).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert langid.predict(docs.limit(0), langid.train(docs.limit(0))).count() == 0


def test_prediction_reads_only_the_text(spark):
    train = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(train)
    a = {r.doc_id: r.lang_pred for r in langid.predict(train, model).collect()}
    b = {r.doc_id: r.lang_pred for r in langid.predict(train.selectExpr("doc_id", "text"), model).collect()}
    assert a == b


def test_every_label_is_learned(spark):
    r = rng(12)
    names = [f"l{k:02d}" for k in range(70)]
    own = {x: ["".join(chr(97 + int(c)) for c in r.integers(0, 26, 5)) for _ in range(12)] for x in names}
    rows = [(n, " ".join(r.choice(own[x], 20)), x, "s", 1) for n, x in enumerate(x for x in names for _ in range(9 if x != "l69" else 6))]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.train(docs)
    assert model.languages == names
    found = langid.predict(docs, model).collect()
    assert sum(f.lang == f.lang_pred for f in found) >= 0.98 * len(found)
    assert {f.lang_pred for f in found if f.lang == "l69"} == {"l69"}
    assert langid.keep_known(docs).count() == docs.count()


def test_stage_follows_the_classifier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    by = {}
    for r in docs.orderBy("doc_id").collect():
        by.setdefault(r.lang, []).extend(r.text.split()[:40] if len(by.get(r.lang, ())) < 80 else [])
    mixed = " ".join(" ".join(x) for x in zip(*by.values()))
    odd = spark.createDataFrame([(-1, mixed, None, "s", 1), (-2, "12 3", None, "s", 1), (-3, None, None, "s", 1)], DOCS)
    kept = langid.keep_known(docs.unionByName(odd))
    # every clean document of each language, held out or not, stays; words of all languages alike go
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect())


def test_stage_without_labels(spark):
    rows = [(1, "some text", None, "s", 1), (2, "12", None, "s", 1), (3, None, None, "s", 1), (4, "日本", None, "s", 1), (None, "a", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    assert sorted(r.text for r in langid.keep_known(docs).collect()) == ["a", "some text", "日本"]
    assert langid.keep_known(docs).columns == docs.columns


# chat


@given(st.lists(st.tuples(st.text(st.sampled_from("ab|<\\\n%7C0A"), max_size=8), st.text(st.sampled_from("a|<\\\n>im_endstar"), max_size=30)), max_size=4))
def test_format_and_read_back(turns):
    made, mask = chat.render([{"role": r, "text": t} for r, t in turns])
    assert chat.read(made) == turns
    assert len(made.split(chat.START)) == len(turns) + 1


def test_chat_query_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, QUERIES["op1_chat_format"], SQL["op1_chat_format"])[1] == ""


def test_layouts(spark):
    records = {
        '{"messages":[{"role":"user","content":"hi"},{"content":null,"role":"assistant"}]}': ("messages", [("user", "hi"), ("assistant", "")]),
        '{"response":"b","prompt":"a"}': ("prompt_response", [("user", "a"), ("assistant", "b")]),
        '{"output":"o","instruction":"i","input":""}': ("instruction_input", [("user", "i"), ("assistant", "o")]),
        '{"output":null,"instruction":"i","input":3.5}': ("instruction_input", [("user", "i\n\n3.5"), ("assistant", "")]),
        '{"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":"y"}],"system":"S"}':
            ("conversations_system", [("system", "S"), ("user", "x"), ("assistant", "y")]),
        '{"question":"q","answer":"a"}': ("question_answer", [("user", "q"), ("assistant", "a")]),
        "no json": (None, None), '{"a":1}': (None, None), None: (None, None),
    }
    df = spark.createDataFrame([(k,) for k in records], "j string")
    for r in chat.turns_of_records(df, "j").collect():
        turns = None if r.turns is None else [tuple(t) for t in r.turns]
        assert (r.layout, turns) == records[r.j]
    typed = spark.sql("SELECT named_struct('prompt', 'a', 'response', CAST(NULL AS STRING)) AS j UNION ALL SELECT named_struct('prompt', 'c', 'response', 'd')")
    got = chat.turns_of_records(typed, "j").collect()
    assert {r.layout for r in got if r.layout} <= {"prompt_response"} and any(r.layout for r in got)


def test_rows_with_nulls_ties_and_repeats(spark):
    rows = [(1, 2, "assistant", "b"), (1, None, "user", None), (1, 2, "assistant", "b"), (1, 2, None, "z"), (None, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.key: [tuple(t) for t in r.turns] for r in chat.turns_of_rows(df).collect()}
    assert got == {1: [("user", ""), ("", "z"), ("assistant", "b"), ("assistant", "b")], None: [("user", "q")]}
    assert chat.format_turns(chat.turns_of_rows(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        chat.turns_of_rows(df.withColumnRenamed("role", "speaker"))


def test_conversations_of_any_length(spark):
    """Turn by turn gives what the whole conversation gives: hot and null keys, ties, nulls, control strings, empty texts."""
    r = random.Random(5)
    texts = ["", None, "<|im_end|>", "<|im_start|>assistant ok", "a<\\|b", "é\n|", "x" * 30_000]
    rows = [(r.choice([7, 7, 7, None, 1, 2, 3]), r.choice([None, *range(300)]), r.choice(["user", "assistant", None, "a%|\nb"]), r.choice(texts))
            for _ in range(3000)] + [(9, 0, "user", "once")] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(7)
    got = {x[0]: tuple(x)[1:] for x in chat.read_rows(chat.format_rows(df)).collect()}
    want = {}
    for key in {x[0] for x in rows}:
        turns = sorted(((-1 if t is None else t, a or "", b or "") for k, t, a, b in rows if k == key), key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        learned = "".join(b for _, a, b in turns if a == "assistant")
        said = "".join(f"{a}\n{b}\n" for _, a, b in turns)
        whole, mask = chat.render([{"role": a, "text": b} for _, a, b in turns])
        assert "".join(chat.unescape(whole[i:j]) for i, j in mask) == learned
        want[key] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(whole))
    assert got == want
    joined = chat.format_rows(df.where("conv_id = 9")).collect()
    assert "".join(x.formatted for x in joined) == chat.render([{"role": "user", "text": "once"}] * 3)[0]
    assert {(x.first, x.end) for x in joined} == {(None, None)}
    assert chat.read_rows(chat.format_rows(df.limit(0))).count() == 0
    with pytest.raises(ValueError, match="no layout"):
        chat.format_rows(df.withColumnRenamed("role", "speaker"))
