"""Secret scans."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedkit.llm import secretscan
from feedkit.llm.assignments import literal_quality, name_weight, pairs, sensitive_literals
from feedkit.llm.queries import QUERIES
from llmtools import DOCS, SF, odd_documents, rng

SHAPES = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
KEY = "q7RtZ0pXw9LmK2vB"


def base(text):
    """The fixed shapes of a text, by start, then kind."""
    out = []
    for n, (kind, shape) in enumerate(SHAPES.items()):
        for m in shape.finditer(text or ""):
            size = len(m.group(2)) if kind == "assign" else len(m.group())
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}", kind))
    return sorted(out)


def check(rows, texts):
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        for kind in SHAPES:
            assert r[f"n_{kind}"] == sum(x[3] == kind for x in want)
        assert r.base_sha256 == hashlib.sha256(",".join(x[2] for x in want).encode()).hexdigest(), texts[r.doc_id]
        every = r.spans.split(",") if r.spans else []
        assert [s for s in every if not s.startswith("literal")] == [x[2] for x in want]
        starts = [int(s.split(":")[1]) for s in every]
        assert starts == sorted(starts) and r.n_literal == len(every) - len(want)


def test_query_has_the_fixed_shapes_of_every_text(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_secret_scan"](spark, SF).collect()
    check(rows, texts)
    # of plain prose only what is planted in it is found
    assert all(not r.n_literal or r.n_assign for r in rows)


def test_fixed_shapes_of_random_and_odd_texts(spark, monkeypatch):
    import feedkit.llm.queries as queries

    r = rng(2)
    parts = ["password", "PassWD", "ſecret", "toKen", "token", "API_key", "apikey", "=", ":", " ", "  ", '"', "'", "AKIA", "ABCDEFGH1234", "é", "日",
             "0123456789abcdef", "deadbeef", "\n", "secret=token", "x", "G", "a" * 31, ";"]
    texts = {k: "".join(r.choice(parts, int(r.integers(1, 30)))) for k in range(400)}
    texts |= {1000: None, 1001: "", 1002: "deadbeef" * 3, 1003: "deadbeef" * 3, 1004: "é" * 3_000_000 + " token=" + KEY, 1005: "a" * 2_000_000}
    rows = [(k, t, None, None, None) for k, t in texts.items()]
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, DOCS))
    check(QUERIES["op11_secret_scan"](spark, "").collect(), texts)


def test_odd_rows(spark):
    docs = spark.createDataFrame(odd_documents(), DOCS)
    assert secretscan.find_secrets(docs).where(F.size("secrets") > 0).count() == 0 and secretscan.find_secrets(docs).count() == 10
    assert secretscan.find_secrets(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        secretscan.find_secrets(docs.withColumnRenamed("lang", "secrets"))


def literals(text):
    return [text[a:b] for a, b, _, _ in sensitive_literals(text)]


@pytest.mark.parametrize("text", [
    f'db_password = "{KEY}"', f"const apiKey = '{KEY}';", f'password: str = "{KEY}"', f"export AUTH_TOKEN={KEY}\n", f'{{"client_secret": "{KEY}", "a": 1}}',
    f"spring.datasource.password={KEY}\n", f"  password: {KEY}  # live\n", f'config["access_key"] = "{KEY}"', f'connect(host="h", password="{KEY}")',
    f'props.setProperty("db.password", "{KEY}");', f"<password>{KEY}</password>", f'<add key="DbPassword" value="{KEY}"/>',
    f'- name: API_TOKEN\n  value: "{KEY}"\n', f"run --password {KEY} --host h", f"run --api-key={KEY}", f'String clientSecret = decode("{KEY}");',
    f'secretKey := `{KEY}`', f'"passphrase" => "{KEY}",', f"# password = '{KEY}'", f'PASSWORD = """{KEY}"""', f'token =\n    "{KEY}"',
])
def test_pairs_of_many_forms(text):
    assert literals(text) == [KEY], list(pairs(text))
    # such a text is read by tokens, wherever it lies in a piece
    texts = ["some key", text, "value", f"é{text}"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    named = secretscan._candidates(np.frombuffer(b"".join(raw), np.uint8), offsets)[1]
    assert {1, 3} <= set(named.tolist())


def test_constants_are_followed():
    assert literals(f'x = "{KEY}"\ny = x\npassword = y') == [KEY]
    assert literals(f'secret = KEY_VALUE\nKEY_VALUE = "{KEY}"') == [KEY]
    half, rest = KEY[:8], KEY[8:]
    assert literals(f'a = "{half}"\ntoken = a + "{rest}"') == [half, rest]
    assert literals(f'base: {KEY}\nauth_token: "${{base}}"')[0] == KEY
    assert literals(f'x = "{KEY}"\nx = "plain"\npassword = x\n') == []
    assert literals("a = b\nb = a\npassword = a") == []
    deep = f'v0 = "{KEY}"\n' + "".join(f"v{k + 1} = v{k}\n" for k in range(3000)) + "password = v3000"
    assert literals(deep) == [KEY]
    doubled = f'v0 = "{KEY}"\n' + "".join(f"v{k + 1} = v{k} + v{k}\n" for k in range(60)) + "password = v60"
    assert literals(doubled) == [KEY]


@pytest.mark.parametrize("text", [
    'password = os.environ["DB_PASSWORD_2"]', 'token = getenv("A1b2C3d4E5f6")', 'password = "<your password 1>"', 'api_key = "${API_KEY_V2}"', 'password = "changeme123"',
    f'token_type = "{KEY}"', f'password_field = "{KEY}"', f'color = "{KEY}"', f'if password == "{KEY}":', 'secret_path: /run/secrets/a1', "The secret: nobody knows it",
    'query = "password = Abc12345xyz"', "tokens = []", "password", "=", 'password = "',
])
def test_what_is_no_secret(text):
    assert literals(text) == []


def test_prose_is_not_read_by_tokens():
    prose = b"the key to pass is the author's own token, with credit; a monkey passed " * 50
    assert len(secretscan._candidates(np.frombuffer(prose, np.uint8), np.array([0, len(prose)]))[1]) == 0


def test_names_and_literals():
    assert name_weight("dbPassword") == 1 and name_weight("X-Api-Key") == 1 and name_weight("monkey") == 0 and name_weight("") == 0
    assert literal_quality(KEY) == 1 and literal_quality("aaaaaaaaaaaa") == 0 and literal_quality("short") == 0
    assert literal_quality("correcthorse") < 0.35 < literal_quality("c0rrect-horse")


def test_redaction(spark):
    docs = spark.createDataFrame([(1, f'é password="{KEY}" and AKIAABCDEFGH1234XY.'), (2, "plain"), (3, None), (4, ""), (5, "deadbeef" * 4)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in secretscan.redact(secretscan.find_secrets(docs)).collect()}
    assert got == {1: 'é [SECRET]" and [SECRET].', 2: "plain", 3: None, 4: "", 5: "[SECRET]"}
