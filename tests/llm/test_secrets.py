"""Secret scans: base kinds against the rules, pairs of names and literals, constants, scores."""
import hashlib
import random
import re
import time

import pytest

from marketmill.llm import secret_scan

from .conftest import words

SF = "/root/testdata/sf0.001"

#: The base kinds as they are defined; a match that fails is dropped and not tried again.
RULES = {
    "assign": (re.compile(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 8),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def by_rules(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, (pattern, ok)) in enumerate(RULES.items()) for m in pattern.finditer(text or "") if ok(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def secret_rows():
    rng = random.Random(11)
    parts = [
        "token", "password=token", ": abcdefghijk", "secret", "Api_Key", "APIKEY", "apiKey", "ſecret", "toKen", "=", ":", '"', "'", " ", "  ", "\n", "\t", "abcdefgh", "abc", "==", "AKIA", "AKIAAKIA", "ABCDEF0123456789", "0123456789abcdef", "0123456789abcdef0",
        "é", "日本", "+/_.=-", "\x00", "passwd", "PassWord", "x", ".", ",", "{", "}", "(", ")", "+", "\\", "`", "<", ">", "--", "key",
    ]
    rows = [(200 + k, "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for k in range(600)]
    return rows + [(900, "a" * 100_000), (901, "AKIA" * 20_000), (902, "token=" * 5000), (903, 'password = "x1y2z3w4!" ' * 2000)]


def test_base_kinds_equal_the_rules(spark, make_docs, odd_rows):
    rows = secret_rows() + odd_rows
    got = secret_scan.find_secrets(make_docs(rows)).collect()
    want = []
    for i, t in rows:
        base = by_rules(t)
        counts = [sum(kind == k for kind, *_ in base) for k in RULES]
        want.append(str((i, *counts, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest())))
    assert sorted(want) == sorted(str((r.id, r.n_assign, r.n_access, r.n_hex, r.base_sha256)) for r in got)
    texts = dict(rows)
    for r in got:
        spans = [(x.kind, x.start, x.end) for x in r.found]
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        order = list(secret_scan.KINDS)
        assert spans == sorted(spans, key=lambda x: (x[1], order.index(x[0]), x[2]))
        base = by_rules(texts.get(r.id)) if r.id is not None else []
        if r.id not in (6, None):
            assert [x for x in spans if x[0] != "literal"] == base
            # What was added lies beside the base spans.
            for k, s, e in spans:
                assert k != "literal" or not any(a < e and s < b for _, a, b in base)
    assert secret_scan.find_secrets(make_docs([])).count() == 0


def added(text):
    return [(text[s:e], name) for kind, s, e, name, _ in secret_scan.scan(text)[1] if kind == "literal"]


@pytest.mark.parametrize("text, want", [
    ('db_password = "hunter2!x"', [("hunter2!x", "db_password")]),
    ('cfg["password"] = "s3cr3t Value9"', [("s3cr3t Value9", "password")]),
    ("\"passwd\" => 'p4ssw0rdX9'", [("p4ssw0rdX9", "passwd")]),
    ('connect(host="db1", pwd="Yk72!mmQ")', [("Yk72!mmQ", "pwd")]),
    ('var passphrase string = "gopher-9182"', [("gopher-9182", "passphrase")]),
    ('const authKey: string = "Zx81kq9Lm2"', [("Zx81kq9Lm2", "authKey")]),
    ("export SECRET_KEY=django-insecure-8#kd", [("django-insecure-8#kd", "SECRET_KEY")]),
    ("spring.datasource.password: {Tr0ub4dor&3", []),
    ("<password>Tr0ub4dor&3</password>", [("Tr0ub4dor&3", "password")]),
    ("mysql --password S3kretPw99 -h x", [("S3kretPw99", "password")]),
    ("postgres://bob:Pw12345x@host/db", [("Pw12345x", "password")]),
    ('secret = "abcd" + "EFGH1234x"', [("EFGH1234x", "secret")]),
    ('password => getenv("DB_PASSWORD", "hunter22x")', [("hunter22x", "password")]),
    ("don't ask, it's pwd: 'correcthorse7'", [("correcthorse7", "pwd")]),
])
def test_pairs_of_many_syntaxes(text, want):
    assert added(text) == want


def test_constants_are_propagated():
    text = 'first = "abc8F3kk2pqz"\nsecond = first\n\nauth_token = second\nother = "qqq8F3kk2pqz"\nfoo = other\nfirst = auth_token\n'
    assert added(text) == [("abc8F3kk2pqz", "auth_token")]
    # A name that reaches two names counts by the more sensitive one; circles end.
    assert added('k = "abc8F3kk2pqz"\nsalt = k\npassphrase = k\nk = salt') == [("abc8F3kk2pqz", "passphrase")]


@pytest.mark.parametrize("text", [
    'pwd = "changeme"', "pwd = ${DB_PASSWORD}", 'pwd = "<your password>"', "pwd: required", 'secrets_path = "/etc/secrets/k9"', "password_min_length = 123456789", "pwd = None", 'color = "abc8F3kk2pqz"', "author: Brown2000x", "The key: somebody", "pwd == 'abc8F3kk2pqz'",
])
def test_what_is_no_secret(text):
    assert added(text) == []


def test_hot_texts_take_linear_time():
    for text in ['token "' + '\\" ' * 60_000, "password = '" + "' \\' " * 60_000, "pwd a=b " * 60_000, "token " + "<a>" * 60_000, "secret=f(" * 20_000 + 'f("x" ' * 20_000, "pwd=" * 60_000, "--pwd" * 60_000, "x=y " * 50_000 + "pwd=x"]:
        start = time.time()
        secret_scan.scan(text)
        assert time.time() - start < 8


def test_query_equals_the_rules(spark):
    got = secret_scan.op11_secret_scan(spark, SF)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = by_rules(texts[r.doc_id])
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert ",".join(p for p in r.spans.split(",") if not p.startswith("literal")) == line
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for kind, *_ in base) for k in RULES)
