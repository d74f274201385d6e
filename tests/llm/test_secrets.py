import hashlib
import random
import re

from aerolake.llm import secrets

BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6, 2),
    ("access", re.compile("AKIA[A-Z0-9]+"), 20, 0),
    ("hex", re.compile("[0-9a-f]+"), 24, 0),
]
TOKENS = ["password", "PASSWD", "secret", "Token", "api_key", "apikey", "=", ":", " ", '"', "'", "=", "AKIA", "AKIAKIA", "ABCDEFGH12345678",
          "0123456789abcdef", "abc", "é", "\U0001f600", "x", "/", "-", "_", "\n", "deadbeef"]


def brute(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, least, group) in enumerate(BASE) for m in p.finditer(text or "") if m.end(group) - m.start(group) >= least]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def texts(n):
    rng = random.Random(1)
    return ["".join(rng.choice(TOKENS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_base_spans_against_regex():
    scanner = secrets.Scanner()
    for text in texts(8000):
        data = text.encode()
        got = [(secrets.RULES[k].kind, s, e) for s, e, k in secrets.code_points(data, scanner.spans(data)) if secrets.RULES[k].base]
        assert got == brute(text), text


def test_query_columns(table, odd_rows):
    rows = [*enumerate(texts(200)), *((None if i is None else i + 1000, t) for i, t in odd_rows)]
    got = sorted((tuple(r)[:5] for r in secrets.digest(secrets.scan(table(rows))).collect()), key=str)
    want = []
    for i, t in rows:
        spans = brute(t)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        want.append((i, *(sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex")), hashlib.sha256(joined.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_further_kinds(table):
    text = "é gh" + "p_" + "A1" * 18 + " -----BEGIN RSA PRIVATE KEY----- sk_" + "live_" + "a" * 15
    row = secrets.digest(secrets.scan(table([(1, text)]))).first()
    assert row.spans == "code_host:2:42,private_key:43:74"
    assert row.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_redact_keeps_columns(table):
    df = table([(1, "é password=abcdef1 z"), (2, None), (3, ""), (4, "clean"), (5, "token=deadbeefdeadbeefdeadbeef00")])
    out = secrets.redact(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "é [SECRET] z", 2: None, 3: "", 4: "clean", 5: "[SECRET]"}


def test_empty_table(table):
    assert secrets.digest(secrets.scan(table([]))).count() == 0
