import random
import re
import time

import pytest

from tidewell.llm.secrets import BASE, RULES, Rule, compiled, find_secrets, in_code_points, parsed, redact

PATTERNS = {
    "assign": (re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def brute(text: str) -> list[tuple[int, int, int]]:
    out = []
    for k, rule in enumerate(BASE):
        pattern, group, least = PATTERNS[rule.kind]
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(out)


def test_same_as_regular_expressions():
    scanner, rng = compiled(RULES), random.Random(1)
    parts = ["token", "api_key", "APIKEY", "apikey", "Secret", "passwd", "password", "=", ":", " ", '"', "'", "AKIA", "abc", "0123456789abcdef", "ABCDEF1234567890", "é", "🙂", "x_y-z", ".", "\n", "deadbeef", "ghp_", "a" * 13]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        raw = text.encode()
        assert [x for x in in_code_points(raw, scanner.scan(raw)) if x[1] < len(BASE)] == brute(text), text


def test_overlap_with_used_up_text():
    text = b"token=api_key:token=abcdefghijkl token=secret:abcdefghijklmnop"
    assert compiled(RULES).scan(text) == brute(text.decode())


def test_added_kinds():
    kinds = {r.kind for r in RULES}
    text = b"-----BEGIN RSA PRIVATE KEY----- eyJhbGci.eyJzdWIi.c2ln ghp_" + b"A1" * 20 + b" xoxb-123456789012-abcdefgh sk_live_" + b"a9" * 12 + b" https://bob:pa55word@example.edu/"
    assert kinds - {"assign", "access", "hex"} == {RULES[k].kind for _, k, _ in compiled(RULES).scan(text)} - {"assign", "access", "hex"}


def test_private_keys_go_with_their_bodies(spark):
    body = "\n".join("MIIEow+/IBAAKC" * 4 for _ in range(12)) + "=="
    key = f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    old = f"-----BEGIN EC PRIVATE KEY-----\r\nProc-Type: 4,ENCRYPTED\r\nDEK-Info: AES-128-CBC,A0\r\n\r\n{body}\r\n-----END EC PRIVATE KEY-----"
    escaped = key.replace("\n", "\\n")
    texts = [f"é a {key} b", f"a {key}\n{key} b", f"a {old} b", f'"{escaped}"', "-----BEGIN PRIVATE KEY-----. No key here.", f"-----BEGIN PRIVATE KEY----- no. {key}"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in redact(rows).orderBy("doc_id").collect()]
    assert got == ["é a [secret] b", "a [secret]\n[secret] b", "a [secret] b", '"[secret]"', "[secret]. No key here.", "[secret] no. [secret]"]


def test_added_rules_like_regular_expressions():
    """Each rule's whole pattern, as Python reads it, gives the same spans."""
    scanner, rng = compiled(RULES), random.Random(2)
    parts = ["eyJ", "a", ".", "gh", "p_", "xox", "b-", "-", "sk_live_", "rk_", "://", "u", ":", "p", "@", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", " ", "Z9" * 12, "eyJa.eyJb."]
    wholes = [(k, re.compile(r.pattern.encode()), r) for k, r in enumerate(RULES) if k >= len(BASE) and not r.tail]
    for _ in range(4000):
        raw = "".join(rng.choices(parts, k=rng.randint(0, 20))).encode()
        want = sorted((m.start(), k, m.end()) for k, p, r in wholes for m in p.finditer(raw) if len(m[0]) >= r.least)
        assert [x for x in scanner.scan(raw) if x[1] >= len(BASE) and not RULES[x[1]].tail] == want, raw


def test_compiles_fast_and_refuses_what_it_does_not_know():
    began = time.process_time()
    compiled.__wrapped__((*RULES, Rule("x", "x[0-9]+", "x[0-9]")))
    assert time.process_time() - began < 5
    for bad in (".", "a{2", "(a", "a)", r"\d", "(?=a)", "é"):
        with pytest.raises(ValueError):
            parsed(bad)


def test_odd_tables(spark):
    long = "x " * 200_000 + "token=abcdefghijkl"
    rows = [(1, None, 1, "s"), (2, "", 2, "s"), (3, long, 3, None), (4, "é token=abcdefghijkl é", 4, "s"), (4, "é token=abcdefghijkl é", 4, "s"), (None, "AKIA" + "A" * 20, 5, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets int, spans string")
    got = sorted(((r.doc_id or 0, r.text and r.text[-10:], r.secrets, r.spans or "") for r in redact(docs).collect()))
    assert got == [(0, "[secret]", 5, "s"), (1, None, 1, "s"), (2, "", 2, "s"), (3, "x [secret]", 3, ""), (4, "[secret] é", 4, "s"), (4, "[secret] é", 4, "s")]
    assert redact(docs).schema == docs.schema and redact(docs.filter("false")).count() == 0
    found = find_secrets(docs, out="found")
    assert [(x.kind, x.start, x.end) for x in found.filter("doc_id = 3").first().found] == [("assign", 400_000, 400_018)]
    with pytest.raises(ValueError):
        find_secrets(docs)


@pytest.mark.parametrize("text", [b"eyJa" * 50_000, b"://a:" * 40_000, b"eyJa" * 20_000 + b".eyJb." + b"eyJa" * 20_000], ids=["dots that never come", "no at sign", "one match"])
def test_long_runs_are_linear(text):
    """Marks that stand close together in one run, of which each would read to its end."""
    began = time.monotonic()
    found = compiled(RULES).scan(text)
    assert time.monotonic() - began < 20 and len(found) == (b".eyJb." in text)


def test_runs_same_as_expression():
    """Reads that are cut short give what whole reads give: runs longer than what is worth keeping."""
    rng, jwt = random.Random(6), [r.kind for r in RULES].index("jwt")
    for _ in range(300):
        text = "".join(rng.choice(["eyJa", "eyJ" + "b" * 70, ".", " ", "c" * 90, ".eyJx."]) for _ in range(rng.randrange(1, 14)))
        want = [(m.start(), m.end()) for m in re.finditer(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", text)]
        assert [(a, b) for a, k, b in compiled(RULES).scan(text.encode()) if k == jwt] == want, text
