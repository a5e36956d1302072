"""Personal data and secrets: base spans against the plain expressions, added kinds, edge rows."""

import base64
import json
import random
import re
import zlib

from fanwrite.llm import pii, secrets

LONG = "word " * 200_000


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_personal(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(pii.BASE[k], s, e) for s, k, e in sorted(out)]


def base_secrets(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.IGNORECASE | re.ASCII) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(secrets.BASE[k], s, e) for s, k, e in sorted(out)]


def fuzz(parts, n=8000):
    rnd = random.Random(7)
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_base_personal_data_equals_the_expressions(spark, sf_small):
    texts = [r[0] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect() if r[0]]
    parts = ["a", ".", "@", "-", "1", "55", "0255", "+", "(", ")", " ", "é", "٣", "4242 4242", "@b.c", "9.9.9.9", "+1 202", "\n"]
    for text in [*texts, *fuzz(parts), "1" * 5000 + ".1.1.1", "a" * 9000 + "@", "+" * 3000 + "1"]:
        assert [s for s in pii.find(text) if s[0] in pii.BASE] == base_personal(text), text[:200]


def test_base_secrets_equal_the_expressions(spark, sf_small):
    texts = [r[0] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect() if r[0]]
    parts = ["pass", "word", "token", "TOKEN", "=", ":", " ", '"', "'", "AKIA", "A1", "0a", "ſecret", "secret", "api", "_", "key", "ff00" * 8, "deadbeef", "é", "K"]
    for text in [*texts, *fuzz(parts), "a" * 31, "a" * 32, "g" + "a" * 32 + "g" + "b" * 63, "token=" * 2000]:
        assert [s for s in secrets.find(text) if s[0] in secrets.BASE] == base_secrets(text), text[:200]


def test_added_personal_kinds_are_validated():
    def found(text):
        return [(k, text[s:e]) for k, s, e in pii.find(text) if k not in pii.BASE]

    assert found("IBAN: DE89 3704 0044 0532 0130 00 and more") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert found("IBAN DE88370400440532013000") == []
    assert found("see https://joe:pw@host.example/x") == [("login", "joe:pw")]
    assert found("Account no: 12345678, account of 1234567890") == [("account", "12345678")]
    assert found("on account of the weather, ibang") == []
    for cue in ("Konto ", "KONTO Nr. ", "Kontonummer: ", "cuenta ", "cuenta número ", "compte: ", "Passport no. ", "pasaporte nº "):
        assert found(f"x {cue}12345678.") == [("account", "12345678")], cue
    assert found("Kontoauszug 12345678, compter 12345678, IBAN Nr. DE89370400440532013000") == [("iban", "DE89370400440532013000")]


def test_added_secrets_need_their_checksum():
    body, digits, value = "abcDEF0123456789abcDEF01234567", secrets._DIGITS62, zlib.crc32(b"abcDEF0123456789abcDEF01234567")
    check = ""
    for _ in range(6):
        value, d = divmod(value, 62)
        check = digits[d] + check
    good, bad = f"ghp_{body}{check}", f"npm_{body}000000"
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'none'})}.{part({'sub': 'x'})}.c2ln"
    pem = "-----BEGIN RSA PRIVATE KEY-----\nAAAA\n-----END RSA PRIVATE KEY-----"
    text = f"{good} {bad} {jwt} eyJub3Rqc29u.eyJub3Rqc29u.x {pem} -----BEGIN PRIVATE KEY-----"
    assert [(k, text[s:e]) for k, s, e in secrets.find(text) if k not in secrets.BASE] == [("github", good), ("jwt", jwt), ("pem", pem)]


def test_encrypted_keys_and_deep_tokens():
    pem = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\nAAAA\nBB==\n-----END RSA PRIVATE KEY-----"
    other = "-----BEGIN ENCRYPTED PRIVATE KEY-----\nAAAA\n-----END ENCRYPTED PRIVATE KEY-----"
    assert [(k, s) for k, s, _ in secrets.find(pem + " " + other) if k == "pem"] == [("pem", 0), ("pem", len(pem) + 1)]
    part = lambda x: base64.urlsafe_b64encode(x.encode()).decode().rstrip("=")
    deep = part('{"a":' * 60_000 + "1" + "}" * 60_000)
    assert secrets.find(f"{deep}.{deep}.x") == []
    good = f"{part('{"a":1}')}.{part('{"b":2}')}.c2ln"
    assert [(k, s) for k, s, _ in secrets.find(f"{deep}.x {'eyJ' * 50} {good}")] == [("jwt", len(deep) + len(".x ") + 150 + 1)]


def expression_tokens(text):
    """Tokens by one expression, as it stands."""
    found = []
    for m in re.finditer(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+", text):
        if secrets.json_object(m[1]) and secrets.json_object(m[2]):
            found.append(("jwt", m.start(), m.end()))
    return found


def test_tokens_equal_the_expression():
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    parts = [part({"a": 1}), part({"bb": [2]}), "eyJ", ".", ".", " ", "x", "-", "eyj", "EYJ"]
    for text in fuzz(parts, 20000):
        assert [x for x in secrets.find(text) if x[0] == "jwt"] == expression_tokens(text), text


HOSTILE = [
    *("eyJ", "eyJ.", "eyJ.eyJ.", "token", "token=", "password ", "api_key: ", "AKIA", "akia", "ghp_", "npm_", "a", "0", "f0"),
    *("-----BEGIN PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----\n", "a:-----BEGIN PRIVATE KEY-----\n", "-----BEGIN ", "-----BEGIN A"),
    *("@", "a@", "a@b", "a@b.", "+", "+1", "+1(", "+1 ", "1.", "1.1.1.1", "1 ", "1-", "4242 ", "://", "://a", "://a:", "a:", "a:b@", "IBAN ", "IBAN DE89 ", "account ", "konto nr. 1"),
]


def test_time_grows_with_the_text_whatever_it_repeats():
    import time

    def seconds(find, text):
        start = time.process_time()
        find(text)
        return time.process_time() - start

    for cue in HOSTILE:
        for find in (pii.find, secrets.find):
            text = cue * (1_000_000 // len(cue))
            took = seconds(find, text)
            assert took < 4, (cue, find.__module__, took)  # a quadratic scan would take many minutes
            assert seconds(find, cue + " " * 1_000_000) < 4 and seconds(find, cue + "a" * 1_000_000) < 4, cue


def test_edge_rows(make_docs, no_docs):
    rows = [(1, None, None), (2, "", "en"), (3, LONG + "a@b.cd", "en"), (None, "a@b.cd", "en"), (4, "a@b.cd", "en"), (4, "a@b.cd", "en")]
    for operator, column in ((pii, "n_email"), (secrets, "n_hex")):
        got = [tuple(r) for r in operator.digests(make_docs(rows)).select("doc_id", column, "spans").collect()]
        email = operator is pii
        one = "email:0:6" if email else ""
        want = [(1, 0, ""), (2, 0, ""), (3, int(email), f"email:{len(LONG)}:{len(LONG) + 6}" if email else ""), (None, int(email), one), (4, int(email), one), (4, int(email), one)]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert operator.digests(no_docs).count() == 0


def test_masking_keeps_the_rest(make_docs):
    assert pii.mask("write to a.b@c.de or +1 202 555 0100.") == "write to <EMAIL> or <PHONE>."
    assert pii.mask("nothing here") == "nothing here" and pii.mask(None) is None and pii.mask("") == ""
    assert pii.mask("+4242 4242 4242 42 x") .endswith(" x") and "4242" not in pii.mask("+4242 4242 4242 42 x")
    docs = make_docs([(1, "a@b.cd!", "en"), (2, None, None)])
    got = pii.redact(docs)
    assert got.columns == docs.columns and [r["text"] for r in got.orderBy("doc_id").collect()] == ["<EMAIL>!", None]
