"""Secrets: formats against the plain patterns, the battery on random and on written tokens."""

import hashlib
import random
import re

import pytest

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm import secrets as S

PLAIN = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+"),
]


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN):
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        for m in re.finditer(pattern, text, flags):
            n = len(m[2] if kind == "assign" else m[0])
            if n >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{PLAIN[k][0]}:{a}:{b}" for a, k, b in sorted(spans))


def test_formats_equal_plain_patterns():
    rng = random.Random(4)
    pieces = ["password", "TOKEN", "api_key", "ApiKey", "secret", "tokEn", "ſecret", "toKen", "=", ":", " ",
              '"', "'", "AKIA", "AKIAAKIA", "0123456789abcdef", "deadbeef" * 3, "ABCDEFGH23", "é", "x.y-z", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        got = sorted((a, S.KINDS.index(k), b) for a, b, k in S.formats(text))
        assert got == plain(text), text


def random_token(rng, symbols, n):
    return "".join(rng.choice(symbols) for _ in range(n))


def test_battery_takes_random_and_rejects_patterns():
    rng = random.Random(9)
    for name in ("hex", "base62", "base32", "base64"):
        p = [S.battery(random_token(rng, S.ALPHABETS[name], 40), name) for _ in range(400)]
        assert sum(x < 0.05 for x in p) < 400 * 0.12
    assert S.battery("abababababababababababab01", "base62") < 1e-6
    assert S.battery("0123456789abcdef0123456789abcdef", "hex") < 0.01
    assert S.battery("aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "hex") < 1e-6


@pytest.mark.parametrize("token,name", [("0" * 20, "digits"), ("ab12" * 6, "hex"), ("AB12" * 6, "HEX"),
                                        ("QX27" * 6, "base32"), ("aZ0" * 8, "base62"), ("aZ0+" * 6, "base64"),
                                        ("aZ0_" * 6, "base64url"), ("a+_" * 8, None)])
def test_encodings(token, name):
    assert S.encoding_of(token) == name


def test_bounds_follow_the_step_up_rule():
    # 100 tests; 5 at p <= 1e-4 are fine at 1 %, as 1e-4 * 100 <= 0.01 * ... holds from bin 40 on.
    counts = [("s", 0, 95), ("s", 40, 5), ("t", 3, 10)]
    assert S.bin_bounds(counts, 0.01) == {"s": 40}
    assert S.bin_bounds([], 0.01) == {}


def docs_with_tokens():
    rng = random.Random(2)
    words = ["the", "house", "of", "reading", "stands", "near", "water", "Every", "morning", "people", "walk"]
    rows, planted = [], {}
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(200))
        if i % 10 == 0:
            token = random_token(rng, S.ALPHABETS["base62"], 44)
            planted[i] = (len(text) + 1, len(text) + 45)
            text += " " + token + " " + text
        elif i % 10 == 1:
            text += " " + "reading-house-of-the-water-people" + " some/long/path/of/words/there"
        rows.append((i, text))
    return rows, planted


def test_random_tokens_are_added(spark):
    rows, planted = docs_with_tokens()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in S.find_secrets(docs).collect()}
    for i, (a, b) in planted.items():
        assert got[i].spans == f"random:{a}:{b}"
    assert all(r.n_random == (i in planted) for i, r in got.items())


def test_edge_rows_and_table(spark):
    extra = [(50, 'see Password: "hunter2secret" and AKIA' + "A1" * 10, *(None,) * 9),
             (51, "x" * 100_000 + " token=" + "b" * 50_000, *(None,) * 9)]
    edge = spark.createDataFrame(edge_rows() + extra, EDGE_SCHEMA).repartition(3)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for docs in (edge, table):
        texts = docs.collect()
        got = S.find_secrets(docs).collect()
        want = []
        for r in texts:
            spans = plain(r.text or "")
            n = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
            want.append((r.doc_id, *n, hashlib.sha256(listed(spans).encode()).hexdigest()))
        assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
        for r in got:
            base = [s for s in r.spans.split(",") if s and not s.startswith("random")]
            assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
    assert S.find_secrets(edge.limit(0)).collect() == []


def put_to_test(text):
    return {text[a:b] for a, b, *_ in S.candidates(text)}


def test_parts_and_single_case_tokens_are_tested():
    hook = "https://h.example/my-app/hook/Xk29fPq0LmZ8vT4sRb7NcY1dWe6Ga3Hu"
    assert "Xk29fPq0LmZ8vT4sRb7NcY1dWe6Ga3Hu" in put_to_test(hook)
    for secret in ("wJalrXUtnFEMI+K7MDENG+bPxRfiCYEXAMPLEKEY", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY="):
        assert any(t.endswith(secret) for t in put_to_test("aws-key/" + secret))
    assert "Xk29fPq0-LmZ8vT4s_Rb7NcY1dWe6Ga3Hu" in put_to_test("a+b/Xk29fPq0-LmZ8vT4s_Rb7NcY1dWe6Ga3Hu")
    for n in (20, 44, 200):
        token = random_token(random.Random(n), S.ALPHABETS["lower"], n)
        assert put_to_test(f"see {token} here") == {token}


def test_joined_and_single_case_tokens_are_reported(spark):
    rng = random.Random(31)
    rows, planted = docs_with_tokens()[0], {}
    for i in range(2, 300, 10):
        secret = random_token(rng, S.ALPHABETS["lower" if i % 20 == 2 else "base62"], 160 if i % 20 == 2 else 44)
        text = rows[i][1] + (" " if i % 20 == 2 else " my-app/hook/") + secret
        planted[i] = (len(text) - len(secret), len(text))
        rows[i] = (i, text + " " + rows[i][1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.spans for r in S.find_secrets(docs).collect()}
    for lower in (True, False):  # a path before a secret may be taken with it
        own = {i: at for i, at in planted.items() if (i % 20 == 2) == lower}
        spans = {i: [tuple(map(int, s.split(":")[1:])) for s in got[i].split(",") if s] for i in own}
        found = sum(any(a - 12 <= c <= a and d == b for c, d in spans[i]) for i, (a, b) in own.items())
        assert found >= 0.9 * len(own), (lower, found, spans)


def test_intervals_tell_overlaps():
    import random

    from linkloom.llm.shared import Intervals

    rng = random.Random(8)
    spans = [(a, a + rng.randint(1, 9)) for a in (rng.randrange(400) for _ in range(60))]
    kept, held = Intervals(spans), list(spans)
    for _ in range(500):
        a = rng.randrange(420)
        b = a + rng.randint(1, 6)
        assert kept.touches(a, b) == any(x < b and a < y for x, y in held)
        if not kept.touches(a, b):
            kept.add(a, b)
            held.append((a, b))


def test_a_long_list_of_hashes_takes_linear_time(spark):
    import hashlib
    import time

    def seconds(n):
        text = "\n".join(hashlib.md5(b"%d" % i).hexdigest() for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        row = S.find_secrets(docs).collect()[0]
        assert row.n_hex == n
        return time.perf_counter() - start

    seconds(100)
    short, long = seconds(15_000), seconds(60_000)
    assert long < 12 * max(short, 1)
