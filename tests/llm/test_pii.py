"""Personal data: formats against the plain patterns, and what the trees add."""

import hashlib
import random
import re

import numpy as np

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm import pii as P


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(digits(m[0])) <= 15]
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_formats_equal_plain_patterns():
    rng = random.Random(8)
    pieces = ["a", "b.c", "@", "@x", ".", ".com", "_", "+", "-", " ", "(", ")", "1", "25", "256", "300", "0001",
              "4337166598464399", "1.2.3.4", "+1 (988) 555-2485", "é", "\n", "%", "x@y.z_w@v.u"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert P.formats(text) == plain(text), text


def test_long_runs_take_one_pass():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "@" * 300_000,
                 "+1" + " " * 300_000, "1 " * 150_000, "a@" * 150_000, "(at)" * 70_000):
        P.formats(text)
        assert sum(1 for _ in P.candidates(text)) >= 0


def test_trees_fit_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    score = P.Trees().fit(x[:2000], y[:2000]).scores(x[2000:])
    assert ((score > 0) == (y[2000:] == 1)).mean() > 0.95


def pii_docs():
    rng = random.Random(12)
    words = "the people walk near water every morning and read of houses".split()
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        d = "4" + digits(14)
        return next(d + c for c in "0123456789" if luhn(d + c))

    rows = []
    for i in range(900):
        thing = [
            f"{rng.choice(words)}.{digits(2)}@mail{digits(1)}.example.com", card(),
            ".".join(str(rng.randint(1, 255)) for _ in range(4)), f"+1 ({digits(3)}) 555-{digits(4)}",
            digits(16), f"{digits(3)}.{digits(3)}.{digits(3)}", f"{digits(2)}/{digits(2)}/{digits(4)} {digits(2)}:{digits(2)}",
        ][i % 7]
        rows.append((i, " ".join(rng.choices(words, k=30)) + " " + thing + " " + " ".join(rng.choices(words, k=9))))
    head = " ".join(words)
    rows += [(2001, f"{head} jo.doe (at) mail3.example.com {head}"), (2002, f"{head} {card()} {card()} {head}"),
             (2003, f"{head} version 1.2.3 of 12 pages {head}")]
    return rows


def test_spans_are_added(spark):
    rows = pii_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in P.find_pii(docs).collect()}
    texts = dict(rows)
    cut = lambda i: [texts[i][int(a) : int(b)] for _, a, b in (s.split(":") for s in got[i].spans.split(","))]
    assert cut(2001) == ["jo.doe (at) mail3.example.com"]
    assert got[2002].n_card == 0 and len(cut(2002)) == 2
    assert got[2003].spans == ""
    clean = [r for i, r in got.items() if i < 900 and i % 7 in (5, 6)]
    assert sum(r.n_added for r in clean) <= 0.02 * len(clean)
    assert "[email]" in P.redact(texts[0], got[0].spans) and "@" not in P.redact(texts[0], got[0].spans)
    assert P.redact("abcdef", "ip:1:3,card:2:4") == "a[ip]ef" and P.redact("a", "") == "a"


def test_edge_rows_and_table(spark):
    extra = [(60, "a@b.c, 10.0.0.1 " + "9" * 50_000, *(None,) * 9), (61, "é +49 30 1234567 é", *(None,) * 9)]
    edge = spark.createDataFrame(edge_rows() + extra, EDGE_SCHEMA).repartition(3)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for docs in (edge, table):
        got = P.find_pii(docs).collect()
        want = []
        for r in docs.collect():
            spans = P.formats(r.text or "")
            n = [sum(s[0] == k for s in spans) for k in P.KINDS]
            want.append((r.doc_id, *n, hashlib.sha256(listed(spans).encode()).hexdigest()))
        assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    assert P.find_pii(edge.limit(0)).collect() == []


def test_neighbours_in_a_run_are_proposed():
    proposed = lambda text: {(k, text[a:b]) for k, a, b in P.candidates(text)}
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400-0000-0000-009", "6011000000000004"] * 5
    assert {("card", c) for c in cards} <= proposed("pay " + " ".join(cards) + " now")
    phones = [f"(212) 555-01{i}" for i in range(23, 60)]
    for between in (" ", ", ", "/"):
        assert {("phone", p) for p in phones} <= proposed("tel " + between.join(phones))
    assert ("phone", "555-0123 45") not in proposed("tel 212 555-0123 45th")


def test_grouped_cards_on_one_line_are_added(spark):
    rows = pii_docs()
    line = "4111 1111 1111 1111 5500 0000 0000 0004 4012 8888 8888 1881"
    head = "the people walk near water every morning"
    docs = spark.createDataFrame([*rows, (3001, f"{head} {line} {head}")], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in P.find_pii(docs.repartition(4)).collect()}[3001]
    at = len(head) + 1
    assert spans == ",".join(f"card:{at + 20 * i}:{at + 20 * i + 19}" for i in range(3))


def learnt(spark):
    docs = spark.createDataFrame(pii_docs(), "doc_id long, text string")
    rows = docs.mapInArrow(P._examples(4000), P._EXAMPLE).distinct().collect()
    return P.learn([(r.kind, r.before, r.match, r.after, r.fixed) for r in rows])


def test_added_spans_equal_a_plain_choice(spark):
    """All candidates scored at once, and each taken that touches none of the surer ones."""
    judge = learnt(spark)
    rng = random.Random(6)
    pieces = ["4111 1111 1111 1111 ", "tel (212) 555-0123, ", "jane (at) site.org ", "10.0.0.7 ", "12 34 ", "x@y.com ",
              "5500-0000-0000-0004 ", "version 1.2.3.4 ", "words and words ", "+1 212 555 0123 "]
    for _ in range(60):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 25)))
        base = P.formats(text)
        loose = [c for c in dict.fromkeys(P.candidates(text)) if c not in base]
        score = {}
        for kind, a, b in loose:
            x = P.features(kind, text[max(0, a - P.CONTEXT) : a], text[a:b], text[b : b + P.CONTEXT])
            score[kind, a, b] = float(judge.probabilities(np.array([x], float))[0])
        taken, want = [(a, b) for _, a, b in base], []
        for kind, a, b in sorted(loose, key=lambda c: (-score[c], c[1], c[2], P.KINDS.index(c[0]))):
            if score[kind, a, b] >= judge.thresholds[kind] and not any(x < b and a < y for x, y in taken):
                taken.append((a, b))
                want.append((kind, a, b))
        assert P.added_spans(judge, text, base) == want


def test_a_long_run_of_numbers_is_scored_in_pieces(spark):
    """Linear in the text, with memory for what passes and no more."""
    import time
    import tracemalloc

    judge = learnt(spark)

    def cost(n):
        text = "1 " * n
        tracemalloc.start()
        start = time.perf_counter()
        P.added_spans(judge, text, P.formats(text))
        seconds, peak = time.perf_counter() - start, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return seconds, peak

    short, long = cost(1000), cost(5000)
    assert long[0] < 10 * max(short[0], 0.1) and long[1] < 60 << 20
