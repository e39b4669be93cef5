"""Ranked search against scoring every document, with few and many rounds, and long queries."""

import math
import random
from collections import Counter

import pytest

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm import ranking as R


def model(docs, items, top=20):
    counts = [(i, Counter(R.terms_of(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        scores = []
        for (i, c), n in zip(counts, lengths):
            if n:
                m = 75 + 25 * n * n_docs // n_terms
                score = sum(
                    times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * (10**9 * c[w] // (1000 * c[w] + 12 * m))
                    for w, times in Counter(R.terms_of(text)).items() if c[w]
                )
                if score > 0:
                    scores.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if null else i, -score))
    return sorted(out, key=repr)


def found(docs, items, top=20):
    return sorted((tuple(r) for r in R.search(docs, items, top).collect()), key=repr)


def test_terms():
    assert R.terms_of("Ab-c\x00É1 _x\x7f中\x80y") == [b"ab", b"c", "É1".encode(), b"x", "中\x80y".encode()]
    assert R.terms_of(None) == R.terms_of("- _") == []


def test_edge_rows(spark):
    rows = edge_rows()
    docs = spark.createDataFrame(rows, EDGE_SCHEMA).repartition(4)
    queries = [(1, "a b"), (2, None), (3, ""), (3, "a a b c w5 w9"), (None, "end word"), (4, "nowhere"),
               (5, "w1 " * 400 + "w2"), (1, "a b"), (6, "É w3 文")]
    items = spark.createDataFrame([(i, t, "x", "y") for i, t in queries], "item_id long, text string, doc_id string, n string")
    assert found(docs, items) == model([r[:2] for r in rows], queries)
    assert found(docs.limit(0), items) == [] and found(docs, items.limit(0)) == []
    assert R.search(docs.limit(0), items).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize(("layers", "growth", "bits", "words", "most"), [(18, 0.5, 62, 4, 10**6), (9, 0.0, 3, 2, 0), (1, 0.5, 62, 4, 10**6)])
def test_rounds(spark, monkeypatch, layers, growth, bits, words, most):
    for name, value in (("LAYERS", layers), ("GROWTH", growth), ("FIRST_SHARE", 0), ("BITS", bits), ("WORDS", words), ("MOST_CANDIDATES", most)):
        monkeypatch.setattr(R, name, value)
    monkeypatch.setattr(R, "_MET", [f"met{k}" for k in range(words)])
    rng = random.Random(3)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(common, k=rng.randint(0, 30)) + rng.choices(rare, k=rng.randint(0, 4)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # ties beyond the twentieth
    queries = [(i, " ".join(rng.choices(common, k=5) + rng.choices(rare, k=4))) for i in range(8)] + [(99, docs[7][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(queries, "item_id long, text string")
    assert found(table, items) == model(docs, queries)


def test_many_terms(spark, monkeypatch):
    """Beyond the bound nothing of the queries' size is broadcast, with the same result."""
    docs = [(i, f"t{i % 7} t{i % 11} x{i}") for i in range(60)]
    queries = [(1, "t1 t2 t3"), (2, "x5 t0")]
    monkeypatch.setattr(R, "MOST_TERMS", 2)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(table, spark.createDataFrame(queries, "item_id long, text string"), 5) == model(docs, queries, 5)


def test_test_table(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [[tuple(r) for r in t.collect()] for t in (docs.select("doc_id", "text"), items.select("item_id", "text"))]
    assert found(docs, items) == model(*rows)
