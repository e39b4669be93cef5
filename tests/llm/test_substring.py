"""Repeated passages against a plain model, for several windows and block sizes."""

import hashlib
import random

import pytest

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm import substring as S


def model(rows, window):
    first = {}
    docs = [(2**63 - 1 if i is None else i, (t or "").encode().split()) for i, t in rows]
    for oid, w in docs:
        for i in range(len(w) - window + 1):
            gram = tuple(w[i : i + window])
            first[gram] = min(first.get(gram, oid), oid)
    out = []
    for (doc_id, _), (oid, w) in zip(rows, docs):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < oid:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(docs, window=50):
    return sorted((tuple(r) for r in S.repeated_passages(docs, window).collect()), key=repr)


@pytest.mark.parametrize("period", sorted(S.COVERS))
def test_covers(period):
    cover = S.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert len(cover) * (len(cover) - 1) == period - 1


@pytest.mark.parametrize("window", [50, 20, 12, 3, 1])
def test_edge_rows(spark, window):
    rows = edge_rows()
    docs = spark.createDataFrame(rows, EDGE_SCHEMA).repartition(4)
    assert run(docs, window) == model([r[:2] for r in rows], window)


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_shared_passages(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rng = random.Random(11)
    passages = [[f"p{rng.randrange(40)}" for _ in range(rng.randint(40, 90))] for _ in range(8)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 3)):
            words += [f"x{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))]
            words += rng.choice(passages)[rng.randint(0, 5) :]
        rows.append((rng.randrange(100), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(docs) == model(rows, 50)


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(6)
    got = run(docs)
    assert got == model([(r.doc_id, r.text) for r in docs.collect()], 50)
    assert sum(r[2] for r in got) > 0
    assert run(docs.limit(0)) == []


def test_kept_text(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, "a " + shared), (2, "b\n" + shared + "  c d"), (3, "a " + shared), (4, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in S.repeated_passages(docs, with_text=True).collect()}
    assert got == {1: (0, None), 2: (60, "b c d"), 3: (61, None), 4: (0, None)}
