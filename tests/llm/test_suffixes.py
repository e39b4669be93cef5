"""Repeated bytes against a plain model; the suffix sort against sorted slices."""

import hashlib
import random

import numpy as np
import pytest

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm import suffixes as S

LAST = 2**63 - 1


def model(rows, window):
    """Rows of (doc_id, text); rows equal in both are one document."""
    docs = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    order = sorted({(oid, S.text_key(b)[0], b) for oid, b in docs})
    first = {}
    for place, (_, _, b) in enumerate(order):
        for i in range(len(b) - window + 1):
            first.setdefault(b[i : i + window], (place, i))
    out = []
    for (doc_id, _), (oid, b) in zip(rows, docs):
        place = order.index((oid, S.text_key(b)[0], b))
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - window + 1):
            if first[b[i : i + window]] != (place, i):
                gone[i : i + window] = True
        # A copy of a text with a smaller doc_id goes whole, as every window of it does.
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(docs, window=100, seed=76):
    return sorted((tuple(r) for r in S.repeated_bytes(docs, window, seed).collect()), key=repr)


@pytest.mark.parametrize("text", [b"abcab" * 60, b"z" * 300, bytes(random.Random(1).choices(b"ab", k=700)), b"x" * 99])
@pytest.mark.parametrize("window", [100, 20, 5])
def test_suffix_sort(text, window):
    buffer = S.Buffer([(1, 5, 0, text), (0, 7, 10, text[3:]), (1, 5, 2, text[2:])], window)
    at = list(zip(buffer.oid.tolist(), buffer.key.tolist(), buffer.start.tolist()))
    assert len(set(at)) == len(at) and at == sorted(at)
    slices = [buffer.data[a : a + window].tobytes() for a in buffer.at]
    seen, want = set(), []
    for row, piece in enumerate(slices):
        if piece in seen:
            want.append(row)
        seen.add(piece)
    assert sorted(buffer.repeated().tolist()) == want


def test_collisions_are_sorted_again(monkeypatch):
    """With hashes that call everything equal the order fails the comparison of bytes."""

    class Blind(S.Prefixes):
        def __init__(self, data, base=0):
            super().__init__(data, base)
            self.blind = base == 0

        def of(self, starts, sizes):
            return np.zeros(len(starts), np.uint64) if self.blind else super().of(starts, sizes)

    text = bytes(random.Random(2).choices(b"ab", k=500))
    want = sorted(S.Buffer([(0, 0, 0, text)], 12).repeated().tolist())
    monkeypatch.setattr(S, "Prefixes", Blind)
    assert sorted(S.Buffer([(0, 0, 0, text)], 12).repeated().tolist()) == want


@pytest.mark.parametrize("chunk", [64, 1 << 20])
def test_anchors(monkeypatch, chunk):
    """Every window holds an anchor, and equal windows hold the same ones."""
    monkeypatch.setattr(S, "CHUNK", chunk)
    data = np.frombuffer(bytes(random.Random(3).choices(b"abc", k=90)) * 4 + b"q" * 60, np.uint8)
    places = set(S.anchors(data, 30, 20).tolist())
    of = {}
    for i in range(len(data) - 29):
        inside = tuple(p - i for p in range(i, i + 11) if p in places)
        assert inside
        of.setdefault(data[i : i + 30].tobytes(), []).append(inside)
    # Another window may pick further seeds in it; one is shared by all.
    assert all(set.intersection(*map(set, sets)) for sets in of.values())
    assert S.anchors(data[:29], 30, 20).tolist() == []


@pytest.mark.parametrize(("window", "seed"), [(100, 76), (20, 16), (6, 1)])
def test_edge_rows(spark, window, seed):
    rows = edge_rows() + [(LAST, "t" * 130), (None, "t" * 131), (20, "é" * 90), (21, "xé" + "é" * 90)] + [tuple(edge_rows()[10])]
    docs = spark.createDataFrame([(i, t, "x", "y", None, "z", None, None, "s", "en", None) for i, t, *_ in rows], EDGE_SCHEMA)
    assert run(docs.repartition(4), window, seed) == model([r[:2] for r in rows], window)
    assert run(docs.limit(0), window, seed) == []


@pytest.mark.parametrize(("rows", "windows", "most", "ids"), [(50, 40, 4096, 9999), (1 << 20, 1 << 18, 4096, 0), (50, 40, 2, 9999), (1 << 20, 1 << 18, 0, 9999)])
def test_shared_passages(spark, monkeypatch, rows, windows, most, ids):
    """In small and large blocks, with few and with all anchors sorted in blocks, ids broadcast or not."""
    for name, value in (("ROWS", rows), ("WINDOWS", windows), ("MOST_CONTEXTS", most), ("MOST_IDS", ids)):
        monkeypatch.setattr(S, name, value)
    rng = random.Random(11)
    line = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    passages = [line(rng.randint(100, 260)) for _ in range(8)]
    table = []
    for _ in range(150):
        text = ""
        for _ in range(rng.randint(0, 3)):
            text += line(rng.randint(0, 150)) + rng.choice(passages)[rng.randint(0, 30) : rng.randint(90, 260)]
        table.append((rng.randrange(120), text))
    table += [(500 + i, line(i % 5) + passages[0] + line(3)) for i in range(30)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    assert run(docs) == model(table, 100)


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(6)
    got = run(docs)
    assert got == model([(r.doc_id, r.text) for r in docs.collect()], 100)
    assert sum(r[2] for r in got) > 0


def test_kept_text(spark):
    shared = "".join(random.Random(5).choices("abcdef", k=130))
    rows = [(1, "A" + shared), (2, "é" + shared + "C"), (3, "A" + shared), (4, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept) for r in S.repeated_bytes(docs, with_text=True).collect()}
    assert got == {1: (0, 0, None), 2: (130, 1, "éC".encode()), 3: (131, 1, None), 4: (0, 0, None)}
