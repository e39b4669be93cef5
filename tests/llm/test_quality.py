"""The byte network: held-out accuracy, and that no window of a document is missed."""

import zlib

import numpy as np
import pytest

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_every_window_is_seen(monkeypatch):
    net = Q.Network.initial(3)
    text = "".join(chr(97 + i * i % 26) for i in range(1000)) + "é!"
    steps = Q.as_steps(text)
    both = np.concatenate([net.head, net.tail], axis=1)
    found = net.embed[steps].reshape(len(steps), -1) @ both
    want = (found[:-1, : Q.FILTERS] + found[1:, Q.FILTERS :]).max(axis=0)
    for chunk in (8, 64, 1 << 14):
        monkeypatch.setattr(Q, "CHUNK", chunk)
        top, place = Q.strongest(net, steps)
        assert np.allclose(top, want)
        values = found[place, np.arange(Q.FILTERS)] + found[place + 1, np.arange(Q.FILTERS, 2 * Q.FILTERS)]
        assert np.allclose(values, want)
        pooled = np.tanh(np.maximum(want + net.bias, 0))
        p = 1 / (1 + np.exp(-(pooled @ net.weights)))
        assert abs(Q.probability(net, steps) - p) < 1e-6


def test_steps_cover_all_bytes():
    for n in (0, 1, 3, 4, 5, 8, 9):
        steps = Q.as_steps("x" * n)
        assert (steps == 120).sum() == n and steps.shape[0] * Q.STEP >= n + Q.STEP and len(steps) >= 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in Q.score_quality(docs, labels).collect()}
    assert len(got) == docs.count() == 1000
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in quality if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(i for i, r in got.items() if r.held_out) == sorted(
        i for i in got if zlib.crc32(str(i).encode()) % 5 == 0
    )
    assert np.mean([got[i].predicted == quality[i] for i in held]) >= 0.9
    good = [got[i].predicted for i in held if quality[i] == 1]
    assert np.mean(good) >= 0.93
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())


@pytest.mark.parametrize("labelled,want", [([], 0.5), ([(4, 1), (5, 1), (None, 0)], 1.0), ([(4, 0)], 0.0)])
def test_edge_rows(spark, labelled, want):
    docs = spark.createDataFrame(edge_rows(), EDGE_SCHEMA).repartition(3)
    free = [(i, q) for i, q in labelled if i is None or zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, q, 0) for i, q in free if i], "doc_id long, quality int, toxic int")
    got = Q.score_quality(docs, labels).collect()
    assert len(got) == len(edge_rows())
    if len(free) == len(labelled):
        assert all(abs(r.score - want) < 1e-9 for r in got)
    kept = Q.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got)
    assert Q.score_quality(docs.limit(0), labels).collect() == []
