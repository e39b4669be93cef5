"""Whitening against numpy, and the rows that are left out."""

import math

import numpy as np
import pytest

from linkloom.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, row string, x string, v string, task string, z string"


def whole(v):
    return v is not None and len(v) > 0 and all(e is not None and math.isfinite(e) for e in v)


def model(rows, components=4):
    """Per row: id and deviation; per row and component: the projection, up to its sign."""
    kept = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in rows if whole(v)]
    table = np.array([x for _, x in kept])
    fit = np.unique(table, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = int((e[:components] > e[0] * 1e-12).sum())
    z = (table - sums / n) @ u[:, :k] / np.sqrt(e[:k])
    return [i for i, _ in kept], n, ((n * table - sums) ** 2).sum(1), z, e[:k] / e.sum()


def check(rows, got, components=4):
    ids, n, deviation, z, explained = model(rows, components)
    assert got.n.unique().tolist() == [n]
    assert got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1
    for k in range(z.shape[1]):
        part = got[got.component == k + 1]
        assert part.explained.unique() == pytest.approx([explained[k]], rel=1e-9)
        want = sorted(zip(map(str, ids), deviation.tolist(), z[:, k].tolist()))
        for sign in (1, -1):
            have = sorted(zip(part.vec_id.astype("object").map(lambda i: str(None) if i != i or i is None else str(int(i))), part.deviation, sign * part.whitened))
            same = [h[:2] == w[:2] and abs(h[2] - w[2]) < 1e-8 for h, w in zip(have, want)]
            if len(have) == len(want) and all(same):
                break
        else:
            raise AssertionError(k)
    assert got.component.max() == z.shape[1]


def test_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding").collect()]
    check(rows, W.whiten(table).toPandas())


@pytest.mark.parametrize("block", [3, 1024])
def test_edge_rows(spark, monkeypatch, block):
    monkeypatch.setattr(W, "BLOCK_ROWS", block)
    monkeypatch.setattr(W, "BLOCKS_PER_TASK", 2)
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(40, 6)) * [4, 3, 2, 1, 0.5, 0]).tolist()
    vectors += [vectors[3], vectors[3], [-0.0] * 6]
    rows = list(enumerate(vectors)) + [
        (50, None), (51, []), (52, [1.0] * 5 + [None]), (53, [float("nan")] + [1.0] * 5),
        (54, [1.0] * 5 + [float("-inf")]), (7, vectors[5]),
    ]
    odd = [(60, [1.0, 2.0])]  # another length than most
    clash = [(i, v, "r", "x", None, "t", "z") for i, v in rows + odd]
    df = spark.createDataFrame(clash, SCHEMA).repartition(4)
    check(rows, W.whiten(df).toPandas())


def test_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert W.whiten(empty).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whiten(empty).count() == 0
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(3)], "vec_id long, embedding array<double>")
    assert W.whiten(same).count() == 0
    line = spark.createDataFrame([(i, [float(i), float(2 * i)]) for i in range(9)], "vec_id long, embedding array<double>")
    got = W.whiten(line).toPandas()
    assert got.component.unique().tolist() == [1] and got.explained.unique() == pytest.approx([1.0])
