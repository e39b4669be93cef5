"""Mixing: the distributed steps against plain numpy, and totals against targets."""

import numpy as np
import pytest

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm import mixing as M

SF = "/root/testdata/sf0.01"


def marked_table(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    shares = rng.dirichlet([0.4, 0.3, 0.3], n)
    tokens = rng.integers(0, 900, n)
    rows = [(i, int(t), [float(x) for x in p]) for i, (t, p) in enumerate(zip(tokens, shares))]
    return spark.createDataFrame(rows, "id long, __tokens long, __shares array<double>"), tokens, shares


def plain_rates(tokens, shares, target, max_rate, steps=20000):
    """Projected gradient without any help, long enough."""
    mass = tokens @ shares
    r = np.ones(len(tokens))
    for _ in range(steps):
        r = np.clip(r - shares @ (((tokens * r) @ shares - target) / mass), 0, max_rate)
    return r


@pytest.mark.parametrize("weights", [[1, 1, 1], [0.7, 0.2, 0.1], [0.05, 0.05, 0.9]])
def test_totals_match_targets(spark, weights):
    marked, tokens, shares = marked_table(spark)
    residuals = M.solve(marked.repartition(5), weights, 8.0)
    rates, _ = M.replay(shares, residuals, 8.0)
    target = np.array(weights) / sum(weights) * tokens.sum()
    assert (rates >= 0).all() and (rates <= 8).all()
    # The least distance that any rates reach, by the plain way.
    best = (tokens * plain_rates(tokens, shares, target, 8.0)) @ shares
    mass = tokens @ shares
    off = lambda totals: (((totals - target) ** 2) / mass).sum() / tokens.sum()
    assert off((tokens * rates) @ shares) <= off(best) + 1e-6
    got = {r.id: r["__rate"] for r in M.with_rates(marked, residuals, 3, 8.0).collect()}
    assert np.allclose([got[i] for i in range(len(tokens))], rates)


def test_partitions_leave_no_trace(spark):
    marked, _, _ = marked_table(spark)
    one, many = (M.solve(marked.repartition(k), [3, 2, 1], 8.0) for k in (1, 7))
    assert np.allclose(one, many)


def test_rates_of_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = M.label_domains(spark.read.parquet(f"{SF}/labels.parquet"))
    targets = {"clean": 0.8, "low": 0.15, "toxic": 0.05}
    rows = M.mixing_rates(docs, labels, targets).collect()
    assert len(rows) == docs.count()
    n = np.array([r.n_tokens for r in rows])
    rates = np.array([r.rate for r in rows])
    shares = np.array([[r.p_clean, r.p_low, r.p_toxic] for r in rows])
    totals = (n * rates) @ shares
    assert np.allclose(totals / totals.sum(), [0.8, 0.15, 0.05], atol=0.01)
    assert abs(totals.sum() / n.sum() - 1) < 0.01
    assert all(abs(r.copies - r.rate) < 1 for r in rows)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == len(text[r.doc_id].encode().split()) for r in rows)
    domain = {r.doc_id: r.domain for r in labels.collect()}
    guess = {r.doc_id: max(("clean", "low", "toxic"), key=lambda d: r[f"p_{d}"]) for r in rows}
    assert np.mean([guess[i] == d for i, d in domain.items()]) > 0.85


def test_edge_rows(spark):
    docs = spark.createDataFrame(edge_rows(), EDGE_SCHEMA).repartition(3)
    labelled = spark.createDataFrame(
        [(8, "a"), (9, "a"), (12, "b"), (12, "a"), (None, "b"), (13, "c")], "doc_id long, domain string"
    )
    rows = M.mixing_rates(docs, labelled, {"a": 1, "b": 2}).collect()
    assert len(rows) == len(edge_rows())
    assert all(abs(r.p_a + r.p_b - 1) < 1e-9 and r.rate >= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}
    none = M.mixing_rates(docs, labelled.limit(0), {"a": 1, "b": 1}).collect()
    assert all(abs(r.p_a - 0.5) < 1e-9 and abs(r.rate - 1) < 1e-5 for r in none)
    assert M.mixing_rates(docs.limit(0), labelled, {"a": 1, "b": 1}).collect() == []
    mixed = M.mix_documents(docs, labelled, {"a": 1, "b": 1}, "a")
    assert mixed.columns == docs.columns and mixed.count() <= len(edge_rows())


def test_copies_keep_the_mean(spark):
    rates = spark.range(20000).selectExpr("id as doc_id", "1.3d as rate")
    copies = [r.c for r in rates.select(M.copies_of(rates.rate, "doc_id").alias("c")).collect()]
    assert set(copies) == {1, 2} and abs(np.mean(copies) - 1.3) < 0.02


def test_an_unmet_target_is_told(spark, monkeypatch):
    """Overlapping posteriors take more steps than are left; that is said, with what is off."""
    import numpy as np

    from linkloom.llm import mixing

    rng = np.random.default_rng(4)
    shares = rng.dirichlet([14, 4, 2], 200)
    rows = [(int(n), s.tolist()) for n, s in zip(rng.integers(5, 90, 200), shares)]
    marked = spark.createDataFrame(rows, "__tokens long, __shares array<double>")
    monkeypatch.setattr(mixing, "STEPS", 3)
    with pytest.warns(RuntimeWarning, match="off by"):
        assert len(mixing.solve(marked, [0.9, 0.07, 0.03], 8.0)) == 3
