"""Shards found by pointers against the sequential rule."""

import random

import pytest

from linkloom.operators import packing, tokens

SCHEMA = "batch_id long, pos long, path string, n_tokens long"


def shards(df):
    return sorted((r.batch_id is None, r.batch_id or 0, r.pos, r.path, r.n_tokens, r.shard_id) for r in df.collect())


@pytest.mark.parametrize("limit", [30, 4000])
def test_pointers_equal_the_sequential_rule(spark, limit):
    rng = random.Random(limit)
    rows = []
    for batch, n in ((3, 160), (None, 70), (5, 1)):
        for pos in rng.sample(range(10_000), n):
            rows.append((batch, pos, f"f{pos}", rng.choice([0, 1, 2, limit, rng.randint(1, 60), 5 * limit])))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = shards(tokens.pack(df, limit))
    assert len({(w[1], w[5]) for w in want}) > 3
    assert shards(packing.pack_far(df, limit, rows=25)) == want


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack_far(empty, 10).columns == ["batch_id", "pos", "path", "n_tokens", "shard_id"]
    assert packing.pack_far(empty, 10).count() == 0


def test_buckets_bound_every_window(spark):
    """No group of rows that meets in a window is larger than a bucket allows."""
    df = spark.range(900).selectExpr("1L as batch_id", "id as pos", "cast(id as string) as path", "7L as n_tokens")
    seen = []
    plain = packing.running_total

    def watched(rows, by, bucket, *rest):
        seen.append(max(r["count"] for r in rows.groupBy(by, bucket).count().collect()))
        return plain(rows, by, bucket, *rest)

    packing.running_total = watched
    try:
        packing.pack_far(df, 100, rows=50).count()
    finally:
        packing.running_total = plain
    assert len(seen) == 3 and max(seen) <= 102  # a bucket of totals holds those of both kinds
