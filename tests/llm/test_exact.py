"""Exact groups against a plain model, with tables so small that buckets spill."""

import hashlib
import re

import pytest

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm.exact import ContentTable, exact_groups


def model(rows):
    groups = {}
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(norm, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for norm, members in groups.items():
        best = min(members)
        digest = hashlib.sha256(norm.encode()).hexdigest()
        kept = True
        for m in sorted(members):
            out.append((m[3], best[3], len(members), kept, digest))
            kept = False
    return sorted(out, key=repr)


@pytest.mark.parametrize("room", [1, 3000, 1 << 20])
def test_groups_of_edge_rows(spark, room):
    rows = edge_rows()
    docs = spark.createDataFrame(rows, EDGE_SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in exact_groups(docs, room).collect()), key=repr)
    assert got == model([r[:2] for r in rows])


def test_groups_of_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7)
    got = sorted((tuple(r) for r in exact_groups(docs, 40_000).collect()), key=repr)
    assert got == model([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    docs = spark.createDataFrame([], EDGE_SCHEMA)
    assert exact_groups(docs).collect() == []


def test_table_compares_contents(monkeypatch):
    from linkloom.llm import exact

    monkeypatch.setattr(exact.xxhash, "xxh64_intdigest", lambda content: 7)  # all hashes collide
    table = ContentTable(1 << 20)
    found = [table.find_or_add(b"%d" % (i % 50))[0] for i in range(200)]
    assert found == [i % 50 for i in range(200)]


def test_full_table_refuses_for_good():
    table = ContentTable(1)
    assert table.find_or_add(b"aa") == (0, True)
    assert table.find_or_add(b"bb") == (-1, False)
    assert table.find_or_add(b"aa") == (0, False)


@pytest.mark.parametrize("tables", [10, 60])
def test_levels_do_not_grow_with_the_data(spark, monkeypatch, tables):
    """Contents of so many tables: buckets are cut by their bytes, so two levels or three are enough."""
    from linkloom.llm import exact

    writes, plain = [], exact.written
    monkeypatch.setattr(exact, "written", lambda df: writes.append(1) or plain(df))
    n, room = tables * 20, 20 * 300
    docs = spark.range(n).selectExpr("id as doc_id", "rpad(cast(id as string), 100, 'x') as text").repartition(4)
    got = exact_groups(docs, room).collect()
    assert len(got) == n and all(r.kept and r.group_size == 1 for r in got)
    assert len(writes) <= 4
