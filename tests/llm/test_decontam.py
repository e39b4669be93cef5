"""Contamination against a plain model; slices and both ways of removal."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cases import EDGE_SCHEMA, edge_rows
from linkloom.llm.decontam import contamination, cut_words, decontaminate, merged

BENCH = [
    (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (1, None), (2, ""), (3, "..."), (4, "One"),
    (5, " ".join(f"W{i}" for i in range(20, 34))), (5, "w1, w2 w3-w4 w5 w6 w7 w8 w9 w10"),
    (10, "a b!"), (11, "É nothing here"), (12, "word " * 12),
]


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def model(docs, bench):
    grams = {}
    for item, text in bench:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if own := grams.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    items |= own
        ids = sorted(str(x) for x in items if x is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 4000])
def test_edge_rows(spark, slice_bytes):
    rows = edge_rows()
    docs = spark.createDataFrame(rows, EDGE_SCHEMA).withColumn("item_id", F.lit("q")).repartition(4)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = contamination(docs, bench, slice_bytes=slice_bytes).collect()
    want = model([r[:2] for r in rows], BENCH)
    assert sorted((tuple(r) for r in got), key=repr) == want
    clean = decontaminate(docs, bench, slice_bytes=slice_bytes)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r[-1] for r in want)
    cut = decontaminate(docs, bench, "spans", slice_bytes=slice_bytes)
    left = {r.doc_id: r.text for r in cut.collect() if r.doc_id in (4, 5, 7, 11, 15)}
    assert left[4] == " c d" and left[5] == "ab cd" and left[11] == "" and left[15] == "z" * 20000
    assert cut.count() == len(rows)


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = sorted((tuple(r) for r in contamination(docs, bench).collect()), key=repr)
    want = model(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]
    )
    assert got == want and any(r[-1] for r in want)
    assert contamination(docs.limit(0), bench).collect() == []
    assert not any(r.contaminated for r in contamination(docs, bench.limit(0)).collect())


def test_bad_mode(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        decontaminate(docs, docs, "everything")


def test_ranges():
    assert merged([5, 9, 0, 3, 2, 5, 20, 21]) == [0, 9, 20, 21]
    assert cut_words("Ab, c-é (d) e.", [1, 3]) == "Ab,  (d) e."
    assert cut_words("a b", [0, 2]) == ""
