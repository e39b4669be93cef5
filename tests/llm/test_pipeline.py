"""Each stage of the pipeline against a plain model of it, on small tables."""

import corpus_pipeline as C
from linkloom.llm import quality as Q
from linkloom.llm import simhash as S
from linkloom.llm.queries import table
from linkloom.llm.shared import written
from test_decontam import model as contaminated
from test_sharding import check as check_shards
from test_simhash import model as grouped
from test_simhash import plain_print

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "benchmark", "mixing", "sharding"]

    first = written(C.quality(spark, docs, SF))
    net = Q.train(docs, table(spark, SF, "labels"))
    want = {r.doc_id for r in docs.collect() if Q.probability(net, Q.as_steps(r.text)) >= 0.3}
    assert first.columns == columns and {r.doc_id for r in first.collect()} == want

    second = written(C.near_duplicates(spark, first, SF))
    rows = [(r.doc_id, r.text) for r in first.collect()]
    least = {component for _, _, component in grouped(rows)}
    assert second.columns == columns and sorted(r.doc_id for r in second.collect()) == sorted(least)

    third = written(C.benchmark(spark, second, SF))
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    found = contaminated([(r.doc_id, r.text) for r in second.collect()], bench)
    assert third.columns == columns
    assert {r.doc_id for r in third.collect()} == {r[0] for r in found if not r[-1]}

    fourth = written(C.mixing(spark, third, SF))
    assert fourth.columns == columns
    ids = [r.doc_id for r in fourth.collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in third.collect()}
    labels = {r.doc_id: (r.quality, r.toxic) for r in table(spark, SF, "labels").collect()}
    clean = [r.doc_id for r in third.collect() if labels.get(r.doc_id) == (1, 0)]
    assert sum(i in set(ids) for i in clean) >= 0.9 * len(clean)

    last = C.sharding(spark, fourth, SF)
    assert set(columns) <= set(last.columns)
    texts = [(r.doc_id, r.text) for r in fourth.collect()]
    check_shards(last.collect(), texts, C.SHARDS)


def test_fingerprint_of_five_words():
    assert S.fingerprint("A b\tC", 3) == S.fingerprint("a b c", 5)
    assert S.fingerprint("a b c d") % 2**64 == plain_print("a b c d")


def test_stages_take_edge_rows_and_empty_tables(spark):
    from cases import EDGE_SCHEMA, edge_rows

    rows = edge_rows()
    docs = spark.createDataFrame(rows, EDGE_SCHEMA).repartition(3)
    for k, (name, stage) in enumerate(C.STAGES):
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, SF)
            got = out.collect()
            if k < 4:
                assert out.columns == docs.columns, name
                assert {tuple(r) for r in got} <= set(rows), name
            else:
                assert len(got) == given.count()
                assert len({(r.shard, r.slot) for r in got}) == len(got)
                assert {"uid", "fp", "text", "shard", "slot"} <= set(out.columns)
    near = C.near_duplicates(spark, docs, SF).collect()
    ids = [r.doc_id for r in near]
    # The blank ones are one group, and so are the rows of one text; the smallest id stays.
    assert sorted(i for i in ids if i in (1, 2, 3)) == [1]
    # A no-break space is no white space here, so 6 is a word of its own.
    assert ids.count(7) == 1 and ids.count(6) == 1 and -3 in ids and 4 not in ids and None not in ids
