"""Plans: no nested-loop joins, no single-task exchange of rows, pruned scans."""

import re

import pytest

import __spark_entry__ as entry_file
from linkloom.plans.link_queries import POLICY
from linkloom.operators import links
from linkloom.operators.policy import policy_table

SF = "/root/testdata/sf0.001"


def plan(spark, name, sf=SF):
    df = entry_file.queries()[name](spark, sf)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for s in entry_file.LIBRARY for n in s.QUERIES))
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["page_corpus", "dedupe_urls", "first_seen_rank", "chunk_urls", "number_lines"])
def test_rows_never_meet_in_one_task(spark, name):
    assert "SinglePartition" not in plan(spark, name)


@pytest.mark.parametrize("name", ["page_corpus", "dedupe_urls", "dedupe_host_path"])
def test_dedup_limits_before_its_only_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == 1
    limit = [m.start() for m in re.finditer("WindowGroupLimit", text)]
    assert len(limit) == 2 and limit[0] < text.index("Exchange hashpartitioning") < limit[1]


def test_html_is_not_shuffled_by_the_flagship(spark):
    text = plan(spark, "page_corpus")
    above = text[: text.index("Exchange hashpartitioning")]
    assert "html" not in above


@pytest.mark.parametrize("name", ["vet_links", "deny_domains", "dedupe_urls", "pending_urls", "chunk_urls"])
def test_url_queries_do_not_read_html(spark, name):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name))
    assert scans and all("html" not in s for s in scans)


def test_html_is_not_shuffled_by_scraping(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(spark, "scrape_corpus")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "html" not in line


def test_small_policy_joins_map_side(spark):
    text = plan(spark, "deny_domains")
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 2


def test_large_policy_is_not_broadcast_by_hint(spark, monkeypatch):
    monkeypatch.setattr(links, "BROADCAST_ROWS", 1)
    urls = spark.read.parquet(f"{SF}/pages.parquet").select("url")
    df = links.deny_domains(urls, policy_table(spark, POLICY))
    assert "strategy=broadcast" not in df._jdf.queryExecution().analyzed().toString()


def test_json_is_parsed_once(spark):
    df = links.parse_submissions(spark.range(3).selectExpr("cast(id as string) as value")).filter("status = 'hit'")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1


def test_token_lengths_read_no_ids(spark, tmp_path):
    from linkloom.operators import tokens as K

    path = str(tmp_path / "encoded")
    spark.createDataFrame([("a", [1, 2], 2)], "path string, ids array<int>, n_tokens bigint").write.parquet(path)
    text = K.pack_tokens(spark.read.parquet(path), min_length=1)._jdf.queryExecution().executedPlan().toString()
    assert all("ids" not in s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text))
