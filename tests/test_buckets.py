"""Bucketed members and sightings: plans without an exchange, and runs one after another."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from linkloom.operators import dedup, numbering, seen, state
from linkloom.plans import corpus
from linkloom.sinks.members import bucket_count, bucketed_pending, extract_bucketed, write_bucketed


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def pages(spark, n):
    return spark.range(n).select(
        F.format_string("m%d", F.col("id") % 3).alias("month"), F.format_string("f%03d", "id").alias("fid"),
        F.when(F.col("id") % 10 == 4, F.lit("<script>x</script>")).otherwise(
            F.concat(F.lit("<p>text of "), "id", F.lit("</p>"))).alias("html"),
    )


def tables(spark, tmp_path):
    name = f"t{uuid.uuid4().hex}"
    return name, f"{name}_texts", str(tmp_path / "members"), str(tmp_path / "texts")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_of_members(spark, tmp_path, no_broadcast):
    members, texts, at, texts_at = tables(spark, tmp_path)
    write_bucketed(pages(spark, 60), members, at, buckets=4)
    write_bucketed(pages(spark, 20).select("month", "fid"), texts, texts_at, buckets=4)
    write_bucketed(pages(spark, 30).where("fid >= 'f020'").select("month", "fid"), texts, texts_at, buckets=4)
    pending = bucketed_pending(spark, members, texts)
    text = plan_of(pending)
    assert "Exchange" not in text and "Sort" not in text and "ShuffledHashJoin" in text
    assert sorted(r.fid for r in pending.collect()) == [f"f{i:03d}" for i in range(30, 60)]
    assert bucket_count(spark, members) == 4
    # The plain join of the same size moves the pages.
    assert "Exchange" in plan_of(state.pending_members(pages(spark, 60), pages(spark, 20)))


def test_buckets_must_agree(spark, tmp_path):
    members, texts, at, texts_at = tables(spark, tmp_path)
    write_bucketed(pages(spark, 6), members, at, buckets=4)
    write_bucketed(pages(spark, 6).select("month", "fid"), texts, texts_at, buckets=8)
    with pytest.raises(ValueError):
        bucketed_pending(spark, members, texts)
    with pytest.raises(ValueError):
        write_bucketed(pages(spark, 6), members, at, buckets=8)


@pytest.mark.parametrize("empty", [True, False])
def test_extraction_goes_on(spark, tmp_path, empty):
    members, texts, at, texts_at = tables(spark, tmp_path)
    write_bucketed(pages(spark, 20), members, at, buckets=4)
    schema = "month string, fid string, text string, word_count bigint"
    write_bucketed(spark.createDataFrame([], schema), texts, texts_at, buckets=4)
    first = extract_bucketed(spark, members, texts, texts_at, 4, empty)
    assert first == (20 if empty else 18)
    assert extract_bucketed(spark, members, texts, texts_at, 4, empty) == 0
    write_bucketed(pages(spark, 33).where("fid >= 'f020'"), members, at, buckets=4)
    extract_bucketed(spark, members, texts, texts_at, 4, empty)
    rows = spark.table(texts).where("text is not null").collect()
    assert sorted((r.fid, r.text) for r in rows) == [(f"f{i:03d}", f"text of {i}") for i in range(33) if i % 10 != 4]


def test_members_without_a_key_stay_pending(spark, tmp_path):
    members, texts, at, texts_at = tables(spark, tmp_path)
    rows = spark.createDataFrame([(None, "a", "x"), ("m", None, "y"), ("m", "b", "z")], "month string, fid string, html string")
    write_bucketed(rows, members, at, buckets=2)
    write_bucketed(rows.select("month", "fid"), texts, texts_at, buckets=2)
    assert sorted(r.html for r in bucketed_pending(spark, members, texts).collect()) == ["x", "y"]


def lists(spark, month, paths, file="a"):
    rows = [(2016, month, file, i, f"http://e.org/{p}") for i, p in enumerate(paths)]
    return spark.createDataFrame(rows, "year int, month int, file string, uid bigint, url string")


def test_months_equal_all_at_once(spark, tmp_path):
    table = f"s{uuid.uuid4().hex}"
    seen.create_seen(spark, table, str(tmp_path / "seen"), 4)
    months = {1: ["a", "b", "a", "c?x=1&amp;y=2"], 2: ["b", "d", "c?y=2&x=1", "[::"], 3: [], 4: ["d", "e", "a", "e"]}
    files = {m: lists(spark, m, p) for m, p in months.items()}
    for month, rows in files.items():
        seen.dedupe_run(rows, table, f"2016-{month:02d}")
    everything = files[1].union(files[2]).union(files[3]).union(files[4])
    want = sorted((r.month, r.uid, r.url) for r in dedup.dedupe_urls(everything).collect())
    got = [(r.month, r.uid, r.url) for r in spark.table(table).collect()]
    assert sorted(got) == want
    # A run that is repeated replaces its own rows.
    again = seen.dedupe_run(files[4], table, "2016-04")
    assert sorted((r.month, r.uid, r.url) for r in again.collect()) == [w for w in want if w[0] == 4]
    assert spark.table(table).count() == len(want)
    with pytest.raises(ValueError):
        seen.dedupe_run(files[2], table, "2016-02")
    with pytest.raises(ValueError):
        seen.dedupe_run(files[2], table, "a/b")


def test_the_seen_table_is_not_moved(spark, tmp_path, no_broadcast):
    table = f"s{uuid.uuid4().hex}"
    seen.create_seen(spark, table, str(tmp_path / "seen"), 4)
    seen.dedupe_run(lists(spark, 1, "abc"), table, "2016-01")
    new = lists(spark, 2, "bcd").selectExpr("url as url_key")
    text = plan_of(seen.sighted_before(spark.table(table), new, 4))
    join = text[text.index("ShuffledHashJoin") :]
    scan = [line for line in join.splitlines() if "Scan parquet" in line or "FileScan" in line]
    assert any("Bucketed: true" in line for line in scan)
    # Below the join the only exchange is that of the new keys.
    assert len(re.findall("Exchange", join)) == 1 and "Sort" not in join
    files = {f for f in spark.table(table).inputFiles()}
    assert all("run=2016-01" in f for f in files)


def test_ranks_of_equal_values_are_spread(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "x").alias("file"),
        F.when(F.col("id") % 3 > 0, F.lit(7)).alias("line"), F.col("id"),
    ).repartition(3)
    out = numbering.ranked_evenly(df, ["file"], ["line"], "n", partitions=8).cache()
    for file in ("x", None):
        rows = out.where(F.col("file").eqNullSafe(file)).orderBy("n").collect()
        assert [r.n for r in rows] == list(range(2000))
        lines = [r.line is not None for r in rows]
        assert lines == sorted(lines)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / 8
    total = numbering.ranked_evenly(df, [], ["line", "id"], "n", partitions=5).orderBy("n").collect()
    assert [(r.line is not None, r.id) for r in total] == sorted((r.line is not None, r.id) for r in total)
    assert [r.n for r in total] == list(range(4000))


def test_rows_without_a_number_are_dealt_out(spark):
    df = spark.range(5000).select(F.lit("m").alias("month"), F.lit(None).cast("long").alias("uid"), F.concat(F.lit("u"), "id").alias("url"))
    bucket = numbering.range_bucket(F.col("uid"), 100, numbering.row_hash(df))
    assert df.groupBy(bucket).count().count() > 2000
    chunks = numbering.assign_chunks(df.union(spark.createDataFrame([("m", -5, "v")], df.schema)), 1000)
    assert sorted(r["count"] for r in chunks.groupBy("chunk_id").count().collect()) == [1] + [1000] * 5
    assert chunks.where("uid = -5").first().chunk_id == 6


def test_scraping_keeps_pages_without_month_or_id(spark, monkeypatch):
    rows = [("m", 1, "u1"), (None, 2, "u2"), ("m", None, "u3"), ("m", None, "u4"), ("m", 5, "u5")]
    landed = spark.createDataFrame(rows, "month string, uid bigint, url string").withColumn("html", F.concat(F.lit("<p>words of "), "url"))
    landed = landed.union(spark.createDataFrame([("m", 6, "u6", "<script>1</script>")], landed.schema))
    done = spark.createDataFrame([("m", 5, 3)], state.STATE_SCHEMA)
    for mode in ("visible", "raw"):
        for limit in (10, 0):  # done keys are broadcast, and are not
            monkeypatch.setattr(corpus, "STATE_ROWS", limit)
            docs = corpus.scrape_corpus(landed, done, mode, size=2).collect()
            assert sorted(r.meta.url for r in docs) == ["u1", "u2", "u3", "u4"]
            # Four pages of the month are pending, one without text; chunks go on after the third.
            assert sorted((r.month or "", r.chunk_id) for r in docs) == [("", 1), ("m", 4), ("m", 4), ("m", 5)]


def test_done_pages_are_not_extracted(spark, monkeypatch):
    """Pages are counted where extraction takes them up."""
    seen_pages = spark.sparkContext.accumulator(0)
    landed = pages(spark, 40).select("month", F.expr("cast(substr(fid, 2) as bigint)").alias("uid"), F.lit("u").alias("url"), "html")
    done = landed.where("uid < 30").select("month", "uid", F.lit(1).cast("bigint").alias("chunk_id"))
    plain = corpus.extract_all

    def counted(df, mode):
        def run(batches):
            for batch in batches:
                seen_pages.add(batch.num_rows)
                yield batch

        return plain(df.mapInArrow(run, df.schema), mode)

    monkeypatch.setattr(corpus, "extract_all", counted)
    assert corpus.scrape_corpus(landed, done, size=5).select("text").collect()
    # Once for the texts and once for the counts of the chunks, which take no text.
    assert seen_pages.value <= 20
