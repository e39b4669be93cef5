"""Numbering, chunks, resumable runs and their stream."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import numbering, state, stats
from linkloom.streaming.resume import resume_stream

URLS = "month string, uid bigint, url string"


def test_ranks_equal_a_sort(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), n) for n in rng.sample(range(5000), 800)]
    df = spark.createDataFrame(rows, "file string, line bigint").repartition(7)
    got = {(r.file, r.line): r.uid for r in numbering.number_lines(df, "file", "line", rows=100).collect()}
    for file in ("a", "b", None):
        ordered = sorted(n for f, n in rows if f == file)
        assert [got[file, n] for n in ordered] == list(range(len(ordered)))


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunk_sizes(spark, size):
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("month"), F.col("id").alias("uid"))
    chunks = numbering.assign_chunks(df, size, prev=4, rows=50)
    for month, total in (("x", 100), ("y", 200)):
        counts = {r.chunk_id: r["count"] for r in chunks.filter(F.col("month") == month).groupBy("chunk_id").count().collect()}
        assert min(counts) == 5 and max(counts) == 4 + -(-total // size)
        assert all(counts[c] == size for c in counts if c != max(counts))
        assert sum(counts.values()) == total


def test_batches(spark):
    df = spark.range(250).select(F.format_string("f%d", "id").alias("path"))
    rows = numbering.batch_files(df, 100, digits=1).collect()
    assert sorted({(r.batch_id, r.pos) for r in rows}) == [(i // 100, i % 100) for i in range(250)]
    again = numbering.batch_files(df.repartition(3), 100, digits=2).collect()
    assert sorted(rows) == sorted(again)


def test_limit(spark):
    df = spark.range(10).withColumnRenamed("id", "uid")
    assert numbering.limit_pending(df).count() == 10
    assert sorted(r.uid for r in numbering.limit_pending(df, 2).collect()) == [0, 1]
    assert sorted(r.uid for r in numbering.limit_pending(df, 7, rows=3).collect()) == list(range(7))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 150_000])
def test_limits_count_rows_without_a_number_first(spark, n):
    df = spark.createDataFrame([(None, "a"), (7, "b"), (None, "c"), (-(10**18), "d"), (10**18, "e")], "uid long, url string")
    got = sorted(r.url for r in numbering.limit_pending(df, n).collect())
    assert got in {1: [["a"], ["c"]], 2: [["a", "c"]], 3: [["a", "c", "d"]], 4: [["a", "b", "c", "d"]]}.get(
        n, [["a", "b", "c", "d", "e"]]
    )


def test_no_row_is_lost_without_an_order_value(spark):
    df = spark.createDataFrame([("m", None), ("m", 3), (None, None), ("m", None)], "month string, uid long")
    assert sorted(r.u for r in numbering.number_lines(df, "month", "uid", name="u").collect()) == [0, 0, 1, 2]
    assert [r.chunk_id for r in numbering.assign_chunks(df, 10).collect()] == [1] * 4
    paths = spark.createDataFrame([(None,), ("x",), (None,)], "path string")
    assert sorted(r.pos for r in numbering.batch_files(paths, 10).collect()) == [0, 1, 2]
    seen = spark.createDataFrame([("k", 2016, None, "f", 1), ("k", 2016, 1, "f", None), ("k", None, 2, "f", 3)],
                                 "url_key string, year int, month int, file string, uid long")
    assert sorted(r.seen_rank for r in numbering.first_seen_rank(seen).collect()) == [1, 2, 3]


def test_lists_of_two_years_resume(spark, tmp_path):
    """From files to state: labels tell the same month of two years apart, and a limit goes last."""
    from linkloom.sources.lines import read_url_lists

    for year in (2016, 2017):
        (tmp_path / f"RS_{year}-01.xz.goodlinks.txt").write_text("".join(f"http://e.org/{year}/{i}\n" for i in range(6)))
    urls = read_url_lists(spark, str(tmp_path))
    assert {r.month for r in urls.collect()} == {"RS_2016-01", "RS_2017-01"}
    paths = str(tmp_path / "state"), str(tmp_path / "data")
    wanted = urls.select("month", "uid", "url")
    state.resume(wanted.filter("month = 'RS_2016-01'"), *paths, fetched, size=4, max_urls=5)
    assert state.pending_urls(urls, state.read_state(spark, paths[0])).count() == 7
    # Keys of another type are written as the state has them.
    state.resume(wanted.withColumn("uid", F.col("uid").cast("int")), *paths, fetched, size=4)
    state.resume(wanted, *paths, fetched, size=4)
    done = state.read_state(spark, paths[0])
    assert sorted((r.month, r.uid) for r in done.collect()) == [(f"RS_{y}-01", i) for y in (2016, 2017) for i in range(6)]


def test_scraping_twice_keeps_every_document(spark, tmp_path):
    from linkloom.plans.corpus import scrape_corpus
    from linkloom.sinks.tables import write_chunks

    pages = spark.range(7).select(
        F.lit("m").alias("month"), F.col("id").alias("uid"), F.concat(F.lit("http://e.org/"), "id").alias("url"),
        F.concat(F.lit("<p>one two three four "), "id", F.lit("</p>")).alias("html"),
    )
    done = spark.createDataFrame([], state.STATE_SCHEMA)
    path = str(tmp_path / "docs")
    for part in ("uid < 4", "uid < 7"):
        docs = scrape_corpus(pages.filter(part), done, size=2).cache()
        write_chunks(docs, path)
        done = done.union(docs.select("month", "uid", "chunk_id"))
    assert sorted(r.uid for r in spark.read.parquet(path).collect()) == list(range(7))


def url_frame(spark, n, month="RS_2016-01"):
    return spark.range(n).select(F.lit(month).alias("month"), F.col("id").alias("uid"), F.concat(F.lit("u"), "id").alias("url"))


def fetched(plan):
    text = F.when(F.col("uid") % 10 == 3, " ").otherwise(F.concat(F.lit("text "), "url"))
    return plan.withColumn("text", text)


def flaky(plan):
    return fetched(plan).withColumn("timed_out", F.col("uid") % 4 == 0)


def test_resume_twice_is_run_once(spark, tmp_path):
    paths = str(tmp_path / "state"), str(tmp_path / "data")
    urls = url_frame(spark, 45)
    first = state.resume(urls.filter("uid < 25"), *paths, fetched, size=10, rows=20)
    assert first == {"n_attempted": 25, "n_timed_out": 0, "n_content": 22}
    state.resume(urls, *paths, fetched, size=10, rows=20)
    last = state.resume(urls, *paths, fetched, size=10, rows=20)
    assert last == {"n_attempted": 0, "n_timed_out": 0, "n_content": 0}
    data, done = spark.read.parquet(paths[1]), state.read_state(spark, paths[0])
    assert sorted(r.uid for r in data.collect()) == list(range(45))
    assert sorted(r.uid for r in done.collect()) == list(range(45))
    docs = state.committed_documents(data, done)
    assert sorted(r.uid for r in docs.collect()) == [i for i in range(45) if i % 10 != 3]
    # The first run filled chunks 1-3, the second went on from there.
    assert {r.chunk_id for r in data.filter("uid >= 25").collect()} == {4, 5}
    report = {r.chunk_id: r for r in stats.chunk_report(data).collect()}
    assert (report[1].n_attempted, report[1].n_content, report[1].n_timed_out) == (10, 9, 0)


def test_timed_out_urls_stay_pending(spark, tmp_path):
    paths = str(tmp_path / "state"), str(tmp_path / "data")
    urls = url_frame(spark, 20)
    state.resume(urls, *paths, flaky, size=10, rows=20)
    left = state.pending_urls(urls, state.read_state(spark, paths[0]))
    assert sorted(r.uid for r in left.collect()) == [0, 4, 8, 12, 16]
    state.resume(urls, *paths, fetched, size=10, rows=20)
    docs = state.committed_documents(spark.read.parquet(paths[1]), state.read_state(spark, paths[0]))
    assert sorted(r.uid for r in docs.collect()) == [i for i in range(20) if i % 10 != 3]


def test_a_run_that_died_before_its_state_is_repeated_in_place(spark, tmp_path):
    urls = url_frame(spark, 30)
    state.resume(urls, str(tmp_path / "lost"), str(tmp_path / "data"), fetched, size=10, rows=20)
    state.resume(urls, str(tmp_path / "state"), str(tmp_path / "data"), fetched, size=15, rows=20)
    docs = state.committed_documents(spark.read.parquet(str(tmp_path / "data")), state.read_state(spark, str(tmp_path / "state")))
    assert sorted(r.uid for r in docs.collect()) == [i for i in range(30) if i % 10 != 3]


def test_nothing_pending_writes_no_state(spark, tmp_path):
    paths = str(tmp_path / "state"), str(tmp_path / "data")
    state.resume(url_frame(spark, 0), *paths, fetched)
    assert state.read_state(spark, paths[0]).count() == 0


def test_stream_takes_new_files_once(spark, tmp_path):
    source, args = str(tmp_path / "urls"), [str(tmp_path / n) for n in ("state", "data", "ckpt")]
    url_frame(spark, 12).write.parquet(source)
    resume_stream(spark, source, *args, fetched, size=5, rows=20).awaitTermination()
    url_frame(spark, 20, "RS_2016-02").write.mode("append").parquet(source)
    url_frame(spark, 15).write.mode("append").parquet(source)
    resume_stream(spark, source, *args, fetched, size=5, rows=20).awaitTermination()
    data = spark.read.parquet(args[1])
    assert sorted((r.month, r.uid) for r in data.collect()) == sorted(
        [("RS_2016-01", i) for i in range(15)] + [("RS_2016-02", i) for i in range(20)]
    )


def test_append_state_and_counts(spark):
    old = spark.createDataFrame([("m", 1), ("m", 2)], "month string, uid bigint")
    new = spark.createDataFrame([("m", 2), ("m", 3)], "month string, uid bigint")
    assert sorted(r.uid for r in state.append_state(old, new).collect()) == [1, 2, 3]
    docs = spark.createDataFrame([("a",), ("a",), ("b",)], "archive string")
    assert {tuple(r) for r in stats.archive_counts(docs).collect()} == {("a", 2, False), ("b", 1, False), (None, 3, True)}
    unnamed = docs.union(spark.createDataFrame([(None,)], docs.schema))
    assert {tuple(r) for r in stats.archive_counts(unnamed).collect() if r.archive is None} == {(None, 1, False), (None, 4, True)}


def test_shared_folder_is_named_off_local_mode(spark):
    from types import SimpleNamespace

    from linkloom.session import shared_folder

    def session(master, folder):
        conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(session(master, None))
