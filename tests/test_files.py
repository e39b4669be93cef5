"""Readers and writers on small files."""

import bz2
import gzip
import io
import lzma
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from linkloom.plans.corpus import link_corpus
from linkloom.sinks import tables
from linkloom.sources import archives, dumps, lines

OPENERS = {"xz": lzma.open, "bz2": bz2.open, "gz": gzip.open, "json": open}


def write(path, data, kind):
    with OPENERS[kind](path, "wb") as f:
        f.write(data)
    return str(path)


@pytest.fixture
def dump_lines():
    rng = random.Random(3)
    return [b"" if i % 97 == 0 else b"x" * rng.randint(1, 60) + str(i).encode() for i in range(9000)]


@pytest.mark.parametrize("name", ["RS_v2_2005-06.xz", "RS_2006-01.bz2", "RS_2007-01.gz", "RS_2008-01.json", "RS_2009-01.bz2.part"])
def test_dumps_of_every_codec(spark, tmp_path, dump_lines, name):
    kind = "bz2" if ".bz2" in name else name.rsplit(".", 1)[-1]
    path = write(tmp_path / name, b"\n".join(dump_lines) + b"\n", kind)
    rows = dumps.read_submission_lines(spark, path).orderBy("line_no").collect()
    assert [r.line_no for r in rows] == list(range(len(dump_lines)))
    assert [r.value.encode() for r in rows] == dump_lines
    assert {r.src_file.rsplit("/", 1)[-1] for r in rows} == {name}


def test_mixed_dumps_and_odd_names(spark, tmp_path):
    folder = tmp_path / "with space %41"
    folder.mkdir()
    paths = [write(folder / "RS_a b.xz", b"1\n2", "xz"), write(folder / "RS_c.gz", b"3\n", "gz"), write(folder / "RS_e.xz", b"", "xz")]
    rows = dumps.read_submission_lines(spark, [p.replace("%", "%") for p in paths]).collect()
    assert sorted((r.line_no, r.value) for r in rows) == [(0, "1"), (0, "3"), (1, "2")]


@pytest.mark.parametrize("name", ["RS.zst", "RS.csv"])
def test_unknown_dumps_are_refused(spark, name):
    with pytest.raises(ValueError):
        dumps.read_submission_lines(spark, name)


def test_select_dumps(spark):
    names = ["RS_2016-01.xz", "RS_2017-01.xz", "RS_2016_2017.xz", "RS_2019-01.xz", "RS_2016-01.xz", "2017/RS_2020-01.xz"]
    df = spark.createDataFrame([(f"d/{n}",) for n in names], "path string")
    assert [r.path for r in dumps.select_dumps(df, 2016, 2017).collect()] == ["d/RS_2016-01.xz", "d/RS_2016_2017.xz", "d/RS_2017-01.xz"]
    assert [r.path for r in dumps.select_dumps(df, single_file="RS_2019-01.xz").collect()] == ["d/RS_2019-01.xz"]


def test_line_numbers_across_splits(spark, tmp_path):
    """Files are cut into many splits and several share a task; numbers stay per file."""
    rng = random.Random(9)
    want = {}
    for n, count in enumerate((3000, 1, 0, 700)):
        rows = ["" if i % 50 == 3 else f"http://e.org/{n}/{i}/" + "y" * rng.randint(0, 80) for i in range(count)]
        name = f"RS_2016-0{n + 1}.xz.goodlinks.txt"
        (tmp_path / name).write_text("".join(r + "\n" for r in rows))
        want |= {(f"RS_2016-0{n + 1}", i): r for i, r in enumerate(rows)}
    (tmp_path / "ignored.csv").write_text("x\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 7000)
    try:
        df = lines.read_url_lists(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 5
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.month, r.uid): r.url for r in rows} == want
    assert len(rows) == len(want) and {r.year for r in rows} == {2016}


def test_text_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo\n")
    (tmp_path / "b.txt").write_text("three")
    rows = lines.read_text_docs(spark, f"{tmp_path}/*.txt").collect()
    assert {r.path.rsplit("/", 1)[-1]: r.text for r in rows} == {"a.txt": "one\n\ntwo\n", "b.txt": "three"}


@pytest.mark.parametrize("kind", ["xz", "bz2", "gz"])
def test_archives(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(archives, "MEMBERS_PER_BATCH", 7)
    members = {f"{i:07d}-x.txt": f"page {i} é" * (i % 5) for i in range(40)}
    path = tmp_path / f"RS_2017-04-4_data.{kind}"
    with tarfile.open(path, f"w:{kind}") as tar:
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            tar.addfile(info, io.BytesIO(text.encode()))
    df = archives.read_archives(spark, str(tmp_path), glob="*_data.*")
    assert {r.member: r.content for r in df.collect()} == members
    names = archives.read_archives(spark, str(tmp_path), content=False)
    assert names.filter("content is null").count() == len(members)


def test_links_from_dump_to_lists(spark, tmp_path):
    def record(url, score=5):
        return b'{"url": "%s", "score": %d, "over_18": false}\n' % (url.encode(), score)

    early = write(tmp_path / "RS_2016-01.xz", record("http://e.org/a?x=1&amp;y=2") + b"junk\n" + record("http://e.org/b", 1), "xz")
    late = write(tmp_path / "RS_2016-02.bz2", record("http://e.org/a?y=2&x=1") + record("http://e.org/c"), "bz2")
    kept = link_corpus(dumps.read_submission_lines(spark, [late, early]))
    rows = sorted((r.year, r.month, r.uid, r.url) for r in kept.collect())
    assert rows == [(2016, 1, 0, "http://e.org/a?x=1&y=2"), (2016, 2, 1, "http://e.org/c")]


@pytest.mark.parametrize("codec", ["none", "gzip", "bzip2"])
def test_url_lists_keep_order(spark, tmp_path, codec):
    rows = [(f"2016-0{1 + i % 2}", i, f"http://e.org/{i}") for i in range(500)]
    random.Random(1).shuffle(rows)
    path = str(tmp_path / "out")
    tables.write_url_lists(spark.createDataFrame(rows, "month string, uid bigint, url string"), path, codec)
    for month in ("2016-01", "2016-02"):
        files = sorted((tmp_path / "out" / f"month={month}").glob("part-*"))
        read = [line for f in files for line in spark.read.text(str(f)).toPandas()["value"]]
        assert read == [u for m, _, u in sorted(rows, key=lambda r: r[1]) if m == month]
    with pytest.raises(ValueError):
        tables.write_url_lists(spark.createDataFrame(rows, "month string, uid bigint, url string"), path, "xz")


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_chunks(spark, tmp_path, fmt):
    rows = [("m", i // 10, i, None if i == 3 else "" if i == 4 else f"t{i}") for i in range(35)]
    df = spark.createDataFrame(rows, "month string, chunk_id bigint, uid bigint, text string")
    path = str(tmp_path / "out")
    tables.write_chunks(df, path, format=fmt)
    tables.write_chunks(df.filter("chunk_id = 1"), path, format=fmt)  # a rerun replaces its own chunk only
    back = spark.read.format(fmt).load(path)
    assert sorted(r.uid for r in back.collect()) == [i for i in range(35) if i not in (3, 4)]
    assert len(list((tmp_path / "out" / "month=m" / "chunk_id=1").glob("part-*"))) == 1


def test_texts_shards_and_counts(spark, tmp_path):
    texts = spark.createDataFrame([("m", "b", "x"), ("m", "a", "y")], "month string, fid string, text string")
    tables.write_text(texts, str(tmp_path / "t"))
    tables.write_text(texts.limit(1), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    shards = spark.createDataFrame([(0, 1, 2, [1]), (0, 0, 1, [2, 3])], "batch_id bigint, shard_id bigint, pos bigint, ids array<int>")
    tables.write_token_shards(shards, str(tmp_path / "s"))
    assert [r.ids for r in spark.read.parquet(str(tmp_path / "s")).orderBy("shard_id").collect()] == [[2, 3], [1]]
    docs = spark.createDataFrame([("a",), ("a",), ("b",)], "archive string")
    cache = spark.createDataFrame([("a", 9)], "archive string, n_docs bigint")
    out = str(tmp_path / "c")
    assert tables.write_counts(docs, cache, out)
    written = spark.read.parquet(out)
    assert {tuple(r) for r in written.collect()} == {("a", 9), ("b", 1)}
    assert not tables.write_counts(docs, written, str(tmp_path / "d"))


def test_cached_archives_are_not_opened(spark, tmp_path):
    from linkloom.plans.corpus import count_new

    for name in ("RS_2017-04-4_data.xz", "RS_2017-05-4_data.xz"):
        with tarfile.open(tmp_path / name, "w:xz") as tar:
            for i in range(3):
                tar.addfile(tarfile.TarInfo(f"{i}.txt"), io.BytesIO(b""))
    (tmp_path / "RS_2017-06-4_data.xz").write_bytes(b"broken")
    broken = f"file:{tmp_path}/RS_2017-06-4_data.xz"
    cache = spark.createDataFrame([(broken, 5)], "archive string, n_docs bigint")
    new = count_new(spark, str(tmp_path), cache)
    out = str(tmp_path / "counts")
    assert tables.add_counts(new, cache, out)
    assert sorted(r.n_docs for r in spark.read.parquet(out).collect()) == [3, 3, 5]
    assert not tables.add_counts(count_new(spark, str(tmp_path), spark.read.parquet(out)), cache, out + "2")


def test_sinks_run_their_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000, numPartitions=4).select(
        F.lit("m").alias("month"), F.col("id").alias("uid"), F.concat(F.lit("u"), "id").alias("url"),
        F.col("id").cast("string").alias("fid"), F.lit("archive").alias("archive"),
    ).mapInArrow(count, "month string, uid long, url string, fid string, archive string")
    cache = spark.createDataFrame([], "archive string, n_docs bigint")
    for n, write_rows in enumerate((
        lambda: tables.write_text(rows, str(tmp_path / "t")),
        lambda: tables.write_url_lists(rows, str(tmp_path / "u")),
        lambda: tables.write_counts(rows, cache, str(tmp_path / "c")),
    ), 1):
        write_rows()
        assert seen.value == 1000 * n


def test_files_without_a_month_are_rejects(spark):
    from linkloom.plans.corpus import undated

    line = '{"url": "http://e.org/a-page", "score": 5, "over_18": false}'
    df = spark.createDataFrame([("d/RS_x.xz", 0, line), ("d/RS_2016-01.xz", 1, line)], "src_file string, line_no long, value string")
    assert [(r.file, r.reason) for r in undated(df).collect()] == [("d/RS_x.xz", "no_month")]
    assert [(r.year, r.uid) for r in link_corpus(df).collect()] == [(2016, 1)]
