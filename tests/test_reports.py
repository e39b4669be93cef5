"""Reports that the writing job counts: right figures, and the data made once."""

import pytest
from pyspark.sql import functions as F

from linkloom.sinks import reports

MEMBERS = "month string, fid string, html string"


def counted(spark, df, column):
    """``df`` with its column passed through a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def look(value):
        calls.add(1)
        return value

    return df.withColumn(column, F.udf(look, "string").asNondeterministic()(column)), calls


def test_members_are_read_once_and_done_ones_not_extracted(spark, tmp_path):
    rows = [("m1" if i % 3 else "m2", f"f{i}", "<p>some text</p>" if i % 5 else "<script>x</script>") for i in range(60)]
    rows += [(None, "f1", "<p>a</p>"), ("m1", None, "<p>b</p>"), ("m1", "x", None), ("m9", "f1", "<p>c</p>")]
    done = [(m, f) for m, f, _ in rows[:60] if int(f[1:]) % 4 == 0] + [(None, "f1"), ("m1", "f4"), ("gone", "f")]
    pages, calls = counted(spark, spark.createDataFrame(rows, MEMBERS).repartition(5), "html")
    done = spark.createDataFrame(done, "month string, fid string")
    path = str(tmp_path / "texts")
    got = reports.extract_texts(pages, done, path, ["m1", "m2", "m3"])
    assert calls.value == len(rows)

    known = {tuple(r) for r in done.collect() if r.month is not None}
    pending = [r for r in rows if r[:2] not in known or r[0] is None]
    full = [r for r in pending if r[2] and "script" not in r[2]]
    for line in got:
        mine = lambda part: sum(line["month"] in (None, r[0]) for r in part)  # noqa: B023, E731
        assert line["n_total"] == mine(rows)
        assert line["n_done"] == mine(rows) - mine(pending)
        assert line["n_unparsable"] == mine(pending) - mine(full)
    assert [line["month"] for line in got] == ["m1", "m2", "m3", None]
    written = spark.read.parquet(path)
    assert sorted(map(str, written.select("month", "fid").collect())) == sorted(
        f"Row(month={m!r}, fid={f!r})" for m, f, _ in full
    )
    assert written.columns == ["fid", "text", "word_count", "month"]


def test_a_second_run_adds_what_is_new(spark, tmp_path):
    pages = spark.createDataFrame([("m1", f"f{i}", "<p>text</p>") for i in range(9)], MEMBERS)
    none = spark.createDataFrame([], "month string, fid string")
    path = str(tmp_path / "texts")
    reports.extract_texts(pages.filter("fid < 'f5'"), none, path)
    (line,) = reports.extract_texts(pages, spark.read.parquet(path), path)
    assert line == {"month": None, "n_total": 9, "n_done": 5, "n_unparsable": 0}
    assert sorted(r.fid for r in spark.read.parquet(path).collect()) == [f"f{i}" for i in range(9)]


def test_encoded_documents_are_made_once(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("path"), F.col("id").alias("n_tokens"))
    df = df.union(spark.createDataFrame([("?", None)], "path string, n_tokens bigint")).repartition(4)
    data, calls = counted(spark, df, "path")
    assert reports.write_encoded(data, str(tmp_path / "e"), 20) == {"n_omitted": 20, "n_total": 101}
    assert calls.value == 101 and spark.read.parquet(str(tmp_path / "e")).count() == 101


@pytest.mark.parametrize("empty", ["limit", "false", "local"])
def test_no_rows(spark, tmp_path, empty):
    df = spark.createDataFrame([("a", 1)], "path string, n_tokens bigint")
    df = {"limit": df.limit(0), "false": df.filter("1 = 0"), "local": spark.createDataFrame([], df.schema)}[empty]
    assert reports.write_encoded(df, str(tmp_path / "e")) == {"n_omitted": 0, "n_total": 0}
