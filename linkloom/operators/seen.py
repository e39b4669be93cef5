"""First sightings kept across runs: a table of the URL keys seen so far, in buckets of the key.

A run brings the URL lists of one or more new months.  Lists of earlier runs are not read again, and the
table of their keys is not moved: only the new keys are dealt out to its buckets, where each bucket's
old keys stream past a hash table of its new ones.  A run adds its own sightings under its own name, and
those rows are its result as well, so a run that is repeated replaces its rows and gives the same.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.urls import with_url_key
from linkloom.operators.dedup import ORDER, keep_first, split_unparsable
from linkloom.session import cut_lineage
from linkloom.sinks.members import bucket_count

BUCKETS = 200
SEEN_COLUMNS = ("url_key", "url", "year", "month", "file", "uid")
SEEN_SCHEMA = "url_key string, url string, year int, month int, file string, uid bigint, run string"


def create_seen(spark: SparkSession, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Make the table of sightings, in a folder that all executors share, if it is not there.

    Its number of buckets stays; a bucket of all URLs ever seen should fit a task's reading, not its
    memory.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({SEEN_SCHEMA}) USING parquet"
        f" OPTIONS (path '{path}') PARTITIONED BY (run)"
        f" CLUSTERED BY (url_key) INTO {buckets} BUCKETS"
    )


def sighted_before(seen: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """Keys of ``new`` that ``seen`` holds; ``seen`` is read in its buckets and neither moved nor sorted.

    The side that is built into hash tables is the new one, so a bucket of any age needs the memory of
    a run's share of keys.
    """
    # Dealt to as many parts as there are buckets: of two sides that differ, Spark would move the other.
    keys = new.select("url_key").repartition(buckets, "url_key").distinct().hint("shuffle_hash")
    return seen.select("url_key").join(keys, "url_key", "left_semi").distinct()


def dedupe_run(
    urls: DataFrame, table: str, run: str, mode: str = "full", url: str = "url"
) -> DataFrame:
    """First sightings among ``(file, year, month, uid, url)`` of one run, added to ``table``.

    A URL that an earlier run has seen is left out, whatever its month: runs are taken in order, so
    months should be as well.  Runs go by name, which sorts them: those with a smaller name are
    earlier.  Unparsable URLs are left out; ``split_unparsable`` lists them.
    """
    spark = urls.sparkSession
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"the name of a run may hold letters, digits, '_', '-' and '.': {run!r}")
    later = spark.table(table).where(F.col("run") > run).select("run").head(1)
    if later:
        raise ValueError(f"{table} holds the run {later[0].run!r}, which comes after {run!r}")
    parsable, _ = split_unparsable(urls.select("file", "year", "month", "uid", url), url)
    first = cut_lineage(keep_first(with_url_key(parsable, mode, url), ORDER))
    seen = spark.table(table).where(F.col("run") < run)
    # Made before the run is written, as a table cannot be read while it is written to.
    buckets = bucket_count(spark, table)
    before = cut_lineage(sighted_before(seen, first, buckets))
    fresh = first.join(before, "url_key", "left_anti").repartition(buckets, "url_key")
    view = f"run_{uuid.uuid4().hex}"
    fresh.select(
        "url_key", F.col(url).alias("url"), F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"), "file", F.col("uid").cast("bigint").alias("uid"),
    ).createOrReplaceTempView(view)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run = '{run}') SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return run_sightings(spark, table, run)


def run_sightings(spark: SparkSession, table: str, run: str) -> DataFrame:
    """What one run has seen first."""
    return spark.table(table).where(F.col("run") == run).select(*SEEN_COLUMNS)
