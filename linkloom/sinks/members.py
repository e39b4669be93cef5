"""Archive members and their texts in buckets, so that joins on ``(month, fid)`` move no ``html``.

Both tables are hashed on the same keys into the same number of buckets when they are written.  A join
of the two then reads bucket by bucket: no exchange on either side, at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("month", "fid")
BUCKETS = 200


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: tuple = KEYS, buckets: int = BUCKETS, append: bool = True
) -> None:
    """Add rows to a bucketed table, which is made if it is not there.

    Rows are dealt out by the keys before they are written, so that a run adds one file to a bucket,
    and sorted by them within it.  This is the one shuffle of the rows; runs that read the table have
    none.  ``path`` must lie in a folder that all executors share.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and bucket_count(spark, table) != buckets:
        raise ValueError(f"{table} has {bucket_count(spark, table)} buckets, not {buckets}")
    (
        df.repartition(buckets, *keys)
        .write.mode("append" if append else "overwrite")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def bucket_count(spark: SparkSession, table: str) -> int:
    """Buckets of a table; 0 if it has none."""
    found = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return int(found.data_type) if found else 0


def bucketed_pending(spark: SparkSession, members: str, texts: str, keys: tuple = KEYS) -> DataFrame:
    """Members that have no row in ``texts``; neither side is exchanged, and members are not sorted.

    The keys of a bucket's texts are built into a hash table of their own task, and its members stream
    past it: ``html`` is read once and stays where it is read.  A member without a month or id matches
    nothing and stays pending.
    """
    if bucket_count(spark, members) != bucket_count(spark, texts):
        raise ValueError(f"{members} and {texts} differ in their buckets")
    done = spark.table(texts).select(*keys).hint("shuffle_hash")
    return spark.table(members).join(done, list(keys), "left_anti")


def extract_bucketed(
    spark: SparkSession, members: str, texts: str, path: str, buckets: int = BUCKETS, empty: bool = True
) -> int:
    """Texts of the members that have none yet, added to ``texts``; the number of rows added.

    With ``empty`` members without text are kept as rows with a null text, so that the next run does
    not extract them again.  A run that fails leaves no row of its own, and the next one makes them.
    """
    from linkloom.operators.pages import main_text

    pending = bucketed_pending(spark, members, texts)
    found = main_text(pending).select(*KEYS, F.when(F.length("text") > 0, F.col("text")).alias("text"), "word_count")
    if not empty:
        found = found.where("text is not null")
    before = spark.table(texts).count()
    write_bucketed(found, texts, path, buckets=buckets)
    return spark.table(texts).count() - before
