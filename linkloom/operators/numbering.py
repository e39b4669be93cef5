"""Numbering, chunking, ordering and limits without a global window.

A global rank would sort everything in one task.  Here the order is cut into buckets by a
rule that never decreases along it (a range of integers, a hash prefix).  Rows are ranked
inside their bucket, and a small table of bucket sizes gives each bucket its first rank.
Rows without a value in the order column come first, as in any sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from linkloom.session import cut_lineage

BUCKET_ROWS = 1_000_000


def ranked(
    df: DataFrame,
    by: list[str],
    bucket: Column,
    order: list,
    name: str = "rank0",
    carry: DataFrame | None = None,
    coarse: Column | None = None,
) -> DataFrame:
    """Add the 0-based rank of each row along ``order`` within ``by``.

    ``bucket`` must not decrease along ``order`` and should hold a bounded number of rows.
    ``carry`` is a table with one row per ``by``: its other columns are added as well, by way of
    the bucket table, so that the rows are not joined on ``by``, which may be skewed.
    ``coarse`` is a rule on ``_bucket`` that does not decrease with it: where sparse ids make many
    buckets, sizes are summed within coarse buckets first, and never in one task.
    """
    keys = [f"_by{i}" for i in range(len(by))]

    # Grouping takes nulls as equal but a join does not, so keys are strings without nulls.
    def with_keys(table):
        strings = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in by]
        return table.withColumns(dict(zip(keys, strings))) if by else table

    keyed = with_keys(df).withColumn("_bucket", bucket)
    local = keyed.withColumn(
        "_in_bucket", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    )
    sizes = keyed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    if coarse is None:
        starts = _running(sizes, keys, "_bucket", "_start")
    else:
        sizes = sizes.withColumn("_coarse", coarse)
        fine = _running(sizes, [*keys, "_coarse"], "_bucket", "_fine")
        groups = sizes.groupBy(*keys, "_coarse").agg(F.sum("_n").alias("_n"))
        starts = _join(fine, _running(groups, keys, "_coarse", "_before"), keys, "_coarse")
        starts = starts.select(*keys, "_bucket", (F.col("_fine") + F.col("_before")).alias("_start"))
    carried = []
    if carry is not None:
        carried = [c for c in carry.columns if c not in by]
        starts = starts.join(with_keys(carry).select(*keys, *carried), keys, "left")
    return (
        _join(local, starts, keys, "_bucket")
        .withColumn(name, (F.col("_start") + F.col("_in_bucket") - 1).cast("bigint"))
        .select(*df.columns, name, *carried)
    )


def _running(sizes: DataFrame, keys: list[str], bucket: str, name: str) -> DataFrame:
    """Rows before each bucket, within ``keys``."""
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    return sizes.withColumn(name, total).drop("_n")


def _join(rows: DataFrame, starts: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """An inner join on keys without nulls and a bucket that may be null."""
    renamed = starts.withColumnsRenamed({c: f"{c}_r" for c in (*keys, bucket)})
    same = F.col(bucket).eqNullSafe(F.col(f"{bucket}_r"))
    for key in keys:
        same = same & (F.col(key) == F.col(f"{key}_r"))
    return rows.join(renamed, same).drop(*(f"{c}_r" for c in (*keys, bucket)))


# At most so many buckets in a coarse one: 2 ** 22 of each cover all 64-bit ids.
COARSE_BITS = 22


def _coarse_range() -> Column:
    return F.shiftright(F.col("_bucket"), COARSE_BITS)


# Sub-buckets of the rows without an id.
NULL_BUCKETS = 4096
_LEAST = -(2**63)


def range_bucket(number: Column, rows: int = BUCKET_ROWS, spread: Column | None = None) -> Column:
    """Bucket of an integer id: at most ``rows`` distinct ids in each.

    ``spread`` is a hash that deals rows without an id to buckets before all others, where any order
    among them will do.
    """
    bucket = F.floor(number / rows)
    if spread is None:
        return bucket
    return F.coalesce(bucket, F.lit(_LEAST) + F.pmod(spread, F.lit(NULL_BUCKETS)))


def row_hash(df: DataFrame) -> Column:
    """A hash of what can be hashed in a row."""
    plain = [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]
    return F.xxhash64(*plain)


def ranked_evenly(
    df: DataFrame, by: list[str], order: list[str], name: str = "rank0", partitions: int | None = None
) -> DataFrame:
    """The same ranks for any order columns and any skew: equal and missing values are spread as well.

    Rows are dealt out by ranges that Spark draws from a sample of (by, order, random number), so that
    rows of equal order come in any order and fill several tasks.  They are written once in that order
    to the shared folder; a row's rank is its place in its task and the rows of its group in the tasks
    before, which a table with a row for each group and task tells.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by, *order, "_salt"]
    dealt = df.withColumn("_salt", F.rand(17)).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # A task's rows are numbered in their order; the number of the task is in the high bits.
    held = cut_lineage(dealt.drop("_salt").withColumn("_id", F.monotonically_increasing_id()))
    held = held.withColumn("_task", F.shiftright("_id", 33))
    runs = held.groupBy(*by, "_task").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    starts = runs.select(*(F.col(c).alias(f"_of_{c}") for c in (*by, "_task")), (before - F.col("_first")).alias("_shift"))
    same = F.col("_task") == F.col("_of__task")
    for column in by:
        same = same & F.col(column).eqNullSafe(F.col(f"_of_{column}"))
    rank = (F.col("_id") + F.col("_shift")).cast("bigint")
    return held.join(starts, same).select(*df.columns, rank.alias(name))


def hash_bucket(text: Column, digits: int = 3) -> Column:
    """Bucket of a string ordered by its md5: ``16 ** digits`` buckets of even size."""
    return F.substring(F.md5(text), 1, digits)


def number_lines(
    df: DataFrame, file: str, order: str, rows: int = BUCKET_ROWS, name: str = "uid"
) -> DataFrame:
    """0-based line number per file along an integer order column."""
    return ranked(df, [file], range_bucket(F.col(order), rows, row_hash(df)), [order], name)


def assign_chunks(
    df: DataFrame,
    size: int,
    prev: int | DataFrame = 0,
    by: str = "month",
    order: str = "uid",
    rows: int = BUCKET_ROWS,
    spread: Column | None = None,
) -> DataFrame:
    """Cut each group into chunks of ``size``; ids go on after ``prev``.

    ``prev`` is one number, or a table ``(by, prev)`` with the last chunk id of each group.
    ``spread`` is the hash that deals out rows without an order value; by default that of the row.
    """
    last = prev.select(by, "prev") if isinstance(prev, DataFrame) else None
    bucket = range_bucket(F.col(order), rows, row_hash(df) if spread is None else spread)
    chunked = ranked(df, [by], bucket, [order], "_rank0", last)
    before = F.lit(prev) if last is None else F.coalesce(F.col("prev"), F.lit(0))
    chunk = F.floor(F.col("_rank0") / size) + 1 + before
    return chunked.select(*df.columns, chunk.cast("bigint").alias("chunk_id"))


def batch_files(
    df: DataFrame, size: int = 10_000, path: str = "path", digits: int = 3
) -> DataFrame:
    """Batches of ``size`` files: ``batch_id`` and the position ``pos`` in the batch.

    Files come in no particular order, so they are taken by the md5 of their path: an order
    that does not depend on the cluster and spreads evenly over buckets.
    """
    order = [F.md5(F.col(path)), path]
    numbered = ranked(df, [], hash_bucket(F.col(path), digits), order, "_rank0")
    return numbered.select(
        *df.columns,
        F.floor(F.col("_rank0") / size).cast("bigint").alias("batch_id"),
        (F.col("_rank0") % size).cast("bigint").alias("pos"),
    )


def first_seen_rank(
    df: DataFrame,
    key: str = "url_key",
    order: tuple = ("year", "month", "file", "uid"),
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``seen_rank``: 1 for a key's first sighting, 2 for the next, and so on.

    The last order column must be an integer; a key that holds a third of all rows is ranked
    in many buckets.  For the first sighting alone use ``dedupe_urls``.
    """
    *outer, inner = order
    parts = [F.col(c).alias(f"o{i}") for i, c in enumerate(outer)]
    bucket = F.struct(*parts, range_bucket(F.col(inner), rows).alias("block"))
    out = ranked(df, [key], bucket, list(order), "_rank0")
    return out.withColumn("seen_rank", F.col("_rank0") + 1).drop("_rank0")


def order_sources(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


# Up to so many rows a limit is taken from the heaps that tasks keep of their least rows.
HEAP_ROWS = 100_000


def limit_pending(
    df: DataFrame, n: int = -1, order: str = "uid", rows: int = BUCKET_ROWS
) -> DataFrame:
    """The first ``n`` rows along ``order``; -1 is no limit.  Goes after the anti-join.

    Rows without an order value come first.  A small limit keeps ``n`` rows in each task and merges
    them.  A larger one filters on the rank.
    """
    if n == -1:
        return df
    if n <= HEAP_ROWS:
        return df.orderBy(F.col(order).asc_nulls_first()).limit(n)
    bucket = range_bucket(F.col(order), rows, row_hash(df))
    numbered = ranked(df, [], bucket, [order], "_rank0", coarse=_coarse_range())
    return numbered.filter(F.col("_rank0") < n).drop("_rank0")
