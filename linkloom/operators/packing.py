"""Shards of batches of any size: greedy packing by pointers.

Where a shard begins depends on where the one before it ended, so the plain way walks through a batch.
But where a shard *would* end that began at a given document depends on that document alone: it is the
first whose running total exceeds the total before the start by more than the limit.  So each document
gets a pointer to the start of the next shard, all at once, and the starts that are reached from the
first document are found by doubling: with pointers that leap 1, 2, 4, ... shards, the known starts
double in each round.  A batch is never in one task, and the number of rounds is the logarithm of its
number of shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.numbering import BUCKET_ROWS, range_bucket, ranked
from linkloom.session import cut_lineage

_BATCH, _PLACE = "_batch", "_i"


def running_total(df: DataFrame, by: str, bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` up to and with each row along ``order``, within ``by``.

    ``bucket`` must not decrease along ``order``.  Buckets are summed apart, and a row for each of them
    brings what stands before it.  Neither ``by`` nor ``bucket`` may be null.
    """
    own = Window.partitionBy(by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(by, bucket).agg(F.sum(value).alias("_sum"))
    before = sums.select(by, bucket, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    local = df.withColumn("_local", F.sum(value).over(own))
    total = (F.col("_local") + F.col("_before")).cast("bigint")
    return local.join(before, [by, bucket]).select(*df.columns, total.alias(name))


def next_starts(docs: DataFrame, limit: int, tokens: int) -> DataFrame:
    """``_batch, _i, _next``: the document a shard that starts at ``_i`` is followed by, if there is one.

    ``docs`` has ``_batch, _i, _n, _end``: place, length and running total.  Totals and the totals at
    which shards are full are merged in one order, in buckets of so many ``tokens``; the totals before a
    full one tell the document that fills it.
    """
    ends = docs.select(_BATCH, F.col("_end").alias("value"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias(_PLACE))
    full = docs.select(_BATCH, (F.col("_end") - F.col("_n") + limit).alias("value"), F.lit(1).alias("kind"), _PLACE)
    both = ends.unionByName(full).withColumn("bucket", F.floor(F.col("value") / tokens))
    both = both.withColumn("one", 1 - F.col("kind"))
    merged = running_total(both, _BATCH, "bucket", ["value", "kind"], "one", "within")
    sizes = docs.groupBy(_BATCH).agg(F.count("*").alias("size"))
    # The documents within the limit, the one that exceeds it, and then the next start.
    pointers = merged.where("kind = 1").select(_BATCH, _PLACE, (F.col("within") + 1).alias("_next"))
    return pointers.join(sizes, _BATCH).where("_next < size").drop("size")


def reached_starts(pointers: DataFrame, first: DataFrame) -> DataFrame:
    """``_batch, _i`` of all starts that the pointers reach from those of ``first``."""
    starts, leap = cut_lineage(first), cut_lineage(pointers)
    while True:
        found = starts.join(leap, [_BATCH, _PLACE]).select(_BATCH, F.col("_next").alias(_PLACE))
        more = cut_lineage(found)
        if more.isEmpty():
            return starts
        starts = cut_lineage(starts.unionByName(more))
        then = leap.select(_BATCH, F.col(_PLACE).alias("_next"), F.col("_next").alias("_then"))
        leap = cut_lineage(leap.join(then, [_BATCH, "_next"]).select(_BATCH, _PLACE, F.col("_then").alias("_next")))


def pack_far(
    lengths: DataFrame,
    limit: int,
    by: str = "batch_id",
    order: str = "pos",
    length: str = "n_tokens",
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``shard_id`` as ``tokens.pack`` does, for batches that no task could hold.

    Documents come along the integer ``order``, which is distinct in a batch; a null batch is one, and
    a null length counts as zero.  Buckets hold ``rows`` documents, or the tokens of so many of mean
    length.  Pass names and lengths only.
    """
    batch = F.coalesce(F.col(by).cast("string"), F.lit("\u0000"))
    named = lengths.withColumn(_BATCH, batch)
    placed = ranked(named, [_BATCH], range_bucket(F.col(order), rows), [order], _PLACE)
    placed = placed.withColumns({
        "_n": F.coalesce(F.col(length), F.lit(0)).cast("bigint"), "_bucket_of": F.floor(F.col(_PLACE) / rows),
    })
    docs = cut_lineage(running_total(placed, _BATCH, "_bucket_of", [_PLACE], "_n", "_end"))
    mean = docs.agg(F.avg("_n")).first()[0]
    if mean is None:
        return lengths.withColumn("shard_id", F.lit(None).cast("bigint"))
    pointers = next_starts(docs, limit, max(1, int(mean * rows)))
    first = docs.where(F.col(_PLACE) == 0).select(_BATCH, _PLACE)
    starts = reached_starts(pointers, first).withColumn("_new", F.lit(1))
    marked = docs.join(starts, [_BATCH, _PLACE], "left").withColumn("_new", F.coalesce("_new", F.lit(0)))
    counted = running_total(marked, _BATCH, "_bucket_of", [_PLACE], "_new", "_shards")
    return counted.select(*lengths.columns, (F.col("_shards") - 1).alias("shard_id"))
