"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Equal texts are one indivisible group.  Groups of at least one unit (the total over ``shards`` times
``units``) are items of their own, of which there can be no more than ``shards * units``; smaller ones
are summed by hash into as many bundles.  So the differencing sees a list whose length is fixed by
parameters, not by the data, and its result is a table small enough to broadcast by the same bound.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.shared import written

#: Cells that number the rows of a shard; bounds the table of their offsets.
CELLS = 4096


def differencing(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item: combine the two partial partitions of largest spread, oppositely.

    A partial partition has one part for each shard; a part is its sum and a tree of items.  The
    largest part of one is united with the smallest of the other, and so on.
    """
    heap = []
    for i, size in enumerate(sizes):
        parts = [(size, i)] + [(0, None)] * (shards - 1)
        heap.append((-size, i, parts))
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        parts = [
            (x + y, s if t is None else t if s is None else (s, t))
            for (x, s), (y, t) in zip(a, reversed(b))
        ]
        parts.sort(key=lambda part: -part[0])
        n += 1
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], n, parts))
    labels = [0] * len(sizes)
    for shard, (_, tree) in enumerate(heap[0][2] if heap else []):
        open_nodes = [] if tree is None else [tree]
        while open_nodes:
            node = open_nodes.pop()
            if isinstance(node, tuple):
                open_nodes.extend(node)
            else:
                labels[node] = shard
    return labels


def shard_documents(
    docs: DataFrame, shards: int = 40, units: int = 500, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    The law is ``bytes``: sizes (UTF-8 bytes of the text, none for null, plus 16) near equal over the
    shards, equal texts in one shard (null and empty are equal).  A group larger than a fair share
    has a shard to itself as far as possible.  ``slot`` numbers the rows of a shard from 0 without
    gaps.  ``grown_shard`` is null: it belongs to another law.  ``carry`` names further columns of
    ``docs`` to return; those with a name of the result are left out.  Empty in, empty out.
    """
    own = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    carry = tuple(c for c in carry if c not in own)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 16).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("__group"),
            F.pmod(F.spark_partition_id(), F.lit(CELLS)).alias("__cell"),
            F.monotonically_increasing_id().alias("__row"),
            *(F.col(c) for c in carry),
        )
    )
    bundle = F.pmod(F.xxhash64("__group"), F.lit(shards * units))
    total = base.agg(F.sum("size")).first()[0] or 0
    unit = total // (shards * units) + 1
    groups = written(
        base.groupBy("__group").agg(F.sum("size").alias("bytes")).withColumn("__bundle", bundle)
    )
    # Both lists hold shards * units rows at most: by their sum, and by the number of bundles.
    alone = [(bytes(r[0]), None, r[1]) for r in groups.where(F.col("bytes") >= unit).select("__group", "bytes").collect()]
    small = groups.where(F.col("bytes") < unit).groupBy("__bundle").agg(F.sum("bytes"))
    items = alone + [(None, r[0], r[1]) for r in small.collect()]
    items.sort(key=lambda x: (-x[2], x[0] or b"", x[1] or 0))
    labels = differencing([x[2] for x in items], shards)

    spark = docs.sparkSession
    by_group = spark.createDataFrame(
        [(bytearray(g), s) for (g, _, _), s in zip(items, labels) if g is not None],
        "__group binary, __alone int",
    )
    by_bundle = spark.createDataFrame(
        [(b, s) for (g, b, _), s in zip(items, labels) if g is None], "__bundle long, __bundled int"
    )
    placed = (
        base.withColumn("__bundle", bundle)
        .join(F.broadcast(by_group), "__group", "left")
        .join(F.broadcast(by_bundle), "__bundle", "left")
        .withColumn("shard", F.coalesce("__alone", "__bundled"))
        .drop("__group", "__bundle", "__alone", "__bundled")
    )
    before = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "__cell").agg(F.count("*").alias("n"))
        .select("shard", "__cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    )  # shards * CELLS rows at most
    order = Window.partitionBy("shard", "__cell").orderBy("__row")
    numbered = placed.withColumn("__at", F.row_number().over(order).cast("long") - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "__cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("__before") + F.col("__at")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *carry,
    )
