"""Ranked search by sequential reads only (NRA: no random access).

Every term of a query has a list of the documents that hold it, by falling impact.  The lists are cut
into layers of equal impact, half an octave each, and written as one folder per layer.  A round reads the
next folders of all lists.  A document that has been seen has a score interval: below, the impacts read so
far; above, these and, for each list it was not met in, the largest impact that the list still holds.
Documents whose upper end is below the twentieth lower end of their query are dropped.  A query is closed
once a document not met at all could not reach that end; from then on only its candidates are looked for.
Rounds go on until every candidate's interval is a point, which settles members, ties and scores.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.shared import remove, rows_of_task, values, written
from linkloom.session import has_at_most

TOP = 20
#: No count is worth more.
MOST_WORTH = 1_000_000
#: Half octaves below the largest impact; the last layer holds all that is less.
LAYERS = 18
#: A round reads layers until it has this share of what was read before it, or of all at first.
GROWTH, FIRST_SHARE = 0.5, 0.01
#: The lists a document was met in are bits of words of so many; lists of a longer query beyond the last
#: word count as unmet, which leaves its intervals wider for longer and its result the same.
BITS, WORDS = 62, 4
#: At most so many terms go to every task, and so many candidates.
MOST_TERMS, MOST_CANDIDATES = 1_000_000, 1_000_000

_TERM = regex.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII; only A-Z lower-cased."""
    return _TERM.findall((text or "").encode().lower())


def _counted(kept: frozenset | None):
    """``id, text`` to ``uid, id, n, terms, counts``; only terms of ``kept``, if given, are listed."""

    def run(batches):
        rows = rows_of_task()
        for batch in batches:
            out = []
            for key, text in zip(values(batch, "id"), values(batch, "text")):
                found = terms_of(text)
                counts = Counter(found if kept is None else filter(kept.__contains__, found))
                out.append((next(rows), key, len(found), list(counts), list(counts.values())))
            uid, key, n, terms, counts = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(uid, pa.int64()), pa.array(key, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(terms, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int64())),
                ],
                ["uid", "id", "n", "terms", "counts"],
            )

    return run


_COUNTED = "uid long, id long, n long, terms array<binary>, counts array<long>"


def _listed(df: DataFrame) -> DataFrame:
    """One row for each term of a counted text."""
    return df.select(
        "uid", "id", "n", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("tf")))
    )


def _texts(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"), F.col("text").cast("string").alias("text"))


def weight(n_docs: int, df: Column) -> Column:
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * df + 1).cast("double")
    return F.floor(1000 * F.log(ratio)).cast("long")


def saturation(n_docs: int, n_terms: int) -> Column:
    """What an occurrence count is worth in a document of ``n`` terms; whole numbers throughout."""
    m = f"(75L + (25L * n * {n_docs}L) div {n_terms}L)"
    return F.expr(f"(1000000000L * tf) div (1000L * tf + 12L * {m})")


def layer_of(impact: Column, top: int) -> Column:
    """0 for the largest impacts, and one more for each half octave below."""
    return F.least(F.floor(2 * F.log2(F.lit(float(top)) / impact)), F.lit(LAYERS - 1)).cast("int")


class Lists:
    """Impact-sorted lists of the queries' terms, in one folder per layer."""

    def __init__(self, docs: DataFrame, items: DataFrame):
        self.n_docs = 0
        queries = written(_texts(items, "item_id").mapInArrow(_counted(None), _COUNTED))
        self.items = _listed(queries).select(
            F.col("uid").alias("item"), F.col("id").alias("item_id"), "term", F.col("tf").alias("times")
        )
        vocabulary = self.items.select("term").distinct()
        kept = None
        if has_at_most(vocabulary, MOST_TERMS):
            kept = frozenset(bytes(r.term) for r in vocabulary.collect())
        counted = written(_texts(docs, "doc_id").mapInArrow(_counted(kept), _COUNTED))
        n_docs, n_terms = counted.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            return
        of_terms = _listed(counted).groupBy("term").agg(F.count("*").alias("df"))
        weights = written(
            vocabulary.join(of_terms, "term").withColumn("w", weight(n_docs, F.col("df"))).where("w > 0")
            .select("term", F.monotonically_increasing_id().alias("t"), "w")
        )
        heaviest = weights.agg(F.max("w")).first()[0]
        if heaviest is None:
            return
        gain = F.col("w") * saturation(n_docs, n_terms)
        postings = _listed(counted).join(F.broadcast(weights) if kept is not None else weights, "term")
        postings = postings.select("uid", "id", "t", gain.alias("impact")).where("impact > 0")
        layered = postings.withColumn("layer", layer_of(F.col("impact"), heaviest * MOST_WORTH))
        self.lists = written(layered, "layer")
        self.tops = written(
            self.lists.groupBy("t", "layer").agg(F.max("impact").alias("most"), F.count("*").alias("rows"))
        )
        # A query's longest lists of high impact come first, so that these are told apart by bits.
        self.items = written(
            self.items.join(weights, "term").select(
                "item", "item_id", "t", "times",
                (F.row_number().over(Window.partitionBy("item").orderBy(F.desc("w"), "t")) - 1).alias("place"),
            )
        )
        self.few = has_at_most(self.items, MOST_TERMS)
        self.n_docs = n_docs

    def small(self, df: DataFrame) -> DataFrame:
        """Broadcast tables of the queries' size where that is known to be small."""
        return F.broadcast(df) if self.few else df

    def rounds(self) -> list[list[int]]:
        """Which layers each round reads."""
        sizes = dict(self.tops.groupBy("layer").agg(F.sum("rows")).collect())
        total, read, out, held, n = sum(sizes.values()), 0, [], [], 0
        for layer in sorted(sizes):
            held.append(layer)
            n += sizes[layer]
            if n >= max(GROWTH * read, FIRST_SHARE * total):
                out.append(held)
                read, held, n = read + n, [], 0
        return out + [held] if held else out

    def limits(self, layer: int) -> DataFrame:
        """For each item what its lists can still add beyond a layer: ``caps`` by place, and their sum."""
        left = self.tops.where(F.col("layer") > layer).groupBy("t").agg(F.max("most").alias("most"))
        cap = F.coalesce(F.col("most"), F.lit(0)) * F.col("times")
        rows = self.items.join(left, "t", "left").select("item", F.struct("place", cap.alias("cap")).alias("p"))
        lists = rows.groupBy("item").agg(F.sort_array(F.collect_list("p")).alias("ps"), F.sum("p.cap").alias("rest"))
        return lists.select("item", "rest", F.slice(F.col("ps.cap"), 1, BITS * WORDS).alias("caps"))

    def read(self, layers: list[int], items: DataFrame, only: DataFrame | None) -> DataFrame:
        """``item, uid, id, low, met0...`` of the given layers; ``only`` names the pairs to look for."""
        rows = self.lists.where(F.col("layer").isin(layers))
        if only is None:
            rows = rows.join(self.small(items), "t")
        else:
            rows = rows.join(only, "uid").join(self.small(items), ["item", "t"])
        bit = F.expr(f"shiftleft(1L, cast(place % {BITS} as int))")
        word = F.floor(F.col("place") / BITS)
        return rows.select(
            "item", "uid", "id", (F.col("impact") * F.col("times")).alias("low"),
            *(F.when(word == k, bit).otherwise(0).alias(f"met{k}") for k in range(WORDS)),
        )


_MET = [f"met{k}" for k in range(WORDS)]


def _summed(rows: DataFrame) -> DataFrame:
    """Of each item and document what was read: the sum of the impacts, and the bits of the lists."""
    sums = [F.sum(c).alias(c) for c in ("low", *_MET)]
    return rows.groupBy("item", "uid").agg(F.first("id").alias("id"), *sums)


def _upper() -> Column:
    """The upper end: what was read, and the caps of the lists that the document was not met in."""

    def met(place: Column) -> Column:
        word = F.get(F.array(*_MET), F.floor(place / BITS).cast("int"))
        return F.getbit(word, (place % BITS).cast("int")) == 1

    known = F.aggregate(
        F.transform("caps", lambda cap, place: F.when(met(place), cap).otherwise(0)),
        F.lit(0).cast("long"), lambda total, cap: total + cap,
    )
    return F.col("low") + F.col("rest") - known


def _reaching(seen: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows whose interval reaches the end of their item, with its upper end ``high``.

    While an item is open every interval does, as what was read is no less than the caps of its lists;
    so the exact upper end is only worked out for closed items, and there where a rougher one reaches.
    """
    is_open = F.col("end").isNull() | (F.col("rest") >= F.col("end"))
    rough = F.col("low") + F.col("rest")
    high = F.when(is_open, rough).when(rough >= F.col("end"), _upper()).otherwise(0)
    rows = seen.join(bounds, "item", "left").withColumn("high", high).where(is_open | (F.col("high") >= F.col("end")))
    return rows.select("item", "uid", "id", "low", *_MET, "high")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` highest-scoring documents of each item, ranks from 1.

    A document scores, for each of the item's terms, repeats included, the term's weight by how few
    documents hold it, times what its count is worth in a document of that length; all in whole numbers.
    Scores of 0 are no results; equal ones are ranked by ascending ``doc_id`` (null last, then rows in
    any order).  A null text has no terms; items without terms, empty tables and an empty corpus give no
    rows.  Rows with equal ids are documents, and items, of their own; other columns are not read.
    """
    lists = Lists(docs, items)
    if not lists.n_docs:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    names = lists.items.select("item", "item_id").distinct()
    queries = lists.items.select("item", "t", "times", "place")
    n_items, state, closed, only = names.count(), None, None, None
    for layers in lists.rounds():
        limits = written(lists.limits(layers[-1]))
        parts = [] if state is None else [state]
        if closed is None:
            parts.append(lists.read(layers, queries, None))
        else:
            if n_closed < n_items:
                parts.append(lists.read(layers, queries.join(closed, "item", "left_anti"), None))
            parts.append(lists.read(layers, queries, only))
        seen = _summed(reduce(DataFrame.unionByName, parts))
        if state is not None:  # ends only rise: what is below the last one is below the next
            seen = _reaching(seen, lists.small(limits.join(ends, "item", "left"))).drop("high")
        before, table = state and table, written(seen)
        best = Window.partitionBy("item").orderBy(F.desc("low"))
        ends = table.select("item", "low", F.row_number().over(best).alias("n")).where(f"n = {top}")
        ends = written(ends.select("item", F.col("low").alias("end")))
        bounds = written(limits.join(ends, "item", "left"))
        left = _reaching(table, lists.small(bounds))
        state = left.drop("high")
        if before is not None:
            remove(before)
        # A document not met yet has no more than all lists can still add.
        closed = written(bounds.where("rest < end").select("item"))
        n_closed = closed.count()
        open_pairs = left.join(lists.small(closed), "item", "left_semi").where("high > low")
        only = written(open_pairs.select("item", "uid"))
        n_only = only.count()
        if not n_only and bounds.where("rest > 0").join(closed, "item", "left_anti").isEmpty():
            break
        if n_only <= MOST_CANDIDATES:
            only = F.broadcast(only)
    order = Window.partitionBy("item").orderBy(F.desc("low"), F.col("id").asc_nulls_last(), "uid")
    ranked = state.where("low > 0").select("item", "id", "low", F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= top).join(lists.small(names), "item").select(
        "item_id", "rank", F.col("id").alias("doc_id"), F.col("low").alias("score")
    )
