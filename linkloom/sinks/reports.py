"""Reports counted by the job that writes the rows: the data is made once, for both.

The counts are taken in the tasks that write, behind the last exchange.  A task that is tried again counts
once there; in front of an exchange a lost executor would have rows counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linkloom.operators.pages import main_text
from linkloom.operators.tokens import MIN_LENGTH
from linkloom.sinks.tables import TEXT_FILES


def written_with_counts(
    df: DataFrame,
    counts: dict[str, Column],
    write: Callable[[DataFrame], None],
    keep: Column | None = None,
) -> dict[str, int]:
    """Write ``df`` and return how many of its rows meet each condition of ``counts``.

    Rows that do not meet ``keep`` are counted and not written.  ``write`` must run one job, and none that
    exchanges rows: deal them out before.
    """
    observation = Observation()
    seen = df.observe(observation, *[F.count_if(test).alias(name) for name, test in counts.items()])
    write(seen if keep is None else seen.filter(keep))
    found = observation.get
    # A plan that Spark proves empty has no counts.
    return {name: found.get(name, 0) for name in counts}


def extract_texts(
    pages: DataFrame, done: DataFrame, path: str, months: Sequence[str] = (), keys=("month", "fid")
) -> list[dict]:
    """Texts of the members ``(month, fid, html)`` that have none yet, added to ``path`` by month.

    Returns the members, those done before and those whose extraction gave no text, as dictionaries
    ``month, n_total, n_done, n_unparsable``: one for each of ``months`` and at last one with month None
    for all rows.  Done members pass by with their ``html`` taken away, so they are counted and not
    extracted.  A member without a month or id is in no list of done ones, so it is pending.
    """
    month = keys[0]
    marked = pages.join(done.select(*keys).distinct().withColumn("_done", F.lit(True)), list(keys), "left")
    known = marked.withColumn("_done", F.coalesce("_done", F.lit(False)))
    texts = main_text(known.withColumn("html", F.when(~F.col("_done"), F.col("html"))))
    texts = texts.select(*keys, "text", "word_count", "_done")
    # Texts are dealt out as they are written; what is done leaves its keys only.
    dealt = texts.repartition(month, F.pmod(F.xxhash64(*keys), F.lit(TEXT_FILES)))
    empty = ~F.col("_done") & (F.coalesce(F.length("text"), F.lit(0)) == 0)
    groups = {None: F.lit(True)} | {m: F.col(month).eqNullSafe(m) for m in months}
    counts = {}
    for i, one in enumerate(groups.values()):
        counts |= {f"n_total{i}": one, f"n_done{i}": one & F.col("_done"), f"n_unparsable{i}": one & empty}

    def write(rows: DataFrame) -> None:
        rows.drop("_done").write.mode("append").partitionBy(month).parquet(path)

    found = written_with_counts(dealt, counts, write, ~F.col("_done") & ~empty)
    kinds = ("n_total", "n_done", "n_unparsable")
    report = [{"month": m} | {k: found[f"{k}{i}"] for k in kinds} for i, m in enumerate(groups)]
    return [*report[1:], report[0]]


def write_encoded(encoded: DataFrame, path: str, min_length: int = MIN_LENGTH) -> dict[str, int]:
    """Encoded documents written whole, and of them ``n_omitted`` (too short to be packed) and ``n_total``.

    Documents of no known length are not omitted, as in ``token_report``.
    """
    counts = {"n_omitted": F.col("n_tokens") < min_length, "n_total": F.lit(True)}
    return written_with_counts(encoded, counts, lambda rows: rows.write.mode("overwrite").parquet(path))
