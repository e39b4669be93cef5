"""Global first-seen URL dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.arrow import html_unescape
from linkloom.functions.urls import is_parsable, with_url_key
from linkloom.session import computed_once

ORDER = ("year", "month", "file", "uid")


def split_unparsable(df: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """Rows with ``url`` HTML-unescaped in place, and the rejects with their reason."""
    plain = df.withColumn(url, html_unescape(F.col(url)))
    good = F.coalesce(is_parsable(F.col(url)), F.lit(False))
    judged = computed_once(plain, {"_good": good})
    rejects = judged.filter(~F.col("_good")).withColumn("reason", F.lit("unparsable"))
    return judged.filter("_good").drop("_good"), rejects.drop("_good")


def keep_first(keyed: DataFrame, order=ORDER, key: str = "url_key") -> DataFrame:
    """The first row of each key along ``order``.

    Each map task keeps its own first row per key before the shuffle, so the copies of a hot
    URL meet as one row per task.  The hash goes first to make the sort compare numbers; the
    key itself keeps the result exact.
    """
    copies = Window.partitionBy(F.xxhash64(key), key).orderBy(*order)
    return keyed.withColumn("_n", F.row_number().over(copies)).filter("_n = 1").drop("_n")


def dedupe_urls(df: DataFrame, mode: str = "full", order=ORDER, url: str = "url") -> DataFrame:
    """First sighting of every URL, unescaped; unparsable URLs are left out."""
    parsable, _ = split_unparsable(df, url)
    return keep_first(with_url_key(parsable, mode, url), order).drop("url_key")


def source_stats(df: DataFrame, kept: DataFrame, by: str = "month") -> DataFrame:
    """URLs read and kept per source; sources without a survivor stay in, with zero."""
    tagged = df.select(by, F.lit(0).alias("_kept")).unionByName(
        kept.select(by, F.lit(1).alias("_kept"))
    )
    return tagged.groupBy(by).agg(
        F.count_if(F.col("_kept") == 0).alias("n_urls"),
        F.count_if(F.col("_kept") == 1).alias("n_kept"),
    )
