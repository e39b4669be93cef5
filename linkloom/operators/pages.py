"""Page stage: paragraphs, clean HTML, main text, links and metadata.

All of it is one narrow projection per page.  ``html`` is by far the widest column, so it is
turned into text before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import html as H
from linkloom.functions.arrow import html_unescape, plain_texts, text_of_nested
from linkloom.functions.strings import is_blank, space_pieces, word_count


def nonempty_text(df: DataFrame, text: str = "text", strip: bool = True) -> DataFrame:
    """Drop empty texts; with ``strip`` also those of white space only."""
    keep = ~is_blank(F.col(text)) if strip else F.length(text) > 0
    return df.filter(keep)


def with_paragraphs(
    pages: DataFrame,
    min_words: int = 4,
    normalize: bool = True,
    html: str = "html",
    name: str = "paragraphs",
) -> DataFrame:
    """Replace ``html`` by its paragraphs, ARRAY<STRUCT<pos, text>>.

    The strings are found in the JVM, unescaped and NFKD-normalized with one Arrow call per
    page that needs any, then filtered by words and stripped.
    """
    rest = [c for c in pages.columns if c != html]
    found = pages.select(*rest, H.raw_paragraphs(F.col(html)).alias("_raw"))
    plain = found.withColumn("_plain", plain_texts(F.col("_raw.text"), normalize))
    both = F.zip_with(
        "_raw", "_plain", lambda r, t: F.struct(r["pos"].alias("pos"), t.alias("text"))
    )
    normal = plain.select(*rest, both.alias("_p"))
    return normal.select(*rest, H.long_paragraphs(F.col("_p"), min_words).alias(name))


def extract_paragraphs(
    pages: DataFrame, min_words: int = 4, normalize: bool = True, html: str = "html"
) -> DataFrame:
    """One row per paragraph: the page's columns without ``html``, ``pos`` and ``text``."""
    rest = [c for c in pages.columns if c != html]
    found = with_paragraphs(pages, min_words, normalize, html, "_p")
    return found.select(*rest, F.inline("_p"))


def min_paragraph_words(df: DataFrame, n: int = 4, text: str = "text") -> DataFrame:
    return df.filter(space_pieces(F.col(text)) >= n)


def paragraph_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Paragraph mode: ``text`` is all paragraphs joined by spaces, with its word count."""
    rest = [c for c in pages.columns if c != html]
    found = with_paragraphs(pages, html=html, name="_p")
    return found.select(
        *rest,
        H.join_paragraphs(F.col("_p")).alias("text"),
        H.paragraph_words(F.col("_p")).alias("word_count"),
    )


def _with_body(pages: DataFrame, html: str) -> DataFrame:
    """Add ``_body``, the escaped text without boilerplate; null with ``_nested`` for pages that have
    blocks in blocks of their kind, which a helper reads that counts tags."""
    opened = pages.withColumn("_opened", H.without_blocks(F.col(html)))
    nested = opened.withColumn("_nested", H.has_nested_blocks(F.col("_opened")))
    body = F.when(~F.col("_nested"), H.body_lines(F.col("_opened")))
    return nested.withColumn("_body", body).drop("_opened")


def _plain(html: str, body: Column) -> Column:
    """Unescaped text of a page: of ``body``, or of the nested page itself."""
    return F.coalesce(text_of_nested(F.when(F.col("_nested"), F.col(html))), html_unescape(body))


def with_visible_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Add the main text by a stated rule: no scripts, boilerplate blocks or tags, entities
    unescaped; blocks become lines that are parted by an empty line."""
    body = _with_body(pages, html)
    plain = body.withColumn("_plain", _plain(html, F.col("_body")))
    return plain.withColumn(name, H.squeezed(F.col("_plain"))).drop("_nested", "_body", "_plain")


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Main-text mode: visible text without boilerplate, with its word count."""
    found = with_visible_text(pages, html).drop(html)
    return found.withColumn("word_count", word_count(F.col("text")))


def clean_html(pages: DataFrame, html: str = "html", keep: bool = False) -> DataFrame:
    """Raw mode: cleaned HTML of the pages whose main text is not empty; no word count.

    With ``keep`` the other pages stay, with a null text.
    """
    rest = [c for c in pages.columns if c != html]
    tagless = _with_body(pages, html)
    # A character that no entity can hold settles it; otherwise entities are looked into.
    sure = F.coalesce(F.col("_body").rlike(H.SURELY_VISIBLE), F.lit(False))
    looked = tagless.withColumn("_sure", sure).withColumn(
        "_plain", _plain(html, F.when(~F.col("_sure"), F.col("_body")))
    )
    visible, text = F.col("_sure") | ~is_blank(F.col("_plain")), H.cleaned_html(F.col(html))
    found = looked if keep else looked.filter(visible)
    text = F.when(visible, text) if keep else text
    return found.select(*rest, text.alias("text")).withColumn("word_count", F.lit(None).cast("bigint"))


SCRAPERS = {"raw": clean_html, "paragraphs": paragraph_text, "visible": main_text}
# Names under which these modes are asked for elsewhere.
ALIASES = {"bs4": "paragraphs", "newspaper": "visible"}


def mode_name(mode: str) -> str:
    """The name of the rule that a mode, or an alias of it, stands for."""
    name = ALIASES.get(mode, mode)
    if name not in SCRAPERS:
        raise ValueError(f"unknown mode {mode!r}; one of {', '.join((*SCRAPERS, *ALIASES))}")
    return name


def extract(pages: DataFrame, mode: str = "visible") -> DataFrame:
    """Text of pages by mode name; blank results are dropped."""
    return nonempty_text(SCRAPERS[mode_name(mode)](pages))


def extract_all(pages: DataFrame, mode: str = "visible") -> DataFrame:
    """The same with a row for every page; the text of a page without any is null or blank."""
    name = mode_name(mode)
    return clean_html(pages, keep=True) if name == "raw" else SCRAPERS[name](pages)


def with_meta(df: DataFrame, mode: str, url: str = "url", elapsed: str | None = None) -> DataFrame:
    """Add ``meta``: url, word count (null in raw mode), elapsed seconds and mode name."""
    mode = mode_name(mode)
    seconds = F.col(elapsed) if elapsed else F.lit(None)
    words = F.lit(None) if mode == "raw" else F.col("word_count")
    return df.withColumn(
        "meta",
        F.struct(
            F.col(url).alias("url"),
            words.cast("int").alias("word_count"),
            seconds.cast("double").alias("elapsed"),
            F.lit(mode).alias("scraper"),
        ),
    )


def page_links(pages: DataFrame, pattern: str = H.GREEDY_LINK, html: str = "html") -> DataFrame:
    """One row per link that group 1 of ``pattern`` finds, with its position on the page.

    Java is told to end lines at newlines only and to take Unicode spaces as white space.  The
    greedy pattern tries every anchor of a line up to its end, which takes a minute and more on a
    minified page; its other form finds the same in one pass.
    """
    if pattern == H.GREEDY_LINK:
        pattern = H.GREEDY_LINK_ONCE
    rest = [c for c in pages.columns if c != html]
    flags = "(?dU)"
    found = F.regexp_extract_all(F.col(html), F.lit(flags + pattern), 1)
    return pages.select(*rest, F.posexplode(found).alias("pos", "link")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )
