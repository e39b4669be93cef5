"""Names, fingerprints, counts and small text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.split() and str.strip() take as white space (fixed values): as the
# inside of a Java character class, to be used under the Unicode flag, and spelled out.
UNICODE = "(?U)"
SPACE = r"\s\x1c-\x1f"
_SPACE_CHARACTERS = (
    " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Month label at the start of a file's base name (fixed value).
MONTH_PATTERN = r"^(RS_.*2\d{3}-\d{2})"


def strip(text: Column) -> Column:
    """Remove white space at both ends, Unicode spaces included."""
    return F.btrim(text, F.lit(_SPACE_CHARACTERS))


def is_blank(text: Column) -> Column:
    """True for null, empty or white-space-only text."""
    return ~F.coalesce(text.rlike(f"{UNICODE}[^{SPACE}]"), F.lit(False))


def word_count(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(text, F.lit(f"{UNICODE}[^{SPACE}]+")).cast("bigint")


def space_pieces(text: Column) -> Column:
    """Pieces of a split on single spaces; empty pieces count and newlines do not split."""
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def month_label(path: Column) -> Column:
    """Month label from a file name; ``''`` where the name carries none."""
    return F.regexp_extract(base_name(path), MONTH_PATTERN, 1)


def year_month(path: Column) -> Column:
    """STRUCT<year INT, month INT> from the text after a path's last ``_``; null if not numeric."""
    stem = F.regexp_replace(path, r"^((?:.*/)?\.*[^./][^/]*)\.[^./]*\z", "$1")
    label = F.substring(F.substring_index(stem, "_", -1), 1, 7)
    parts = F.split(label, "-", -1)
    return F.struct(
        F.get(parts, F.lit(0)).try_cast("int").alias("year"),
        F.get(parts, F.lit(1)).try_cast("int").alias("month"),
    )


def doc_fid(uid: Column, url: Column) -> Column:
    """Document id: zero-padded uid, dash, md5 of the trimmed URL."""
    return F.format_string("%07d-%s", uid, F.md5(strip(url)))


def content_md5(html: Column) -> Column:
    return F.md5(html)


def deduped_name(path: Column) -> Column:
    """Name of the deduplicated list that belongs to a list of good links."""
    return F.replace(path, F.lit("goodlinks.txt"), F.lit("deduped.txt"))


def tokenized_name(path: Column, kind: str = "txt") -> Column:
    return F.replace(base_name(path), F.lit(".txt"), F.lit(f".tokenized.{kind}"))


def archive_name(month: Column, chunk_id: Column, part: str = "data", fmt: str = "xz") -> Column:
    return F.format_string(f"%s-%d_{part}.{fmt}", month, chunk_id)


def percent(hits: Column, total: Column) -> Column:
    """Whole percent, cut not rounded; null where there is nothing to divide by."""
    return F.try_divide(hits.cast("double"), total.cast("double")).__mul__(100).cast("int")


def meta_json(meta: Column) -> Column:
    return F.to_json(meta)


def fold_newlines(text: Column) -> Column:
    """Carriage returns read as newlines, as a text-mode reader does."""
    folded = F.regexp_replace(text, r"\r\n?", "\n")
    return F.when(text.contains("\r"), folded).otherwise(text)


def lines_of(text: Column) -> Column:
    """ARRAY<STRUCT<line_no, line, kept>> of a text's lines.

    A line counts its own newline, and is kept if longer than one character; so a last line
    that has no newline needs two.  Nothing after a final newline is no line.
    """
    whole = F.regexp_extract_all(fold_newlines(text), F.lit("[^\n]*+\n|[^\n]++"), F.lit(0))
    return F.transform(
        whole,
        lambda x, i: F.struct(
            i.cast("bigint").alias("line_no"),
            F.rtrim(x, F.lit("\n")).alias("line"),
            (F.length(x) > 1).alias("kept"),
        ),
    )
