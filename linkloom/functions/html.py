"""HTML rules as regular expressions that run inside the JVM.

They scan a page in one pass: a block that is never closed runs to the end of the page instead of
being retried, and repeated groups are possessive, which also keeps them off the Java stack.
Without the possessive marks the tag patterns are plain RE2, for the SQL checks.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.strings import SPACE, UNICODE, space_pieces, strip

# Tag groups (fixed values, from the HTML standard).
INLINE_TAGS = (
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "dfn", "em", "font", "i", "kbd",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var",
)
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog",
    "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol",
    "p", "pre", "section", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)
BOILERPLATE_TAGS = ("head", "nav", "header", "footer", "aside", "noscript", "template")
# What cleaning removes with content, removes as a lone tag, or unwraps (fixed values).
KILLED_BLOCKS = ("script", "style", "iframe", "button", "select", "textarea")
KILLED_TAGS = ("link", "meta", "embed", "input", "frame")
UNWRAPPED_TAGS = ("html", "head", "title", "form", "blink", "marquee")

# The rest of a tag: quotes count behind an equals sign only, where they may hold < and >.  Each
# part is possessive, so a tag that is never closed costs no second look.
ATTRIBUTES = r"""(?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""

SPACE_RUN = f"{UNICODE}[{SPACE}]+"
# The same without the newline.
INLINE_SPACE_RUN = f"{UNICODE}[{SPACE}&&[^\n]]+"
# A visible character at the start or behind a space or semicolon, so outside any entity.
SURELY_VISIBLE = f"{UNICODE}(?:^|[;{SPACE}])[^&;{SPACE}]"
ANY_TAG = rf"</?[A-Za-z]{ATTRIBUTES}>|<[!?][^<>]*>"


def block_pattern(tags, comments: bool = True) -> str:
    """Whole elements of the named kinds, and comments, leftmost first."""
    parts = [rf"{t}(?:\s{ATTRIBUTES})?>.*?(?:</{t}\s*>|\z)" for t in tags]
    if comments:
        parts.insert(0, r"!--.*?(?:-->|\z)")
    return f"(?is)<(?:{'|'.join(parts)})"


def tag_pattern(tags) -> str:
    """Opening, closing and self-closing tags of the named kinds."""
    return rf"(?i)</?(?:{'|'.join(tags)})(?:[\s/]{ATTRIBUTES})?>"


HIDDEN = block_pattern(("script", "style"))
P_OPEN = rf"(?i)<p(?:\s{ATTRIBUTES})?>"
# One string, perhaps inside one chain of inline tags, up to the next block tag or the end.
LEAF = (
    rf"(?i)^(?:<(?:{'|'.join(INLINE_TAGS)})(?:\s{ATTRIBUTES})?>)*"
    r"([^<]+)"
    rf"(?:</(?:{'|'.join(INLINE_TAGS)})\s*>)*"
    rf"(?:</?(?:{'|'.join(BLOCK_TAGS)})(?:[\s/]{ATTRIBUTES})?>|\z)"
)
EVENT_ATTRIBUTE = r"""(?i)\son[a-z]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"']+)"""

# Link pattern of the dump index reader (fixed value): greedy, so the last link of a line.
GREEDY_LINK = r"""<a\s.*href=["'](\S+)["'][^>]*>\S*<\/a>"""
# Finds the same, but from the first anchor of a line only: what follows a later one on the line follows
# the first one too.  An anchor tag cut by the line's end is tried on its own.
GREEDY_LINK_ONCE = (
    r"""(?m)(?:(?:^|\G)(?>.*?<a\s)|<a\n).*href=["'](\S+)["'][^>]*>\S*<\/a>"""
)
# Every link of a page.
EACH_LINK = r"""(?i)<a\s[^<>]*?href\s*=\s*["']([^"'>\s]+)["'][^<>]*>"""


def raw_paragraphs(html: Column) -> Column:
    """ARRAY<STRUCT<pos, text>>: the string of each ``<p>`` that holds one string only.

    A script, style or comment inside a paragraph is a second child, so it leaves a void tag
    behind and the paragraph drops out like any other mixed content.
    """
    pieces = F.split(F.regexp_replace(html, HIDDEN, "<br>"), P_OPEN, -1)
    bodies = F.slice(pieces, 2, 1 << 30)
    leaves = F.transform(
        bodies,
        lambda p, i: F.struct(
            i.cast("bigint").alias("pos"), F.regexp_extract(p, LEAF, 1).alias("text")
        ),
    )
    return F.filter(leaves, lambda x: x["text"] != "")


def long_paragraphs(paragraphs: Column, min_words: int = 4) -> Column:
    """Drop paragraphs under ``min_words`` pieces, then strip the rest."""
    kept = F.filter(paragraphs, lambda x: space_pieces(x["text"]) >= min_words)
    return F.transform(
        kept, lambda x: F.struct(x["pos"].alias("pos"), strip(x["text"]).alias("text"))
    )


def paragraph_words(paragraphs: Column) -> Column:
    """Words of all paragraphs, split on single spaces."""
    return F.aggregate(
        paragraphs, F.lit(0).cast("bigint"), lambda n, x: n + space_pieces(x["text"])
    )


def join_paragraphs(paragraphs: Column) -> Column:
    return F.array_join(F.transform(paragraphs, lambda x: x["text"]), " ")


def has_nested_blocks(opened: Column) -> Column:
    """Whether ``without_blocks`` left a closing tag of a boilerplate block.

    It ends a block at the first closing tag of its kind, so what nested blocks, or tags in comments and
    scripts, have it end too early leaves that of the block itself.
    """
    return F.coalesce(opened.rlike(rf"(?i)</(?:{'|'.join(BOILERPLATE_TAGS)})\s*>"), F.lit(False))


def without_nested_blocks(html: str) -> str:
    """A page with each boilerplate block, comment, script and style replaced by a newline.

    A block ends with the closing tag at which the tags of its kind balance; those in comments, scripts and
    styles do not count, and a block whose tags never balance runs to the end.  One pass over the tags.
    """
    kept, at, kind, depth = [], 0, None, 0
    for found in _block_tags().finditer(html):
        opened, closed = found["open"], found["close"]
        if kind is None and not closed:
            kept.append(html[at : found.start()])
            at = found.end()
            if opened:
                kind, depth = opened.lower(), 1
        elif kind and kind == (opened or closed or "").lower():
            depth += 1 if opened else -1
            if not depth:
                at, kind = found.end(), None
    return "\n".join([*kept, html[at:] if kind is None else ""])


@lru_cache(maxsize=1)
def _block_tags() -> re.Pattern:
    names = "|".join(BOILERPLATE_TAGS)
    raw = rf"<(?P<raw>script|style)(?:\s{ATTRIBUTES})?>.*?(?:</(?P=raw)\s*>|\Z)"
    tags = rf"<(?P<open>{names})(?:\s{ATTRIBUTES})?>|</(?P<close>{names})\s*>"
    return re.compile(rf"<!--.*?(?:-->|\Z)|{raw}|{tags}", re.I | re.S | re.A)


def text_of_nested(html: str) -> str:
    """What ``body_lines`` makes of a page, with nested blocks dropped whole, and unescaped."""
    lines = re.sub(tag_pattern((*BLOCK_TAGS, "br")), "\n", without_nested_blocks(html), flags=re.A)
    return unescape(re.sub(ANY_TAG, "", lines, flags=re.A))


def without_blocks(html: Column) -> Column:
    """A page with boilerplate, scripts, styles and comments made newlines."""
    return F.regexp_replace(html, block_pattern(("script", "style", *BOILERPLATE_TAGS)), "\n")


def body_lines(opened: Column) -> Column:
    """Escaped text of a page without boilerplate: block tags to newlines, other tags dropped."""
    lines = F.regexp_replace(opened, tag_pattern((*BLOCK_TAGS, "br")), "\n")
    return F.regexp_replace(lines, ANY_TAG, "")


def squeezed(text: Column) -> Column:
    """Runs of white space to one blank; lines trimmed, blank ones dropped, the rest parted by
    an empty line."""
    text = F.regexp_replace(text, INLINE_SPACE_RUN, " ")
    return F.btrim(F.regexp_replace(text, "[ \n]*\n[ \n]*", "\n\n"), F.lit(" \n"))


def cleaned_html(html: Column) -> Column:
    """HTML without scripts, styles, comments, embedded parts and event handlers, minified."""
    text = F.regexp_replace(html, block_pattern(KILLED_BLOCKS), "")
    text = F.regexp_replace(text, tag_pattern((*KILLED_TAGS, *UNWRAPPED_TAGS)), "")
    text = F.regexp_replace(text, r"<[!?][^<>]*>", "")
    text = F.when(text.rlike(EVENT_ATTRIBUTE), _without_handlers(text)).otherwise(text)
    return F.btrim(F.regexp_replace(text, SPACE_RUN, " "), F.lit(" "))


def _without_handlers(html: Column) -> Column:
    """Drop event handler attributes, inside opening tags only."""

    def piece(p, i):
        tag = F.substring_index(p, ">", 1)
        is_tag = (i > 0) & p.rlike("^[A-Za-z]") & p.contains(">")
        rest = F.substr(p, F.length(tag) + 1)
        return F.when(
            is_tag, F.concat(F.regexp_replace(tag, EVENT_ATTRIBUTE, ""), rest)
        ).otherwise(p)

    return F.array_join(F.transform(F.split(html, "<", -1), piece), "<")
