"""The Arrow-batched helpers for the few string rules Spark has no built-in for."""

from __future__ import annotations

from functools import lru_cache
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _string_udf(per_value):
    # Declared nondeterministic so that the optimizer neither copies the call into a filter
    # nor runs it again: one Arrow pass per row.
    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array(
            [None if v is None else per_value(v) for v in batch.to_pylist()], pa.string()
        )

    return run.asNondeterministic()


# Entities that are replaced without leaving the JVM; the ampersand goes last (fixed values).
_COMMON = (
    "lt", "gt", "quot", "apos", "#39", "nbsp", "copy", "middot", "hellip", "mdash", "ndash",
    "lsquo", "rsquo", "ldquo", "rdquo", "amp",
)


@lru_cache(maxsize=1)
def _other_entity() -> str:
    """An entity, or its beginning, that is not one of the common ones."""
    # Names that HTML lets stand without a semicolon, from the standard library's table.
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return (
        f"&(?!(?:{'|'.join(_COMMON)});)"
        f"(?:#[0-9xX]|[A-Za-z][A-Za-z0-9]*;|{'|'.join(bare)})"
    )


def _common_replaced(text: Column) -> Column:
    for name in _COMMON:
        entity = f"&{name};"
        text = F.replace(text, F.lit(entity), F.lit(unescape(entity)))
    return text


def html_unescape(text: Column) -> Column:
    """Full HTML unescape.  Texts with common entities only are done in the JVM.

    The operand is used several times: hand in a column, not a costly expression.
    """

    def full(value):
        from html import unescape as f

        return f(value)

    has_any = text.contains("&")
    has_other = has_any & text.rlike(_other_entity())
    return F.coalesce(
        _string_udf(full)(F.when(has_other, text)),
        F.when(has_any & text.contains(";"), _common_replaced(text)),
        text,
    )


def text_of_nested(html: Column) -> Column:
    """Text of pages with nested boilerplate blocks, by counting tags; nulls stay null."""

    def text(value):
        from linkloom.functions.html import text_of_nested as f

        return f(value)

    return _string_udf(text)(html)


def nfkd(text: Column) -> Column:
    """NFKD normalization; pure ASCII is its own normal form and stays in the JVM."""

    def normal(value):
        from unicodedata import normalize

        return normalize("NFKD", value)

    touched = text.rlike(r"[^\x00-\x7f]")
    return F.coalesce(_string_udf(normal)(F.when(touched, text)), text)


def plain_texts(texts: Column, normalize: bool = True) -> Column:
    """Unescape, then NFKD-normalize, every string of an array; plain arrays stay in the JVM."""
    @F.arrow_udf("array<string>")
    def run(batch: pa.Array) -> pa.Array:
        from html import unescape
        from unicodedata import normalize as normal_form

        import pyarrow.compute as pc

        values = [unescape(v) for v in batch.flatten().to_pylist()]
        if normalize:
            values = [normal_form("NFKD", v) for v in values]
        ends = pc.cumulative_sum(pc.fill_null(batch.value_lengths(), 0)).to_pylist()
        return pa.ListArray.from_arrays(
            pa.array([0, *ends], pa.int32()), pa.array(values, pa.string()), mask=batch.is_null()
        )

    def needs(text):
        escaped = text.contains("&")
        return escaped | text.rlike(r"[^\x00-\x7f]") if normalize else escaped

    return F.coalesce(run.asNondeterministic()(F.when(F.exists(texts, needs), texts)), texts)
