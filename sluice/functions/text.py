"""String and JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.dates import float_text

# Fixed value: byte limit of one text field in a document store.
MAX_FIELD_BYTES = 8000


def truncate_utf8_bytes(text: Column, limit: int = MAX_FIELD_BYTES) -> Column:
    """Cut to ``limit`` bytes and drop the broken character a cut may leave behind."""
    head = F.substring(F.encode(text, "UTF-8"), 1, limit)
    # Only the last three bytes can belong to an incomplete character: a lead byte followed by
    # fewer continuation bytes than it announces.
    tail = F.hex(F.substring(head, -3, 3))
    broken = (
        F.when(tail.rlike("[CDEF][0-9A-F]$"), 1)
        .when(tail.rlike("[EF][0-9A-F][89AB][0-9A-F]$"), 2)
        .when(tail.rlike("F[0-9A-F][89AB][0-9A-F][89AB][0-9A-F]$"), 3)
        .otherwise(0)
    )
    whole = F.substring(head, F.lit(1), F.lit(limit) - broken)
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.decode(whole, "UTF-8"))


def fix_unescaped_unicode(text: Column) -> Column:
    r"""Turn literal ``\uXXXX`` text into the character; text that would not decode is kept."""
    quoted = F.to_json(F.array(text))
    unescaped = F.regexp_replace(quoted, r"\\\\u([0-9A-Fa-f]{4})", r"\\u$1")
    decoded = F.get(F.from_json(unescaped, "array<string>"), F.lit(0))
    # A lone surrogate cannot be encoded; keep the input then.
    lone = text.rlike(
        r"(?i)\\ud[89ab][0-9a-f]{2}(?!\\ud[c-f][0-9a-f]{2})"
        r"|(?<!\\ud[89ab][0-9a-f]{2})\\ud[c-f][0-9a-f]{2}"
    )
    return F.when(text.rlike(r"\\u[0-9A-Fa-f]{4}") & ~lone, F.coalesce(decoded, text)).otherwise(
        text
    )


def json_or_text(text: Column) -> Column:
    """JSON value of the text; a second try reads single quotes as double; else the text."""
    first = F.try_parse_json(text)
    second = F.try_parse_json(F.replace(text, F.lit("'"), F.lit('"')))
    return F.coalesce(F.to_json(first), F.to_json(second), text)


def vector_to_csv(vector: Column) -> Column:
    return F.array_join(F.transform(vector, float_text), ",")


def prompt_normalize(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def sanitize_name(name: Column, fallback: str) -> Column:
    """Attachment name without path separators."""
    clean = F.regexp_replace(F.regexp_replace(name, r"[/\\]+", "_"), r"^\s+|\s+$", "")
    return F.when(clean != "", clean).otherwise(F.lit(fallback))


def csv_field(value: Column) -> Column:
    """One CSV cell, quoted only when needed; null is empty."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\r\n]'), quoted).otherwise(text)


def csv_line(*cells: Column) -> Column:
    # concat keeps empty cells, which concat_ws over nulls would drop.
    line = csv_field(cells[0])
    for cell in cells[1:]:
        line = F.concat(line, F.lit(","), csv_field(cell))
    return line


def plain_text(value: Column, dtype) -> Column:
    """Text of one typed scalar: floats in plain notation, booleans as True/False."""
    name = dtype.typeName()
    if name in ("double", "float"):
        return float_text(value.cast("double") if name == "double" else value)
    if name == "boolean":
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    return value.cast("string")
