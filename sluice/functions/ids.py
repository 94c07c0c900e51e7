"""Deterministic identities, all as JVM expressions."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the RFC 4122 DNS namespace.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5_dns(name: Column) -> Column:
    """RFC 4122 version-5 UUID of ``name`` in the DNS namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE_HEX)), F.encode(name, "UTF-8")))
    # Top two bits of the 17th nibble are the variant 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def enhanced_element_id(element_id: Column, record_id: Column) -> Column:
    """Row id of an element inside its record; a missing element id prints as ``None``."""
    return uuid5_dns(F.concat(F.coalesce(element_id.cast("string"), F.lit("None")), record_id))


def element_hash(filename: Column, text: Column, page: Column, seq: Column) -> Column:
    """Content id of an element: missing parts print as ``None``."""
    parts = [F.coalesce(c.cast("string"), F.lit("None")) for c in (filename, text, page, seq)]
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def sha256_id(*parts: Column, sep: str = "-") -> Column:
    return F.sha2(F.concat_ws(sep, *parts), 256)


def sha256_16(value: Column) -> Column:
    return F.substring(F.sha2(value, 256), 1, 16)


def fields_suffix(fields: Sequence[str] | None) -> str:
    """``-<8 hex>`` for a projected record, empty for a whole one. Plan-time constant."""
    if not fields:
        return ""
    return "-" + hashlib.sha256(",".join(fields).encode()).hexdigest()[:8]


def record_identifier(
    prefix: str | None, record_id: Column, fields: Sequence[str] | None = None
) -> Column:
    """``prefix-id`` plus a hash of the projected fields when only some are read."""
    head = [] if prefix is None else [F.lit(f"{prefix}-")]
    return F.concat(*head, record_id.cast("string"), F.lit(fields_suffix(fields)))


def prefixed_id(record_id: Column, element_uuid: Column) -> Column:
    """``record#uuid`` so that a store can delete a record by id prefix."""
    return F.concat_ws("#", record_id, element_uuid)


def config_hash(config: dict, *extras: str) -> str:
    """Lineage key of a step's settings. Plan-time constant."""
    payload = json.dumps(config, sort_keys=True, default=str) + "".join(extras)
    return hashlib.sha256(payload.encode()).hexdigest()[:12]


def batch_identity(items: Column) -> Column:
    """Identity of a batch: uuid5 over its sorted id -> version JSON object.

    ``items`` is an array of (identifier, version) structs sorted by identifier.
    """
    pairs = F.transform(
        items,
        lambda i: F.concat(
            ascii_json_string(i["identifier"]),
            F.lit(": "),
            F.coalesce(ascii_json_string(i["version"]), F.lit("null")),
        ),
    )
    return uuid5_dns(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")))


def json_quote(value: Column) -> Column:
    """JSON text of one value of any type, null when the value is null."""
    boxed = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(boxed, F.lit(2), F.length(boxed) - F.lit(2)))


def ascii_json_string(value: Column) -> Column:
    """JSON string literal with every non-ASCII or control character as ``\\uXXXX``.

    Hash inputs need this form; ``to_json`` leaves non-ASCII characters unescaped.
    """

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))

    def escape(ch: Column) -> Column:
        code = F.ascii(ch)
        above = code - 0x10000
        return (
            F.when(ch == '"', F.lit('\\"'))
            .when(ch == "\\", F.lit("\\\\"))
            .when(ch == "\n", F.lit("\\n"))
            .when(ch == "\r", F.lit("\\r"))
            .when(ch == "\t", F.lit("\\t"))
            .when(ch == "\b", F.lit("\\b"))
            .when(ch == "\f", F.lit("\\f"))
            .when(
                code > 0xFFFF,
                F.concat(
                    unit(F.shiftright(above, 10) + 0xD800),
                    unit(above.bitwiseAND(0x3FF) + 0xDC00),
                ),
            )
            .when((code > 126) | (code < 32), unit(code))
            .otherwise(ch)
        )

    plain = value.rlike(r"^[ !#-\[\]-~]*$")
    escaped = F.array_join(F.transform(F.split(value, ""), escape), "")
    return F.concat(F.lit('"'), F.when(plain, value).otherwise(escaped), F.lit('"'))
