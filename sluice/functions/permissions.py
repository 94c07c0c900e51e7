"""Access lists: canonical JSON and digest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.ids import ascii_json_string, json_quote

OPERATIONS = ("read", "update", "delete")


def permissions_json(permissions: Column) -> Column:
    """``[{"read":{"users":[..],"groups":[..]}}, ..]`` as compact text, null for null."""
    empty = F.array().cast("array<string>")
    items = F.transform(
        permissions,
        lambda p: F.concat(
            F.lit("{"),
            json_quote(p["op"]),
            F.lit(':{"users":'),
            F.to_json(F.coalesce(p["users"], empty)),
            F.lit(',"groups":'),
            F.to_json(F.coalesce(p["groups"], empty)),
            F.lit("}}"),
        ),
    )
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _canonical(permissions: Column) -> Column:
    """Array text with sorted keys and sorted lists."""

    def names(values: Column, sep: str) -> Column:
        quoted = F.array_sort(F.transform(values, ascii_json_string))
        return F.concat(F.lit("["), F.array_join(quoted, sep), F.lit("]"))

    def item(p: Column, comma: str, colon: str) -> Column:
        empty = F.array().cast("array<string>")
        return F.concat(
            F.lit("{"),
            ascii_json_string(p["op"]),
            F.lit(f'{colon}{{"groups"{colon}'),
            names(F.coalesce(p["groups"], empty), comma),
            F.lit(f'{comma}"users"{colon}'),
            names(F.coalesce(p["users"], empty), comma),
            F.lit("}}"),
        )

    # Items sort by their spaced text, which orders a list before its longer continuation.
    ordered = F.array_sort(
        F.transform(
            permissions,
            lambda p: F.struct(item(p, ", ", ": ").alias("sort"), item(p, ",", ":").alias("text")),
        )
    )
    texts = F.transform(ordered, lambda i: i["text"])
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def acl_digest(permissions: Column, denied: Column | None = None) -> Column:
    """Order-insensitive digest of an access list.

    Null means that no access list was delivered; an empty list is a state of its own.
    """
    allowed_text = F.coalesce(_canonical(permissions), F.lit("[]"))
    if denied is None:
        denied_text, known = F.lit("[]"), permissions.isNotNull()
    else:
        denied_text = F.coalesce(_canonical(denied), F.lit("[]"))
        known = permissions.isNotNull() | denied.isNotNull()
    payload = F.concat(
        F.lit('{"denied":'), denied_text, F.lit(',"permissions":'), allowed_text, F.lit("}")
    )
    return F.when(known, F.sha2(payload, 256))
