"""Masks for paths, identifiers, URLs and secrets in reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name parts that mark a secret.
SECRET_WORDS = [
    "password",
    "token",
    "secret",
    "key",
    "api_key",
    "access_token",
    "refresh_token",
    "client_secret",
    "private_key",
    "credentials",
]
# Name parts that mark a location.
LOCATION_WORDS = ["path", "file", "location", "document_location"]


def mask_path(path: Column) -> Column:
    """File name only; deeper paths keep their parent as ``.../parent/name``."""
    clean = F.regexp_replace(F.regexp_replace(path, "/+", "/"), "(?<=.)/$", "")
    parts = F.filter(F.split(clean, "/"), lambda p: (p != "") & (p != "."))
    depth = F.size(parts) + F.when(clean.startswith("/"), 1).otherwise(0)
    name = F.element_at(parts, -1)
    parent = F.try_element_at(parts, F.lit(-2))
    return (
        F.when(F.coalesce(path, F.lit("")) == "", F.lit("<empty>"))
        .when(depth > 2, F.concat(F.lit(".../"), F.coalesce(parent, F.lit("")), F.lit("/"), name))
        .otherwise(F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")))
    )


def _edges(value: Column, empty: str) -> Column:
    size = F.length(value)
    return (
        F.when(F.coalesce(value, F.lit("")) == "", F.lit(empty))
        .when(
            size < 10,
            F.concat(F.substring(value, F.lit(1), F.floor(size / 2).cast("int")), F.lit("...")),
        )
        .otherwise(F.concat(F.substring(value, 1, 4), F.lit("..."), F.right(value, F.lit(4))))
    )


def mask_id(value: Column) -> Column:
    return _edges(value, "<id>")


def mask_token(value: Column) -> Column:
    return _edges(value, "<token>")


def mask_url(url: Column) -> Column:
    """Drop query and fragment."""
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("<url>")).otherwise(
        F.regexp_extract(url, r"^([^?#]*)", 1)
    )


def mask_location(location: Column) -> Column:
    """URL, ``table:id`` reference or path, whichever the text looks like."""
    reference = F.concat(
        F.substring_index(location, ":", 1),
        F.lit(":"),
        mask_id(F.substring(location, F.instr(location, ":") + 1, F.length(location))),
    )
    return (
        F.when(F.coalesce(location, F.lit("")) == "", F.lit("<empty>"))
        .when(location.rlike("^(http|https|ftp|ftps)://"), mask_url(location))
        .when(location.contains(":") & ~location.startswith("/"), reference)
        .otherwise(mask_path(location))
    )


def mask_columns(df: DataFrame) -> DataFrame:
    """Mask string columns by name: secrets, then locations, then long identifiers."""
    out = []
    for field in df.schema.fields:
        name = field.name.lower()
        column = F.col(f"`{field.name}`")
        if any(word in name for word in SECRET_WORDS):
            column = mask_token(column.cast("string"))
        elif field.dataType.typeName() == "string":
            if any(word in name for word in LOCATION_WORDS):
                column = mask_location(column)
            elif "id" in name:
                column = F.when(F.length(column) > 8, mask_id(column)).otherwise(column)
        out.append(column.alias(field.name))
    return df.select(*out)

