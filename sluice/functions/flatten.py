"""Flattening of nested rows, driven by the schema at plan time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.ids import json_quote
from sluice.functions.text import plain_text
from sluice.session import reliable

ENTRY = "array<struct<key:string,value:string,json:string>>"
PAIR = "array<struct<key:string,value:string>>"


def flat_columns(
    schema: T.StructType,
    source: str | None = None,
    sep: str = "_",
    keep: Sequence[str] = (),
    prefix: str = "",
) -> list[tuple[str, Column]]:
    """Leaf columns of a struct schema as (flat name, column). Arrays and maps stay whole.

    Names in ``keep`` are not descended into.
    """
    out: list[tuple[str, Column]] = []
    for field in schema.fields:
        name = f"{prefix}{sep}{field.name}" if prefix else field.name
        path = f"{source}.`{field.name}`" if source else f"`{field.name}`"
        if isinstance(field.dataType, T.StructType) and name not in keep:
            out.extend(flat_columns(field.dataType, path, sep, keep, name))
        else:
            out.append((name, F.col(path)))
    return out


def flatten_struct(
    df: DataFrame, column: str, sep: str = "_", keep: Sequence[str] = (), prefix: str = ""
) -> DataFrame:
    """Replace a struct column by its flat leaves; a top-level name clash is won by the leaf."""
    schema = df.schema[column].dataType
    leaves = flat_columns(schema, f"`{column}`", sep, keep, prefix)
    names = {name for name, _ in leaves}
    rest = [F.col(f"`{c}`") for c in df.columns if c != column and c not in names]
    return df.select(*rest, *[c.alias(name) for name, c in leaves])


def _entry(key: Column, value: Column, dtype: T.DataType, json: bool) -> Column:
    nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
    text = F.to_json(value) if nested else plain_text(value, dtype)
    fields = [key.alias("key"), F.when(value.isNotNull(), text).alias("value")]
    return F.struct(*fields, *([json_quote(value).alias("json")] if json else []))


def flat_entries(
    value: Column,
    dtype: T.DataType,
    key: Column,
    sep: str = "-",
    lists: bool = False,
    drop_null: bool = False,
    json: bool = True,
) -> Column:
    """(key, value, json) entries of a nested value, in schema and list order.

    ``lists`` descends into arrays with the index as key part. Map keys are data, so map entries
    are read from the row; all other keys come from the schema. Without ``json`` the entries are
    (key, value): nothing later would keep Spark from making the JSON text of every value.
    """
    none = F.array().cast(ENTRY if json else PAIR)
    absent = none if drop_null else F.array(_null_entry(key, json))
    if isinstance(dtype, T.StructType):
        parts = [
            flat_entries(
                value[f.name],
                f.dataType,
                F.concat(key, F.lit(sep + f.name)),
                sep,
                lists,
                drop_null,
                json,
            )
            for f in dtype.fields
        ]
        inner = F.concat(*parts) if parts else none
        return F.when(value.isNotNull(), inner).otherwise(absent)
    if isinstance(dtype, T.MapType):
        inner = F.flatten(
            F.transform(
                F.map_entries(value),
                lambda e: flat_entries(
                    e["value"],
                    dtype.valueType,
                    F.concat(key, F.lit(sep), e["key"]),
                    sep,
                    lists,
                    drop_null,
                    json,
                ),
            )
        )
        return F.when(value.isNotNull(), inner).otherwise(absent)
    if isinstance(dtype, T.ArrayType) and lists:
        inner = F.flatten(
            F.transform(
                value,
                lambda item, i: flat_entries(
                    item,
                    dtype.elementType,
                    F.concat(key, F.lit(sep), i.cast("string")),
                    sep,
                    lists,
                    drop_null,
                    json,
                ),
            )
        )
        return F.when(value.isNotNull(), inner).otherwise(absent)
    entry = F.array(_entry(key, value, dtype, json))
    if drop_null:
        return F.when(value.isNotNull(), entry).otherwise(none)
    return entry


def _null_entry(key: Column, json: bool) -> Column:
    names = ["value", "json"] if json else ["value"]
    return F.struct(key.alias("key"), *[F.lit(None).cast("string").alias(n) for n in names])


def flat_row_entries(
    schema: T.StructType,
    columns: Sequence[str],
    sep: str = "-",
    lists: bool = False,
    drop_null: bool = False,
    prefix: str = "",
    json: bool = True,
) -> Column:
    """Entries of several top-level columns, in the given order."""
    parts = [
        flat_entries(
            F.col(f"`{c}`"), schema[c].dataType, F.lit(prefix + c), sep, lists, drop_null, json
        )
        for c in columns
    ]
    return F.concat(*parts)


def entries_map(entries: Column, json: bool = True) -> Column:
    """The map of key to value; ``json`` tells whether the entries have JSON text to leave out."""
    if not json:
        return F.map_from_entries(entries)
    return F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    )


def entries_json(entries: Column) -> Column:
    """JSON object text of flat entries; null values print as ``null``."""
    pairs = F.transform(
        entries,
        lambda e: F.concat(
            json_quote(e["key"]), F.lit(":"), F.coalesce(e["json"], F.lit("null"))
        ),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def flat_values_text(entries: Column) -> Column:
    """Values joined by newlines in order; a missing value prints as ``None``."""
    return F.array_join(
        F.transform(entries, lambda e: F.coalesce(e["value"], F.lit("None"))), "\n"
    )


def variant_entries(df: DataFrame, column: str) -> DataFrame:
    """(path, value) rows of a VARIANT column whose keys are only known from the data.

    One lateral explode per nesting level, until no row holds an object. Each level is written,
    so that asking whether it is the last one computes it once. Arrays are leaves.
    """
    rest = [c for c in df.columns if c != column]
    tvf = df.sparkSession.tvf
    level = reliable(df.select(*rest, F.lit("").alias("path"), F.col(column).alias("v")))
    is_object = F.schema_of_variant(F.col("v")).startswith("OBJECT")
    leaves = None
    while True:
        done = level.filter(F.coalesce(~is_object, F.lit(True)))
        done = done.select(*rest, "path", F.col("v").cast("string").alias("value"))
        leaves = done if leaves is None else leaves.unionByName(done)
        nested = level.filter(is_object).alias("l")
        if nested.isEmpty():
            return leaves
        entries = nested.lateralJoin(tvf.variant_explode(F.col("l.v").outer()).alias("e"))
        name = F.when(F.col("l.path") == "", F.col("e.key")).otherwise(
            F.concat(F.col("l.path"), F.lit("_"), F.col("e.key"))
        )
        level = reliable(
            entries.select(
                *[F.col(f"l.`{c}`") for c in rest], name.alias("path"), F.col("e.value").alias("v")
            )
        )
