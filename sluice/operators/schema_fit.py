"""Fitting rows to a destination schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fit_to_schema(
    df: DataFrame,
    target: T.StructType,
    add_missing: bool = True,
    case_sensitive: bool = True,
    cast: bool = True,
) -> DataFrame:
    """Drop columns the target lacks and add null columns it has; columns come in target order."""
    have = {c if case_sensitive else c.lower(): c for c in df.columns}
    out = []
    for field in target.fields:
        name = have.get(field.name if case_sensitive else field.name.lower())
        if name is None:
            if add_missing:
                out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        column = F.col(f"`{name}`")
        if cast and df.schema[name].dataType != field.dataType:
            column = column.cast(field.dataType)
        out.append(column.alias(field.name))
    return df.select(*out)


def _prune(
    value: Column, have: T.DataType, want: T.DataType, depth: int, max_depth: int | None
) -> Column:
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        if max_depth is not None and depth >= max_depth:
            return F.when(value.isNotNull(), F.struct())
        wanted = {f.name: f.dataType for f in want.fields}
        fields = [
            _prune(value[f.name], f.dataType, wanted[f.name], depth + 1, max_depth).alias(
                f.name
            )
            for f in have.fields
            if f.name in wanted
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType):
        inner = want.elementType if isinstance(want, T.ArrayType) else want
        if isinstance(have.elementType, T.StructType) and isinstance(inner, T.StructType):
            return F.transform(
                value, lambda item: _prune(item, have.elementType, inner, depth, max_depth)
            )
    return value


def fit_nested_schema(
    df: DataFrame, target: T.StructType, max_depth: int | None = None
) -> DataFrame:
    """Keep only fields of the target's field tree, at every level and inside lists of objects.

    ``max_depth`` is the depth a destination allows, if it has such a limit; objects below it are
    emptied.
    """
    wanted = {f.name: f.dataType for f in target.fields}
    return df.select(
        *[
            _prune(F.col(f"`{f.name}`"), f.dataType, wanted[f.name], 1, max_depth).alias(f.name)
            for f in df.schema.fields
            if f.name in wanted
        ]
    )


def _missing_paths(
    value: Column, have: T.StructType, want: T.StructType, prefix: str
) -> list[tuple[str, Column]]:
    """(path, is present in this row) of the fields the target lacks."""
    wanted = {f.name: f.dataType for f in want.fields}
    out = []
    for field in have.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        column = F.col(f"`{field.name}`") if value is None else value[field.name]
        if field.name not in wanted:
            out.append((path, column.isNotNull()))
            continue
        target = wanted[field.name]
        if isinstance(field.dataType, T.StructType) and isinstance(target, T.StructType):
            out.extend(_missing_paths(column, field.dataType, target, path))
        elif (
            isinstance(field.dataType, T.ArrayType)
            and isinstance(field.dataType.elementType, T.StructType)
            and isinstance(target, T.ArrayType)
            and isinstance(target.elementType, T.StructType)
        ):
            wanted_items = {f.name for f in target.elementType.fields}
            for sub in field.dataType.elementType.fields:
                if sub.name not in wanted_items:
                    out.append((f"{path}.{sub.name}", _any_item_has(column, sub.name)))
    return out


def _any_item_has(items: Column, name: str) -> Column:
    return F.coalesce(F.exists(items, lambda item: item[name].isNotNull()), F.lit(False))


def dropped_columns_report(df: DataFrame, target: T.StructType) -> DataFrame:
    """(path, rows) of the data's fields that the target lacks, in one aggregation."""
    missing = _missing_paths(None, df.schema, target, "")
    if not missing:
        return df.sparkSession.createDataFrame([], "path string, n_rows long")
    counts = df.agg(
        *[F.count(F.when(present, 1)).alias(f"_{i}") for i, (_, present) in enumerate(missing)]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(path).alias("path"), F.col(f"_{i}").alias("n_rows"))
            for i, (path, _) in enumerate(missing)
        ]
    )
    return counts.select(F.explode(pairs).alias("p")).select("p.*").filter("n_rows > 0")


def non_empty_columns(df: DataFrame) -> list[str]:
    """Columns with any non-null value. One aggregation; only one row reaches the driver."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if counts[c] > 0]


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)])
