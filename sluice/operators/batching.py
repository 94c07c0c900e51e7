"""Batches by row count and by bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.ids import batch_identity
from sluice.operators.packing import pack
from sluice.session import written


def global_position(
    df: DataFrame,
    order: Sequence[str | Column],
    out: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """0-based position of every row in a total order, without a one-task window.

    Rows are range partitioned and sorted, and written once so that both passes see the same
    partitions. Offsets are a prefix sum over one row per partition.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    ranged = (
        ranged.sortWithinPartitions(*by)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = written(ranged, "ranges")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: this window and the broadcast are bounded by the partition count.
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    in_partition = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_offset") + in_partition)
        .drop("_pid", "_mid", "_offset")
    )


def position_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "nth"
) -> DataFrame:
    """0-based position inside each group, for orders that no numeric block can cut.

    The total order splits a giant group over many range partitions; its first position comes from
    a partial aggregate. That is written, so that Spark knows its size: for few groups, the rows then
    stay in their range partitions and are not brought together by group.
    """
    placed = global_position(df, [*keys, *order], "_position")
    first = written(placed.groupBy(*keys).agg(F.min("_position").alias("_first")), "firsts")
    return (
        placed.join(first, list(keys))
        .withColumn(out, F.col("_position") - F.col("_first"))
        .drop("_position", "_first")
    )


def batch_by_count(
    df: DataFrame, order: Sequence[str], size: int, out: str = "batch_no", **options
) -> DataFrame:
    """Consecutive batches of ``size`` rows in the given order."""
    placed = global_position(df, order, "_position", **options)
    return placed.withColumn(out, F.floor(F.col("_position") / size)).drop("_position")


def batch_rows(
    ids: DataFrame, id_column: str, size: int, version: str | None = None
) -> DataFrame:
    """One row per batch of sorted distinct ids: items, identity, count. A batch holds ``size`` ids.

    An id that occurs with two versions fails the job: its versions would share one batch item.
    """
    source = ids.select(
        F.col(id_column).alias("_id"),
        (F.col(version) if version else F.lit(None)).cast("string").alias("_version"),
    ).distinct()
    batches = (
        batch_by_count(source, ["_id"], size)
        .groupBy("batch_no")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("_id").cast("string").alias("identifier"),
                        F.col("_version").alias("version"),
                    )
                )
            ).alias("batch_items"),
            F.min("_id").cast("string").alias("first_id"),
            F.max("_id").cast("string").alias("last_id"),
        )
    )
    names = F.transform("batch_items", lambda i: i["identifier"])
    unique = F.size(names) == F.size(F.array_distinct(names))
    return batches.select(
        "batch_no",
        F.when(unique, batch_identity(F.col("batch_items")))
        .otherwise(F.raise_error(F.lit("duplicate identifiers in a batch")))
        .alias("identifier"),
        "batch_items",
        F.size("batch_items").cast("long").alias("n_items"),
        "first_id",
        "last_id",
    )


def batch_by_bytes(
    df: DataFrame,
    size: Column,
    limit_bytes: int | None,
    max_rows: int | None = None,
    key: str = "record_id",
    order: str = "pos",
    min_size: int = 1,
    **options,
) -> DataFrame:
    """Greedy batches per record: a row that would pass either limit opens the next batch.

    A row larger than the limit is a batch of its own; no batch is empty. Without limits all rows
    of a record are one batch. ``min_size`` is a lower bound of the row size, which bounds how far
    a batch can reach.
    """
    if limit_bytes is None and max_rows is None:
        return df.withColumn("batch_start", F.lit(0).cast("long"))
    return pack(
        df.withColumn("_size", size.cast("long")),
        key=key,
        order=order,
        size="_size",
        limit=limit_bytes,
        max_rows=max_rows,
        min_size=min_size,
        out="batch_start",
        **options,
    ).drop("_size")


def columnar_batch(df: DataFrame, columns: Sequence[str], batch: str, order: str) -> DataFrame:
    """Parallel lists of equal length per batch; a batch is bounded by its size."""
    rows = F.array_sort(
        F.collect_list(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in columns]))
    )
    grouped = df.groupBy(batch).agg(rows.alias("_rows"))

    def column_of(name: str) -> Column:
        return F.transform("_rows", lambda r: r[name]).alias(name)

    return grouped.select(batch, *[column_of(c) for c in columns])
