"""Ordered operators over the rows of one record, safe when one record holds most rows.

A window partitioned by the record alone would put a giant record into one task. Rows are instead
windowed per (record, block of positions); what a block needs from earlier blocks is computed from
one summary row per block and joined back. The summaries of a record are ``BLOCK_ROWS`` times
fewer than its rows. ``bounded=True`` skips this for records known to be small (for example all
elements that came out of one input row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _blocked(df: DataFrame, key, order, block_rows: int, bounded: bool):
    keys = _keys(key)
    orders = [order] if isinstance(order, str) else list(order)
    block = F.lit(0).cast("long") if bounded else F.floor(F.col(orders[0]) / block_rows)
    rows = df.withColumn("_block", block)
    window = Window.partitionBy(*keys, "_block").orderBy(*orders)
    return rows, keys, orders, window


def _order_struct(orders: list[str]) -> Column:
    return F.struct(*[F.col(o) for o in orders])


def _attach(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    on = [*keys, "_block"]
    return rows.join(carry, on, "left")


def neighbours(
    df: DataFrame,
    value: str,
    before: str | None = None,
    after: str | None = None,
    key="record_id",
    order="pos",
    block_rows: int = BLOCK_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Value of the previous row, of the next row, or of both; null at the ends of the record."""
    rows, keys, orders, window = _blocked(df, key, order, block_rows, bounded)
    if before:
        rows = rows.withColumn(before, F.lag(value).over(window))
    if after:
        rows = rows.withColumn(after, F.lead(value).over(window))
    if bounded:
        return rows.drop("_block")
    rows = rows.withColumn("_head", F.lag(F.lit(True)).over(window).isNull())
    rows = rows.withColumn("_tail", F.lead(F.lit(True)).over(window).isNull())
    at = _order_struct(orders)
    ends = rows.groupBy(*keys, "_block").agg(
        F.min_by(F.col(value), at).alias("_first"), F.max_by(F.col(value), at).alias("_last")
    )
    over_blocks = Window.partitionBy(*keys).orderBy("_block")
    carry = ends.select(
        *keys,
        "_block",
        F.lag("_last").over(over_blocks).alias("_from_before"),
        F.lead("_first").over(over_blocks).alias("_from_after"),
    ).filter(F.col("_from_before").isNotNull() | F.col("_from_after").isNotNull())
    joined = _attach(rows, carry, keys)
    if before:
        edge = F.when(F.col("_head"), F.col("_from_before")).otherwise(F.col(before))
        joined = joined.withColumn(before, edge)
    if after:
        edge = F.when(F.col("_tail"), F.col("_from_after")).otherwise(F.col(after))
        joined = joined.withColumn(after, edge)
    return joined.drop("_block", "_head", "_tail", "_from_before", "_from_after")


def ordered_lag(df: DataFrame, value: str, out: str, **options) -> DataFrame:
    """Value of the previous row of the record."""
    return neighbours(df, value, before=out, **options)


def previous_present(
    df: DataFrame,
    value: str,
    out: str,
    key="record_id",
    order="pos",
    block_rows: int = BLOCK_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Last non-null value before the current row."""
    rows, keys, orders, window = _blocked(df, key, order, block_rows, bounded)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(out, F.last(value, ignorenulls=True).over(before))
    if bounded:
        return rows.drop("_block")
    # Rows without a value have no order and never win; a block without values has a null summary.
    present = F.when(F.col(value).isNotNull(), _order_struct(orders))
    blocks = rows.groupBy(*keys, "_block").agg(F.max_by(F.col(value), present).alias("_last"))
    over_blocks = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = blocks.select(
        *keys, "_block", F.last("_last", ignorenulls=True).over(over_blocks).alias("_carry")
    ).filter(F.col("_carry").isNotNull())
    joined = _attach(rows, carry, keys)
    return joined.withColumn(out, F.coalesce(F.col(out), F.col("_carry"))).drop("_block", "_carry")


def running_sum(
    df: DataFrame,
    value: Column,
    out: str,
    key="record_id",
    order="pos",
    block_rows: int = BLOCK_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Inclusive running sum of an integer expression."""
    rows, keys, _, window = _blocked(df, key, order, block_rows, bounded)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_value", value.cast("long"))
    rows = rows.withColumn(out, F.sum("_value").over(upto))
    if bounded:
        return rows.drop("_block", "_value")
    totals = rows.groupBy(*keys, "_block").agg(F.sum("_value").alias("_total"))
    over_blocks = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *keys, "_block", F.sum("_total").over(over_blocks).alias("_carry")
    ).filter(F.col("_carry") != 0)
    joined = _attach(rows, carry, keys)
    return joined.withColumn(
        out, F.col(out) + F.coalesce(F.col("_carry"), F.lit(0))
    ).drop("_block", "_carry", "_value")


def dense_position(df: DataFrame, out: str, key="record_id", order="pos", **options) -> DataFrame:
    """0-based position of a row inside its record."""
    ranked = running_sum(df, F.lit(1), "_rank", key, order, **options)
    return ranked.withColumn(out, F.col("_rank") - 1).drop("_rank")


def seq_on_page(
    df: DataFrame,
    page: str,
    out: str = "seq",
    key="record_id",
    order="pos",
    block_rows: int = BLOCK_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Index of a row in its run of equal consecutive page values (null equals null).

    The index restarts whenever the page changes, also when an earlier page number comes back.
    """
    rows, keys, orders, window = _blocked(df, key, order, block_rows, bounded)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.row_number().over(window)
    rows = rows.withColumn("_rn", number).withColumn("_prev", F.lag(page).over(window))
    is_start = (F.col("_rn") == 1) | ~F.col("_prev").eqNullSafe(F.col(page))
    rows = rows.withColumn("_start", F.max(F.when(is_start, F.col("_rn"))).over(upto))
    rows = rows.withColumn(out, (F.col("_rn") - F.col("_start")).cast("long")).drop("_prev")
    if bounded:
        return rows.drop("_block", "_rn", "_start")
    at = _order_struct(orders)
    blocks = rows.groupBy(*keys, "_block").agg(
        F.min_by(F.col(page), at).alias("_head"),
        F.max_by(F.col(page), at).alias("_tail"),
        F.max("_start").alias("_tail_start"),
        (F.max("_rn") - F.max("_start") + 1).alias("_tail_rows"),
    )
    over_blocks = Window.partitionBy(*keys).orderBy("_block")
    blocks = blocks.withColumn(
        "_joins",
        (F.row_number().over(over_blocks) > 1)
        & F.lag("_tail").over(over_blocks).eqNullSafe(F.col("_head")),
    )
    # A run passes through a block when the block is one run that continues the block before.
    resets = F.when(F.col("_joins") & (F.col("_tail_start") == 1), 0).otherwise(1)
    blocks = blocks.withColumn("_span", F.sum(resets).over(over_blocks))
    in_span = Window.partitionBy(*keys, "_span").orderBy("_block")
    blocks = blocks.withColumn("_open", F.sum("_tail_rows").over(in_span))
    carry = blocks.select(
        *keys,
        "_block",
        F.when(F.col("_joins"), F.lag("_open").over(over_blocks)).alias("_carry"),
    ).filter(F.col("_carry").isNotNull())
    joined = _attach(rows, carry, keys)
    in_head = F.col("_start") == 1
    return joined.withColumn(
        out, F.col(out) + F.when(in_head, F.coalesce(F.col("_carry"), F.lit(0))).otherwise(0)
    ).drop("_block", "_rn", "_start", "_carry")
