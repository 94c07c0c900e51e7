"""Documents as ordered parts.

A document that is put together from child rows may have any number of them, so it is not one cell.
It is rows (identity .., part, text): parts are numbered from 0, all have the identity of the document,
and their texts joined in that order, with nothing between them, are the document. Nearly every
document has one part. Which children a part holds follows from their position alone, so no task
ever holds more than a part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.batching import position_in_group
from sluice.operators.sequence import dense_position

PART_ROWS = 4096


def part_of(position: Column, part_rows: int) -> Column:
    return F.floor(position / F.lit(part_rows)).cast("long")


def placed_rows(
    rows: DataFrame, keys: Sequence[str], order: str | Sequence[str], numeric_order: bool = True
) -> DataFrame:
    """``rows`` with ``nth``, the position from 0 within the key.

    A numeric first order column (a rank) cuts large keys into blocks of positions; any other order
    is placed by range partitioning (``numeric_order=False``).
    """
    if numeric_order:
        return dense_position(rows, "nth", key=list(keys), order=order)
    return position_in_group(rows, list(keys), [order] if isinstance(order, str) else list(order))


def part_texts(
    placed: DataFrame,
    keys: Sequence[str],
    render: Callable[[Column], Column],
    columns: Sequence[str] = ("text",),
    between: str = "",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(key.., part, text): the rows of each part rendered and joined by ``between``.

    Parts after the first begin with ``between``. ``render`` gets a struct of nth and ``columns``.
    """
    ordered = F.array_sort(F.collect_list(F.struct("nth", *columns)))
    joined = F.array_join(F.transform("_rows", render), between)
    lead = F.when(F.col("part") > 0, F.lit(between)).otherwise(F.lit(""))
    return (
        placed.withColumn("part", part_of(F.col("nth"), part_rows))
        .groupBy(*keys, "part")
        .agg(ordered.alias("_rows"))
        .select(*keys, "part", F.concat(lead, joined).alias("text"))
    )


def assembled(
    texts: DataFrame,
    keys: Sequence[str],
    heads: DataFrame | None = None,
    children: DataFrame | None = None,
    opening: Column | None = None,
    closing: Column | None = None,
    part_rows: int = PART_ROWS,
    counts: DataFrame | None = None,
    several: DataFrame | None = None,
) -> DataFrame:
    """The columns of ``heads`` (one row per key), ``part`` and ``body``.

    ``opening`` stands before the first part and ``closing`` after the last one; both may use the
    columns of ``heads``. Documents without children have one part. ``children`` has a row per child
    and tells which heads have none and, if there is a closing, which part is the last. Without
    ``heads``, every key that has children is a document. ``counts`` (key.., _children) takes the
    place of ``children`` where they are counted already. ``several`` (key.., _children) has only the
    documents of more than ``part_rows`` children, without heads; all others end with part 0, and if
    Spark knows that they are few, texts do not move.
    """
    last = F.lit(True)
    bare = None
    if heads is not None:
        present = next(d for d in (children, counts, texts) if d is not None)
        present = present.select(*keys).distinct()
        bare = heads.join(present, list(keys), "left_anti")
    if several is not None:
        last = F.col("part") == part_of(F.coalesce("_children", F.lit(1)) - 1, part_rows)
        lone = " OR ".join(f"`{k}` IS NULL" for k in keys)
        # A document without a key has none of its texts.
        named = several.where(f"NOT ({lone})")
        texts = texts.where(f"NOT ({lone}) OR part = 0")
        texts = texts.join(named, list(keys), "left")
        texts = texts.withColumn("text", F.when(~F.expr(lone), F.col("text")))
    elif closing is not None:
        if counts is None:
            counts = children.groupBy(*keys).agg(F.count(F.lit(1)).alias("_children"))
        if heads is None:
            heads, bare = counts, counts.where(" OR ".join(f"`{k}` IS NULL" for k in keys))
        else:
            heads = heads.join(counts, list(keys), "left")
        last = F.col("part") == part_of(F.coalesce("_children", F.lit(1)) - 1, part_rows)
    # An inner join and the heads left over: Spark splits a large document in it, but never on that
    # side of an outer join.
    found = texts
    if heads is not None:
        found = heads.join(texts, list(keys)).unionByName(bare, allowMissingColumns=True)
    found = found.withColumn("part", F.coalesce("part", F.lit(0).cast("long")))
    pieces = [F.coalesce("text", F.lit(""))]
    if opening is not None:
        pieces.insert(0, F.when(F.col("part") == 0, opening).otherwise(F.lit("")))
    if closing is not None:
        pieces.append(F.when(last, closing).otherwise(F.lit("")))
    return found.withColumn("body", F.concat(*pieces)).drop("text", "_children")
