"""Content ids of elements and the matching parent references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.ids import element_hash
from sluice.operators.sequence import seq_on_page


def assign_hash_ids(
    elements: DataFrame, strict: bool = False, bounded: bool = False, parents: bool = True
) -> DataFrame:
    """Replace element ids by content ids and map parent ids to the new ids.

    ``parents=False`` skips the mapping for rows without parents, such as chunks.
    """
    work = elements.withColumn("_page", F.col("metadata.page_number"))
    work = seq_on_page(work, "_page", "_seq", bounded=bounded)
    work = work.withColumn("old_id", F.col("element_id")).withColumn(
        "element_id",
        element_hash(F.col("metadata.filename"), F.col("text"), F.col("_page"), F.col("_seq")),
    )
    work = work.drop("_page", "_seq")
    return (remap_parent_ids(work, strict) if parents else work).drop("old_id")


def remap_parent_ids(elements: DataFrame, strict: bool = False) -> DataFrame:
    """Map ``metadata.parent_id`` from old to new ids inside each record.

    The lookup has one row per old id (its last element wins), so the element side may be skewed
    towards one parent while the lookup side is unique; adaptive execution splits the skewed side.
    ``strict`` fails on a parent that does not exist, otherwise such a parent becomes null.
    """
    parent = F.when(F.col("metadata.parent_id") != "", F.col("metadata.parent_id"))
    lookup = (
        elements.groupBy("record_id", F.col("old_id").alias("_old_parent"))
        .agg(F.max_by("element_id", "pos").alias("_new_parent"))
    )
    joined = elements.withColumn("_old_parent", parent).join(
        lookup, ["record_id", "_old_parent"], "left"
    )
    mapped = F.col("_new_parent")
    if strict:
        missing = F.raise_error(F.concat(F.lit("unknown parent id "), F.col("_old_parent")))
        mapped = F.when(
            F.col("_old_parent").isNotNull() & F.col("_new_parent").isNull(), missing
        ).otherwise(mapped)
    return joined.withColumn(
        "metadata", F.col("metadata").withField("parent_id", mapped)
    ).select(*elements.columns)
