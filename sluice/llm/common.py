"""Shared pieces of the corpus operators: stage tables, total order, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.session import checkpoint_dir

# Words are runs of anything but space and the five ASCII line and tab characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/corpus/{label}-{uuid.uuid4().hex}"


BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
_BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
    "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, Arrow batches have at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES``.

    Whole texts make long rows, and a batch is held by the JVM and by Python at once, for every core
    of an executor. A row longer than the bound is a batch of its own.
    """
    before = {name: spark.conf.get(name) for name in _BATCH_SETTINGS}
    for name, most in _BATCH_SETTINGS.items():
        spark.conf.set(name, most)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage.

    A lost executor then costs a reread and not the stages before.
    """
    path = shared_path(df.sparkSession, label)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its dense position (from 0) in the total order given, as column ``name``.

    Range partitions are written once; the position is the rank within the partition plus the rows
    of all partitions before, a sum over one row per partition. Rows that tie are numbered in any
    order. ``df`` must have no columns ``_part`` and ``_before``.
    """
    parts = staged(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        parts.withColumn(name, rank)
        .join(offsets, "_part")
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_part", "_before")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b); the component is its smallest node.

    Rounds of contraction: every node points to its smallest neighbour if that is smaller than
    itself, pointers are followed to their roots by doubling, and edges are moved to the roots.
    Pointers always go down, so a root is the smallest node of its tree and the last root the
    smallest of its component. Only narrow pairs are written; joins read written tables on both
    sides, so that adaptive execution can split a hot node. Edges with a null end are ignored, an
    edge from a node to itself only names the node. Repeated edges and empty input are allowed.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    loops = edges.where("a = b").select(F.col("a").alias("node")).distinct()
    left = staged(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = staged(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
                "node", F.least("node", "b").alias("root")
            ),
            "pointers",
        )
        while True:
            up = pointers.select(F.col("node").alias("root"), F.col("root").alias("top"))
            moved = staged(pointers.join(up, "root").select("node", "root", "top"), "pointers")
            pointers = moved.select("node", F.col("top").alias("root"))
            if moved.where("root <> top").isEmpty():
                break
        maps.append(pointers)
        to = pointers.withColumnRenamed("node", "a").withColumnRenamed("root", "ra")
        on = pointers.withColumnRenamed("node", "b").withColumnRenamed("root", "rb")
        left = staged(
            left.join(to, "a")
            .join(on, "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "edges",
        )
    found = None
    for pointers in maps:
        if found is None:
            found = pointers.select("node", F.col("root").alias("component"))
        else:
            up = pointers.select(F.col("node").alias("component"), "root")
            found = found.join(up, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")
            )
    alone = loops.select("node", F.col("node").alias("component"))
    if found is None:
        return alone
    found = staged(found, "components")
    return found.unionByName(alone.join(found, "node", "left_anti"))
