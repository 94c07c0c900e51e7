"""Writers to systems outside Spark: batched calls, messages, JDBC, named connectors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.schema_fit import fit_to_schema
from sluice.operators.staging import element_json

JDBC_BATCH = 50
MESSAGE_BATCH = 100


def batches(
    rows: Iterable, max_rows: int | None, max_bytes: int | None, size: Callable[[object], int]
):
    """Greedy batches of a row stream; no batch is empty, an oversized row is alone."""
    held, used = [], 0
    for row in rows:
        n = size(row) if max_bytes else 0
        full = max_rows is not None and len(held) >= max_rows
        heavy = max_bytes is not None and used + n > max_bytes
        if held and (full or heavy):
            yield held
            held, used = [], 0
        held.append(row)
        used += n
    if held:
        yield held


def write_batches(
    rows: DataFrame,
    send: Callable[[list], None],
    max_rows: int | None = 100,
    max_bytes: int | None = None,
    size_column: str | None = None,
    concurrency: int | None = None,
) -> None:
    """Send rows to ``send`` in sized batches, one stream per partition.

    ``concurrency`` is the number of streams; the steps before keep their own. ``send`` must tolerate repeats (replace by id):
    a lost executor sends its partition again.
    """
    if concurrency:
        rows = rows.repartition(concurrency)

    def size(row) -> int:
        if size_column:
            return int(row[size_column])
        return len(str(row.asDict()).encode("utf-8"))

    def run(partition):
        for batch in batches(partition, max_rows, max_bytes, size):
            send(batch)

    rows.foreachPartition(run)


def message_values(elements: DataFrame, key: str | None = "element_id") -> DataFrame:
    """(key, value): one JSON message per element."""
    columns = [element_json(elements).alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return elements.select(*columns)


def write_messages(elements: DataFrame, servers: str, topic: str, **options) -> None:
    """Messages to a topic; needs the Kafka connector on the class path."""
    writer = message_values(elements).write.format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    # All in-sync replicas must acknowledge, else the write fails.
    writer.option("kafka.acks", "all").options(**options).save()


def write_jdbc(rows: DataFrame, url: str, table: str, **options) -> None:
    """Append rows in statement batches."""
    rows.write.format("jdbc").option("url", url).option("dbtable", table).option(
        "batchsize", options.pop("batchsize", JDBC_BATCH)
    ).options(**options).mode("append").save()


def read_jdbc_ids(
    spark: SparkSession, url: str, table: str, id_column: str, **options
) -> DataFrame:
    """Only the id column; give partitionColumn, bounds and numPartitions for a parallel read."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.options(**options).load().select(id_column)


def insert_into(rows: DataFrame, table: str) -> None:
    """Append to a catalog table after fitting the rows to its columns."""
    spark = rows.sparkSession
    fit_to_schema(rows, spark.table(table).schema).write.insertInto(table)


class Registry:
    """Named sources and destinations; a name can be taken once."""

    def __init__(self):
        self._sources: dict[str, Callable] = {}
        self._destinations: dict[str, Callable] = {}

    def register_source(self, name: str, reader: Callable) -> None:
        if name in self._sources:
            raise ValueError(f"source {name} is already registered")
        self._sources[name] = reader

    def register_destination(self, name: str, writer: Callable) -> None:
        if name in self._destinations:
            raise ValueError(f"destination {name} is already registered")
        self._destinations[name] = writer

    def source(self, name: str) -> Callable:
        return self._sources[name]

    def destination(self, name: str) -> Callable:
        return self._destinations[name]

    def names(self) -> tuple[Sequence[str], Sequence[str]]:
        return sorted(self._sources), sorted(self._destinations)
