"""The batch operators over streams. Message schema: key, value, topic, partition, offset, timestamp."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.external import message_values
from sluice.operators.tables import RecordTable
from sluice.sources.listings import doc_index
from sluice.sources.messages import newest, package_columns, time_stamp, with_package


def index_messages(stream: DataFrame) -> DataFrame:
    """Topic records to index rows with their body; works on streams and on batch reads."""
    identifier = F.concat_ws(
        "_", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")
    )
    filename = F.concat(identifier, F.lit(".txt"))
    rows = stream.withColumn("body", F.decode("value", "UTF-8"))
    return doc_index(
        rows,
        keep=("body",),
        identifier=identifier,
        connector_type=F.lit("kafka"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        additional_metadata=F.to_json(F.struct("topic", "partition", "offset")),
    )


def package_activity(stream: DataFrame, watermark: str | None = None) -> DataFrame:
    """Newest activity per channel and UTC day as a running aggregate.

    Without a watermark a reply to any old day still updates it, and state grows with the number
    of days. With ``watermark`` old days leave the state and later edits to them are dropped; the
    stream needs an ``event_time`` column for that.
    """
    if watermark:
        stream = stream.withWatermark("event_time", watermark)
    activity = newest([F.col("ts"), F.col("latest_reply"), F.col("edited_ts")])
    stamp = time_stamp(F.col("ts"))
    identifier, filename = package_columns()
    return (
        with_package(stream)
        .withColumn("_activity", activity)
        .withColumn("_stamp", stamp)
        .groupBy("channel", "day")
        .agg(
            F.max("_activity").alias("_version"),
            F.min("_stamp").alias("_oldest"),
            F.count(F.lit(1)).alias("n_messages"),
        )
        .select(
            identifier.alias("identifier"),
            filename.alias("filename"),
            "channel",
            "day",
            F.col("_version.text").alias("version"),
            F.col("_oldest.text").alias("date_created"),
            "n_messages",
        )
    )


def tumbling_counts(stream: DataFrame, time: str, group: str, width: str = "1 day", **aggregates):
    """Tumbling windows in UTC; pass named aggregate columns."""
    columns = [c.alias(n) for n, c in aggregates.items()] or [F.count(F.lit(1)).alias("n")]
    return (
        stream.groupBy(F.window(time, width), group)
        .agg(*columns)
        .select(F.col("window.start").alias("window_start"), group, *list(aggregates or ["n"]))
    )


def latest_per_identifier(stream: DataFrame, order: Column, columns: list[str]) -> DataFrame:
    """One row per identifier: the one with the largest order value."""
    row = F.struct(*columns)
    return stream.groupBy("identifier").agg(F.max_by(row, order).alias("_r")).select(
        "identifier", "_r.*"
    )


def first_per_identifier(stream: DataFrame, time: str | None = None, delay: str | None = None):
    """Drop repeated identifiers; a watermark bounds the state and the reach of the check."""
    if time and delay:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["identifier"])
    return stream.dropDuplicates(["identifier"])


def drain(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str
) -> StreamingQuery:
    """Process everything available in micro-batches, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def upsert_into(table: RecordTable, id_column: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: insert or replace by id. Repeating a batch changes nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, id_column)

    return handle


def replace_into(
    table: RecordTable, transform: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: run batch operators, then replace the arriving records."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.overwrite_records(transform(batch))

    return handle


def write_message_stream(
    elements: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Elements of a stream to a topic; needs the Kafka connector on the class path."""
    return (
        message_values(elements)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
