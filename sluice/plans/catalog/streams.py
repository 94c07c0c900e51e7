"""Streaming forms, drained over the events and conversations files."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators.partition import partition_text
from sluice.operators.staging import stage_sql
from sluice.operators.tables import RecordTable
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.documents import scratch
from sluice.plans.catalog.registry import query
from sluice.sources.messages import daily_packages
from sluice.streaming import messages
from sluice.streaming.incremental import process_changes


def _stream(spark, sf, name):
    """A table, one file or a folder of files, as a stream source."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    # The source takes a single file only by a pattern, here one that fits this name alone.
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def _drain_append(stream, folder, spark):
    """Run an append-mode stream into files and read them back."""
    running = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/data")
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/data")


def _topic_records(events):
    value = F.to_json(F.struct("user_id", "props"))
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        roles.utc("ts").alias("timestamp"),
    )


@query(
    "stream_messages_index",
    """SELECT event_type || '_' || user_id % 4 || '_' || event_id AS identifier,
      event_type || '_' || user_id % 4 || '_' || event_id || '.txt' AS filename,
      '{"user_id":' || user_id || ',"props":' || to_json(props)::varchar || '}' AS body,
      '{"topic":"' || event_type || '","partition":' || user_id % 4 || ',"offset":' || event_id ||
      '}' AS additional_metadata
    FROM events""",
)
def stream_messages_index(spark, sf):
    records = _topic_records(_stream(spark, sf, "events"))
    index = messages.index_messages(records).select(
        "identifier", "filename", "body", "additional_metadata"
    )
    return _drain_append(index, scratch(spark, "index"), spark)


@query(
    "kafka_index",
    """SELECT event_type || '_' || user_id % 4 || '_' || event_id AS identifier, event_type AS topic
    FROM events""",
)
def kafka_index(spark, sf):
    index = messages.index_messages(_topic_records(roles.table(spark, sf, "events")))
    topic = F.get_json_object("additional_metadata", "$.topic")
    return index.select("identifier", topic.alias("topic"))


@query(
    "stream_kafka_out",
    o.with_(o.LINES, "SELECT element_id AS key, text, lang FROM parts"),
)
def stream_kafka_out(spark, sf):
    """Messages of a document stream; files stand in for the topic."""
    from sluice.operators.external import message_values

    folder = scratch(spark, "topic")
    documents = roles.document_columns(_stream(spark, sf, "documents"))

    def send(batch, batch_id):
        values = message_values(partition_text(batch))
        values.write.mode("overwrite").parquet(f"{folder}/topic/batch={batch_id}")

    messages.drain(documents, send, f"{folder}/state", "append")
    topic = spark.read.parquet(f"{folder}/topic")
    return topic.select(
        "key",
        F.get_json_object("value", "$.text").alias("text"),
        F.get_json_object("value", "$.metadata.languages[0]").alias("lang"),
    )


def _message_stream(spark, sf):
    conv = _stream(spark, sf, "conversations")
    # The same projection as the batch role.
    return roles.message_columns(conv)


@query(
    "stream_daily_packages",
    o.with_(
        o.PACKAGES,
        "SELECT identifier, channel, day, version, oldest AS date_created, n_messages "
        "FROM packages",
    ),
)
def stream_daily_packages(spark, sf):
    folder = scratch(spark, "packages")
    target = RecordTable(spark, f"{folder}/table", key="identifier", buckets=4)
    activity = messages.package_activity(_message_stream(spark, sf))
    target.create_if_missing(activity.schema)
    messages.drain(
        activity, messages.upsert_into(target, "identifier"), f"{folder}/state", "update"
    )
    return target.read().select(
        "identifier", "channel", "day", "version", "date_created", "n_messages"
    )


@query(
    "tumbling_message_windows",
    """SELECT strftime(time_bucket(INTERVAL '1 day', ts), '%Y-%m-%d') AS day, event_type,
      count(*) AS n, max(event_id) AS newest FROM events GROUP BY 1, 2""",
)
def tumbling_message_windows(spark, sf):
    folder = scratch(spark, "windows")
    events = _stream(spark, sf, "events").withColumn("ts", roles.utc("ts"))
    counts = messages.tumbling_counts(
        events, "ts", "event_type", "1 day", n=F.count(F.lit(1)), newest=F.max("event_id")
    )
    seconds = F.unix_timestamp("window_start")
    rows = counts.select(
        F.date_format(F.date_from_unix_date((seconds / 86400).cast("int")), "yyyy-MM-dd").alias(
            "day"
        ),
        "event_type",
        "n",
        "newest",
    ).withColumn("id", F.concat_ws("#", "day", "event_type"))
    target = RecordTable(spark, f"{folder}/table", key="id", buckets=4)
    target.create_if_missing(rows.schema)
    messages.drain(rows, messages.upsert_into(target, "id"), f"{folder}/state", "update")
    return target.read().drop("id")


@query(
    "stream_dedupe",
    "SELECT user_id::varchar AS identifier, max(event_id) AS event_id FROM events GROUP BY 1",
)
def stream_dedupe(spark, sf):
    folder = scratch(spark, "latest")
    events = _stream(spark, sf, "events").withColumn(
        "identifier", F.col("user_id").cast("string")
    )
    latest = messages.latest_per_identifier(events, F.col("event_id"), ["event_id"])
    target = RecordTable(spark, f"{folder}/table", key="identifier", buckets=4)
    target.create_if_missing(latest.schema)
    messages.drain(latest, messages.upsert_into(target, "identifier"), f"{folder}/state", "update")
    return target.read()


@query("stream_first_seen", "SELECT DISTINCT user_id::varchar AS identifier FROM events")
def stream_first_seen(spark, sf):
    events = _stream(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("identifier")
    )
    return _drain_append(messages.first_per_identifier(events), scratch(spark, "first"), spark)


@query(
    "stream_filter_stage_sink",
    o.with_(
        o.LINES,
        "SELECT record_id, element_id, text FROM parts WHERE lang = 'en' AND "
        "filesize_bytes <= 5000",
    ),
)
def stream_filter_stage_sink(spark, sf):
    """Documents stream through filter, partition and staging into a table."""
    folder = scratch(spark, "ingest")
    target = RecordTable(spark, f"{folder}/table", buckets=8)
    documents = roles.document_columns(_stream(spark, sf, "documents"))
    kept = documents.filter("lang = 'en' AND filesize_bytes <= 5000")

    def prepare(batch):
        rows = stage_sql(partition_text(batch))
        return rows.select("record_id", "element_id", "text")

    messages.drain(kept, messages.replace_into(target, prepare), f"{folder}/state", "append")
    return target.read()


@query(
    "stream_incremental",
    o.with_(
        o.DOCS,
        "SELECT identifier, version FROM docs WHERE doc_id % 4 <> 1",
    ),
)
def stream_incremental(spark, sf):
    """Index rows stream against a state table that knows a quarter of them unchanged."""
    folder = scratch(spark, "changes")
    documents = roles.documents(spark, sf)
    state = RecordTable(spark, f"{folder}/state_table", key="identifier", buckets=8)
    known = documents.filter(F.col("doc_id") % 4 == 1).select(
        "identifier",
        F.lit(4e9).alias("processed_at"),
        "version",
        "permissions_version",
    )
    state.append(known)
    done = RecordTable(spark, f"{folder}/done", key="identifier", buckets=8)

    def process(changed):
        done.overwrite_records(changed.select("identifier", "version"))

    done.create_if_missing(documents.select("identifier", "version").schema)
    stream = roles.document_columns(_stream(spark, sf, "documents")).drop("body")
    messages.drain(stream, process_changes(state, process), f"{folder}/check", "append")
    return done.read()


@query(
    "late_reply_updates_package",
    o.with_(
        o.PACKAGES,
        "SELECT identifier, '1999999999.000900' AS version FROM packages WHERE channel = 'C1' "
        "UNION ALL SELECT identifier, version FROM packages WHERE channel <> 'C1'",
    ),
)
def late_reply_updates_package(spark, sf):
    """A reply that arrives later keeps the identifier of its day and moves its version."""
    rows = roles.messages(spark, sf)
    late = rows.filter("channel = 'C1' AND thread_ts IS NULL").withColumn(
        "latest_reply", F.lit("1999999999.000900")
    )
    index = daily_packages(rows.unionByName(late))
    return index.select("identifier", "version")
