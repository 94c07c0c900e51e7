"""Channel messages: daily packages, attachments, threads and channel transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.ids import sha256_id
from sluice.functions.text import sanitize_name
from sluice.operators.batching import global_position
from sluice.operators.filters import cap_per_group
from sluice.sources.listings import doc_index
from sluice.operators.sequence import neighbours
from sluice.sources.parts import PART_ROWS, assembled, part_texts, placed_rows

CHANNEL_LIMIT = 100


def root_ts(messages: DataFrame) -> Column:
    """A reply belongs to its thread's root."""
    blank = F.lit("")
    thread = F.when(F.coalesce("thread_ts", blank) != "", F.col("thread_ts"))
    return F.coalesce(thread, F.when(F.col("ts") != "", F.col("ts")))


def utc_day(ts: Column) -> Column:
    """UTC date text of epoch seconds, whatever the session zone is."""
    days = F.floor(ts.cast("double") / 86400).cast("int")
    return F.date_format(F.date_from_unix_date(days), "yyyy-MM-dd")


def newest(values: list[Column]) -> Column:
    """(number, text) of the numerically largest of several epoch texts, null for none."""
    pairs = [
        F.when(
            F.coalesce(v, F.lit("")) != "",
            F.struct(v.cast("double").alias("number"), v.alias("text")),
        )
        for v in values
    ]
    return F.greatest(*pairs)


def with_package(messages: DataFrame) -> DataFrame:
    """Messages with their UTC day; messages without any time are left out."""
    root = root_ts(messages)
    return messages.withColumn("day", utc_day(root)).filter(F.col("day").isNotNull())


def package_columns() -> tuple[Column, Column]:
    identifier = sha256_id(F.col("channel"), F.col("day"))
    return identifier, F.concat(F.substring(identifier, 1, 16), F.lit(".xml"))


def time_stamp(ts: Column) -> Column:
    """(number, text) of a message time, in numeric order; null for texts that are no time."""
    number = ts.try_cast("double")
    return F.when(number.isNotNull(), F.struct(number.alias("number"), ts.alias("text")))


def daily_packages(messages: DataFrame) -> DataFrame:
    """One index row per channel and UTC day.

    The identifier is stable while the version is the newest activity (message, reply or edit),
    so a late reply updates its old day. All aggregates are partial, so a hot channel only ships
    one row per task.
    """
    activity = newest([F.col("ts"), F.col("latest_reply"), F.col("edited_ts")])
    stamp = time_stamp(F.col("ts"))
    grouped = (
        with_package(messages)
        .withColumn("_activity", activity)
        .withColumn("_stamp", stamp)
        .groupBy("channel", "day")
        .agg(
            F.max("_activity").alias("version"),
            F.min("_stamp").alias("oldest"),
            F.max("_stamp").alias("latest"),
            F.count(F.lit(1)).alias("n_messages"),
        )
    )
    identifier, filename = package_columns()
    version = F.col("version.text")
    return doc_index(
        grouped,
        keep=("channel", "day", "n_messages"),
        identifier=identifier,
        connector_type=F.lit("slack"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        version=version,
        date_created=F.col("oldest.text"),
        date_modified=version,
        record_locator=F.create_map(
            F.lit("channel"), F.col("channel"),
            F.lit("day"), F.col("day"),
            F.lit("oldest"), F.col("oldest.text"),
            F.lit("latest"), F.col("latest.text"),
        ),
    )


def recency_order(index: DataFrame, group: str) -> DataFrame:
    """``index`` with ``nth`` (from 1): newest version first inside each group.

    A version that is no number counts as zero. Positions come from a distributed order, so a hot
    group is no single task.
    """
    age = -F.coalesce(F.col("version").try_cast("double"), F.lit(0.0))
    placed = global_position(index.withColumn("_age", age), [group, "_age", "identifier"])
    first = placed.groupBy(group).agg(F.min("position").alias("_first"))
    nth = F.col("position") - F.col("_first") + 1
    return placed.join(first, group).withColumn("nth", nth).drop("_age", "_first", "position")


def attachments(messages: DataFrame) -> DataFrame:
    """One index row per attached file of messages with a time."""
    files = messages.filter(F.coalesce("ts", F.lit("")) != "").select(
        "channel", "ts", F.explode("files").alias("f")
    ).filter(F.coalesce("f.id", F.lit("")) != "")

    def present(name: str) -> Column:
        return F.when(F.col(f"f.{name}") != "", F.col(f"f.{name}"))

    label = F.coalesce(present("name"), present("title"), F.col("f.id"))
    filename = sanitize_name(F.concat(F.col("f.id"), F.lit("-"), label), "slack-file")
    return doc_index(
        files,
        identifier=sha256_id(F.col("channel"), F.col("ts"), F.col("f.id")),
        connector_type=F.lit("slack"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        url=present("permalink"),
        version=F.col("ts"),
        date_created=F.col("f.created").cast("string"),
        date_modified=F.col("ts"),
        record_locator=F.create_map(
            F.lit("type"), F.lit("file"),
            F.lit("channel"), F.col("channel"),
            F.lit("message_ts"), F.col("ts"),
            F.lit("file_id"), F.col("f.id"),
        ),
    )


def xml_escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def package_xml(messages: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Content of the daily packages: threads newest first, replies after their root.

    A thread is one ``<message><text>`` with ``<reply>`` marks between its messages. A package comes
    in parts; a thread may go on from one part to the next.
    """
    rows = with_package(messages).select(
        "channel",
        "day",
        (-root_ts(messages).cast("double")).alias("thread"),
        F.col("ts").cast("double").alias("at"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = ["channel", "day"]
    placed = placed_rows(rows, keys, ["thread", "at", "text"], numeric_order=False)
    placed = neighbours(placed, "thread", before="_before", key=keys, order="nth")
    opening = (
        F.when(F.col("nth") == 0, F.lit("<message><text>"))
        .when(F.col("_before") != F.col("thread"), F.lit("</text></message><message><text>"))
        .otherwise(F.lit(" &lt;reply&gt; "))
    )
    marked = placed.withColumn("text", F.concat(opening, xml_escape(F.col("text"))))
    texts = part_texts(marked, keys, lambda r: r["text"], part_rows=part_rows)
    packages = assembled(
        texts,
        keys,
        children=rows,
        opening=F.lit("<?xml version='1.0' encoding='utf-8'?>\n<messages>"),
        closing=F.lit("</text></message></messages>"),
        part_rows=part_rows,
    )
    identifier, filename = package_columns()
    return packages.select(
        identifier.alias("identifier"), "part", filename.alias("filename"), "body"
    )


def package_documents(messages: DataFrame, **options) -> DataFrame:
    """Daily packages as text documents for partitioning: one line per message text line.

    Marks never cross parts, so each part is turned into text by itself.
    """
    packages = package_xml(messages, **options)
    text = F.regexp_replace(F.regexp_replace("body", r"^<\?xml[^>]*>", ""), "<[^>]*>", "\n")
    text = F.replace(F.replace(text, F.lit(" &lt;reply&gt; "), F.lit("\n")), F.lit("&lt;"), F.lit("<"))
    text = F.replace(F.replace(text, F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    return doc_index(
        packages.withColumn("body", text),
        keep=("part", "body"),
        identifier=F.col("identifier"),
        connector_type=F.lit("slack"),
        filename=F.col("filename"),
        fullpath=F.col("filename"),
    )


def channel_text(messages: DataFrame, limit: int) -> DataFrame:
    """The newest ``limit`` messages of each channel, newest first, one per line.

    The limit is the feature (a channel history read); at most ``limit`` rows per channel leave
    each task.
    """
    rows = messages.withColumn("_at", F.col("ts").cast("double"))
    kept = cap_per_group(rows, "channel", [F.col("_at").desc(), F.col("text")], limit)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("_at")).alias("o"), F.col("text"))))
    joined = kept.groupBy("channel").agg(ordered.alias("_rows"))
    filename = F.concat(F.col("channel"), F.lit(".txt"))
    return doc_index(
        joined.withColumn(
            "body",
            F.array_join(F.transform("_rows", lambda r: F.coalesce(r["text"], F.lit(""))), "\n"),
        ),
        keep=("body",),
        identifier=F.col("channel"),
        connector_type=F.lit("discord"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        record_locator=F.create_map(F.lit("channel_id"), F.col("channel")),
    )
