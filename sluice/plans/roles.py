"""The payload roles the test tables play."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schemas
from sluice.functions.dates import format_rfc3339
from sluice.functions.ids import uuid5_dns
from sluice.operators.partition import partition_text
from sluice.sources.listings import doc_index

ROOT = "s3://corpus/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a table that is smaller than one scan split per core.

    The test tables are single row groups, which one task would read. Larger tables come in many
    splits, and tables of a file per core in as many, and are left alone.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) < split * cores:
        return df.repartition(cores)
    return df


def utc(column: str):
    """Zone-free wall time of a test table as the UTC instant, whatever the session zone is."""
    wall = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column))
    return wall.cast("timestamp")


def _iso(epoch) -> object:
    return F.substring(format_rfc3339(epoch), 1, 19)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows of the documents table, with doc_id, lang, source and body."""
    return document_columns(spread(table(spark, sf_dir, "documents")))


def document_columns(docs: DataFrame) -> DataFrame:
    rel = F.concat_ws(
        "/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    )
    path = F.concat(F.lit(ROOT), rel)
    epoch = F.lit(1700000000) + F.col("doc_id") * 3600
    # One-word lines lose their full stop, which makes them titles.
    body = F.regexp_replace("text", r"(?md)^([^ \n]+)\.$", "$1")
    permissions = F.array(
        F.struct(
            F.lit("read").alias("op"),
            F.array("lang").alias("users"),
            F.array("source").alias("groups"),
        )
    )
    return doc_index(
        docs.withColumn("body", body),
        keep=("doc_id", "lang", "source", "body"),
        identifier=uuid5_dns(path),
        connector_type=F.lit("s3"),
        filename=F.concat(F.col("doc_id").cast("string"), F.lit(".txt")),
        fullpath=path,
        rel_path=rel,
        url=path,
        version=F.sha2("text", 256),
        record_locator=F.create_map(
            F.lit("protocol"), F.lit("s3"), F.lit("remote_file_path"), path
        ),
        date_created=F.concat(epoch.cast("string"), F.lit(".0")),
        date_modified=_iso(epoch + 60),
        date_processed=F.lit("1750000000.5"),
        permissions_data=permissions,
        filesize_bytes=F.octet_length("text").cast("long"),
        display_name=path,
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ELEMENTS of the documents as text partitioning makes them."""
    return partition_text(documents(spark, sf_dir))


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ELEMENTS with optional metadata filled by position, for staging."""
    base = parts(spark, sf_dir)
    pos = F.col("pos")
    doc = F.regexp_replace("metadata.filename", r"\.txt$", "")
    points = F.array(
        F.array(F.lit(0.0), pos.cast("double")), F.array(F.lit(10.5), pos.cast("double"))
    )
    coordinates = F.when(
        pos % 3 == 0,
        F.struct(
            points.alias("points"),
            F.lit("PixelSpace").alias("system"),
            F.lit(612.0).alias("layout_width"),
            F.lit(792.5).alias("layout_height"),
        ),
    )
    link = F.concat(F.lit("http://a.example/"), doc)
    link_urls = F.when(
        pos % 4 == 1,
        F.array(link, F.concat(F.lit("http://b.example/"), pos.cast("string"))),
    )
    links = F.when(
        pos % 4 == 1,
        F.array(
            F.struct(
                F.concat(F.lit("t"), pos.cast("string")).alias("text"),
                link.alias("url"),
                pos.cast("int").alias("start_index"),
            )
        ),
    )
    probability = F.when(pos % 2 == 0, F.lit(0.25) + (pos % 4) * 0.125)
    vector = F.when(
        pos % 6 != 5, F.array(((pos % 8) * 0.25).cast("float"), F.lit(1.5).cast("float"))
    )
    metadata = (
        F.col("metadata")
        .withField("coordinates", coordinates.cast(schemas.COORDINATES))
        .withField("link_urls", link_urls)
        .withField("links", links.cast(schemas.LINKS))
        .withField("is_continuation", F.when(pos % 5 == 2, F.lit(True)))
        .withField("detection_class_prob", probability.cast("double"))
    )
    return base.withColumn("metadata", metadata).withColumn("embeddings", vector)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_columns(table(spark, sf_dir, "conversations"))


def message_columns(conv: DataFrame) -> DataFrame:
    start = F.lit(1704067200) + F.col("conv_id") * 7200
    at = start + F.col("turn") * 60

    def stamp(epoch, fraction: str):
        return F.concat(epoch.cast("string"), F.lit(f".{fraction}"))

    return conv.select(
        F.concat(F.lit("C"), (F.col("conv_id") % 7).cast("string")).alias("channel"),
        stamp(at, "000100").alias("ts"),
        F.when(F.col("turn") > 0, stamp(start, "000100")).alias("thread_ts"),
        F.when(
            (F.col("turn") == 0) & (F.col("conv_id") % 5 == 0), stamp(start + 200000, "000200")
        ).alias("latest_reply"),
        F.when(F.col("conv_id") % 11 == 3, stamp(at + 300000, "000300")).alias("edited_ts"),
        "text",
        "conv_id",
        "turn",
        "role",
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages with one file link and one image added to each."""
    rows = table(spark, sf_dir, "pages")
    page = F.col("page_id").cast("string")
    extra = F.concat(
        F.lit('<p><a class="f" href="/files/'), page, F.lit(".pdf?a=1&amp;b=2\">file</a>"),
        F.lit("<a href='//cdn.example.com/x/"), page, F.lit(".doc'>far</a>"),
        F.lit('<img alt="i" src="/img/'), page, F.lit('.png"/></p>'),
    )
    return rows.withColumn("html", F.concat(F.col("html"), extra))


def page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "pages"))
    filename = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    return doc_index(
        rows.withColumn("body", F.col("html")),
        keep=("body",),
        identifier=uuid5_dns(F.col("url")),
        connector_type=F.lit("web"),
        filename=filename,
        fullpath=filename,
        url=F.col("url"),
        filesize_bytes=F.octet_length("html").cast("long"),
    )
