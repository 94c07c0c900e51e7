"""Writes: replace by record, upsert, append, files, messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import batch_writer, external, files, staging, tables
from sluice.operators.tables import RecordTable
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.documents import scratch
from sluice.plans.catalog.registry import query
from sluice.plans.roles import table
from sluice.session import written
from sluice.sources.parts import assembled, part_texts


def _rows(spark, sf):
    """Staged rows of an earlier load, and a new load of a part of the records."""
    flat = staging.stage_sql(roles.elements(spark, sf))
    own = F.regexp_replace("filename", r"\.txt$", "").cast("long").alias("_own")
    flat = flat.select("id", "record_id", "text", "type", own)
    docs = roles.documents(spark, sf).select(
        F.col("identifier").alias("record_id"), F.col("doc_id")
    )
    # An element has the doc_id of its document; only records that several documents share are
    # joined, and they are written, so that Spark knows whether they are few.
    shared = docs.groupBy("record_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = written(docs.join(shared.select("record_id"), "record_id", "left_semi"), "shared")
    keyed = flat.join(shared.withColumn("_shared", F.lit(True)), "record_id", "left")
    keyed = keyed.withColumn("doc_id", F.when(F.col("_shared"), F.col("doc_id")).otherwise(F.col("_own")))
    keyed = keyed.select("record_id", "id", "text", "type", "doc_id")
    existing = keyed.filter("doc_id % 5 < 4").withColumn("load", F.lit("old")).drop("doc_id")
    arriving = (
        keyed.filter("doc_id % 3 = 0 AND type <> 'Title'")
        .withColumn("load", F.lit("new"))
        .drop("doc_id")
    )
    return existing, arriving


_LOADS = (
    o.ELEMENTS
    + """,
existing AS (SELECT id, record_id, text, type, 'old' AS load FROM elements WHERE doc_id % 5 < 4),
arriving AS (
  SELECT id, record_id, text, type, 'new' AS load FROM elements
  WHERE doc_id % 3 = 0 AND type <> 'Title'
)"""
)
_REPLACED = """SELECT * FROM existing WHERE record_id NOT IN (SELECT record_id FROM arriving)
UNION ALL SELECT * FROM arriving"""


@query("overwrite_by_record_id", o.with_(_LOADS, _REPLACED))
def overwrite_by_record_id(spark, sf):
    existing, arriving = _rows(spark, sf)
    target = RecordTable(spark, scratch(spark, "overwrite"), buckets=8)
    target.append(existing)
    target.overwrite_records(arriving)
    # A second delivery of the same records changes nothing.
    target.overwrite_records(arriving)
    return target.read()


@query("overwrite_anti_join", o.with_(_LOADS, _REPLACED))
def overwrite_anti_join(spark, sf):
    return tables.replace_records(*_rows(spark, sf))


@query(
    "upsert_by_id",
    o.with_(
        _LOADS,
        "SELECT * FROM existing WHERE id NOT IN (SELECT id FROM arriving) "
        "UNION ALL SELECT * FROM arriving",
    ),
)
def upsert_by_id(spark, sf):
    existing, arriving = _rows(spark, sf)
    target = RecordTable(spark, scratch(spark, "upsert"), key="id", buckets=8)
    target.append(existing)
    target.upsert(arriving.unionByName(arriving))
    return target.read()


@query(
    "append_by_name",
    o.with_(_LOADS, "SELECT id, load FROM existing UNION ALL SELECT id, load FROM arriving"),
)
def append_by_name(spark, sf):
    existing, arriving = _rows(spark, sf)
    return tables.append_by_name(existing.select("id", "load"), arriving)


@query(
    "schema_merge_append",
    o.with_(
        _LOADS,
        "SELECT id, NULL::varchar AS text, load FROM existing UNION ALL "
        "SELECT id, text, load FROM arriving",
    ),
)
def schema_merge_append(spark, sf):
    existing, arriving = _rows(spark, sf)
    target = RecordTable(spark, scratch(spark, "merge"), key="id", buckets=4)
    target.append(existing.select("id", "load"))
    target.append(arriving.select("load", "id", "text"), merge_schema=True)
    return target.read()


@query(
    "prefix_delete",
    o.with_(
        _LOADS,
        "SELECT record_id || '#' || id AS id FROM existing WHERE record_id NOT IN "
        "(SELECT record_id FROM arriving)",
    ),
)
def prefix_delete(spark, sf):
    existing, arriving = _rows(spark, sf)
    rows = existing.select(F.concat_ws("#", "record_id", "id").alias("id"))
    return tables.delete_by_prefix(rows, arriving)


@query("create_table_if_missing",
       o.with_(_LOADS, "SELECT record_id, text, NULL::varchar AS metadata FROM arriving"))
def create_table_if_missing(spark, sf):
    _, arriving = _rows(spark, sf)
    target = RecordTable(spark, scratch(spark, "create"), buckets=4)
    target.create_if_missing(staging.ELEMENT_TABLE)
    target.create_if_missing(arriving.schema)
    target.append(arriving)
    return target.read().select("record_id", "text", "metadata")


@query(
    "batched_sink",
    "SELECT count(*) AS n_rows, sum(l_orderkey)::bigint AS keys, 0::bigint AS oversized, "
    "0::bigint AS unfilled, count(*) AS reported_rows, 100 * count(*) AS reported_size, "
    "true AS all_batches FROM lineitem",
)
def batched_sink(spark, sf):
    """Batches of at most 5000 rows and 400 000 bytes in a destination, against its report.

    Whatever the partitions, only the last batch of each holds less than fits.
    """
    folder = scratch(spark, "batches")
    name = "batches_" + folder.rsplit("-", 1)[1]
    batch_writer.register_file_destination(spark, name, folder)
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.lit(100).alias("size"))
    writer = rows.write.format(name).option("size_column", "size").mode("append")
    writer.option("max_rows", 5000).option("max_bytes", 400_000).save()
    partition = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)-(\d+)", 1).cast("int")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)-(\d+)", 2).cast("int")
    back = spark.read.schema("l_orderkey long, size long").json(f"{folder}/batches")
    sent = spark.read.schema("partition int, batches int, rows long, size long").json(
        f"{folder}/report"
    )
    batches = (
        back.groupBy(partition.alias("partition"), number.alias("number"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"), F.sum("size").alias("size")
        )
        .join(sent.select("partition", "batches"), "partition")
    )
    found = batches.agg(
        F.sum("n").alias("n_rows"),
        F.sum("keys").alias("keys"),
        F.count_if((F.col("n") > 5000) | (F.col("size") > 400_000)).alias("oversized"),
        F.count_if((F.col("n") < 4000) & (F.col("number") < F.col("batches") - 1)).alias("unfilled"),
        F.count(F.lit(1)).alias("_batches"),
    )
    report = sent.agg(
        F.sum("rows").alias("reported_rows"),
        F.sum("size").alias("reported_size"),
        F.sum("batches").alias("_sent"),
    )
    # Both have one row, and share no columns.
    both = found.unionByName(report, allowMissingColumns=True)
    names = ["n_rows", "keys", "oversized", "unfilled", "reported_rows", "reported_size"]
    return both.agg(
        *[F.max(name).alias(name) for name in names],
        (F.max("_batches") == F.max("_sent")).alias("all_batches"),
    )


@query(
    "write_json_per_document",
    o.with_(
        o.LINES,
        "SELECT rel AS path, n FROM (SELECT source || '/' || lang || '/' || filename || '.json' AS "
        "rel, count(*) AS n FROM parts GROUP BY 1)",
    ),
)
def write_json_per_document(spark, sf):
    elements = roles.parts(spark, sf)
    relative = F.regexp_replace("metadata.data_source.url", r"^s3://corpus/", "")
    documents = files.json_documents(elements.withColumn("path", relative), "path")
    folder = scratch(spark, "documents")
    written = files.write_documents(documents, folder).agg(F.sum("n_bytes")).first()[0]
    assert written > 0
    back = files.read_element_files(spark, f"{folder}/*/*/*.json", "json", path_column="path")
    name = F.regexp_replace("path", ".*/documents-[0-9a-f]+/", "")
    return back.select(name.alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


@query(
    "write_ndjson",
    o.with_(o.LINES, "SELECT element_id, type, text, page_number FROM parts"),
)
def write_ndjson(spark, sf):
    folder = scratch(spark, "ndjson")
    files.write_ndjson(roles.parts(spark, sf).drop("record_id", "pos"), folder)
    back = files.read_element_files(spark, folder, "ndjson")
    return back.select(
        "element_id", "type", "text", F.col("metadata.page_number").alias("page_number")
    )


@query(
    "read_element_files",
    o.with_(
        o.LINES,
        "SELECT kind, element_id, text FROM parts CROSS JOIN (VALUES ('parquet'), ('csv')) v(kind)",
    ),
)
def read_element_files(spark, sf):
    rows = roles.parts(spark, sf).select("element_id", "text")
    out = None
    for kind in ("parquet", "csv"):
        folder = scratch(spark, kind)
        writer = rows.write
        if kind == "csv":
            writer.option("escape", '"').option("header", "true").csv(folder)
        else:
            writer.parquet(folder)
        back = files.read_element_files(spark, folder, kind).select("element_id", "text")
        back = back.withColumn("kind", F.lit(kind))
        out = back if out is None else out.unionByName(back)
    return out


@query(
    "read_elements_by_content",
    o.with_(
        o.LINES,
        "SELECT kind, element_id, type, text FROM parts CROSS JOIN (VALUES ('array'), ('lines')) v(kind)",
    ),
)
def read_elements_by_content(spark, sf):
    """Pretty-printed arrays and JSON lines under suffixes that tell nothing."""
    rows = roles.parts(spark, sf).select("record_id", "pos", "element_id", "type", "text")
    element = F.to_json(F.struct("element_id", "type", "text"), {"pretty": "true"})
    children = rows.select("record_id", F.col("pos").alias("nth"), element.alias("text"))
    texts = part_texts(children, ["record_id"], lambda r: r["text"], between=",\n")
    arrays = assembled(
        texts, ["record_id"], children=children, opening=F.lit("[\n"), closing=F.lit("\n]\n")
    )
    # One file a document: dealt over folders, they are listed in parallel.
    name = F.concat(F.substring("record_id", 1, 2), F.lit("/"), "record_id", F.lit(".data"))
    named = arrays.select(name.alias("path"), "part", "body")
    folders = {"array": scratch(spark, "pretty"), "lines": scratch(spark, "lines")}
    files.write_documents(named, folders["array"]).write.format("noop").mode("overwrite").save()
    line = F.to_json(F.struct("element_id", "type", "text"))
    rows.select(line.alias("value")).write.text(folders["lines"])
    out = None
    for kind, folder in folders.items():
        below = f"{folder}/*" if kind == "array" else folder
        back = files.read_element_files(spark, below, "data")
        back = back.select(F.lit(kind).alias("kind"), "element_id", "type", "text")
        out = back if out is None else out.unionByName(back)
    return out


@query(
    "kafka_sink",
    o.with_(
        o.LINES,
        "SELECT element_id AS key, text, type, filename FROM parts",
    ),
)
def kafka_sink(spark, sf):
    values = external.message_values(roles.parts(spark, sf))

    def at(path):
        return F.get_json_object("value", path)

    return values.select(
        "key",
        at("$.text").alias("text"),
        at("$.type").alias("type"),
        at("$.metadata.filename").alias("filename"),
    )


@query(
    "lakehouse_table_sink",
    o.with_(_LOADS, "SELECT id, text FROM existing UNION ALL SELECT id, text FROM arriving"),
)
def lakehouse_table_sink(spark, sf):
    existing, arriving = _rows(spark, sf)
    folder = scratch(spark, "managed")
    name = "managed_" + folder.rsplit("-", 1)[1]
    empty = existing.select("id", "text").limit(0)
    empty.write.format("parquet").option("path", folder).saveAsTable(name)
    external.insert_into(existing, name)
    external.insert_into(arriving, name)
    return spark.table(name)


@query(
    "write_json",
    o.with_(o.LINES, "SELECT element_id, type, text, parent_id FROM parts"),
)
def write_json(spark, sf):
    """One JSON array per document, in parts of forty elements, written as files and read back."""
    rows = roles.parts(spark, sf).withColumn("path", F.col("record_id"))
    folder = scratch(spark, "arrays")
    written = files.write_documents(files.json_documents(rows, "path", 40), folder)
    written.write.format("noop").mode("overwrite").save()
    back = files.read_element_files(spark, folder, "json")
    return back.select(
        "element_id", "type", "text", F.col("metadata.parent_id").alias("parent_id")
    )


@query(
    "register_source_destination",
    "SELECT p_partkey, p_name FROM part UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def register_source_destination(spark, sf):
    """Named readers and writers, looked up by name."""
    registry = external.Registry()
    registry.register_source("parts", lambda: table(spark, sf, "part"))
    registry.register_source("suppliers", lambda: table(spark, sf, "supplier"))
    target = RecordTable(spark, scratch(spark, "registry"), key="p_partkey", buckets=4)
    registry.register_destination("lake", target.append)
    write = registry.destination("lake")
    write(registry.source("parts")().select("p_partkey", "p_name"))
    suppliers = registry.source("suppliers")().select("s_suppkey", "s_name")
    write(suppliers.withColumnsRenamed({"s_suppkey": "p_partkey", "s_name": "p_name"}))
    return target.read()
