"""Composite flows from source to destination rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.ids import enhanced_element_id
from sluice.operators import partition, staging
from sluice.operators.embed import is_unit_vector
from sluice.operators.incremental import status_report
from sluice.operators.tables import RecordTable
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.documents import scratch
from sluice.plans.catalog.elements import HASHED_CHUNKS, chunk_ctes
from sluice.plans.catalog.registry import query
from sluice.plans.flow import HTML, Flow
from sluice.plans.roles import table
from sluice.sources import messages, records


_STAGED = f"""{o.uuid5("(element_id || record_id)")} AS id, record_id, element_id, type, text,
  date_created::double AS date_created, page_number::varchar AS page_number, true AS is_unit"""
_SMALL_ENGLISH = "lang = 'en' AND filesize_bytes <= 5000"


@query(
    "flagship_ingest",
    o.with_(
        chunk_ctes(500, titled=True, kept=_SMALL_ENGLISH) + HASHED_CHUNKS,
        f"""SELECT {_STAGED}, filename,
          '{{"protocol":"s3","remote_file_path":"' || fullpath || '"}}' AS record_locator
        FROM hashed""",
    ),
)
def flagship_ingest(spark, sf):
    """English documents under 5 kB: partition, chunk, ids, vectors, table rows."""
    flow = (
        Flow(roles.documents(spark, sf))
        .filter(globs=["*/en/*"], max_size=5000)
        .partition()
        .chunk("by_title", max_characters=500)
        .embed("hash", dimension=16)
        .stage(staging.stage_sql)
    )
    return flow.rows.select(
        "id", "record_id", "element_id", "type", "text", "filename", "page_number",
        "date_created", "record_locator",
        is_unit_vector(F.col("embeddings")).alias("is_unit"),
    )


@query(
    "ingest_basic",
    o.with_(
        chunk_ctes(500, 400, 20, kept=_SMALL_ENGLISH) + HASHED_CHUNKS,
        f"SELECT {_STAGED} FROM hashed",
    ),
)
def ingest_basic(spark, sf):
    flow = (
        Flow(roles.documents(spark, sf))
        .filter(globs=["*/en/*"], max_size=5000)
        .partition()
        .chunk("basic", max_characters=500, new_after_n_chars=400, overlap=20)
        .embed("hash", dimension=16)
        .stage(staging.stage_sql)
    )
    target = RecordTable(spark, scratch(spark, "chunks"), buckets=8)
    flow.write(target)
    return target.read().select(
        "id", "record_id", "element_id", "type", "text", "date_created", "page_number",
        is_unit_vector(F.col("embeddings")).alias("is_unit"),
    )


@query("html_ingest")
def html_ingest(spark, sf):
    flow = (
        Flow(roles.page_documents(spark, sf))
        .partition(HTML)
        .chunk("basic", max_characters=500)
        .stage(staging.stage_search_index, index_name="pages")
    )
    return flow.rows.select(
        F.col("_id").alias("id"), "_source.record_id", "_source.type", "_source.text"
    )


@query(
    "html_failures",
    "SELECT 'partition' AS step, count(*) AS failures, count(DISTINCT url) AS records FROM pages "
    "WHERE page_id % 7 = 3 HAVING count(*) > 0",
)
def html_failures(spark, sf):
    """Every seventh page is broken, and the report has these."""
    broken = F.concat(F.lit("<![broken[ "), F.coalesce("body", F.lit("")))
    documents = roles.page_documents(spark, sf)
    number = F.regexp_extract("filename", r"^\d+", 0).cast("long")
    documents = documents.withColumn("body", F.when(number % 7 == 3, broken).otherwise(F.col("body")))
    flow = Flow(documents).partition_html_or_fail()
    return status_report(flow.errors)


@query(
    "messages_ingest",
    o.with_(
        o.PACKAGES
        + """,
lines AS (
  SELECT channel, day, coalesce(thread_ts, ts)::double AS root, ts::double AS moment, text AS whole,
    list_filter(list_transform(regexp_split_to_array(text, '[\\r\\n]+'),
      lambda s: regexp_replace(s, '^[ \\t\\f]+|[ \\t\\f]+$', '', 'g')), lambda s: s <> '') AS found
  FROM dated
)""",
        """SELECT sha256(channel || '-' || day) AS record_id, sum(len(found))::bigint AS n_elements,
          sha256(string_agg(CASE WHEN len(found) > 0 THEN array_to_string(found, chr(10)) END,
            chr(10) ORDER BY root DESC, moment, whole)) AS text_hash
        FROM lines GROUP BY channel, day""",
    ),
)
def messages_ingest(spark, sf):
    """Daily packages to elements, staged for a vector store."""
    documents = messages.package_documents(roles.messages(spark, sf))
    rows = partition.partition_text(documents)
    staged = staging.stage_chroma(rows)
    ordered = rows.select(
        "record_id",
        "pos",
        enhanced_element_id(F.col("element_id"), F.col("record_id")).alias("id"),
    )
    texts = F.array_sort(F.collect_list(F.struct("pos", "document")))
    return (
        staged.join(ordered, "id")
        .groupBy("record_id")
        .agg(
            F.count(F.lit(1)).alias("n_elements"),
            F.sha2(F.array_join(F.transform(texts, lambda t: t["document"]), "\n"), 256).alias(
                "text_hash"
            ),
        )
    )


@query(
    "sql_ingest",
    """SELECT 'part-' || p_partkey AS record_id, 'Table' AS type,
      'p_partkey p_name ' || p_partkey || ' ' || p_name AS text,
      'part-' || p_partkey || '.csv' AS filename FROM part""",
)
def sql_ingest(spark, sf):
    """Table rows by id batches to CSV documents, Table elements and a lake table."""
    parts = table(spark, sf, "part")
    batches = records.index_batches(parts, "part", "p_partkey")
    rows = records.fetch_records(parts, batches, "p_partkey", ["p_name"])
    documents = records.rows_to_documents(rows, "part", "p_partkey")
    staged = staging.stage_lake_table(partition.partition_csv(documents), drop_empty=False)
    target = RecordTable(spark, scratch(spark, "lake"), buckets=8)
    target.overwrite_records(staged)
    return target.read().select("record_id", "type", "text", "filename")


@query("stage_table_reuse", o.with_(o.LINES, "SELECT record_id, pos, type FROM parts"))
def stage_table_reuse(spark, sf):
    """A second run with the same settings adds nothing to the stage table."""
    target = RecordTable(spark, scratch(spark, "stage"), buckets=8)
    documents = roles.documents(spark, sf)
    Flow(documents.filter("lang = 'en'")).partition().stage_table(target)
    return Flow(documents).partition().stage_table(target).rows.select("record_id", "pos", "type")
