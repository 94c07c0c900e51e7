"""Destination-shaped rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators import staging
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.registry import query

# Epoch values of the date columns.
_CREATED = "date_created::double"
_MODIFIED = "(1700000060 + doc_id * 3600)::double"
_PROCESSED = "1750000000.5::double"
_POINTS = "CASE WHEN pos % 3 = 0 THEN '[[0.0,' || pos || '.0],[10.5,' || pos || '.0]]' END"
_LANGUAGES = "'[\"' || lang || '\"]'"
_LINK_URLS = (
    "CASE WHEN link_urls IS NOT NULL THEN '[\"' || link_urls[1] || '\",\"' || link_urls[2] || "
    "'\"]' END"
)


def _listed(name: str):
    return F.to_json(F.col(name)).alias(name)


_FLAT = f"""record_id, id, element_id, type, text, filename, filetype, page_number::varchar AS
  page_number, url, version, {_CREATED} AS date_created, {_MODIFIED} AS date_modified,
  {_PROCESSED} AS date_processed, {_MODIFIED} AS last_modified, parent_id, category_depth,
  {_POINTS} AS points, system, layout_width, layout_height, links_json AS links,
  locator_json AS record_locator, permissions_json AS permissions_data,
  {_LANGUAGES} AS languages, {_LINK_URLS} AS link_urls, detection_class_prob, is_continuation,
  filesize_bytes"""
_FLAT_NAMES = [
    "record_id", "id", "element_id", "type", "text", "filename", "filetype", "page_number", "url",
    "version", "date_created", "date_modified", "date_processed", "last_modified", "parent_id",
    "category_depth", "points", "system", "layout_width", "layout_height", "links",
    "record_locator", "permissions_data", "detection_class_prob", "is_continuation",
    "filesize_bytes",
]


@query("stage_sql", o.with_(o.ELEMENTS, f"SELECT {_FLAT} FROM elements"))
def stage_sql(spark, sf):
    rows = staging.stage_sql(roles.elements(spark, sf))
    return rows.select(*_FLAT_NAMES, _listed("languages"), _listed("link_urls"))


@query(
    "stage_sql_renamed",
    o.with_(
        o.ELEMENTS,
        f"SELECT id AS pk, record_id, text AS body, {_CREATED} AS created FROM elements",
    ),
)
def stage_sql_renamed(spark, sf):
    rename = {"id": "pk", "text": "body", "date_created": "created"}
    rows = staging.stage_sql_renamed(roles.elements(spark, sf), rename)
    return rows.select("pk", "record_id", "body", "created")


@query(
    "stage_sql_json6",
    o.with_(
        o.ELEMENTS,
        "SELECT id, record_id, element_id, text, type, vector_csv AS embeddings, filename, "
        "page_number::varchar AS page_number, permissions_json FROM elements",
    ),
)
def stage_sql_json6(spark, sf):
    rows = staging.stage_sql_json(roles.elements(spark, sf))
    permissions = F.get_json_object("metadata", "$.data_source.permissions_data")
    return rows.select(
        "id",
        "record_id",
        "element_id",
        "text",
        "type",
        "embeddings",
        F.get_json_object("metadata", "$.filename").alias("filename"),
        F.get_json_object("metadata", "$.page_number").alias("page_number"),
        permissions.alias("permissions_json"),
    )


@query(
    "stage_sql_all_json",
    o.with_(
        o.ELEMENTS,
        f"SELECT id, vector_csv AS embeddings, {_LANGUAGES} AS languages, {_LINK_URLS} AS "
        "link_urls, links_json AS links FROM elements",
    ),
)
def stage_sql_all_json(spark, sf):
    rows = staging.stage_sql_json(roles.elements(spark, sf), metadata_as_json=False)
    return rows.select("id", "embeddings", "languages", "link_urls", "links")


@query(
    "stage_duckdb",
    o.with_(
        o.ELEMENTS,
        f"""SELECT id, element_id, text, type, system, layout_width, url, version, date_created,
          date_modified, last_modified, filename, page_number::varchar AS page_number,
          {_LANGUAGES} AS languages, permissions_json AS permissions_data, false AS has_record_id
        FROM elements""",
    ),
)
def stage_duckdb(spark, sf):
    rows = staging.stage_embedded_table(roles.elements(spark, sf))
    return rows.select(
        "id", "element_id", "text", "type", "system", "layout_width", "url", "version",
        "date_created", "date_modified", "last_modified", "filename", "page_number",
        _listed("languages"), "permissions_data",
        F.lit("record_id" in rows.columns).alias("has_record_id"),
    )


@query(
    "stage_delta",
    o.with_(
        o.ELEMENTS,
        """SELECT record_id, element_id, text, filename, page_number, system AS coordinates_system,
          layout_height AS coordinates_layout_height, version AS data_source_version,
          locator_json AS data_source_record_locator,
          permissions_json AS data_source_permissions_data,
          false AS has_subject, false AS has_orig_elements
        FROM elements""",
    ),
)
def stage_delta(spark, sf):
    rows = staging.stage_lake_table(roles.elements(spark, sf))
    return rows.select(
        "record_id", "element_id", "text", "filename", "page_number", "coordinates_system",
        "coordinates_layout_height", "data_source_version",
        _listed("data_source_record_locator"), "data_source_permissions_data",
        F.lit("subject" in rows.columns).alias("has_subject"),
        F.lit("orig_elements" in rows.columns).alias("has_orig_elements"),
    )


@query(
    "stage_volume_delta",
    o.with_(
        o.ELEMENTS,
        "SELECT id, record_id, element_id, filename, coalesce(system, '-') AS system FROM elements",
    ),
)
def stage_volume_delta(spark, sf):
    rows = staging.stage_volume_table(roles.elements(spark, sf))
    system = F.get_json_object("metadata", "$.coordinates.system")
    return rows.select(
        "id",
        "record_id",
        "element_id",
        F.get_json_object("metadata", "$.filename").alias("filename"),
        F.coalesce(system, F.lit("-")).alias("system"),
    )


@query(
    "stage_volume_delta_flat",
    o.with_(
        o.ELEMENTS,
        f"SELECT id, record_id, filename, system AS coordinates_system, {_LANGUAGES} AS languages, "
        "url AS data_source_url FROM elements",
    ),
)
def stage_volume_delta_flat(spark, sf):
    rows = staging.stage_volume_table(roles.elements(spark, sf), flatten=True)
    return rows.select(
        "id", "record_id", "filename", "coordinates_system", _listed("languages"),
        "data_source_url",
    )


@query(
    "stage_variant_table",
    o.with_(
        o.ELEMENTS,
        "SELECT id, record_id, filename, page_number, layout_height FROM elements",
    ),
)
def stage_variant_table(spark, sf):
    rows = staging.stage_variant_table(roles.elements(spark, sf))

    def at(path, kind):
        return F.try_variant_get("metadata", path, kind)

    return rows.select(
        "id",
        "record_id",
        at("$.filename", "string").alias("filename"),
        at("$.page_number", "long").alias("page_number"),
        at("$.coordinates.layout_height", "double").alias("layout_height"),
    )


def _metadata_rows(key: str, prefix: str = "", sep: str = "-", lists: bool = False) -> str:
    """UNION of (key column, flattened key, text value) rows of the non-null metadata."""

    def name(*parts: str) -> str:
        return "'" + prefix + sep.join(parts) + "'"

    parts = [
        (name("filename"), "filename"),
        (name("filetype"), "filetype"),
        (name("file_directory"), "file_directory"),
        (name("page_number"), "page_number::varchar"),
        (name("parent_id"), "parent_id"),
        (name("category_depth"), "category_depth::varchar"),
        (name("last_modified"), "last_modified"),
        (name("url"), "url"),
        (name("is_continuation"), "CASE WHEN is_continuation THEN 'True' END"),
        (name("detection_class_prob"), "detection_class_prob::varchar"),
        (name("coordinates", "system"), "system"),
        (name("coordinates", "layout_width"), "layout_width::varchar"),
        (name("coordinates", "layout_height"), "layout_height::varchar"),
        (name("data_source", "url"), "url"),
        (name("data_source", "version"), "version"),
        (name("data_source", "record_locator", "protocol"), "'s3'"),
        (name("data_source", "record_locator", "remote_file_path"), "fullpath"),
        (name("data_source", "date_created"), "date_created"),
        (name("data_source", "date_modified"), "date_modified"),
        (name("data_source", "date_processed"), "date_processed"),
        (name("data_source", "filesize_bytes"), "filesize_bytes::varchar"),
    ]
    if lists:
        link = ("links", "0")
        parts += [
            (name("languages", "0"), "lang"),
            (name("link_urls", "0"), "link_urls[1]"),
            (name("link_urls", "1"), "link_urls[2]"),
            (name(*link, "text"), "CASE WHEN pos % 4 = 1 THEN 't' || pos END"),
            (name(*link, "url"), "link_urls[1]"),
            (name(*link, "start_index"), "CASE WHEN pos % 4 = 1 THEN pos::varchar END"),
            (name("data_source", "permissions_data", "0", "op"), "'read'"),
            (name("data_source", "permissions_data", "0", "users", "0"), "lang"),
            (name("data_source", "permissions_data", "0", "groups", "0"), "source"),
        ]
        for i, x in enumerate(("0.0", "10.5")):
            parts.append(
                (name("coordinates", "points", str(i), "0"),
                 f"CASE WHEN pos % 3 = 0 THEN '{x}' END")
            )
            parts.append(
                (name("coordinates", "points", str(i), "1"),
                 "CASE WHEN pos % 3 = 0 THEN pos || '.0' END")
            )
    else:
        parts += [
            (name("languages"), _LANGUAGES),
            (name("link_urls"), _LINK_URLS),
            (name("links"), "links_json"),
            (name("coordinates", "points"), _POINTS),
            (
                name("data_source", "permissions_data"),
                "'[{\"op\":\"read\",\"users\":[\"' || lang || '\"],\"groups\":[\"' || source || "
                "'\"]}]'",
            ),
        ]
    return "\nUNION ALL ".join(
        f"SELECT {key}, {k} AS key, {v} AS value FROM rows WHERE {v} IS NOT NULL" for k, v in parts
    )


_ROWS = o.ELEMENTS + ", rows AS (SELECT * FROM elements)"


@query(
    "stage_elasticsearch",
    o.with_(
        _ROWS,
        "SELECT *, 'docs' AS index_name FROM (" + _metadata_rows("id, element_id, record_id, type")
        + ")",
    ),
)
def stage_elasticsearch(spark, sf):
    rows = staging.stage_search_index(roles.elements(spark, sf), "docs")
    return rows.select(
        F.col("_id").alias("id"),
        F.col("_index").alias("index_name"),
        "_source.element_id",
        "_source.record_id",
        "_source.type",
        F.explode("_source.metadata").alias("key", "value"),
    )


_SPLIT_CREATED = o.rfc3339(_CREATED)
_SPLIT_MODIFIED = o.rfc3339(_MODIFIED)


@query(
    "stage_azure_search",
    o.with_(
        o.ELEMENTS,
        f"""SELECT id, record_id, text, {_POINTS} AS points, version, locator_json,
          permissions_json, links_json, {_SPLIT_CREATED} AS date_created,
          {_SPLIT_MODIFIED} AS date_modified, {_SPLIT_MODIFIED} AS last_modified,
          '2025-06-15T15:06:40.500000Z' AS date_processed, page_number::varchar AS page_number
        FROM elements""",
    ),
)
def stage_azure_search(spark, sf):
    rows = staging.stage_nested_search(roles.elements(spark, sf))
    source = F.col("metadata.data_source")
    links = F.concat(F.lit("["), F.array_join("metadata.links", ","), F.lit("]"))
    return rows.select(
        "id",
        "record_id",
        "text",
        F.col("metadata.coordinates.points").alias("points"),
        source["version"].alias("version"),
        source["record_locator"].alias("locator_json"),
        source["permissions_data"].alias("permissions_json"),
        links.alias("links_json"),
        source["date_created"].alias("date_created"),
        source["date_modified"].alias("date_modified"),
        F.col("metadata.last_modified").alias("last_modified"),
        source["date_processed"].alias("date_processed"),
        F.col("metadata.page_number").alias("page_number"),
    )


@query(
    "stage_chroma",
    o.with_(
        _ROWS,
        _metadata_rows("id, text AS document", "metadata-", lists=True)
        + "\nUNION ALL SELECT id, text, 'element_id', element_id FROM rows"
        + "\nUNION ALL SELECT id, text, 'type', type FROM rows",
    ),
)
def stage_chroma(spark, sf):
    rows = staging.stage_chroma(roles.elements(spark, sf))
    return rows.select("id", "document", F.explode("metadata").alias("key", "value"))


@query(
    "stage_pinecone",
    o.with_(
        o.ELEMENTS
        + """,
kept AS (SELECT *, record_id || '#' || id AS vid,
    strlen('{"element_id":"' || element_id || '","text":' || to_json(text)::varchar ||
      ',"page_number":' || page_number ||
      CASE WHEN parent_id IS NOT NULL THEN ',"parent_id":"' || parent_id || '"' ELSE '' END ||
      CASE WHEN link_urls IS NOT NULL THEN ',"link_urls-0":"' || link_urls[1] ||
        '","link_urls-1":"' || link_urls[2] || '"' ELSE '' END || '}') <= 700 AS fits
  FROM elements WHERE embeddings IS NOT NULL)""",
        """SELECT vid AS id, 'record_id' AS key, record_id AS value FROM kept
  UNION ALL SELECT vid, 'element_id', element_id FROM kept WHERE fits
  UNION ALL SELECT vid, 'text', text FROM kept WHERE fits
  UNION ALL SELECT vid, 'parent_id', parent_id FROM kept WHERE fits AND parent_id IS NOT NULL
  UNION ALL SELECT vid, 'page_number', page_number::varchar FROM kept WHERE fits
  UNION ALL SELECT vid, 'link_urls-0', link_urls[1] FROM kept WHERE fits AND link_urls IS NOT NULL
  UNION ALL SELECT vid, 'link_urls-1', link_urls[2] FROM kept WHERE fits AND link_urls IS NOT NULL
        """,
    ),
)
def stage_pinecone(spark, sf):
    rows = staging.stage_vector_index(
        roles.elements(spark, sf),
        ["element_id", "text", "parent_id", "page_number", "link_urls"],
        max_metadata_bytes=700,
    )
    return rows.select("id", F.explode("metadata").alias("key", "value"))


@query(
    "stage_qdrant",
    o.with_(
        o.ELEMENTS,
        """SELECT id, text, element_id, 'metadata-subject' AS null_key, filename,
          layout_height::varchar AS layout_height,
          CASE WHEN embeddings IS NULL THEN 0 ELSE 2 END::bigint AS n_vector,
          page_number::varchar AS page_number FROM elements""",
    ),
)
def stage_qdrant(spark, sf):
    rows = staging.stage_qdrant(roles.elements(spark, sf))
    fields = F.col("payload.fields")
    has_null = F.map_contains_key(fields, "metadata-subject") & fields["metadata-subject"].isNull()
    serialized = F.get_json_object("payload.element_serialized", "$.metadata.page_number")
    return rows.select(
        "id",
        F.col("payload.text").alias("text"),
        fields["element_id"].alias("element_id"),
        F.when(has_null, F.lit("metadata-subject")).alias("null_key"),
        fields["metadata-filename"].alias("filename"),
        F.try_element_at(fields, F.lit("metadata-coordinates-layout_height")).alias(
            "layout_height"
        ),
        F.size("vector").cast("long").alias("n_vector"),
        serialized.alias("page_number"),
    )


_MILVUS = f"""SELECT record_id, element_id, coalesce(is_continuation, false) AS is_continuation,
  {_LANGUAGES} AS languages, permissions_json AS data_source_permissions_data,
  {_CREATED} AS data_source_date_created, {_MODIFIED} AS data_source_date_modified,
  {_MODIFIED} AS last_modified, filename, system AS coordinates_system
FROM elements WHERE embeddings IS NOT NULL"""


@query("stage_milvus", o.with_(o.ELEMENTS, _MILVUS))
def stage_milvus(spark, sf):
    rows = staging.stage_milvus(roles.elements(spark, sf))
    return rows.select(
        "record_id", "element_id", "is_continuation", "languages",
        "data_source_permissions_data", "data_source_date_created", "data_source_date_modified",
        "last_modified", "filename", "coordinates_system",
    )


@query(
    "prepare_milvus_insert",
    o.with_(
        o.ELEMENTS,
        "SELECT element_id, text, is_continuation, record_id, lang AS language FROM "
        "(SELECT element_id, text, coalesce(is_continuation, false) AS is_continuation, record_id, "
        "lang FROM elements WHERE embeddings IS NOT NULL)",
    ),
)
def prepare_milvus_insert(spark, sf):
    rows = staging.stage_milvus(
        roles.elements(spark, sf),
        fields=["element_id", "text", "is_continuation", "languages", "filename"],
    )
    dynamic = staging.prepare_collection_insert(rows)
    fixed = staging.prepare_collection_insert(
        dynamic.withColumn("language", F.col("languages")[0]),
        ["element_id", "text", "is_continuation", "record_id", "language"],
    )
    return fixed


@query(
    "stage_weaviate",
    o.with_(
        o.ELEMENTS,
        f"""SELECT record_id, element_id, {_POINTS} AS points, links_json AS links, locator_json,
          permissions_json, {_SPLIT_MODIFIED} AS last_modified, page_number::varchar AS page_number,
          {_SPLIT_CREATED} AS flat_created, date_created AS raw_created FROM elements""",
    ),
)
def stage_weaviate(spark, sf):
    elements = roles.elements(spark, sf)
    nested = staging.stage_weaviate(elements)
    source = F.col("metadata.data_source")
    nested = nested.select(
        "record_id",
        "element_id",
        F.col("metadata.coordinates.points").alias("points"),
        F.col("metadata.links").alias("links"),
        source["record_locator"].alias("locator_json"),
        source["permissions_data"].alias("permissions_json"),
        F.col("metadata.last_modified").alias("last_modified"),
        F.col("metadata.page_number").alias("page_number"),
    )
    auto = staging.stage_weaviate(elements, flatten=True, auto_schema=True).select(
        "record_id", "element_id", F.col("data_source_date_created").alias("flat_created")
    )
    flat = staging.stage_weaviate(elements, flatten=True).select(
        "record_id", "element_id", F.col("data_source_date_created").alias("raw_created")
    )
    key = ["record_id", "element_id"]
    return nested.join(auto, key).join(flat, key)


@query(
    "conform_to_collection",
    o.with_(o.ELEMENTS, "SELECT record_id, text, NULL::varchar AS note FROM elements"),
)
def conform_to_collection(spark, sf):
    rows = staging.stage_weaviate(roles.elements(spark, sf))
    return staging.conform_to_collection(
        rows, StructType.fromDDL("record_id string, text string, note string")
    )


@query(
    "stage_kdbai",
    o.with_(_ROWS, _metadata_rows("id, element_id, text AS document", "", "_", lists=True)),
)
def stage_kdbai(spark, sf):
    rows = staging.stage_kdbai(roles.elements(spark, sf))
    return rows.select("id", "element_id", "document", F.explode("metadata").alias("key", "value"))


@query(
    "stage_lancedb",
    o.with_(
        o.ELEMENTS,
        """SELECT record_id, element_id, filename AS metadata_filename, system AS
          metadata_coordinates_system, version AS metadata_data_source_version, text,
          CASE WHEN embeddings IS NOT NULL THEN 2 END::bigint AS n FROM elements""",
    ),
)
def stage_lancedb(spark, sf):
    rows = staging.stage_lancedb(roles.elements(spark, sf))
    return rows.select(
        "record_id",
        "element_id",
        F.col("`metadata-filename`").alias("metadata_filename"),
        F.col("`metadata-coordinates-system`").alias("metadata_coordinates_system"),
        F.col("`metadata-data_source-version`").alias("metadata_data_source_version"),
        "text",
        F.when(F.col("vector").isNotNull(), F.size("vector")).cast("long").alias("n"),
    )


@query(
    "stage_astradb",
    o.with_(
        o.ELEMENTS,
        """SELECT record_id, text AS content, element_id, type, filename, text AS lexical,
          vector_csv AS vector FROM elements
        WHERE embeddings IS NOT NULL AND strlen(text) <= 8000
        UNION ALL SELECT record_id, rtrim(decode(encode(text)[1:8000 -
            CASE WHEN regexp_matches(hex(encode(text)[7998:8000]), '[CDEF][0-9A-F]$') THEN 1
              WHEN regexp_matches(hex(encode(text)[7998:8000]), '[EF][0-9A-F][89AB][0-9A-F]$')
              THEN 2 ELSE 0 END]), ''), element_id, type, filename,
          rtrim(decode(encode(text)[1:8000 -
            CASE WHEN regexp_matches(hex(encode(text)[7998:8000]), '[CDEF][0-9A-F]$') THEN 1
              WHEN regexp_matches(hex(encode(text)[7998:8000]), '[EF][0-9A-F][89AB][0-9A-F]$')
              THEN 2 ELSE 0 END]), ''), vector_csv
        FROM elements WHERE embeddings IS NOT NULL AND strlen(text) > 8000""",
    ),
)
def stage_astradb(spark, sf):
    from sluice.functions.text import vector_to_csv
    from sluice.operators.filters import has_embedding

    rows = staging.stage_astradb(has_embedding(roles.elements(spark, sf)), lexical=True)
    return rows.select(
        "record_id",
        "content",
        F.col("metadata.element_id").alias("element_id"),
        F.col("metadata.type").alias("type"),
        F.col("metadata.metadata.filename").alias("filename"),
        F.col("`$lexical`").alias("lexical"),
        vector_to_csv(F.col("`$vector`")).alias("vector"),
    )


@query(
    "stage_couchbase",
    o.with_(o.ELEMENTS, "SELECT record_id AS source, element_id AS key, text, type, filename "
            "FROM elements"),
)
def stage_couchbase(spark, sf):
    elements = roles.elements(spark, sf)
    rows = staging.stage_couchbase(elements)
    return rows.select(
        F.col("value.metadata.data_source.url").alias("url"),
        "key",
        F.col("value.text").alias("text"),
        F.col("value.type").alias("type"),
        F.col("value.metadata.filename").alias("filename"),
    ).join(
        elements.select("record_id", F.col("metadata.data_source.url").alias("url")).distinct(),
        "url",
    ).select(F.col("record_id").alias("source"), "key", "text", "type", "filename")


@query(
    "stage_vectara",
    o.with_(
        o.ELEMENTS,
        f"""SELECT sha256(record_id) AS id, 'core' AS type, record_id AS title,
          pos // 40 AS part, '[' || string_agg('{{"text":' || {o.js("text")} ||
          ',"metadata":{{"page_number":' || page_number || ',"url":"' || url || '","filename":"' ||
          filename || '","filetype":"text/plain","last_modified":"' || last_modified ||
          '","element_id":"' || element_id || '"}}}}', ',' ORDER BY pos) || ']' AS parts
        FROM elements GROUP BY record_id, pos // 40""",
    ),
)
def stage_vectara(spark, sf):
    rows = staging.stage_document_parts(roles.elements(spark, sf), part_rows=40)
    return rows.select(
        "id",
        "type",
        F.col("metadata.title").alias("title"),
        "part",
        F.to_json("document_parts").alias("parts"),
    )


@query(
    "one_document_per_record",
    o.with_(
        o.LINES,
        "SELECT record_id, count(*) AS n_parts, string_agg(text, chr(10) ORDER BY pos) AS text "
        "FROM parts GROUP BY 1",
    ),
)
def one_document_per_record(spark, sf):
    rows = staging.stage_document_parts(roles.parts(spark, sf))
    return rows.select(
        F.col("metadata.title").alias("record_id"),
        F.size("document_parts").cast("long").alias("n_parts"),
        F.array_join("document_parts.text", "\n").alias("text"),
    )


@query(
    "stage_blob_json",
    o.with_(
        o.LINES,
        f"""SELECT 'src/' || record_id || '.json' AS path, count(*) AS n,
          '[' || string_agg({o.js("text")}, ',' ORDER BY pos) || ']' AS texts
        FROM parts GROUP BY record_id""",
    ),
)
def stage_blob_json(spark, sf):
    from sluice.operators.files import json_documents

    rows = roles.parts(spark, sf)
    rows = rows.withColumn("path", F.concat(F.lit("src/"), "record_id"))
    documents = json_documents(rows, "path")
    items = F.from_json("body", "array<struct<text:string>>")
    return documents.select(
        "path",
        F.size(items).cast("long").alias("n"),
        F.to_json(F.transform(items, lambda e: e["text"])).alias("texts"),
    )


@query(
    "stage_mongo",
    o.with_(o.ELEMENTS, "SELECT record_id, element_id, type, text, filename FROM elements"),
)
def stage_mongo(spark, sf):
    rows = staging.stage_mongo(roles.elements(spark, sf))
    return rows.select(
        "record_id", "element_id", "type", "text", F.col("metadata.filename").alias("filename")
    )


@query(
    "stage_redis",
    o.with_(o.ELEMENTS, "SELECT 'el:' || element_id AS key, record_id, text FROM elements"),
)
def stage_redis(spark, sf):
    elements = roles.elements(spark, sf)
    rows = staging.stage_key_value(elements, "el:")
    path = F.get_json_object("value", "$.metadata.data_source.url")
    from sluice.functions.ids import uuid5_dns

    return rows.select(
        "key",
        uuid5_dns(path).alias("record_id"),
        F.get_json_object("value", "$.text").alias("text"),
    )


@query(
    "stage_snowflake_values",
    o.with_(
        o.ELEMENTS,
        "SELECT id, vector_csv AS vector, lang AS first_language, "
        "CASE WHEN pos % 4 = 1 THEN pos END AS start_index FROM elements",
    ),
)
def stage_snowflake_values(spark, sf):
    from sluice.functions.text import vector_to_csv

    flat = staging.stage_sql(roles.elements(spark, sf)).select(
        "id", "embeddings", "languages", "links"
    )
    rows = staging.stage_typed_values(flat, ["embeddings"], ["languages", "links"])
    return rows.select(
        "id",
        vector_to_csv(F.col("embeddings")).alias("vector"),
        F.try_variant_get("languages", "$[0]", "string").alias("first_language"),
        F.try_variant_get("links", "$[0].start_index", "long").alias("start_index"),
    )


@query(
    "stage_sql_bind_values",
    o.with_(
        o.ELEMENTS,
        f"""SELECT id, {_LANGUAGES} AS languages,
          strftime(make_timestamp(({_CREATED} * 1000000)::bigint), '%Y-%m-%d %H:%M:%S') AS
            date_created,
          CASE WHEN pos % 2 = 0 THEN detection_class_prob END AS detection_class_prob
        FROM elements""",
    ),
)
def stage_sql_bind_values(spark, sf):
    flat = staging.stage_sql(roles.elements(spark, sf)).select(
        "id",
        "languages",
        "date_created",
        F.coalesce("detection_class_prob", F.lit(float("nan"))).alias("detection_class_prob"),
    )
    rows = staging.bind_values(flat)
    created = F.unix_micros("date_created")
    from sluice.functions.dates import format_rfc3339

    text = F.replace(
        F.substring(format_rfc3339(created / 1000000), 1, 19), F.lit("T"), F.lit(" ")
    )
    return rows.withColumn("date_created", text)


def _shout(rows, column):
    return rows.withColumn(column, F.upper(column))


@query(
    "custom_stager",
    o.with_(o.LINES, "SELECT record_id, pos, upper(type) AS type FROM parts"),
)
def custom_stager(spark, sf):
    rows = roles.parts(spark, sf).select("record_id", "pos", "type")
    named = f"{__name__}:_shout"
    return staging.custom_stage(rows, named, column="type")


@query(
    "conform_hooks",
    o.with_(
        o.LINES,
        "SELECT record_id, pos * 2 AS twice FROM parts WHERE type = 'NarrativeText'",
    ),
)
def conform_hooks(spark, sf):
    rows = roles.parts(spark, sf).select("record_id", "pos", "type")
    return staging.conform_elements(
        rows,
        lambda e: {"record_id": e["record_id"], "twice": e["pos"] * 2},
        "record_id string, twice long",
        should_include=lambda e: e["type"] == "NarrativeText",
    )
