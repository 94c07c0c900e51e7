"""Element rows in the shape of each destination.

Every function takes ELEMENTS and returns a DataFrame. Field lists come from the schema at plan
time; only map keys and list lengths are read from the rows. JSON text is compact UTF-8.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources.parts import PART_ROWS, part_of
from sluice import schemas
from sluice.functions.dates import (
    epoch_to_timestamp,
    format_rfc3339,
    parse_date_lenient,
)
from sluice.functions.flatten import (
    entries_json,
    entries_map,
    flat_columns,
    flat_entries,
    flat_row_entries,
)
from sluice.functions.ids import enhanced_element_id, prefixed_id
from sluice.functions.permissions import permissions_json
from sluice.functions.text import truncate_utf8_bytes, vector_to_csv
from sluice.operators.filters import has_embedding
from sluice.operators.orig_elements import light_orig_elements
from sluice.operators.schema_fit import fit_to_schema, non_empty_columns

# Columns with dates, JSON text and plain text in table destinations.
DATE_COLUMNS = ["date_created", "date_modified", "date_processed", "last_modified"]
JSON_COLUMNS = ["permissions_data", "record_locator", "points", "links"]
TEXT_COLUMNS = ["version", "page_number", "regex_metadata"]

# Fixed value: columns the embedded analytical table has.
EMBEDDED_TABLE_COLUMNS = [
    "id", "element_id", "text", "embeddings", "type", "system", "layout_width", "layout_height",
    "points", "url", "version", "date_created", "date_modified", "date_processed",
    "permissions_data", "record_locator", "category_depth", "parent_id", "attached_filename",
    "filetype", "last_modified", "file_directory", "filename", "languages", "page_number", "links",
    "page_name", "link_urls", "link_texts", "sent_from", "sent_to", "subject", "section",
    "header_footer_type", "emphasized_text_contents", "emphasized_text_tags", "text_as_html",
    "regex_metadata", "detection_class_prob",
]

# Metadata fields a vector index row may carry, and its size limit in bytes.
VECTOR_INDEX_FIELDS = [
    "element_id", "text", "parent_id", "category_depth", "emphasized_text_tags",
    "emphasized_text_contents", "coordinates", "last_modified", "page_number", "filename",
    "is_continuation", "link_urls", "link_texts", "text_as_html", "entities",
]
VECTOR_INDEX_METADATA_BYTES = 40_960

# Fixed value: flattened metadata keys a document-part store keeps, and their names there.
PART_METADATA = {
    "page_number": "page_number",
    "data_source-url": "url",
    "filename": "filename",
    "filetype": "filetype",
    "last_modified": "last_modified",
    "element_id": "element_id",
}


def row_id() -> Column:
    return enhanced_element_id(F.col("element_id"), F.col("record_id"))


def _data_columns(df: DataFrame) -> list[str]:
    """Element columns that belong to the element itself, in schema order."""
    return [c for c in df.columns if c not in ("record_id", "pos", "orig")]


def _top_level(elements: DataFrame) -> dict[str, tuple[Column, T.DataType]]:
    """Element, metadata, data source and coordinates in one level; the later one wins."""
    out: dict[str, tuple[Column, T.DataType]] = {}

    def add(fields, column_of: Callable[[str], Column], skip=()):
        for field in fields:
            if field.name in skip:
                continue
            column = column_of(field.name)
            if field.name in out:
                column = F.coalesce(column, out[field.name][0].cast(field.dataType))
            out[field.name] = (column, field.dataType)

    own = [elements.schema[c] for c in _data_columns(elements) if c != "metadata"]
    add(own, lambda n: F.col(f"`{n}`"))
    metadata = elements.schema["metadata"].dataType
    nested = ("data_source", "coordinates")
    add(metadata.fields, lambda n: F.col(f"metadata.`{n}`"), skip=nested)
    for part in nested:
        if part in metadata.names:
            add(
                metadata[part].dataType.fields,
                lambda n, part=part: F.col(f"metadata.{part}.`{n}`"),
            )
    return out


def _as_json(column: Column, dtype: T.DataType, name: str) -> Column:
    """JSON text of a list or object; anything else has none."""
    if name == "permissions_data":
        return permissions_json(column)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(column.isNotNull(), F.to_json(column))
    return F.lit(None).cast("string")


def stage_sql(elements: DataFrame) -> DataFrame:
    """Flat row with id and record_id; dates as epoch seconds, nested values as JSON text."""
    columns = _top_level(elements)
    out = [row_id().alias("id"), F.col("record_id")]
    for name, (column, dtype) in columns.items():
        if name in DATE_COLUMNS:
            column = parse_date_lenient(column)
        elif name in JSON_COLUMNS:
            column = _as_json(column, dtype, name)
        elif name in TEXT_COLUMNS:
            column = column.cast("string")
        elif isinstance(dtype, (T.MapType, T.StructType)):
            column = F.to_json(column)
        out.append(column.alias(name))
    return elements.select(*out)


def stage_sql_renamed(elements: DataFrame, rename: dict[str, str]) -> DataFrame:
    return stage_sql(elements).withColumnsRenamed(rename)


def metadata_json(elements: DataFrame) -> Column:
    """Metadata as one JSON object; absent fields are left out."""
    metadata = F.col("metadata")
    names = elements.schema["metadata"].dataType.names
    if "data_source" in names:
        source = elements.schema["metadata"].dataType["data_source"].dataType
        if "permissions_data" in source.names:
            by_op = F.transform(
                F.col("metadata.data_source.permissions_data"),
                lambda p: F.map_from_arrays(
                    F.array(p["op"]),
                    F.array(F.struct(p["users"].alias("users"), p["groups"].alias("groups"))),
                ),
            )
            metadata = metadata.withField("data_source.permissions_data", by_op)
    return F.to_json(metadata)


def stage_sql_json(elements: DataFrame, metadata_as_json: bool = True) -> DataFrame:
    """Seven columns with vector text and JSON metadata, or the flat row with all lists as JSON."""
    vector = vector_to_csv(F.col("embeddings")).alias("embeddings")
    if metadata_as_json:
        return elements.select(
            row_id().alias("id"),
            "record_id",
            F.coalesce("element_id", F.lit("")).alias("element_id"),
            "text",
            "type",
            vector,
            metadata_json(elements).alias("metadata"),
        )
    flat = stage_sql(elements)
    out = []
    for field in flat.schema.fields:
        if field.name == "embeddings":
            out.append(vector)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(F.col(field.name)).alias(field.name))
        else:
            out.append(F.col(field.name))
    return flat.select(*out)


def stage_embedded_table(elements: DataFrame) -> DataFrame:
    """Flat row without record id, known columns only."""
    columns = _top_level(elements)
    out = [row_id().alias("id")]
    for name in EMBEDDED_TABLE_COLUMNS:
        if name in columns:
            column, dtype = columns[name]
            if name in TEXT_COLUMNS:
                column = column.cast("string")
            elif name == "permissions_data":
                column = permissions_json(column)
            elif isinstance(dtype, T.StructType):
                column = F.to_json(column)
            out.append(column.alias(name))
    return elements.select(*out)


def _flat_metadata(elements: DataFrame, keep: Sequence[str] = ()) -> list[tuple[str, Column]]:
    schema = elements.schema["metadata"].dataType
    out = []
    for name, column in flat_columns(schema, "metadata", "_", keep):
        if name.endswith("permissions_data"):
            column = permissions_json(column)
        out.append((name, column))
    return out


def stage_lake_table(elements: DataFrame, drop_empty: bool = True) -> DataFrame:
    """Record id and flattened metadata; the record locator stays one column.

    ``drop_empty`` leaves out columns without any value (one aggregation pass).
    """
    flat = elements.select(
        "record_id",
        *[F.col(c) for c in _data_columns(elements) if c != "metadata"],
        *[
            c.alias(n)
            for n, c in _flat_metadata(elements, keep=["data_source_record_locator"])
        ],
    )
    return flat.select(*non_empty_columns(flat)) if drop_empty else flat


def stage_volume_table(elements: DataFrame, flatten: bool = False) -> DataFrame:
    """Id, record id and metadata, either as JSON text or flattened."""
    own = [F.col(c) for c in _data_columns(elements) if c != "metadata"]
    if flatten:
        rest = [c.alias(n) for n, c in _flat_metadata(elements)]
    else:
        rest = [metadata_json(elements).alias("metadata")]
    return elements.select(row_id().alias("id"), "record_id", *own, *rest)


def stage_variant_table(elements: DataFrame) -> DataFrame:
    """As :func:`stage_volume_table` with the metadata parsed into a VARIANT."""
    return stage_volume_table(elements).withColumn("metadata", F.parse_json("metadata"))


def _flat_map(
    elements: DataFrame, columns: Sequence[str], sep: str, lists: bool, drop_null: bool
) -> Column:
    entries = flat_row_entries(elements.schema, columns, sep, lists, drop_null, json=False)
    return entries_map(entries, json=False)


def _metadata_map(elements: DataFrame, sep: str, lists: bool, drop_null: bool) -> Column:
    parts = [
        flat_entries(
            F.col(f"metadata.`{f.name}`"), f.dataType, F.lit(f.name), sep, lists, drop_null, json=False
        )
        for f in elements.schema["metadata"].dataType.fields
    ]
    return entries_map(F.concat(*parts), json=False)


def stage_search_index(elements: DataFrame, index_name: str) -> DataFrame:
    """Bulk-index action: ``_index``, ``_id`` and ``_source`` with flattened metadata."""
    metadata = _metadata_map(elements, "-", False, True)
    source = F.struct(
        F.col("element_id"),
        F.col("embeddings"),
        F.col("text"),
        F.col("type"),
        F.col("record_id"),
        metadata.alias("metadata"),
    )
    return elements.select(
        F.lit(index_name).alias("_index"), row_id().alias("_id"), source.alias("_source")
    )


def _rfc3339(text: Column) -> Column:
    return format_rfc3339(parse_date_lenient(text))


def _normalize_nested(elements: DataFrame, links_as_one: bool) -> Column:
    """Metadata with nested values as JSON text, RFC 3339 dates, and text version and page."""
    links = F.col("metadata.links")
    link_text = (
        F.to_json(links) if links_as_one else F.transform(links, lambda link: F.to_json(link))
    )
    changes = {
        "coordinates.points": F.to_json(F.col("metadata.coordinates.points")),
        "data_source.record_locator": F.to_json(F.col("metadata.data_source.record_locator")),
        "data_source.permissions_data": permissions_json(
            F.col("metadata.data_source.permissions_data")
        ),
        "links": F.when(links.isNotNull(), link_text),
        "last_modified": _rfc3339(F.col("metadata.last_modified")),
        "page_number": F.col("metadata.page_number").cast("string"),
    }
    for name in ("date_created", "date_modified", "date_processed"):
        changes[f"data_source.{name}"] = _rfc3339(F.col(f"metadata.data_source.{name}"))
    metadata = F.col("metadata")
    for path, value in changes.items():
        metadata = metadata.withField(path, value)
    return metadata


def stage_nested_search(elements: DataFrame) -> DataFrame:
    """Nested document with id and record id for an index with a typed field tree."""
    return elements.select(
        row_id().alias("id"),
        "record_id",
        *[F.col(c) for c in _data_columns(elements) if c != "metadata"],
        _normalize_nested(elements, links_as_one=False).alias("metadata"),
    )


def stage_chroma(elements: DataFrame) -> DataFrame:
    rest = [c for c in _data_columns(elements) if c not in ("embeddings", "text")]
    return elements.select(
        row_id().alias("id"),
        F.col("embeddings").alias("embedding"),
        F.col("text").alias("document"),
        _flat_map(elements, rest, "-", True, True).alias("metadata"),
    )


def stage_vector_index(
    elements: DataFrame,
    fields: Sequence[str] = tuple(VECTOR_INDEX_FIELDS),
    max_metadata_bytes: int = VECTOR_INDEX_METADATA_BYTES,
) -> DataFrame:
    """Id with record prefix, values, and the listed metadata; too large metadata is left out.

    The record id is always part of the metadata. Elements without a vector are left out.
    """
    rows = has_embedding(elements)
    parts = []
    for name, (column, dtype) in _layers(rows).items():
        if name in fields:
            parts.append(flat_entries(column, dtype, F.lit(name), "-", True, True))
    entries = F.concat(*parts)
    sized = rows.withColumn("_entries", entries)
    fits = F.octet_length(entries_json(F.col("_entries"))) <= max_metadata_bytes
    none = F.create_map().cast("map<string,string>")
    record = F.create_map(F.lit("record_id"), F.col("record_id"))
    return sized.select(
        prefixed_id(F.col("record_id"), row_id()).alias("id"),
        F.col("embeddings").alias("values"),
        F.map_concat(
            F.when(fits, entries_map(F.col("_entries"))).otherwise(none), record
        ).alias("metadata"),
    )


def _layers(elements: DataFrame) -> dict[str, tuple[Column, T.DataType]]:
    """As :func:`_top_level`, in field-list order of element, metadata, source, coordinates."""
    return {k: v for k, v in _top_level(elements).items() if k != "embeddings"}


def stage_qdrant(elements: DataFrame) -> DataFrame:
    """Id, vector (empty when missing) and payload: text, JSON of the rest, flattened rest."""
    rest = [c for c in _data_columns(elements) if c not in ("embeddings", "text")]
    serialized = F.to_json(F.struct(*rest))
    payload = F.struct(
        F.col("text").alias("text"),
        serialized.alias("element_serialized"),
        _flat_map(elements, rest, "-", True, False).alias("fields"),
    )
    return elements.select(
        row_id().alias("id"),
        F.coalesce("embeddings", F.array().cast("array<float>")).alias("vector"),
        payload.alias("payload"),
    )


def stage_milvus(
    elements: DataFrame, flatten: bool = True, fields: Sequence[str] | None = None
) -> DataFrame:
    """Optional flattening, default continuation flag, epoch dates, JSON languages and
    permissions. A listed field that no element can have fails at plan time, one that is null in a
    row fails the job."""
    rows = has_embedding(elements)
    columns: dict[str, Column] = {
        c: F.col(c) for c in _data_columns(rows) if c != "metadata"
    }
    if flatten:
        schema = rows.schema["metadata"].dataType
        columns.update(dict(flat_columns(schema, "metadata", "_")))
    else:
        columns["metadata"] = F.col("metadata")
    given = columns.get("is_continuation", F.lit(None).cast("boolean"))
    columns["is_continuation"] = F.coalesce(given, F.lit(False))
    if fields:
        missing = [f for f in fields if f not in columns]
        if missing:
            raise KeyError(f"fields missing in the data: {missing}")
        columns = {
            f: F.coalesce(columns[f], F.raise_error(F.lit(f"field {f} is missing in the data")))
            for f in fields
        }
    for name in ("data_source_date_created", "data_source_date_modified",
                 "data_source_date_processed", "last_modified"):
        if name in columns:
            columns[name] = parse_date_lenient(columns[name])
    if "languages" in columns:
        columns["languages"] = F.to_json(columns["languages"])
    if "data_source_permissions_data" in columns:
        columns["data_source_permissions_data"] = permissions_json(
            columns["data_source_permissions_data"]
        )
    return rows.select(*[c.alias(n) for n, c in columns.items()], "record_id")


def prepare_collection_insert(
    rows: DataFrame, schema_fields: Sequence[str] | None = None
) -> DataFrame:
    """Dynamic collections get ``languages`` as a list; fixed ones only their own fields."""
    if schema_fields is None:
        if "languages" in rows.columns:
            return rows.withColumn("languages", F.from_json("languages", "array<string>"))
        return rows
    return rows.select(*[c for c in rows.columns if c in schema_fields])


def stage_weaviate(
    elements: DataFrame, flatten: bool = False, auto_schema: bool = False
) -> DataFrame:
    """Nested and normalized, normalized then flattened (auto schema), or flattened as is."""
    rows = elements
    if not flatten or auto_schema:
        rows = rows.withColumn("metadata", _normalize_nested(rows, links_as_one=True))
    own = [F.col(c) for c in _data_columns(rows) if c != "metadata"]
    if flatten:
        schema = rows.schema["metadata"].dataType
        metadata = [c.alias(n) for n, c in flat_columns(schema, "metadata", "_")]
    else:
        metadata = [F.col("metadata")]
    return rows.select(*own, *metadata, "record_id")


def conform_to_collection(rows: DataFrame, properties: T.StructType) -> DataFrame:
    return fit_to_schema(rows, properties, add_missing=True)


def stage_kdbai(elements: DataFrame) -> DataFrame:
    return elements.select(
        row_id().alias("id"),
        "element_id",
        F.col("text").alias("document"),
        "embeddings",
        _metadata_map(elements, "_", True, True).alias("metadata"),
    )


def stage_lancedb(elements: DataFrame) -> DataFrame:
    """Vector, record id, and everything else flattened into columns."""
    schema = elements.schema["metadata"].dataType
    own = [F.col(c) for c in _data_columns(elements) if c not in ("metadata", "embeddings")]
    flat = [c.alias(f"metadata-{n}") for n, c in flat_columns(schema, "metadata", "-")]
    return elements.select(F.col("embeddings").alias("vector"), "record_id", *own, *flat)


def stage_astradb(
    elements: DataFrame,
    generate_embeddings: bool = False,
    lexical: bool = False,
    flatten: bool = False,
) -> DataFrame:
    """Content, record id, metadata and exactly one of own vector or server-side vectorizing."""
    text = truncate_utf8_bytes(F.col("text"))
    metadata = F.col("metadata").withField(
        "text_as_html", truncate_utf8_bytes(F.col("metadata.text_as_html"))
    )
    rows = elements.withColumn(
        "_original", light_orig_elements(F.col("metadata.orig_elements"))
    )
    own = [F.col("element_id"), F.col("type")]
    if flatten:
        fields = [
            f.name for f in elements.schema["metadata"].dataType.fields
            if f.name != "orig_elements"
        ]
        body = F.struct(
            *own,
            *[metadata[f].alias(f) for f in fields],
            F.col("_original").alias("original_elements"),
        )
    else:
        body = F.struct(
            *own,
            metadata.dropFields("orig_elements")
            .withField("original_elements", F.col("_original"))
            .alias("metadata"),
        )
    has_vector = F.coalesce(F.size("embeddings") > 0, F.lit(False))
    if generate_embeddings:
        wrong = F.raise_error(F.lit("elements have vectors and the store is to make vectors"))
        vector = F.when(has_vector, wrong.cast("string")).otherwise(text).alias("$vectorize")
    else:
        wrong = F.raise_error(F.lit("elements have no vectors and the store is not to make any"))
        vector = (
            F.when(has_vector, F.col("embeddings")).otherwise(wrong.cast("array<float>"))
        ).alias("$vector")
    out = [text.alias("content"), F.col("record_id"), body.alias("metadata"), vector]
    if lexical:
        out.append(text.alias("$lexical"))
    return rows.select(*out)


def stage_couchbase(elements: DataFrame) -> DataFrame:
    """Key-value rows: element id and its document."""
    return elements.select(
        F.col("element_id").alias("key"),
        F.struct(
            F.col("embeddings").alias("embedding"),
            F.col("text"),
            F.col("metadata"),
            F.col("type"),
        ).alias("value"),
    )


def stage_document_parts(elements: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One document per record with its parts in order.

    A record's document has one id. It comes in rows of at most ``part_rows`` elements, numbered by
    ``part``, so no row grows with the record; a writer sends those of an id one after the other.
    """
    metadata = F.struct(
        F.col("metadata.page_number").alias(PART_METADATA["page_number"]),
        F.col("metadata.data_source.url").alias(PART_METADATA["data_source-url"]),
        F.col("metadata.filename").alias(PART_METADATA["filename"]),
        F.col("metadata.filetype").alias(PART_METADATA["filetype"]),
        F.col("metadata.last_modified").alias(PART_METADATA["last_modified"]),
        F.col("element_id").alias(PART_METADATA["element_id"]),
    )
    part = F.struct(F.col("pos"), F.col("text"), metadata.alias("metadata"))
    return (
        elements.withColumn("part", part_of(F.col("pos"), part_rows))
        .groupBy("record_id", "part")
        .agg(F.array_sort(F.collect_list(part)).alias("document_parts"))
        .select(
            F.sha2("record_id", 256).alias("id"),
            F.lit("core").alias("type"),
            F.struct(F.col("record_id").alias("title")).alias("metadata"),
            "part",
            F.transform(
                "document_parts",
                lambda p: F.struct(p["text"].alias("text"), p["metadata"].alias("metadata")),
            ).alias("document_parts"),
        )
    )


def stage_mongo(elements: DataFrame) -> DataFrame:
    return elements.select(*_data_columns(elements), "record_id")


def element_json(elements: DataFrame) -> Column:
    """The element as one JSON object, the value of a message or a key-value store."""
    rest = [c for c in _data_columns(elements) if c != "metadata"]
    return F.to_json(F.struct(*rest, F.col("metadata")))


def stage_key_value(elements: DataFrame, prefix: str = "") -> DataFrame:
    """Key ``prefix + element_id`` and the element as JSON."""
    return elements.select(
        F.concat(F.lit(prefix), F.col("element_id")).alias("key"),
        element_json(elements).alias("value"),
    )


def stage_typed_values(
    rows: DataFrame, vectors: Sequence[str] = ("embeddings",), variants: Sequence[str] = ()
) -> DataFrame:
    """Lists and objects to JSON text, then parsed to vector, list or variant values."""
    out = []
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in vectors:
            text = F.to_json(column)
            column = F.from_json(text, "array<float>")
        elif field.name in variants:
            nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
            column = F.try_parse_json(F.to_json(column) if nested else column)
        out.append(column.alias(field.name))
    return rows.select(*out)


def bind_values(rows: DataFrame) -> DataFrame:
    """Statement parameters: lists and objects as JSON, dates as timestamps, NaN as null."""
    out = []
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column)
        elif field.name in DATE_COLUMNS:
            is_text = isinstance(field.dataType, T.StringType)
            column = epoch_to_timestamp(parse_date_lenient(column) if is_text else column)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        out.append(column.alias(field.name))
    return rows.select(*out)


def custom_stage(elements: DataFrame, stager, **options) -> DataFrame:
    """A user stager: a function, or ``module:attribute`` naming one, from rows to rows."""
    if isinstance(stager, str):
        from importlib import import_module

        module, _, attribute = stager.partition(":")
        stager = getattr(import_module(module), attribute)
    return elements.transform(lambda df: stager(df, **options))


def conform_elements(
    elements: DataFrame,
    conform: Callable[[dict], dict],
    schema: T.StructType | str,
    should_include: Callable[[dict], bool] | None = None,
) -> DataFrame:
    """Per-element Python hooks, Arrow batched: filter first, then map one dict to one dict."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pylist()
            kept = rows if should_include is None else [r for r in rows if should_include(r)]
            yield pa.RecordBatch.from_pylist([conform(r) for r in kept], schema=arrow)

    return elements.mapInArrow(run, schema)


ELEMENT_TABLE = schemas.VARIANT_TABLE
