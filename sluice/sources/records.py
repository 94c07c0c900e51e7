"""Records of databases and stores to documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.dates import format_rfc3339
from sluice.functions.flatten import flat_row_entries, flat_values_text
from sluice.functions.ids import record_identifier, uuid5_dns
from sluice.functions.text import csv_line, plain_text
from sluice.operators.batching import batch_rows
from sluice.sources.listings import doc_index
from sluice.sources.parts import PART_ROWS, assembled, part_texts, placed_rows

SQL_BATCH = 100
DOCUMENT_STORE_BATCH = 20


def index_batches(
    table: DataFrame, table_name: str, id_column: str, batch_size: int = SQL_BATCH
) -> DataFrame:
    """One index row per batch of sorted ids. Only the id column is read."""
    batches = batch_rows(table.select(id_column), id_column, batch_size)
    name = F.concat(
        F.lit(f"{table_name}-{id_column}-["),
        F.col("first_id"),
        F.lit(".."),
        F.col("last_id"),
        F.lit("]"),
    )
    index = doc_index(
        batches,
        keep=("batch_no", "n_items"),
        identifier=F.col("identifier"),
        connector_type=F.lit("sql"),
        batch_items=F.col("batch_items"),
        display_name=name,
        additional_metadata=F.to_json(
            F.struct(F.lit(table_name).alias("table_name"), F.lit(id_column).alias("id_column"))
        ),
    )
    return index


def resolve_column(columns: Sequence[str], name: str) -> str:
    """The column as written, else the one that differs only in case."""
    if name in columns:
        return name
    return {c.lower(): c for c in columns}.get(name.lower(), name)


def fetch_records(
    table: DataFrame, batches: DataFrame, id_column: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """Records of the given batches; a projection always starts with the id.

    Ids go back to the column's own type, so the range they span is filtered in the scan; the ids
    themselves become a semi join, which Spark ships as it likes. Ids of types whose text does not
    read back exactly (floats, binaries) are compared as text and scan the whole table.
    """
    id_name = resolve_column(table.columns, id_column)
    names = list(dict.fromkeys([id_name, *fields])) if fields else table.columns
    wanted = batches.select(F.explode("batch_items.identifier").alias("_id")).distinct()
    rows = table.select(*names)
    kind = table.schema[id_name].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType, T.DateType, T.DecimalType)):
        rows = rows.withColumn("_id", F.col(id_name).cast("string"))
        return rows.join(wanted, "_id", "left_semi").drop("_id")
    native = wanted.select(F.col("_id").try_cast(kind).alias("_id"))
    low, high = native.agg(F.min("_id"), F.max("_id")).first()
    within = F.col(f"`{id_name}`").between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return rows.filter(within).join(native, rows[id_name] == native["_id"], "left_semi")


def rows_to_documents(
    rows: DataFrame, table_name: str, id_column: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """One CSV document per row: header line and value line."""
    id_name = resolve_column(rows.columns, id_column)
    identifier = record_identifier(table_name, F.col(id_name), fields)
    header = csv_line(*[F.lit(c) for c in rows.columns])
    values = csv_line(*[_csv_value(rows, c) for c in rows.columns])
    filename = F.concat(identifier, F.lit(".csv"))
    return doc_index(
        rows.withColumn("body", F.concat(header, F.lit("\n"), values, F.lit("\n"))),
        keep=("body",),
        identifier=identifier,
        connector_type=F.lit("sql"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
    )


def _csv_value(rows: DataFrame, name: str) -> Column:
    dtype = rows.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return F.regexp_replace(
            F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"( 00:00:00)?\.000000$", ""
        )
    return plain_text(F.col(name), dtype)


def object_id_time(hex_id: Column) -> Column:
    """Creation time inside a 24-digit object id, ISO text with zone."""
    seconds = F.conv(F.substring(hex_id, 1, 8), 16, 10).cast("double")
    return F.concat(F.substring(format_rfc3339(seconds), 1, 19), F.lit("+00:00"))


def mongo_documents(records: DataFrame, collection: str, id_column: str = "_id") -> DataFrame:
    """Newline-joined flattened values; the date comes from a field or from the object id."""
    names = [c for c in records.columns if c != id_column]
    body = flat_values_text(flat_row_entries(records.schema, names, "_"))
    identifier = F.col(id_column).cast("string")
    from_id = F.when(identifier.rlike("^[0-9a-f]{24}$"), object_id_time(identifier))
    created = from_id
    if "date_created" in names:
        given = F.col("date_created")
        if isinstance(records.schema["date_created"].dataType, T.TimestampType):
            given = F.date_format(given, "yyyy-MM-dd'T'HH:mm:ss")
        created = F.coalesce(given.cast("string"), from_id)
    filename = F.concat(identifier, F.lit(".txt"))
    return doc_index(
        records.withColumn("body", body),
        keep=("body",),
        identifier=identifier,
        connector_type=F.lit("mongodb"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        date_created=created,
        record_locator=F.create_map(
            F.lit("collection_name"), F.lit(collection), F.lit("document_id"), identifier
        ),
    )


def search_documents(
    hits: DataFrame, index_name: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """(_id, _version, _source struct): newline-joined flattened source values."""
    source = hits.schema["_source"].dataType
    flat = hits.select("_id", "_version", "_source.*")
    body = flat_values_text(flat_row_entries(source, source.names, "_"))
    identifier = record_identifier(index_name, F.col("_id"), fields)
    filename = F.concat(identifier, F.lit(".txt"))
    return doc_index(
        flat.withColumn("body", body),
        keep=("body",),
        identifier=identifier,
        connector_type=F.lit("elasticsearch"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        version=F.col("_version").cast("string"),
        record_locator=F.create_map(
            F.lit("index_name"), F.lit(index_name), F.lit("document_id"), F.col("_id")
        ),
    )


def bucket_documents(
    records: DataFrame, bucket: str, id_column: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """Key-value bucket: newline-joined flattened values under ``bucket-id``."""
    names = [c for c in records.columns if c != id_column]
    body = flat_values_text(flat_row_entries(records.schema, names, "_"))
    identifier = record_identifier(bucket, F.col(id_column), fields)
    filename = F.concat(identifier, F.lit(".txt"))
    return doc_index(
        records.withColumn("body", body),
        keep=("body",),
        identifier=identifier,
        connector_type=F.lit("couchbase"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        record_locator=F.create_map(F.lit("document_id"), F.col(id_column).cast("string")),
    )


def collection_documents(
    records: DataFrame, id_column: str = "_id", fields: Sequence[str] | None = None
) -> DataFrame:
    """Two CSV lines (keys, values); the identifier is the file name."""
    identifier = record_identifier(None, F.col(id_column), fields)
    filename = F.concat(identifier, F.lit(".csv"))
    keys = csv_line(*[F.lit(c) for c in records.columns])
    values = csv_line(*[_csv_value(records, c) for c in records.columns])
    return doc_index(
        records.withColumn("body", F.concat(keys, F.lit("\r\n"), values, F.lit("\r\n"))),
        keep=("body",),
        identifier=filename,
        connector_type=F.lit("astradb"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        record_locator=F.create_map(F.lit("document_id"), F.col(id_column).cast("string")),
    )


def table_documents(
    rows: DataFrame, table_key: str, base: str, rank: str, part_rows: int = PART_ROWS
) -> DataFrame:
    """One CSV document per table: columns by name, leading row index.

    ``rank`` orders the rows of a table. The document comes in parts; the first has the header.
    """
    names = sorted(c for c in rows.columns if c not in (table_key, rank))
    header = "," + ",".join(names) + "\n"
    line = csv_line(*[_csv_value(rows, c) for c in names])
    lines = rows.select(table_key, rank, line.alias("_line"))
    texts = part_texts(
        placed_rows(lines, [table_key], rank),
        [table_key],
        lambda r: F.concat(r["nth"].cast("string"), F.lit(","), r["_line"], F.lit("\n")),
        columns=["_line"],
        part_rows=part_rows,
    )
    identifier = uuid5_dns(F.concat(F.lit(base), F.col(table_key).cast("string")))
    filename = F.concat(F.col(table_key).cast("string"), F.lit(".csv"))
    return doc_index(
        assembled(texts, [table_key], opening=F.lit(header)),
        keep=("part", "body"),
        identifier=identifier,
        connector_type=F.lit("airtable"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
    )
