"""Canonical table schemas. Every operator names its columns after these."""

from __future__ import annotations

from pyspark.sql import types as T

PERMISSIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("users", T.ArrayType(T.StringType())),
            T.StructField("groups", T.ArrayType(T.StringType())),
        ]
    )
)

LOCATOR = T.MapType(T.StringType(), T.StringType())

DOC_INDEX = T.StructType(
    [
        T.StructField("identifier", T.StringType()),
        T.StructField("connector_type", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("fullpath", T.StringType()),
        T.StructField("rel_path", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("record_locator", LOCATOR),
        T.StructField("date_created", T.StringType()),
        T.StructField("date_modified", T.StringType()),
        T.StructField("date_processed", T.StringType()),
        T.StructField("permissions_data", PERMISSIONS),
        T.StructField("permissions_version", T.StringType()),
        T.StructField("filesize_bytes", T.LongType()),
        T.StructField("additional_metadata", T.StringType()),
        T.StructField("reprocess", T.BooleanType()),
        T.StructField("display_name", T.StringType()),
        T.StructField(
            "batch_items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("identifier", T.StringType()),
                        T.StructField("version", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

CONTENT = T.StructType(
    [
        T.StructField("identifier", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("media", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("body_bytes", T.BinaryType()),
    ]
)

DATA_SOURCE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("record_locator", LOCATOR),
        T.StructField("date_created", T.StringType()),
        T.StructField("date_modified", T.StringType()),
        T.StructField("date_processed", T.StringType()),
        T.StructField("permissions_data", PERMISSIONS),
        T.StructField("filesize_bytes", T.LongType()),
    ]
)

COORDINATES = T.StructType(
    [
        T.StructField("points", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("system", T.StringType()),
        T.StructField("layout_width", T.DoubleType()),
        T.StructField("layout_height", T.DoubleType()),
    ]
)

LINKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("text", T.StringType()),
            T.StructField("url", T.StringType()),
            T.StructField("start_index", T.IntegerType()),
        ]
    )
)

METADATA = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("filetype", T.StringType()),
        T.StructField("file_directory", T.StringType()),
        T.StructField("page_number", T.LongType()),
        T.StructField("page_name", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("category_depth", T.LongType()),
        T.StructField("languages", T.ArrayType(T.StringType())),
        T.StructField("last_modified", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("link_urls", T.ArrayType(T.StringType())),
        T.StructField("link_texts", T.ArrayType(T.StringType())),
        T.StructField("links", LINKS),
        T.StructField("sent_from", T.ArrayType(T.StringType())),
        T.StructField("sent_to", T.ArrayType(T.StringType())),
        T.StructField("subject", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("text_as_html", T.StringType()),
        T.StructField("emphasized_text_contents", T.ArrayType(T.StringType())),
        T.StructField("emphasized_text_tags", T.ArrayType(T.StringType())),
        T.StructField("is_continuation", T.BooleanType()),
        T.StructField("detection_class_prob", T.DoubleType()),
        T.StructField("orig_elements", T.StringType()),
        T.StructField("entities", T.StringType()),
        T.StructField("coordinates", COORDINATES),
        T.StructField("data_source", DATA_SOURCE),
    ]
)

ELEMENTS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("element_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("metadata", METADATA),
        T.StructField("embeddings", T.ArrayType(T.FloatType())),
    ]
)

ERRORS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# Element-table template used when a destination table has to be created (metadata kept whole).
VARIANT_TABLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("element_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("embeddings", T.ArrayType(T.FloatType())),
        T.StructField("type", T.StringType()),
        T.StructField("metadata", T.StringType()),
    ]
)
