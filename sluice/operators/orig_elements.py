"""The compressed form of a chunk's original elements: JSON, deflated, base64."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: large fields that are not repeated with a chunk.
HEAVY_FIELDS = [
    "image_base64", "text_as_html", "table_as_cells", "link_urls", "link_texts",
    "link_start_indexes", "emphasized_text_contents",
]


@F.pandas_udf(T.StringType())
def _inflate(values: pd.Series) -> pd.Series:
    import base64
    import zlib

    def one(text):
        try:
            return zlib.decompress(base64.b64decode(text)).decode("utf-8")
        except (ValueError, zlib.error):
            return None

    return values.map(one, na_action="ignore")


@F.pandas_udf(T.StringType())
def _deflate(values: pd.Series) -> pd.Series:
    import base64
    import zlib

    return values.map(
        lambda text: base64.b64encode(zlib.compress(text.encode("utf-8"))).decode("ascii"),
        na_action="ignore",
    )


@F.pandas_udf(T.StringType())
def _lighten(values: pd.Series) -> pd.Series:
    import json

    def one(text):
        try:
            items = json.loads(text)
        except ValueError:
            return None
        for item in items:
            item.pop("text", None)
            for name in HEAVY_FIELDS:
                (item.get("metadata") or {}).pop(name, None)
        return json.dumps(items, ensure_ascii=False, separators=(",", ":"))

    return values.map(one, na_action="ignore")


def decode_orig_elements(packed: Column) -> Column:
    """JSON array text; null when the value does not decode."""
    return _inflate(packed)


def encode_orig_elements(json_text: Column) -> Column:
    return _deflate(json_text)


def light_orig_elements(packed: Column) -> Column:
    """Decoded original elements without text and without large metadata, as JSON text."""
    return _lighten(_inflate(packed))


def pack_orig_elements(chunks: DataFrame) -> DataFrame:
    """Fill ``metadata.orig_elements`` from the native ``orig`` array of chunks."""
    packed = encode_orig_elements(F.to_json("orig"))
    return chunks.withColumn("metadata", F.col("metadata").withField("orig_elements", packed))
