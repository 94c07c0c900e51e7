"""Identity, date, string and JSON functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import dates, ids, mask, paths, text
from sluice.functions.flatten import flat_columns, flat_row_entries, flat_values_text
from sluice.functions.flatten import variant_entries
from sluice.functions.permissions import acl_digest
from sluice.operators import orig_elements
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.registry import query
from sluice.plans.roles import table


@query(
    "uuid5_dns",
    o.with_(o.DOCS, f"SELECT doc_id, {o.uuid5('fullpath')} AS id, {o.uuid5('body')} AS body_id "
            "FROM docs"),
)
def uuid5_dns(spark, sf):
    docs = roles.documents(spark, sf)
    return docs.select(
        "doc_id",
        ids.uuid5_dns(F.col("fullpath")).alias("id"),
        ids.uuid5_dns(F.col("body")).alias("body_id"),
    )


@query(
    "enhanced_element_id",
    o.with_(
        o.LINES,
        "SELECT record_id, pos, "
        + o.uuid5("(CASE WHEN pos % 9 = 4 THEN 'None' ELSE element_id END || record_id)")
        + " AS id FROM parts",
    ),
)
def enhanced_element_id(spark, sf):
    rows = roles.parts(spark, sf)
    element = F.when(F.col("pos") % 9 != 4, F.col("element_id"))
    return rows.select(
        "record_id", "pos", ids.enhanced_element_id(element, F.col("record_id")).alias("id")
    )


@query(
    "element_hash",
    o.with_(
        o.LINES,
        "SELECT record_id, pos, substr(sha256(coalesce(CASE WHEN pos % 4 > 0 THEN filename END, "
        "'None') || text || coalesce((CASE WHEN pos % 5 > 0 THEN page_number END)::varchar, 'None')"
        " || pos), 1, 32) AS id FROM parts",
    ),
)
def element_hash(spark, sf):
    pos = F.col("pos")
    return roles.parts(spark, sf).select(
        "record_id",
        "pos",
        ids.element_hash(
            F.when(pos % 4 > 0, F.col("metadata.filename")),
            F.col("text"),
            F.when(pos % 5 > 0, F.col("metadata.page_number")),
            pos,
        ).alias("id"),
    )


@query(
    "config_hash",
    "SELECT c_custkey, '"
    + ids.config_hash({"max_characters": 500, "strategy": "basic"}, "chunk")
    + "' AS config_hash, 'customer-' || c_custkey || '-"
    + ids.config_hash({"max_characters": 500, "strategy": "basic"}, "chunk")
    + "' AS lineage FROM customer",
)
def config_hash(spark, sf):
    key = ids.config_hash({"strategy": "basic", "max_characters": 500}, "chunk")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.lit(key).alias("config_hash"),
        F.concat_ws("-", F.lit("customer"), F.col("c_custkey"), F.lit(key)).alias("lineage"),
    )


@query(
    "record_identifier",
    "SELECT c_custkey, 'cars-' || c_custkey AS whole, "
    "'cars-' || c_custkey || '-' || substr(sha256('car_id,brand'), 1, 8) AS projected "
    "FROM customer",
)
def record_identifier(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        ids.record_identifier("cars", key).alias("whole"),
        ids.record_identifier("cars", key, ["car_id", "brand"]).alias("projected"),
    )


@query(
    "sha256_id",
    "SELECT event_id, sha256(event_type || '-' || user_id) AS id, "
    "substr(sha256(props), 1, 16) AS short_id FROM events",
)
def sha256_id(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        ids.sha256_id(F.col("event_type"), F.col("user_id").cast("string")).alias("id"),
        ids.sha256_16(F.col("props")).alias("short_id"),
    )


@query(
    "pinecone_id",
    o.with_(
        o.LINES,
        f"SELECT record_id || '#' || {o.uuid5('(element_id || record_id)')} AS id FROM parts",
    ),
)
def pinecone_id(spark, sf):
    rows = roles.parts(spark, sf)
    row_id = ids.enhanced_element_id(F.col("element_id"), F.col("record_id"))
    return rows.select(ids.prefixed_id(F.col("record_id"), row_id).alias("id"))


@query(
    "acl_digest",
    """
    SELECT o_orderkey, sha256('{"denied":[],"permissions":[' ||
      '{"delete":{"groups":[],"users":["' || least('u' || o_custkey % 50, 'v' || o_orderkey % 7) ||
      '","' || greatest('u' || o_custkey % 50, 'v' || o_orderkey % 7) || '"]}},' ||
      '{"read":{"groups":["' || o_orderpriority || '"],"users":[]}}]}') AS digest,
      sha256('{"denied":[],"permissions":[]}') AS empty_digest
    FROM orders
    """,
)
def acl_digest_query(spark, sf):
    users = F.array(
        F.concat(F.lit("v"), (F.col("o_orderkey") % 7).cast("string")),
        F.concat(F.lit("u"), (F.col("o_custkey") % 50).cast("string")),
    )
    none = F.array().cast("array<string>")
    permissions = F.array(
        F.struct(
            F.lit("read").alias("op"),
            none.alias("users"),
            F.array("o_orderpriority").alias("groups"),
        ),
        F.struct(F.lit("delete").alias("op"), users.alias("users"), none.alias("groups")),
    )
    empty = F.filter(permissions, lambda p: F.lit(False))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        acl_digest(permissions).alias("digest"),
        acl_digest(empty).alias("empty_digest"),
    )


_STAMP_CASES = """
stamps AS (
  SELECT event_id, (1704067200 + event_id * 997)::bigint AS e, event_id % 9 AS kind FROM events
),
texts AS (
  SELECT event_id, e, kind, CASE kind
    WHEN 0 THEN e::varchar
    WHEN 1 THEN e || '.5'
    WHEN 2 THEN strftime(make_timestamp(e * 1000000), '%Y-%m-%dT%H:%M:%S') || 'Z'
    WHEN 3 THEN strftime(make_timestamp((e - 18000) * 1000000), '%Y-%m-%dT%H:%M:%S') || '-05:00'
    WHEN 4 THEN strftime(make_timestamp(e * 1000000), '%Y-%m-%d %H:%M:%S') || '.250'
    WHEN 5 THEN strftime(make_timestamp(e * 1000000), '%Y-%m-%d')
    WHEN 6 THEN 'Monday'
    WHEN 7 THEN 'inf'
    ELSE '' END AS value
  FROM stamps
)"""
_STAMP_VALUE = """CASE kind WHEN 0 THEN e::double WHEN 1 THEN e + 0.5::double WHEN 2 THEN e::double
    WHEN 3 THEN e::double WHEN 4 THEN e + 0.25::double WHEN 5 THEN (e - e % 86400)::double END"""


def _stamps(spark, sf):
    e = F.lit(1704067200).cast("long") + F.col("event_id") * 997
    kind = F.col("event_id") % 9

    def iso(epoch):
        return F.substring(dates.format_rfc3339(epoch), 1, 19)

    value = (
        F.when(kind == 0, e.cast("string"))
        .when(kind == 1, F.concat(e.cast("string"), F.lit(".5")))
        .when(kind == 2, F.concat(iso(e), F.lit("Z")))
        .when(kind == 3, F.concat(iso(e - 18000), F.lit("-05:00")))
        .when(kind == 4, F.concat(F.replace(iso(e), F.lit("T"), F.lit(" ")), F.lit(".250")))
        .when(kind == 5, F.substring(iso(e), 1, 10))
        .when(kind == 6, F.lit("Monday"))
        .when(kind == 7, F.lit("inf"))
        .otherwise(F.lit(""))
    )
    return table(spark, sf, "events").select("event_id", e.alias("e"), value.alias("value"))


@query("parse_timestamp",
       o.with_(_STAMP_CASES, f"SELECT event_id, value, {_STAMP_VALUE} AS epoch FROM texts"))
def parse_timestamp(spark, sf):
    rows = _stamps(spark, sf)
    return rows.select("event_id", "value", dates.parse_timestamp(F.col("value")).alias("epoch"))


@query(
    "parse_date_lenient",
    o.with_(
        _STAMP_CASES,
        f"SELECT event_id, {_STAMP_VALUE} AS epoch, e::double AS written, "
        "e / 1000.0::double AS millis FROM texts",
    ),
)
def parse_date_lenient(spark, sf):
    rows = _stamps(spark, sf)
    moment = dates.format_rfc3339(F.col("e"))
    day = F.date_format(F.substring(moment, 1, 10).cast("date"), "EEE, d MMM yyyy ")
    written = F.concat(day, F.substring(moment, 12, 8))
    return rows.select(
        "event_id",
        dates.parse_date_lenient(F.col("value")).alias("epoch"),
        dates.parse_date_lenient(F.concat(written, F.lit(" +0000"))).alias("written"),
        dates.parse_date_millis(F.col("e")).alias("millis"),
    )


@query(
    "iso_to_epoch_string",
    o.with_(
        _STAMP_CASES,
        "SELECT event_id, CASE WHEN kind IN (2, 3) THEN e || '.0' WHEN kind = 4 THEN e || '.25' "
        "WHEN kind = 5 THEN (e - e % 86400) || '.0' END AS epoch_text FROM texts",
    ),
)
def iso_to_epoch_string(spark, sf):
    rows = _stamps(spark, sf)
    iso = F.when(F.col("value").contains("-"), F.col("value"))
    return rows.select("event_id", dates.iso_to_epoch_string(iso).alias("epoch_text"))


@query(
    "format_rfc3339",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS text FROM events",
)
def format_rfc3339(spark, sf):
    rows = table(spark, sf, "events")
    epoch = F.unix_micros(roles.utc("ts")).cast("double") / 1000000
    return rows.select("event_id", dates.format_rfc3339(epoch).alias("text"))


@query(
    "ensure_isoformat",
    o.with_(
        _STAMP_CASES,
        "SELECT event_id, CASE WHEN kind = 4 THEN strftime(make_timestamp(e * 1000000), "
        "'%Y-%m-%dT%H:%M:%S') || '.250000' WHEN kind = 1 THEN strftime(make_timestamp(e * 1000000), "
        "'%Y-%m-%dT%H:%M:%S') || '.500000' WHEN kind = 5 THEN "
        "strftime(make_timestamp((e - e % 86400) * 1000000), '%Y-%m-%dT%H:%M:%S') "
        "WHEN kind < 5 THEN strftime(make_timestamp(e * 1000000), '%Y-%m-%dT%H:%M:%S') END AS iso "
        "FROM texts",
    ),
)
def ensure_isoformat(spark, sf):
    iso = dates.ensure_isoformat(F.col("value"), strict=False)
    return _stamps(spark, sf).select("event_id", iso.alias("iso"))


@query(
    "validate_date_args",
    o.with_(
        _STAMP_CASES,
        "SELECT event_id, kind IN (2, 3, 5) AS is_valid, true AS plus_form, false AS bad_month "
        "FROM texts",
    ),
)
def validate_date_args(spark, sf):
    rows = _stamps(spark, sf)
    day = F.substring(dates.format_rfc3339(F.col("e")), 1, 10)
    return rows.select(
        "event_id",
        dates.is_date_argument(F.col("value")).alias("is_valid"),
        dates.is_date_argument(F.concat(day, F.lit("+07:08:09"))).alias("plus_form"),
        dates.is_date_argument(F.regexp_replace(day, "-[0-9]{2}-", "-13-")).alias("bad_month"),
    )


@query(
    "truncate_utf8_bytes",
    o.with_(
        o.DOCS
        + """,
cut AS (
  SELECT doc_id, body, strlen(body) AS n, hex(encode(body)[1:101]) AS head FROM docs
)""",
        "SELECT doc_id, CASE WHEN n <= 101 THEN body ELSE decode(unhex(regexp_replace(head, "
        "'(?:[CDEF][0-9A-F]|[EF][0-9A-F][89AB][0-9A-F]|F[0-9A-F][89AB][0-9A-F][89AB][0-9A-F])$', "
        "''))) END AS head FROM cut",
    ),
)
def truncate_utf8_bytes(spark, sf):
    return roles.documents(spark, sf).select(
        "doc_id", text.truncate_utf8_bytes(F.col("body"), 101).alias("head")
    )


@query(
    "fix_unescaped_unicode",
    o.with_(
        o.DOCS,
        "SELECT doc_id, 'caf' || chr(233) || ' ' || body AS fixed, body AS untouched FROM docs",
    ),
)
def fix_unescaped_unicode(spark, sf):
    docs = roles.documents(spark, sf)
    escaped = F.concat(F.lit(r"café "), F.col("body"))
    return docs.select(
        "doc_id",
        text.fix_unescaped_unicode(escaped).alias("fixed"),
        text.fix_unescaped_unicode(F.col("body")).alias("untouched"),
    )


@query(
    "json_or_text",
    """
    SELECT event_id, '{"k":' || (props->>'$.k') || '}' AS parsed,
      '{"k":' || (props->>'$.k') || '}' AS single_quoted, event_type AS plain FROM events
    """,
)
def json_or_text(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        text.json_or_text(F.col("props")).alias("parsed"),
        text.json_or_text(F.replace("props", F.lit('"'), F.lit("'"))).alias("single_quoted"),
        text.json_or_text(F.col("event_type")).alias("plain"),
    )


@query("vector_to_csv", o.with_(o.ELEMENTS, "SELECT id, vector_csv AS csv FROM elements"))
def vector_to_csv(spark, sf):
    rows = roles.elements(spark, sf)
    row_id = ids.enhanced_element_id(F.col("element_id"), F.col("record_id"))
    return rows.select(row_id.alias("id"), text.vector_to_csv(F.col("embeddings")).alias("csv"))


@query(
    "sanitize_name",
    o.with_(
        o.DOCS,
        "SELECT doc_id, regexp_replace(regexp_replace(fullpath, '[/\\\\]+', '_', 'g'), "
        "'^\\s+|\\s+$', '', 'g') AS name, 'slack-file' AS fallback FROM docs",
    ),
)
def sanitize_name(spark, sf):
    docs = roles.documents(spark, sf)
    return docs.select(
        "doc_id",
        text.sanitize_name(F.col("fullpath"), "slack-file").alias("name"),
        text.sanitize_name(F.repeat(F.lit(" "), (F.col("doc_id") % 3).cast("int")), "slack-file")
        .alias("fallback"),
    )


@query(
    "prompt_normalize",
    "SELECT doc_id, replace(text, chr(10), ' ') AS prompt FROM documents",
)
def prompt_normalize(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.prompt_normalize(F.col("text")).alias("prompt")
    )


@query(
    "mask_columns",
    o.with_(
        o.DOCS,
        """SELECT left(identifier, 4) || '...' || right(identifier, 4) AS identifier,
          doc_id, 's3:' || '//co...' || right(fullpath, 4) AS fullpath_location,
          '.../' || lang || '/' || filename AS rel_path,
          'https://x.example/' || doc_id AS url_location,
          left(version, 4) || '...' || right(version, 4) AS api_token,
          left('k' || doc_id % 10, 1) || '...' AS short_key, lang
        FROM docs""",
    ),
)
def mask_columns(spark, sf):
    docs = roles.documents(spark, sf)
    return mask.mask_columns(
        docs.select(
            "identifier",
            "doc_id",
            F.col("fullpath").alias("fullpath_location"),
            "rel_path",
            F.concat(
                F.lit("https://x.example/"), F.col("doc_id").cast("string"), F.lit("?q=1#f")
            ).alias("url_location"),
            F.col("version").alias("api_token"),
            F.concat(F.lit("k"), (F.col("doc_id") % 10).cast("string")).alias("short_key"),
            "lang",
        )
    )


@query(
    "absolute_url",
    r"""
    SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS base,
      regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/a/' || page_id AS below,
      regexp_extract(url, '^([a-z]+):', 1) || '://cdn.example.com/x' AS same_scheme,
      'http://other.example/' || page_id AS other
    FROM pages
    """,
)
def absolute_url(spark, sf):
    page = F.col("page_id").cast("string")
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        paths.base_url(url).alias("base"),
        paths.absolute_url(F.concat(F.lit("//a/"), page).substr(2, 99), url).alias("below"),
        paths.absolute_url(F.lit("//cdn.example.com/x"), url).alias("same_scheme"),
        paths.absolute_url(F.concat(F.lit("http://other.example/"), page), url).alias("other"),
    )


@query(
    "rel_path",
    o.with_(
        o.DOCS,
        "SELECT identifier, rel_path, filename, doc_id::varchar AS stem, '.txt' AS suffix, "
        "'s3://corpus/' || source || '/' || lang AS parent FROM docs",
    ),
)
def rel_path(spark, sf):
    path = F.col("fullpath")
    return roles.documents(spark, sf).select(
        "identifier",
        paths.rel_path(path, roles.ROOT).alias("rel_path"),
        paths.file_name(path).alias("filename"),
        paths.file_stem(path).alias("stem"),
        paths.file_suffix(path).alias("suffix"),
        paths.parent_dir(path).alias("parent"),
    )


@query(
    "to_plain_json",
    "SELECT c_custkey, '{\"c_custkey\":' || c_custkey || ',\"c_name\":' || "
    + o.js("c_name")
    + " || ',\"c_mktsegment\":' || "
    + o.js("c_mktsegment")
    + " || '}' AS json FROM customer",
)
def to_plain_json(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.to_json(F.struct("c_custkey", "c_name", "c_mktsegment")).alias("json")
    )


@query(
    "flatten_json",
    o.with_(
        o.ELEMENTS,
        """SELECT id, filename AS metadata_filename, page_number AS metadata_page_number,
          system AS metadata_coordinates_system, layout_height AS metadata_coordinates_layout_height,
          version AS metadata_data_source_version, locator_json AS metadata_data_source_record_locator
        FROM elements""",
    ),
)
def flatten_json(spark, sf):
    rows = roles.elements(spark, sf)
    flat = dict(
        flat_columns(
            rows.select("metadata").schema, None, "_", ["metadata_data_source_record_locator"]
        )
    )
    wanted = [
        "metadata_filename",
        "metadata_page_number",
        "metadata_coordinates_system",
        "metadata_coordinates_layout_height",
        "metadata_data_source_version",
    ]
    row_id = ids.enhanced_element_id(F.col("element_id"), F.col("record_id"))
    locator = "metadata_data_source_record_locator"
    return rows.select(
        row_id.alias("id"),
        *[flat[n].alias(n) for n in wanted],
        F.to_json(flat[locator]).alias(locator),
    )


@query(
    "flatten_json_dynamic",
    """
    SELECT event_id, 'k' AS path, props->>'$.k' AS value FROM events
    UNION ALL SELECT event_id, 'who_id', user_id::varchar FROM events
    UNION ALL SELECT event_id, 'who_kind_name', event_type FROM events
    """,
)
def flatten_json_dynamic(spark, sf):
    events = table(spark, sf, "events")
    nested = F.concat(
        F.regexp_replace("props", r"\}$", ""),
        F.lit(',"who":{"id":'),
        F.col("user_id").cast("string"),
        F.lit(',"kind":{"name":"'),
        F.col("event_type"),
        F.lit('"}}}'),
    )
    rows = events.select("event_id", F.parse_json(nested).alias("v"))
    return variant_entries(rows, "v")


@query(
    "flat_values_text",
    "SELECT o_orderkey, o_orderkey || chr(10) || o_orderstatus || chr(10) || o_orderpriority || "
    "chr(10) || 'None' AS text FROM orders",
)
def flat_values_text_query(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.struct("o_orderstatus", F.struct("o_orderpriority").alias("p")).alias("s"),
        F.lit(None).cast("string").alias("missing"),
    )
    entries = flat_row_entries(orders.schema, orders.columns, "_")
    return orders.select("o_orderkey", flat_values_text(entries).alias("text"))


@query(
    "json_stringify_fields",
    o.with_(o.ELEMENTS, "SELECT id, locator_json, '[\"' || lang || '\"]' AS languages_json, "
            "links_json FROM elements"),
)
def json_stringify_fields(spark, sf):
    rows = roles.elements(spark, sf)
    row_id = ids.enhanced_element_id(F.col("element_id"), F.col("record_id"))
    return rows.select(
        row_id.alias("id"),
        F.to_json("metadata.data_source.record_locator").alias("locator_json"),
        F.to_json("metadata.languages").alias("languages_json"),
        F.to_json("metadata.links").alias("links_json"),
    )


@query(
    "orig_elements_decode",
    o.with_(
        o.LINES,
        """SELECT record_id, pos, '[{"metadata":{"page":' || page_number || '}}]' AS light,
          '[{"text":' || """
        + o.js("text")
        + """ || ',"metadata":{"page":' || page_number || ',"text_as_html":"<p>"}}]' AS whole
        FROM parts""",
    ),
)
def orig_elements_decode(spark, sf):
    rows = roles.parts(spark, sf)
    original = F.struct(
        F.col("text"),
        F.struct(
            F.col("metadata.page_number").alias("page"), F.lit("<p>").alias("text_as_html")
        ).alias("metadata"),
    )
    packed = orig_elements.encode_orig_elements(F.to_json(F.array(original)))
    rows = rows.select("record_id", "pos", packed.alias("packed"))
    return rows.select(
        "record_id",
        "pos",
        orig_elements.light_orig_elements(F.col("packed")).alias("light"),
        orig_elements.decode_orig_elements(F.col("packed")).alias("whole"),
    )


@query(
    "url_allow_list",
    r"""
    SELECT page_id, true AS own, false AS foreign_site,
      starts_with(url, 'https://m.') OR starts_with(url, 'http://blog.') AS listed
    FROM pages
    """,
)
def url_allow_list(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        paths.url_allowed(F.concat(paths.base_url(url), F.lit("/x.pdf")), url).alias("own"),
        paths.url_allowed(F.lit("ftp://nowhere/x"), url).alias("foreign_site"),
        paths.url_allowed(url, url, ["https://m.", "http://blog."]).alias("listed"),
    )


@query(
    "path_parts",
    r"""
    SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
      regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$') AS name,
      regexp_extract(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', ''),
        '[^/.][^/]*(\.[^./]+)$', 1) AS suffix
    FROM pages
    """,
)
def path_parts(spark, sf):
    path = paths.url_path(F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id",
        path.alias("path"),
        paths.file_name(path).alias("name"),
        paths.file_suffix(path).alias("suffix"),
    )


@query(
    "sha256_16",
    "SELECT c_custkey, substr(sha256(c_name), 1, 16) || '.eml' AS filename FROM customer",
)
def sha256_16(spark, sf):
    name = F.concat(ids.sha256_16(F.col("c_name")), F.lit(".eml"))
    return table(spark, sf, "customer").select("c_custkey", name.alias("filename"))


@query(
    "is_unit_vector",
    """
    WITH norms AS (
      SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) AS n
      FROM embeddings
    )
    SELECT vec_id, abs(n - 1) <= 1e-3 AS is_unit, abs(n * 1.5 - 1) <= 1e-3 AS longer_is_unit
    FROM norms
    """,
)
def is_unit_vector(spark, sf):
    from sluice.operators.embed import is_unit_vector as is_unit

    vector = F.col("embedding")
    longer = F.transform(vector, lambda x: x.cast("double") * 1.5)
    return table(spark, sf, "embeddings").select(
        "vec_id", is_unit(vector).alias("is_unit"), is_unit(longer).alias("longer_is_unit")
    )
