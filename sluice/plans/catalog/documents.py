"""Listings, document filters and incremental selection."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from sluice.operators import filters, incremental
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.registry import query
from sluice.plans.roles import table
from sluice.session import checkpoint_dir
from sluice.sources import archives, listings


def _listing(spark, sf):
    """Object listing of the documents; every seventh object is a folder, some are empty."""
    docs = roles.documents(spark, sf)
    epoch = F.lit(1700000000).cast("long") + F.col("doc_id") * 3600
    return docs.select(
        "doc_id",
        "lang",
        F.regexp_replace("fullpath", r"^s3://", "").alias("path"),
        F.when(F.col("doc_id") % 11 == 3, 0)
        .otherwise(F.col("filesize_bytes"))
        .cast("long")
        .alias("size"),
        F.when(F.col("doc_id") % 7 == 2, "directory").otherwise("file").alias("type"),
        epoch.alias("e"),
        "version",
    )


_LISTING = (
    o.DOCS
    + f""",
listing AS (
  SELECT doc_id, lang, substr(fullpath, 6) AS path, version,
    CASE WHEN doc_id % 11 = 3 THEN 0 ELSE filesize_bytes END AS size,
    1700000000 + doc_id * 3600 AS e, doc_id % 7 <> 2 AS is_file,
    {o.uuid5("substr(fullpath, 6)")} AS identifier, rel_path, filename
  FROM docs
),
files AS (SELECT * FROM listing WHERE is_file AND size > 0)"""
)


@query(
    "index_files",
    o.with_(
        _LISTING,
        "SELECT identifier, filename, path AS fullpath, rel_path, size AS filesize_bytes, "
        "path AS original_file_path, 'gs' AS protocol FROM files",
    ),
)
def index_files(spark, sf):
    listing = _listing(spark, sf).select("path", "size", "type")
    index = listings.index_files(listing, "corpus/", "gs")
    return index.select(
        "identifier",
        "filename",
        "fullpath",
        "rel_path",
        "filesize_bytes",
        F.get_json_object("additional_metadata", "$.original_file_path").alias(
            "original_file_path"
        ),
        F.col("record_locator")["protocol"].alias("protocol"),
    )


@query(
    "index_files_flat",
    o.with_(
        _LISTING,
        "SELECT 'corpus/' || filename AS fullpath, filename AS rel_path FROM files "
        "WHERE lang = 'en'",
    ),
)
def index_files_flat(spark, sf):
    rows = _listing(spark, sf)
    # English objects lie directly in the root, all others in folders below it.
    path = F.when(
        F.col("lang") == "en",
        F.concat(F.lit("corpus/"), F.col("doc_id").cast("string"), F.lit(".txt")),
    ).otherwise(F.col("path"))
    listing = rows.select(path.alias("path"), "size", "type")
    index = listings.index_files(listing, "corpus/", recursive=False)
    return index.select("fullpath", "rel_path")


@query(
    "sample_files",
    o.with_(
        o.DOCS,
        "SELECT identifier, fullpath FROM docs ORDER BY sha256('7:' || identifier), identifier "
        "LIMIT 50",
    ),
)
def sample_files(spark, sf):
    index = roles.documents(spark, sf).select("identifier", "fullpath")
    return listings.sample_files(index, 50, seed=7)


@query(
    "hydrate_single_file",
    o.with_(
        _LISTING,
        f"""SELECT {o.uuid5("('corpus/' || filename)")} AS identifier,
          'corpus/' || filename AS fullpath, filename, size AS filesize_bytes FROM files
        WHERE 'corpus/' || filename = 'corpus/5.txt'""",
    ),
)
def hydrate_single_file(spark, sf):
    path = F.concat(F.lit("corpus/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    listing = _listing(spark, sf).select(path.alias("path"), "size", "type")
    index = listings.hydrate_single_file(listing, "corpus/5.txt", "s3")
    return index.select("identifier", "fullpath", "filename", "filesize_bytes")


@query(
    "index_s3_listing",
    o.with_(
        _LISTING,
        "SELECT identifier, 's3://' || path AS url, version, e || '.0' AS date_created, "
        "e || '.0' AS date_modified, size AS filesize_bytes FROM files",
    ),
)
def index_s3_listing(spark, sf):
    rows = _listing(spark, sf).select(
        "path",
        "type",
        F.when(F.col("doc_id") % 2 == 0, F.col("size")).alias("size"),
        F.col("size").alias("Size_"),
        F.col("e").alias("LastModified"),
        F.concat(F.lit('"'), F.col("version"), F.lit('"')).alias("ETag"),
    )
    rows = rows.withColumn("size", F.coalesce("size", "Size_"))
    return listings.index_s3_listing(rows, "corpus/").select(
        "identifier", "url", "version", "date_created", "date_modified", "filesize_bytes"
    )


@query(
    "index_gcs_listing",
    o.with_(
        _LISTING,
        "SELECT identifier, 'gs://' || path AS url, e || '.0' AS date_created, "
        "(e + 5) || '.25' AS date_modified, 'id' || doc_id AS file_id FROM files",
    ),
)
def index_gcs_listing(spark, sf):
    rows = _listing(spark, sf)

    def iso(epoch, tail):
        from sluice.functions.dates import format_rfc3339

        return F.concat(F.substring(format_rfc3339(epoch), 1, 19), F.lit(tail))

    landed = rows.select(
        "path",
        "type",
        "size",
        iso(F.col("e"), "Z").alias("timeCreated"),
        iso(F.col("e") + 5, ".250Z").alias("updated"),
        F.col("version").alias("etag"),
        F.concat(F.lit("id"), F.col("doc_id").cast("string")).alias("id"),
    )
    return listings.index_gcs_listing(landed, "corpus/").select(
        "identifier",
        "url",
        "date_created",
        "date_modified",
        F.col("record_locator")["file_id"].alias("file_id"),
    )


@query(
    "index_azure_listing",
    o.with_(
        _LISTING,
        "SELECT identifier, 'az://' || path AS url, version, e || '.0' AS date_created, "
        "(e + 9) || '.0' AS date_modified FROM files",
    ),
)
def index_azure_listing(spark, sf):
    landed = _listing(spark, sf).select(
        "path",
        "type",
        "size",
        F.timestamp_seconds("e").alias("creation_time"),
        F.timestamp_seconds(F.col("e") + 9).alias("last_modified"),
        F.col("version").alias("etag"),
    )
    return listings.index_azure_listing(landed, "corpus/").select(
        "identifier", "url", "version", "date_created", "date_modified"
    )


@query(
    "index_dropbox_listing",
    o.with_(
        _LISTING,
        "SELECT identifier, version, CASE doc_id % 3 WHEN 0 THEN e || '.0' "
        "WHEN 1 THEN (e - 50) || '.0' END AS date_created, CASE doc_id % 3 WHEN 0 THEN "
        "(e + 100) || '.0' WHEN 1 THEN e || '.0' END AS date_modified FROM files",
    ),
)
def index_dropbox_listing(spark, sf):
    shift = F.when(F.col("doc_id") % 3 == 0, 100).when(F.col("doc_id") % 3 == 1, -50).otherwise(0)
    landed = _listing(spark, sf).select(
        "path",
        "type",
        "size",
        F.timestamp_seconds("e").alias("server_modified"),
        F.timestamp_seconds(F.col("e") + shift).alias("client_modified"),
        F.col("version").alias("content_hash"),
        F.col("doc_id").cast("string").alias("id"),
    )
    return listings.index_dropbox_listing(landed, "corpus/").select(
        "identifier", "version", "date_created", "date_modified"
    )


# Every tenth document shares its folder, the one after it the folder above, and others themselves.
_COLLABORATIONS = (
    _LISTING
    + """,
collabs AS (
  SELECT CASE doc_id % 10 WHEN 0 THEN regexp_replace(path, '/[^/]*$', '')
      WHEN 1 THEN regexp_replace(path, '/[^/]*/[^/]*$', '') ELSE path END AS place,
    CASE WHEN doc_id % 20 = 0 THEN 'pending' ELSE 'accepted' END AS status,
    CASE doc_id % 3 WHEN 0 THEN 'editor' WHEN 1 THEN 'viewer' ELSE 'previewer' END AS role,
    CASE WHEN doc_id % 4 = 1 THEN 'group' ELSE 'user' END AS kind, 'u' || doc_id % 50 AS id
  FROM listing WHERE doc_id % 10 IN (0, 1, 5)
),
grants AS (
  SELECT place, unnest(CASE role WHEN 'editor' THEN ['read', 'update', 'delete'] WHEN 'viewer'
    THEN ['read'] ELSE [] END) AS op, kind, id
  FROM collabs WHERE status = 'accepted'
),
granted AS (
  SELECT DISTINCT path, op, kind, id FROM files JOIN grants
    ON place = path OR starts_with(path, place || '/')
),
triples AS (
  SELECT path, op, coalesce(string_agg('"' || id || '"', ',' ORDER BY id)
      FILTER (kind = 'user'), '') AS users,
    coalesce(string_agg('"' || id || '"', ',' ORDER BY id) FILTER (kind = 'group'), '') AS groups
  FROM (SELECT path, op FROM files, (VALUES ('read'), ('update'), ('delete')) v(op))
    LEFT JOIN granted USING (path, op) GROUP BY path, op
),
access AS (
  SELECT path, '[' || string_agg('{"' || op || '":{"users":[' || users || '],"groups":[' || groups ||
      ']}}', ',' ORDER BY op = 'delete', op = 'update') || ']' AS permissions,
    sha256('{"denied":[],"permissions":[' || string_agg('{"' || op || '":{"groups":[' || groups ||
      '],"users":[' || users || ']}}', ',' ORDER BY op) || ']}') AS permissions_version
  FROM triples GROUP BY path
)"""
)


def _collaborations(spark, sf):
    """Collaborations of folders and files, as delivered with the listing."""
    number, path = F.col("doc_id"), F.col("path")
    place = (
        F.when(number % 10 == 0, F.regexp_replace(path, "/[^/]*$", ""))
        .when(number % 10 == 1, F.regexp_replace(path, "/[^/]*/[^/]*$", ""))
        .otherwise(path)
    )
    role = F.when(number % 3 == 0, "editor").when(number % 3 == 1, "viewer").otherwise("previewer")
    return _listing(spark, sf).filter(number.isNotNull() & (number % 10).isin(0, 1, 5)).select(
        place.alias("path"),
        F.when(number % 20 == 0, "pending").otherwise("accepted").alias("status"),
        F.lit(False).alias("is_access_only"),
        role.alias("role"),
        F.when(number % 4 == 1, "group").otherwise("user").alias("type"),
        F.concat(F.lit("u"), (number % 50).cast("string")).alias("id"),
        F.lit(None).cast("string").alias("group_type"),
    )


@query(
    "index_box_listing",
    o.with_(
        _COLLABORATIONS,
        "SELECT identifier, doc_id::varchar AS version, e || '.0' AS date_created, "
        "(e + 60) || '.0' AS date_modified, permissions, permissions_version "
        "FROM files JOIN access USING (path)",
    ),
)
def index_box_listing(spark, sf):
    from sluice.functions.dates import format_rfc3339
    from sluice.functions.permissions import permissions_json

    landed = _listing(spark, sf).select(
        "path",
        "type",
        "size",
        format_rfc3339(F.col("e")).alias("created_at"),
        format_rfc3339(F.col("e") + 60).alias("modified_at"),
        F.col("doc_id").cast("string").alias("id"),
    )
    index = listings.index_box_listing(landed, "corpus/", _collaborations(spark, sf))
    return index.select(
        "identifier",
        "version",
        "date_created",
        "date_modified",
        permissions_json(F.col("permissions_data")).alias("permissions"),
        "permissions_version",
    )


@query(
    "index_sftp_listing",
    o.with_(
        _LISTING,
        "SELECT identifier, 'sftp://' || path AS url, NULL::varchar AS version, "
        "e || '.0' AS date_created, (e + 1) || '.0' AS date_modified FROM files",
    ),
)
def index_sftp_listing(spark, sf):
    landed = _listing(spark, sf).select(
        "path",
        "type",
        "size",
        F.timestamp_seconds("e").alias("time"),
        F.timestamp_seconds(F.col("e") + 1).alias("mtime"),
    )
    return listings.index_sftp_listing(landed, "corpus/").select(
        "identifier", "url", "version", "date_created", "date_modified"
    )


@query(
    "index_volume_listing",
    o.with_(
        _LISTING,
        "SELECT identifier, rel_path, e || '.5' AS date_modified, size AS filesize_bytes "
        "FROM listing WHERE is_file",
    ),
)
def index_volume_listing(spark, sf):
    landed = _listing(spark, sf).select(
        "path",
        (F.col("type") != "file").alias("is_dir"),
        F.col("size").alias("file_size"),
        (F.col("e") * 1000 + 500).alias("modification_time"),
    )
    return listings.index_volume_listing(landed, "corpus/").select(
        "identifier", "rel_path", "date_modified", "filesize_bytes"
    )


@query(
    "index_git_tree",
    o.with_(
        _LISTING,
        f"""SELECT {o.uuid5("('https://git.example/o/r/blob/main/' || path)")} AS identifier,
          'main/' || path AS fullpath, version, '{{"mode":"100644"}}' AS additional_metadata,
          filename FROM files""",
    ),
)
def index_git_tree(spark, sf):
    landed = _listing(spark, sf).select(
        "path",
        F.when(F.col("type") == "file", "blob").otherwise("tree").alias("type"),
        "size",
        F.col("version").alias("sha"),
        F.lit("100644").alias("mode"),
    )
    return listings.index_git_tree(landed, "https://git.example/o/r", "main").select(
        "identifier", "fullpath", "version", "additional_metadata", "filename"
    )


@query(
    "index_gitlab_tree",
    o.with_(
        _LISTING,
        "SELECT version AS identifier, path AS fullpath, rel_path, 'dev' AS ref FROM listing "
        "WHERE is_file",
    ),
)
def index_gitlab_tree(spark, sf):
    landed = _listing(spark, sf).select(
        F.col("version").alias("id"),
        "path",
        F.when(F.col("type") == "file", "blob").otherwise("tree").alias("type"),
        F.lit("100644").alias("mode"),
    )
    return listings.index_gitlab_tree(landed, "corpus/", "dev").select(
        "identifier", "fullpath", "rel_path", F.col("record_locator")["ref"].alias("ref")
    )


@query(
    "read_content",
    o.with_(
        o.DOCS,
        "SELECT identifier, strlen(body)::bigint AS filesize_bytes, sha256(body) AS body_hash "
        "FROM docs WHERE doc_id % 3 > 0",
    ),
)
def read_content(spark, sf):
    docs = roles.documents(spark, sf)
    content = docs.filter(F.col("doc_id") % 3 > 0).select(
        F.col("fullpath").alias("path"), F.encode("body", "UTF-8").alias("content")
    )
    joined = listings.read_content(docs.drop("body"), content)
    return joined.select(
        "identifier", "filesize_bytes", F.sha2("body_bytes", 256).alias("body_hash")
    )


@query(
    "uncompress_archives",
    o.with_(
        o.DOCS,
        f"""SELECT {o.uuid5("('s3://corpus/' || source || '/' || lang || '/' || doc_id || "
                            "'-zip-uncompressed/in/' || doc_id || '.txt')")} AS identifier,
          'corpus-free' AS kind, doc_id || '.txt' AS filename,
          source || '/' || lang || '/' || doc_id || '-zip-uncompressed/in/' || doc_id || '.txt'
            AS rel_path, sha256(body) AS body_hash
        FROM docs WHERE doc_id % 2 = 0
        UNION ALL
        SELECT identifier, 'corpus-free', filename, rel_path, sha256(body) FROM docs
        WHERE doc_id % 2 = 1""",
    ),
)
def uncompress_archives(spark, sf):
    @F.pandas_udf(BinaryType())
    def zipped(names: pd.Series, bodies: pd.Series) -> pd.Series:
        import io
        import zipfile

        def one(name, body):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"in/{name}", body)
                archive.writestr("../outside.txt", "left out")
            return out.getvalue()

        return pd.Series([one(n, b) for n, b in zip(names, bodies)])

    docs = roles.documents(spark, sf)
    is_zip = F.col("doc_id") % 2 == 0

    def renamed(path):
        return F.when(is_zip, F.regexp_replace(path, r"\.txt$", ".zip")).otherwise(F.col(path))

    plain = F.encode("body", "UTF-8")
    packed = zipped(F.col("filename"), F.col("body"))
    rows = docs.select(
        "identifier",
        renamed("filename").alias("filename"),
        renamed("fullpath").alias("fullpath"),
        renamed("rel_path").alias("rel_path"),
        "filesize_bytes",
        F.when(is_zip, packed).otherwise(plain).alias("body_bytes"),
    )
    return archives.uncompress_archives(rows).select(
        "identifier",
        F.lit("corpus-free").alias("kind"),
        "filename",
        "rel_path",
        F.sha2("body_bytes", 256).alias("body_hash"),
    )


@query(
    "archive_errors",
    o.with_(
        o.DOCS,
        "SELECT identifier AS record_id, 'uncompress' AS step FROM docs WHERE doc_id % 5 = 1",
    ),
)
def archive_errors(spark, sf):
    """Texts that pose as archives are failures, one row each; the other documents are none."""
    docs = roles.documents(spark, sf)
    suffix = F.when(F.col("doc_id") % 5 == 1, ".zip").otherwise(".txt")

    def renamed(path):
        return F.concat(F.regexp_replace(path, r"\.txt$", ""), suffix).alias(path)

    rows = docs.select(
        "identifier",
        *[renamed(path) for path in ("filename", "fullpath", "rel_path")],
        "filesize_bytes",
        F.encode("body", "UTF-8").alias("body_bytes"),
    )
    return archives.archive_errors(rows).select("record_id", "step")


_GLOBS = ["*/en/*", "s3://corpus/src[1-3]/*.txt", "*src?/d[!x]/1*"]
_GLOB_SQL = (
    "(fullpath GLOB '*/en/*' OR fullpath GLOB 's3://corpus/src[1-3]/*.txt' "
    "OR fullpath GLOB '*src?/d[!x]/1*')"
)


@query("filter_glob", o.with_(o.DOCS, f"SELECT identifier, fullpath FROM docs WHERE {_GLOB_SQL}"))
def filter_glob(spark, sf):
    index = roles.documents(spark, sf).select("identifier", "fullpath")
    return index.filter(filters.matches_any_glob(F.col("fullpath"), _GLOBS))


@query(
    "filter_max_size",
    o.with_(
        _LISTING,
        "SELECT doc_id, size FROM listing WHERE coalesce(CASE WHEN doc_id % 5 > 0 THEN size END, 0)"
        " = 0 OR size <= 2000",
    ),
)
def filter_max_size(spark, sf):
    rows = _listing(spark, sf)
    size = F.when(F.col("doc_id") % 5 > 0, F.col("size"))
    return rows.filter(filters.within_size(size, 2000)).select("doc_id", "size")


@query(
    "filter_all",
    o.with_(
        o.DOCS,
        f"SELECT identifier, filesize_bytes FROM docs WHERE {_GLOB_SQL} AND filesize_bytes <= 3000",
    ),
)
def filter_all(spark, sf):
    index = roles.documents(spark, sf)
    return filters.filter_documents(index, _GLOBS, 3000).select("identifier", "filesize_bytes")


@query(
    "semi_filter_records",
    o.with_(
        o.LINES,
        "SELECT record_id, pos FROM parts WHERE record_id IN "
        "(SELECT identifier FROM docs WHERE filesize_bytes <= 3000)",
    ),
)
def semi_filter_records(spark, sf):
    kept = filters.filter_documents(roles.documents(spark, sf), None, 3000)
    kept = kept.select(F.col("identifier").alias("record_id"))
    rows = roles.parts(spark, sf).select("record_id", "pos")
    return filters.keep_listed_records(rows, kept, "record_id")


def _drive_items(spark, sf):
    part = table(spark, sf, "part")
    key = F.col("p_partkey")
    mime = (
        F.when(key % 6 == 0, "application/vnd.google-apps.document")
        .when(key % 6 == 1, "application/vnd.google-apps.form")
        .when(key % 6 == 2, "application/pdf")
        .when(key % 6 == 3, "inode/x-empty")
        .when(key % 6 == 4, "application/vnd.google-apps.spreadsheet")
    )
    return part.select(
        F.concat(F.lit("f"), key.cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("parent_path"),
        mime.alias("mimeType"),
        F.when(key % 6 == 2, "PDF").alias("fileExtension"),
        F.when(key % 6 == 5, F.col("p_size") % 3).otherwise(F.col("p_size")).cast("long").alias(
            "size"
        ),
        F.lit("2024-05-06T07:08:09.100Z").alias("createdTime"),
        F.lit("2024-05-06T07:08:10Z").alias("modifiedTime"),
        key.alias("version"),
        F.concat(F.lit("https://drive.example/"), key.cast("string")).alias("webViewLink"),
    )


_DRIVE = """
items AS (
  SELECT 'f' || p_partkey AS id, p_name, p_brand, p_partkey,
    CASE p_partkey % 6 WHEN 0 THEN 'application/vnd.google-apps.document'
      WHEN 1 THEN 'application/vnd.google-apps.form' WHEN 2 THEN 'application/pdf'
      WHEN 3 THEN 'inode/x-empty' WHEN 4 THEN 'application/vnd.google-apps.spreadsheet' END AS mime,
    CASE WHEN p_partkey % 6 = 5 THEN p_size % 3 ELSE p_size END AS size
  FROM part
)"""


@query(
    "skip_mime",
    o.with_(
        _DRIVE,
        "SELECT id, mime FROM items WHERE NOT (coalesce(mime, '') IN "
        "('application/vnd.google-apps.form', 'inode/x-empty') OR (mime IS NULL AND size = 0))",
    ),
)
def skip_mime(spark, sf):
    from sluice.sources.drives import is_skipped_type

    rows = _drive_items(spark, sf)
    return rows.filter(~is_skipped_type(F.col("mimeType"), F.col("size"))).select(
        "id", F.col("mimeType").alias("mime")
    )


@query(
    "drive_items_index",
    o.with_(
        _DRIVE,
        "SELECT id AS identifier, p_brand || '/' || p_name AS fullpath, "
        "'1714979289.1' AS date_created, '1714979290.0' AS date_modified, "
        "p_partkey::varchar AS version FROM items WHERE p_partkey % 6 IN (0, 2)",
    ),
)
def drive_items_index(spark, sf):
    from sluice.sources.drives import index_drive_items

    return index_drive_items(_drive_items(spark, sf), [".pdf", "DOCX"]).select(
        "identifier", "fullpath", "date_created", "date_modified", "version"
    )


@query(
    "status_filter",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P')",
)
def status_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return filters.status_in(orders, "o_orderstatus", ["O", "P"])


@query(
    "folder_filter",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) IN "
    "('machinery', 'building')",
)
def folder_filter(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return filters.folder_in(rows, "c_mktsegment", ["Machinery", "building"])


@query(
    "date_range",
    "SELECT event_id FROM events WHERE epoch(ts) >= 1704500000 AND epoch(ts) <= 1705500000.5",
)
def date_range(spark, sf):
    rows = table(spark, sf, "events")
    return filters.between_dates(rows, "ts", 1704500000, 1705500000.5).select("event_id")


@query(
    "sorted_ids",
    "SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS position FROM customer",
)
def sorted_ids(spark, sf):
    from sluice.operators.batching import global_position

    ids = table(spark, sf, "customer").select("c_custkey")
    return global_position(ids, ["c_custkey"])


@query("distinct_ids", "SELECT DISTINCT user_id FROM events")
def distinct_ids(spark, sf):
    return table(spark, sf, "events").select("user_id").distinct()


@query(
    "union_sources",
    "SELECT 'c' || c_custkey AS id, c_name AS name, NULL::double AS price FROM customer "
    "UNION ALL SELECT 's' || s_suppkey, s_name, NULL FROM supplier "
    "UNION ALL SELECT 'p' || p_partkey, NULL, p_retailprice FROM part",
)
def union_sources(spark, sf):
    def keyed(source, key, prefix, **columns):
        return table(spark, sf, source).select(
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"),
            *[F.col(c).alias(n) for n, c in columns.items()],
        )

    customers = keyed("customer", "c_custkey", "c", name="c_name")
    suppliers = keyed("supplier", "s_suppkey", "s", name="s_name")
    parts = keyed("part", "p_partkey", "p", price="p_retailprice")
    return customers.unionByName(suppliers).unionByName(parts, allowMissingColumns=True)


_STATE = (
    o.DOCS
    + """,
state AS (
  SELECT identifier,
    CASE WHEN doc_id % 7 = 1 THEN date_created::double ELSE date_created::double + 999 END AS at,
    CASE WHEN doc_id % 5 = 2 THEN 'old' ELSE version END AS old_version,
    CASE WHEN doc_id % 3 = 0 THEN 'old' ELSE 'acl' END AS old_acl
  FROM docs WHERE doc_id % 10 > 0
),
changes AS (
  SELECT d.identifier, CASE
    WHEN s.identifier IS NULL THEN 'new'
    WHEN doc_id % 13 = 0 THEN 'forced'
    WHEN d.date_created::double + 60 > s.at THEN 'modified'
    WHEN version <> old_version THEN 'version'
    WHEN doc_id % 4 > 0 AND old_acl <> 'acl' THEN 'acl'
    ELSE 'unchanged' END AS change
  FROM docs d LEFT JOIN state s USING (identifier)
)"""
)


def _index_and_state(spark, sf):
    docs = roles.documents(spark, sf)
    doc = F.col("doc_id")
    index = docs.withColumn("reprocess", doc % 13 == 0).withColumn(
        "permissions_version", F.when(doc % 4 > 0, F.lit("acl"))
    )
    created = F.col("date_created").cast("double")
    state = docs.filter(doc % 10 > 0).select(
        "identifier",
        F.when(doc % 7 == 1, created).otherwise(created + 999).alias("processed_at"),
        F.when(doc % 5 == 2, F.lit("old")).otherwise(F.col("version")).alias("version"),
        F.when(doc % 3 == 0, F.lit("old")).otherwise(F.lit("acl")).alias("permissions_version"),
    )
    return index, state


@query("incremental_changed",
       o.with_(_STATE, "SELECT identifier, change FROM changes WHERE change <> 'unchanged'"))
def incremental_changed(spark, sf):
    index, state = _index_and_state(spark, sf)
    return incremental.changed_documents(index, state).select("identifier", "change")


@query(
    "incremental_removed",
    o.with_(o.DOCS, "SELECT identifier FROM docs WHERE doc_id % 10 > 0 AND doc_id % 17 = 0"),
)
def incremental_removed(spark, sf):
    index, state = _index_and_state(spark, sf)
    return incremental.removed_documents(index.filter(F.col("doc_id") % 17 > 0), state)


@query(
    "skip_existing_output",
    o.with_(o.DOCS, "SELECT identifier AS record_id FROM docs WHERE NOT (doc_id % 3 = 0)"),
)
def skip_existing_output(spark, sf):
    from sluice.functions.ids import config_hash

    docs = roles.documents(spark, sf)
    key = config_hash({"max_characters": 500})
    doc = F.col("doc_id")
    outputs = docs.filter(doc % 3 < 2).select(
        F.col("identifier").alias("record_id"),
        F.when(doc % 3 == 0, F.lit(key)).otherwise(F.lit("other")).alias("config_hash"),
    )
    records = docs.select(F.col("identifier").alias("record_id"))
    return incremental.skip_existing_output(records, outputs, key)


@query(
    "status_report",
    "SELECT CASE WHEN l_returnflag = 'R' THEN 'partition' ELSE 'embed' END AS step, "
    "count(*) AS failures, count(DISTINCT l_orderkey) AS records FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1",
)
def status_report(spark, sf):
    errors = table(spark, sf, "lineitem").filter("l_returnflag <> 'N'").select(
        F.col("l_orderkey").cast("string").alias("record_id"),
        F.when(F.col("l_returnflag") == "R", "partition").otherwise("embed").alias("step"),
        F.lit("x").alias("error"),
    )
    return incremental.status_report(errors)


def scratch(spark, name: str) -> str:
    """A new folder below the checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
