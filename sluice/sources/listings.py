"""Object and file listings to the document index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schemas
from sluice.functions.dates import epoch_string, float_text, iso_to_epoch_string
from sluice.functions.ids import uuid5_dns
from sluice.functions.paths import file_name, rel_path
from sluice.operators.access import path_access
from sluice.operators.acl import attach_permissions, box_grants


def doc_index(df: DataFrame, keep: tuple[str, ...] = (), **given: Column) -> DataFrame:
    """DOC_INDEX rows from the given columns; all other index columns are null.

    ``keep`` names further input columns (content, for instance) that stay with the row.
    """
    columns = [
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.DOC_INDEX.fields
    ]
    return df.select(*columns, *[F.col(c) for c in keep])


def scan_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Listing (path, size, type, mtime) of a folder; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )
    return files.select(
        "path",
        F.col("length").alias("size"),
        F.lit("file").alias("type"),
        epoch_string(F.col("modificationTime")).alias("mtime"),
    )


def _files(listing: DataFrame, recursive: bool = True, root: str = "") -> DataFrame:
    kept = listing.filter((F.col("type") == "file") & (F.col("size") > 0))
    if not recursive:
        kept = kept.filter(~rel_path(F.col("path"), root).contains("/"))
    return kept


def _extra(listing: DataFrame) -> Column:
    """The listing record as JSON, with the path kept under its original name too."""
    return F.to_json(F.struct(*listing.columns, F.col("path").alias("original_file_path")))


def index_files(
    listing: DataFrame,
    root: str,
    protocol: str = "file",
    recursive: bool = True,
    **metadata: Column,
) -> DataFrame:
    """Generic object listing (path, size, type, ..): non-empty files only."""
    path = F.col("path")
    return doc_index(
        _files(listing, recursive, root),
        **{
            "identifier": uuid5_dns(path),
            "connector_type": F.lit(protocol),
            "filename": file_name(path),
            "fullpath": path,
            "rel_path": rel_path(path, root),
            "record_locator": F.create_map(
                F.lit("protocol"), F.lit(protocol), F.lit("remote_file_path"), F.lit(root)
            ),
            "filesize_bytes": F.col("size"),
            "additional_metadata": _extra(listing),
            "display_name": path,
            **metadata,
        },
    )


def sample_files(index: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` documents without replacement, the same ones for the same seed.

    Order by a keyed digest and take the first ``n``: every task keeps at most ``n`` rows. All
    documents come back when there are fewer.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("identifier")), 256)
    return index.withColumn("_key", key).orderBy("_key", "identifier").limit(n).drop("_key")


def index_local(listing: DataFrame, root: str) -> DataFrame:
    """Local files: the path is the identifier; file modes are not visible to Spark."""
    path = F.col("path")
    return doc_index(
        _files(listing),
        identifier=path,
        connector_type=F.lit("local"),
        filename=file_name(path),
        fullpath=path,
        rel_path=F.when(path == root, file_name(path)).otherwise(rel_path(path, root)),
        url=path,
        record_locator=F.create_map(F.lit("path"), path),
        date_created=F.col("mtime"),
        date_modified=F.col("mtime"),
        filesize_bytes=F.col("size"),
        display_name=path,
    )


def hydrate_single_file(listing: DataFrame, path: str, protocol: str = "file") -> DataFrame:
    """The one non-empty file at ``path``; none or several fail the job."""
    here = listing.filter(
        (F.col("path") == path) | F.startswith("path", F.lit(path.rstrip("/") + "/"))
    )
    one = _files(here).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("path", "size", "type")).alias("f"),
    )
    message = F.concat(F.lit("expected one file, found "), F.col("n").cast("string"))
    checked = one.filter(
        F.when(F.col("n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    ).select("f.*")
    return index_files(checked, path, protocol)


def index_s3_listing(listing: DataFrame, root: str) -> DataFrame:
    """(path, type, size, LastModified epoch, ETag, Size)."""
    modified = float_text(F.col("LastModified").cast("double"))
    listing = listing.withColumn("size", F.coalesce(F.col("size"), F.col("Size_")))
    return index_files(
        listing,
        root,
        "s3",
        url=F.concat(F.lit("s3://"), F.col("path")),
        version=F.regexp_replace("ETag", '^"+|"+$', ""),
        date_created=modified,
        date_modified=modified,
    )


def index_gcs_listing(listing: DataFrame, root: str) -> DataFrame:
    """(path, type, size, timeCreated ISO, updated ISO, etag, id)."""
    return index_files(
        listing,
        root,
        "gs",
        url=F.concat(F.lit("gs://"), F.col("path")),
        version=F.col("etag"),
        date_created=iso_to_epoch_string(F.col("timeCreated")),
        date_modified=iso_to_epoch_string(F.col("updated")),
        record_locator=F.create_map(
            F.lit("protocol"), F.lit("gs"),
            F.lit("remote_file_path"), F.lit(root),
            F.lit("file_id"), F.col("id"),
        ),
    )


def index_azure_listing(listing: DataFrame, root: str) -> DataFrame:
    """(path, type, size, creation_time timestamp, last_modified timestamp, etag)."""
    return index_files(
        listing,
        root,
        "az",
        url=F.concat(F.lit("az://"), F.col("path")),
        version=F.col("etag"),
        date_created=epoch_string(F.col("creation_time")),
        date_modified=epoch_string(F.col("last_modified")),
    )


def index_dropbox_listing(listing: DataFrame, root: str) -> DataFrame:
    """(path, type, size, server_modified, client_modified timestamps, content_hash, id).

    Created is the earlier and modified the later of both times; equal times give neither.
    """
    server, client = F.col("server_modified"), F.col("client_modified")
    differ = server != client
    return index_files(
        listing,
        root,
        "dropbox",
        url=F.concat(F.lit("dropbox://"), F.col("path")),
        version=F.col("content_hash"),
        date_created=F.when(differ, epoch_string(F.least(server, client))),
        date_modified=F.when(differ, epoch_string(F.greatest(server, client))),
        record_locator=F.create_map(
            F.lit("protocol"), F.lit("dropbox"),
            F.lit("remote_file_path"), F.lit(root),
            F.lit("file_id"), F.col("id"),
        ),
    )


def index_box_listing(
    listing: DataFrame, root: str, collaborations: DataFrame | None = None
) -> DataFrame:
    """(path, type, size, created_at ISO, modified_at ISO, id).

    The version is the file id, which content changes do not move; use the modified date for
    change detection. ``collaborations`` of folders and files, (path, status, is_access_only, role,
    type, id, group_type), are access: a file has those of its own and of all folders above it, and
    the empty lists if none counts. Without them no access is delivered.
    """
    index = index_files(
        listing,
        root,
        "box",
        url=F.concat(F.lit("box://"), F.col("path")),
        version=F.col("id"),
        date_created=iso_to_epoch_string(F.col("created_at")),
        date_modified=iso_to_epoch_string(F.col("modified_at")),
        record_locator=F.create_map(
            F.lit("protocol"), F.lit("box"),
            F.lit("remote_file_path"), F.lit(root),
            F.lit("file_id"), F.col("id"),
        ),
    )
    if collaborations is None:
        return index
    grants = box_grants(collaborations.withColumnRenamed("path", "folder_id"))
    paths = _files(listing).select("path").distinct()
    found = path_access(paths, grants).permissions()
    return attach_permissions(index, found.select(uuid5_dns(F.col("id")).alias("doc_id"), "permissions_data"))


def index_sftp_listing(listing: DataFrame, root: str) -> DataFrame:
    """(path, type, size, time timestamp, mtime timestamp); there is no version."""
    return index_files(
        listing,
        root,
        "sftp",
        url=F.concat(F.lit("sftp://"), F.col("path")),
        date_created=epoch_string(F.col("time")),
        date_modified=epoch_string(F.col("mtime")),
    )


def index_volume_listing(listing: DataFrame, root: str) -> DataFrame:
    """(path, is_dir, file_size, modification_time in ms)."""
    path = F.col("path")
    return doc_index(
        listing.filter(~F.col("is_dir")),
        identifier=uuid5_dns(path),
        connector_type=F.lit("volumes"),
        filename=file_name(path),
        fullpath=path,
        rel_path=rel_path(path, root),
        url=path,
        date_modified=float_text(F.col("modification_time").cast("double") / 1000),
        record_locator=F.create_map(F.lit("file_path"), path),
        filesize_bytes=F.col("file_size"),
        display_name=path,
    )


def index_git_tree(tree: DataFrame, repository_url: str, branch: str) -> DataFrame:
    """(path, type, size, sha, mode): blobs with content; the version is the blob hash."""
    path = F.concat(F.lit(f"{branch}/"), F.col("path"))
    url = F.concat(F.lit(f"{repository_url}/blob/"), path)
    return doc_index(
        tree.filter((F.col("type") == "blob") & (F.col("size") > 0)),
        identifier=uuid5_dns(url),
        connector_type=F.lit("github"),
        filename=file_name(F.col("path")),
        fullpath=path,
        rel_path=F.col("path"),
        url=url,
        version=F.col("sha"),
        record_locator=F.create_map(
            F.lit("repo_path"), F.lit(repository_url), F.lit("file_path"), F.col("path")
        ),
        filesize_bytes=F.col("size"),
        additional_metadata=F.to_json(F.struct("mode")),
        display_name=path,
    )


def index_gitlab_tree(tree: DataFrame, base_path: str, ref: str) -> DataFrame:
    """(id, path, type, mode): blobs; the identifier is the blob id."""
    path = F.col("path")
    return doc_index(
        tree.filter(F.col("type") == "blob"),
        identifier=F.col("id"),
        connector_type=F.lit("gitlab"),
        filename=file_name(path),
        fullpath=path,
        rel_path=rel_path(path, base_path) if base_path else path,
        url=path,
        record_locator=F.create_map(F.lit("file_path"), path, F.lit("ref"), F.lit(ref)),
        additional_metadata=F.to_json(F.struct("mode")),
        display_name=path,
    )


def read_content(index: DataFrame, content: DataFrame) -> DataFrame:
    """Index rows with their bytes; the real size replaces the listed one.

    ``content`` is ``(path, content)`` such as a ``binaryFile`` read. Filter the index first: the
    join then only fetches what is left.
    """
    body = content.select(F.col("path").alias("fullpath"), F.col("content").alias("body_bytes"))
    joined = index.join(body, "fullpath")
    size = F.octet_length("body_bytes").cast("long")
    return joined.withColumn("filesize_bytes", F.coalesce(size, F.col("filesize_bytes")))
