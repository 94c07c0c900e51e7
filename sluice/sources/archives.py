"""Archive members as documents of their own."""

from __future__ import annotations

import io
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.ids import uuid5_dns
from sluice.functions.paths import file_name

# Archive suffixes.
ZIP_SUFFIXES = [".zip"]
TAR_SUFFIXES = [".tar", ".tar.gz", ".tgz"]

_MEMBER = T.StructType(
    [T.StructField("_member", T.StringType()), T.StructField("error", T.StringType())]
)
BROKEN = (OSError, EOFError, ValueError, RuntimeError, NotImplementedError)


def _is_safe(name: str) -> bool:
    return not name.startswith(("/", "\\")) and ".." not in name.replace("\\", "/").split("/")


def _members(name: str, data: bytes) -> Iterator[tuple[str, bytes]]:
    """(member path, bytes) of the regular files of an archive held in memory."""
    if name.endswith(tuple(ZIP_SUFFIXES)):
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            for info in archive.infolist():
                if not info.is_dir() and _is_safe(info.filename):
                    yield info.filename, archive.read(info)
    else:
        with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as archive:
            for info in archive:
                if info.isfile() and _is_safe(info.name):
                    yield info.name, archive.extractfile(info).read()


def uncompress_archives(documents: DataFrame) -> DataFrame:
    """Replace archive rows (index columns and ``body_bytes``) by one row per member.

    Other rows pass through untouched by Python. Members whose path would leave the archive are
    left out. Members stream out one at a time; memory holds one archive and one member. Archives
    that cannot be read are left out here and reported by :func:`archive_errors`.
    """
    return _unpacked(documents).filter("error IS NULL").select(*documents.columns)


def archive_errors(documents: DataFrame) -> DataFrame:
    """(record_id, step, error) of the archives that cannot be read, or not to their end."""
    return (
        _unpacked(documents)
        .filter("error IS NOT NULL")
        .select(F.col("identifier").alias("record_id"), F.lit("uncompress").alias("step"), "error")
    )


def _unpacked(documents: DataFrame) -> DataFrame:
    """Rows that are no archives, members, and a row with its ``error`` for each broken archive."""
    lower = F.lower("filename")
    suffixes = [(s, "zip") for s in ZIP_SUFFIXES] + [(s, "tar") for s in TAR_SUFFIXES]
    is_archive = F.lit(False)
    folder = F.lit(None).cast("string")
    for suffix, kind in suffixes:
        hit = lower.endswith(suffix)
        is_archive = is_archive | hit
        stem = F.substring(
            F.col("filename"), F.lit(1), F.length("filename") - F.lit(len(suffix))
        )
        folder = F.when(hit, F.concat(stem, F.lit(f"-{kind}-uncompressed"))).otherwise(folder)
    marked = documents.withColumn("_folder", F.coalesce(folder, F.lit(""))).withColumn(
        "_is_archive", F.coalesce(is_archive, F.lit(False))
    )
    schema = T.StructType([*marked.schema.fields, *_MEMBER.fields])
    at = marked.columns.index("body_bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [*batch.schema.names, "_member", "error"]

            def made(row: pa.RecordBatch, data, member, error) -> pa.RecordBatch:
                columns = list(row.columns)
                columns[at] = pa.array([data], pa.binary())
                columns += [pa.array([member], pa.string()), pa.array([error], pa.string())]
                return pa.RecordBatch.from_arrays(columns, names=names)

            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                name = row.column("filename")[0].as_py().lower()
                try:
                    for member, data in _members(name, row.column("body_bytes")[0].as_py() or b""):
                        yield made(row, data, member, None)
                except (*BROKEN, zipfile.BadZipFile, tarfile.TarError, zlib.error) as problem:
                    yield made(row, None, None, f"{type(problem).__name__}: {problem}")

    archives = marked.filter("_is_archive").mapInArrow(run, schema)
    inside = F.concat(F.col("_folder"), F.lit("/"), F.col("_member"))

    def moved(path: str):
        return F.replace(F.col(path), F.col("filename"), inside)

    failed = archives.filter("error IS NOT NULL")
    members = (
        archives.filter("error IS NULL")
        .withColumn("rel_path", moved("rel_path"))
        .withColumn("fullpath", moved("fullpath"))
        .withColumn("identifier", uuid5_dns(F.col("fullpath")))
        .withColumn("filename", file_name(F.col("_member")))
        .withColumn("filesize_bytes", F.octet_length("body_bytes").cast("long"))
    )
    others = marked.filter(~F.col("_is_archive"))
    columns = [*documents.columns, "error"]
    return (
        others.withColumn("error", F.lit(None).cast("string"))
        .select(*columns)
        .unionByName(members.select(*columns))
        .unionByName(failed.select(*columns))
    )
