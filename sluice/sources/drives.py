"""Drive items, mail folders and CRM records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import format_rfc3339, iso_to_epoch_string, parse_timestamp
from sluice.functions.flatten import flat_row_entries
from sluice.functions.ids import sha256_16
from sluice.functions.permissions import acl_digest
from sluice.operators.closure import tree_closure
from sluice.sources.listings import doc_index
from sluice.sources.messages import xml_escape

# Native types that cannot be exported.
SKIPPED_TYPES = [
    "application/vnd.google-apps.shortcut",
    "application/vnd.google-apps.form",
    "application/vnd.google-apps.map",
    "application/vnd.google-apps.site",
    "application/vnd.google-apps.fusiontable",
    "application/vnd.google-apps.jam",
]
# Native type to the extension of its export.
NATIVE_EXPORTS = {
    "application/vnd.google-apps.document": "docx",
    "application/vnd.google-apps.spreadsheet": "xlsx",
    "application/vnd.google-apps.presentation": "pptx",
    "application/vnd.google-apps.drawing": "png",
}

# Fixed value: part boundary of the mail template.
MAIL_BOUNDARY = "00000000000095c9b205eff92630"

# File extension by CRM record type.
CRM_EXTENSIONS = {
    "EmailMessage": ".eml",
    "Account": ".xml",
    "Lead": ".xml",
    "Case": ".xml",
    "Campaign": ".xml",
}


def is_skipped_type(mime: Column, size: Column) -> Column:
    """Types without an export, empty files, and empty files of unknown type."""
    mime = F.coalesce(mime, F.lit(""))
    empty = (F.coalesce(size, F.lit(-1)) == 0) & (mime == "")
    return mime.isin(SKIPPED_TYPES) | (mime == "inode/x-empty") | empty


def export_extension(mime: Column) -> Column:
    """Extension a native type is exported with; the mapping is a constant of four entries."""
    out = F.lit(None).cast("string")
    for native, extension in NATIVE_EXPORTS.items():
        out = F.when(mime == native, F.lit(extension)).otherwise(out)
    return out


def matches_extensions(extension: Column, mime: Column, wanted: Sequence[str] | None) -> Column:
    """By file extension, or by the extension a native type is exported to."""
    names = sorted({w.lower().lstrip(".") for w in wanted or []})
    if not names:
        return F.lit(True)
    own = F.regexp_replace(F.lower(F.coalesce(extension, F.lit(""))), r"^\.+", "")
    return own.isin(names) | F.coalesce(export_extension(mime).isin(names), F.lit(False))


def index_drive_items(items: DataFrame, extensions: Sequence[str] | None = None) -> DataFrame:
    """(id, name, parent_path, mimeType, fileExtension, size, createdTime, modifiedTime, version,
    webViewLink)."""
    kept = items.filter(~is_skipped_type(F.col("mimeType"), F.col("size"))).filter(
        matches_extensions(F.col("fileExtension"), F.col("mimeType"), extensions)
    )
    path = F.when(
        F.coalesce("parent_path", F.lit("")) != "",
        F.concat(F.col("parent_path"), F.lit("/"), F.col("name")),
    ).otherwise(F.col("name"))
    return doc_index(
        kept,
        identifier=F.col("id"),
        connector_type=F.lit("google_drive"),
        filename=F.col("name"),
        fullpath=path,
        rel_path=path,
        display_name=path,
        url=F.col("webViewLink"),
        version=F.col("version").cast("string"),
        date_created=iso_to_epoch_string(F.col("createdTime")),
        date_modified=iso_to_epoch_string(F.col("modifiedTime")),
        filesize_bytes=F.col("size"),
        record_locator=F.create_map(F.lit("file_id"), F.col("id")),
    )


def index_graph_items(
    items: DataFrame, permissions: DataFrame, root: str, user: str
) -> DataFrame:
    """(id, name, parent_path, etag, created, modified) with nested permissions.

    The path follows the colon of the parent path. Items without a permissions row keep null
    (not delivered), which differs from empty permissions.
    """
    folder = F.regexp_replace(F.substring_index("parent_path", ":", -1), "^/", "")
    path = F.concat(folder, F.lit("/"), F.col("name"))
    relative = path
    if root:
        relative = F.replace(path, F.lit(root), F.lit(""))
    given = permissions.select(F.col("doc_id").alias("id"), "permissions_data")
    return doc_index(
        items.join(given, "id", "left"),
        identifier=F.col("id"),
        connector_type=F.lit("onedrive"),
        filename=F.col("name"),
        fullpath=path,
        rel_path=F.regexp_replace(relative, "^/+", ""),
        display_name=path,
        url=F.concat(F.col("parent_path"), F.lit("/"), F.col("name")),
        version=F.col("etag"),
        date_created=iso_to_epoch_string(F.col("created")),
        date_modified=iso_to_epoch_string(F.col("modified")),
        record_locator=F.create_map(
            F.lit("user_pname"), F.lit(user), F.lit("server_relative_path"), path
        ),
        permissions_data=F.col("permissions_data"),
        permissions_version=acl_digest(F.col("permissions_data")),
    )


def index_mail(
    folders: DataFrame, mails: DataFrame, root_folders: Sequence[str], user: str
) -> DataFrame:
    """Messages in the named root folders (any case) and all folders below them.

    ``folders`` is (id, parent_id, name), ``mails`` is (id, folder_id, change_key, created,
    modified, url, subject).
    """
    names = [f.lower() for f in root_folders]
    roots = folders.filter(F.lower("name").isin(names) & F.col("parent_id").isNull()).select("id")
    edges = folders.filter("parent_id IS NOT NULL").select(
        F.col("parent_id").alias("parent"), F.col("id").alias("child")
    )
    inside = tree_closure(edges, roots).select(F.col("node").alias("folder_id")).distinct()
    filename = F.concat(sha256_16(F.col("id")), F.lit(".eml"))
    return doc_index(
        mails.join(inside, "folder_id", "left_semi"),
        identifier=F.col("id"),
        connector_type=F.lit("outlook"),
        filename=filename,
        fullpath=filename,
        display_name=filename,
        url=F.col("url"),
        version=F.col("change_key"),
        date_created=iso_to_epoch_string(F.col("created")),
        date_modified=iso_to_epoch_string(F.col("modified")),
        record_locator=F.create_map(
            F.lit("message_id"), F.col("id"), F.lit("user_email"), F.lit(user)
        ),
        additional_metadata=F.to_json(F.struct("subject")),
    )


def crm_extension(record_type: Column) -> Column:
    """File extension of a record type; an unknown type fails the job."""
    out = F.raise_error(F.concat(F.lit("unknown record type "), record_type)).cast("string")
    for name, extension in CRM_EXTENSIONS.items():
        out = F.when(record_type == name, F.lit(extension)).otherwise(out)
    return out


def crm_records_to_xml(records: DataFrame, record_type: str) -> DataFrame:
    """Each leaf value becomes ``<item>path: value</item>`` with dotted paths."""
    names = [c for c in records.columns]
    entries = flat_row_entries(records.schema, names, ".")
    items = F.transform(
        entries,
        lambda e: F.concat(
            F.lit("<item>"),
            xml_escape(F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None")))),
            F.lit("</item>"),
        ),
    )
    body = F.concat(
        F.lit("<?xml version='1.0' encoding='utf-8'?>\n<root>"),
        F.array_join(items, ""),
        F.lit("</root>"),
    )
    filename = F.concat(F.col("Id"), crm_extension(F.lit(record_type)))
    path = F.concat(F.lit(f"{record_type}/"), filename)
    return doc_index(
        records.withColumn("body", body),
        keep=("body",),
        identifier=F.col("Id"),
        connector_type=F.lit("salesforce"),
        filename=filename,
        fullpath=path,
        display_name=path,
        record_locator=F.create_map(F.lit("id"), F.col("Id")),
    )


def crm_mails_to_eml(mails: DataFrame) -> DataFrame:
    """(Id, MessageDate, MessageIdentifier, Subject, FromAddress, ToAddress, TextBody, HtmlBody)
    to a two-part message."""
    epoch = parse_timestamp(F.col("MessageDate"))
    moment = format_rfc3339(epoch)
    day = F.substring(moment, 1, 10).cast("date")
    date = F.concat(
        F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" "), F.substring(moment, 12, 8),
        F.lit(" -0000"),
    )

    def or_none(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("None"))

    boundary = MAIL_BOUNDARY
    head = [
        F.lit("MIME-Version: 1.0\nDate: "), date,
        F.lit("\nMessage-ID: "), or_none("MessageIdentifier"),
        F.lit("\nSubject: "), or_none("Subject"),
        F.lit("\nFrom: "), or_none("FromAddress"),
        F.lit("\nTo: "), or_none("ToAddress"),
        F.lit(f'\nContent-Type: multipart/alternative; boundary="{boundary}"\n'),
        F.lit(f'--{boundary}\nContent-Type: text/plain; charset="UTF-8"\n'),
        or_none("TextBody"),
        F.lit(f'\n--{boundary}\nContent-Type: text/html; charset="UTF-8"\n'),
        or_none("HtmlBody"),
        F.lit(f"\n--{boundary}--\n"),
    ]
    filename = F.concat(F.col("Id"), F.lit(CRM_EXTENSIONS["EmailMessage"]))
    path = F.concat(F.lit("EmailMessage/"), filename)
    return doc_index(
        mails.withColumn("body", F.concat(*head)),
        keep=("body",),
        identifier=F.col("Id"),
        connector_type=F.lit("salesforce"),
        filename=filename,
        fullpath=path,
        display_name=path,
        record_locator=F.create_map(F.lit("id"), F.col("Id")),
    )
