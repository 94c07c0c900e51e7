"""Tickets, articles, issues and wiki pages to text and HTML documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import iso_to_epoch_string
from sluice.functions.text import fix_unescaped_unicode
from sluice.operators.filters import cap_per_group, first_seen_wins, status_in
from sluice.sources.listings import doc_index
from sluice.sources.parts import PART_ROWS, assembled, part_texts, placed_rows

# Printed fields of tickets and comments, in print order.
TICKET_FIELDS = ["created_at", "description", "id", "subject"]
COMMENT_FIELDS = ["author_id", "body", "created_at", "id"]

# Separators of the issue text.
CELL_SEPARATOR = "|||"
RECORD_SEPARATOR = "\n\n\n"


def _field_lines(title: str, fields: Sequence[str]) -> Column:
    """``title`` and one ``name: value`` line per non-null field, each ending in a newline."""
    lines = [F.concat(F.lit(f"{f}: "), F.col(f).cast("string"), F.lit("\n")) for f in fields]
    return F.concat_ws("", F.lit(f"{title}\n"), *lines)


def tickets_to_text(
    tickets: DataFrame,
    comments: DataFrame,
    ticket_key: str = "ticket_id",
    order: str | Sequence[str] = "rank",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(identifier, part, filename, body): the ticket, then its comments in order, in parts."""
    orders = [order] if isinstance(order, str) else list(order)
    rendered = comments.select(
        ticket_key, *orders, _field_lines("comment", COMMENT_FIELDS).alias("text")
    )
    placed = placed_rows(rendered, [ticket_key], orders)
    texts = part_texts(placed, [ticket_key], lambda r: r["text"], part_rows=part_rows)
    heads = tickets.select(
        F.col("id").alias(ticket_key), _field_lines("ticket", TICKET_FIELDS).alias("_head")
    )
    return assembled(texts, [ticket_key], heads, comments, opening=F.col("_head")).select(
        F.col(ticket_key).cast("string").alias("identifier"),
        "part",
        F.concat(F.col(ticket_key).cast("string"), F.lit(".txt")).alias("filename"),
        "body",
    )


def _titled_html(title: Column, body: Column) -> Column:
    heading = F.when(
        F.coalesce(title, F.lit("")) != "", F.concat(F.lit("<h1>"), title, F.lit("</h1>"))
    ).otherwise(F.lit(""))
    return fix_unescaped_unicode(
        F.concat(
            F.lit("<body class='Document' >"),
            heading,
            F.coalesce(body, F.lit("")),
            F.lit("</body>"),
        )
    )


def articles_to_html(articles: DataFrame) -> DataFrame:
    """(id, title, body, url, created_at, updated_at) to HTML documents."""
    identifier = F.col("id").cast("string")
    name = F.concat(identifier, F.lit(".html"))
    return doc_index(
        articles.withColumn("html", _titled_html(F.col("title"), F.col("body"))),
        keep=("html",),
        identifier=identifier,
        connector_type=F.lit("zendesk"),
        filename=name,
        fullpath=F.concat(F.lit("articles/"), name),
        display_name=F.concat(F.lit("articles/"), name),
        url=F.col("url"),
        date_created=F.col("created_at"),
        date_modified=F.col("updated_at"),
    )


def wiki_pages_to_html(
    pages: DataFrame, max_documents_per_space: int, site: str = ""
) -> DataFrame:
    """(id, space_id, rank, title, body, created_at, version_at, version_number) to HTML.

    The first ``max_documents_per_space`` pages of a space in listing order are indexed; the cap
    is a setting of the source.
    """
    kept = cap_per_group(
        pages, "space_id", [F.col("rank"), F.col("id")], max_documents_per_space
    )
    identifier = F.col("id").cast("string")
    name = F.concat(identifier, F.lit(".html"))
    path = F.concat(F.col("space_id").cast("string"), F.lit("/"), name)
    return doc_index(
        kept.withColumn("html", _titled_html(F.col("title"), F.col("body"))),
        keep=("html", "space_id"),
        identifier=identifier,
        connector_type=F.lit("confluence"),
        filename=name,
        fullpath=path,
        rel_path=path,
        display_name=F.col("title"),
        url=F.concat(F.lit(f"{site}/pages/"), identifier),
        version=F.col("version_number").cast("string"),
        date_created=iso_to_epoch_string(F.col("created_at")),
        date_modified=iso_to_epoch_string(F.col("version_at")),
    )


def issues_union_dedupe(
    sources: Sequence[DataFrame], key: str = "key", statuses: Sequence[str] | None = None
) -> DataFrame:
    """Union of issue listings in the given order; the first listing that names a key wins."""
    ranked = None
    for rank, source in enumerate(sources):
        tagged = source.withColumn("source_rank", F.lit(rank))
        ranked = tagged if ranked is None else ranked.unionByName(tagged, allowMissingColumns=True)
    unique = first_seen_wins(ranked, key, ["source_rank"])
    return status_in(unique, "status", statuses)


def _or_blank(value: Column) -> Column:
    """A missing value behaves as an empty object and prints as ``{}``."""
    return F.coalesce(value.cast("string"), F.lit("{}"))


def issues_to_text(
    issues: DataFrame,
    comments: DataFrame,
    order: str = "rank",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Templated issue text: ids, project, drop-downs, comments, text fields.

    ``issues`` is (id, key, project_key, project_name, issue_type, status, priority, assignee_id,
    assignee_name, reporter_email, reporter_name, labels, components, summary, description,
    attachments); ``comments`` is (key, rank, author, body). Sections are joined by the record
    separator. The text comes in parts; comments are all in the middle of it.
    """
    cell, record = F.lit(CELL_SEPARATOR), F.lit(RECORD_SEPARATOR)
    rendered = comments.select(
        "key",
        order,
        F.concat(_or_blank(F.col("author")), cell, _or_blank(F.col("body")), record).alias("text"),
    )
    placed = placed_rows(rendered, ["key"], order)
    comment_texts = part_texts(
        placed, ["key"], lambda r: r["text"], between=CELL_SEPARATOR, part_rows=part_rows
    )
    ids = F.concat(
        F.lit("IssueID_IssueKey:"), _or_blank(F.col("id")), cell, F.col("key"), record
    )
    project = F.when(
        F.col("project_key").isNotNull(),
        F.concat(
            F.lit("ProjectID_Key:"),
            F.col("project_key"),
            cell,
            _or_blank(F.col("project_name")),
            record,
        ),
    ).otherwise(F.lit(""))

    def pair(label: str, left: str, right: str | None = None) -> Column:
        parts = [F.lit(f"{label}:"), _or_blank(F.col(left))]
        if right:
            parts += [cell, _or_blank(F.col(right))]
        return F.concat(*parts)

    def listed(name: str) -> Column:
        return F.array_join(F.coalesce(F.col(name), F.array().cast("array<string>")), CELL_SEPARATOR)

    def block(*values: Column) -> Column:
        """Values on indented lines, each followed by a record separator line."""
        indent = F.lit("\n        ")
        parts = []
        for value in values:
            parts += [indent, value, indent, record]
        return F.concat(*parts, indent)

    drop_downs = block(
        pair("IssueType", "issue_type"),
        pair("Status", "status"),
        pair("Priority", "priority"),
        pair("AssigneeID_Name", "assignee_id", "assignee_name"),
        pair("ReporterAdr_Name", "reporter_email", "reporter_name"),
        F.concat(F.lit("Labels:"), listed("labels")),
        F.concat(F.lit("Components:"), listed("components")),
    )
    texts = block(
        _or_blank(F.col("summary")), _or_blank(F.col("description")), listed("attachments")
    )
    # A null section is left out with its separator, as concat_ws does.
    opening = F.concat(
        F.concat_ws(RECORD_SEPARATOR, ids, project, drop_downs, F.lit("")), F.lit(RECORD_SEPARATOR)
    )
    closing = F.coalesce(F.concat(F.lit(RECORD_SEPARATOR), texts), F.lit(""))
    return assembled(
        comment_texts, ["key"], issues, comments, opening, closing, part_rows
    ).select(
        F.col("id").cast("string").alias("identifier"),
        "part",
        F.concat(F.col("key"), F.lit(".txt")).alias("filename"),
        "body",
    )


def issue_attachments(issues: DataFrame) -> DataFrame:
    """(key, attachments array<struct<id,filename,created,mime,size,content>>) to index rows."""
    files = issues.select("key", F.explode("attachments").alias("a"))
    path = F.concat(F.col("key"), F.lit("/"), F.col("a.filename"))
    return doc_index(
        files,
        identifier=F.concat(F.col("key"), F.lit("-"), F.col("a.id").cast("string")),
        connector_type=F.lit("jira"),
        filename=F.col("a.filename"),
        fullpath=path,
        display_name=path,
        url=F.col("a.content"),
        date_created=iso_to_epoch_string(F.col("a.created")),
        filesize_bytes=F.col("a.size"),
        record_locator=F.create_map(
            F.lit("parent_issue"), F.col("key"), F.lit("id"), F.col("a.id").cast("string")
        ),
    )
