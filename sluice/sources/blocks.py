"""Block trees of a page to HTML by pre-order keys.

Every block gets the path of sibling ranks that leads to it, by pointer doubling: each round a block
puts the path of the block it points to before its own and points where that one points. Sorted by
path, blocks stand in pre-order. What opens a block stands at its path, what closes it behind all
paths that go on from it, so the page is the texts of these events in order; nothing is folded level
by level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.dates import float_text
from sluice.operators.sequence import BLOCK_ROWS, dense_position, neighbours
from sluice.session import written
from sluice.sources.messages import xml_escape
from sluice.sources.parts import PART_ROWS, assembled, part_texts, placed_rows

# Block type to the tag around its text.
TEXT_TAGS = {
    "paragraph": "p",
    "heading_1": "h1",
    "heading_2": "h2",
    "heading_3": "h3",
    "quote": "blockquote",
    "callout": "p",
    "code": "pre",
    "to_do": "p",
    "toggle": "p",
    "bulleted_list_item": "li",
    "numbered_list_item": "li",
    "equation": "div",
    "template": "div",
    "link_to_page": "div",
}
LIST_TAGS = {"bulleted_list_item": "ul", "numbered_list_item": "ol"}
# Blocks that show an address and a caption, and those that show the address alone.
LINKED = ["bookmark", "embed", "file", "pdf"]
# Blocks without a text of their own.
SILENT = [
    "breadcrumb", "column", "column_list", "divider", "synced_block", "table", "table_of_contents",
    "table_row", "unsupported",
]
# Blocks that hold other blocks, and blocks that are pages of their own.
CONTAINERS = {"table": "table", "column_list": "div"}
SEPARATE = ["child_page", "child_database"]

SIBLINGS = ["page_id", "parent_id"]
LAST = (1 << 63) - 1  # behind every rank


def _among_siblings(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``peer_rank``, ``peer_count`` and the types of the siblings around.

    Siblings are one window where their ranks show that they are few, else windows of blocks.
    """
    ends = blocks.agg(F.min("rank").alias("low"), F.max("rank").alias("high")).first()
    if ends["low"] is None or ends["high"] - ends["low"] < BLOCK_ROWS:
        window = Window.partitionBy(*SIBLINGS).orderBy("rank")
        # In the order of the others, so that all are one pass.
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # Ranks may tie, so their range does not bound the number of siblings; the sort spills.
        return blocks.withColumns(
            {
                "peer_rank": (F.row_number().over(window) - 1).cast("long"),
                "peer_count": F.count(F.lit(1)).over(whole),
                "_before": F.lag("type").over(window),
                "_after": F.lead("type").over(window),
            }
        )
    ranked = neighbours(
        dense_position(blocks, "peer_rank", key=SIBLINGS, order="rank"),
        "type", "_before", "_after", key=SIBLINGS, order="rank",
    )
    counts = blocks.groupBy(*SIBLINGS).agg(F.count(F.lit(1)).alias("peer_count"))
    return ranked.join(counts, SIBLINGS)


def _in_order(events: DataFrame, counts: DataFrame) -> DataFrame:
    """``events`` with ``nth``, their place on the page; large pages are placed by range."""
    most = counts.agg(F.max("_children")).first()[0] or 0
    if most > BLOCK_ROWS:
        return placed_rows(events, ["page_id"], ["key"], numeric_order=False)
    window = Window.partitionBy("page_id").orderBy("key")
    return events.withColumn("nth", (F.row_number().over(window) - 1).cast("long"))


def block_levels(blocks: DataFrame) -> DataFrame:
    """Blocks with sibling ``peer_rank`` and ``peer_count``, the types of the siblings ``_before`` and
    ``_after``, ``path`` and ``level``.

    The path is the peer ranks from the top-level block down to the block, and the level, 0 below the
    page, its length less one. Blocks that no page leads to are left out; a block that is below
    itself raises a ValueError. A tree takes about as many rounds as its depth has binary digits.
    """
    return _levels(blocks)[1]


def _levels(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks among their siblings, as they are written, and ``block_levels``."""
    ranked = written(_among_siblings(written(blocks, "blocks")), "blocks")
    top = F.col("parent_id") == F.col("page_id")
    rows = ranked.select(
        "page_id",
        "block_id",
        F.when(~top, F.col("parent_id")).alias("up"),
        F.array(F.col("peer_rank").cast("long")).alias("path"),
    )
    done, open_ = rows.where("up IS NULL"), rows.where("up IS NOT NULL")
    rounds = None
    while not open_.isEmpty():
        rounds = open_.count().bit_length() + 1 if rounds is None else rounds - 1
        if not rounds:
            raise ValueError("a block is below itself")
        above = done.unionByName(open_).select(
            "page_id",
            F.col("block_id").alias("up"),
            F.col("up").alias("next"),
            F.col("path").alias("before"),
        )
        met = open_.join(above, ["page_id", "up"]).select(
            "page_id", "block_id", F.col("next").alias("up"), F.concat("before", "path").alias("path")
        )
        rows = written(met, "block-paths")
        done = done.unionByName(rows.where("up IS NULL"))
        open_ = rows.where("up IS NOT NULL")
    paths = done.select("page_id", "block_id", "path")
    levels = ranked.join(paths, ["page_id", "block_id"])
    return ranked, levels.withColumn("level", F.size("path") - 1)


def _optional(blocks: DataFrame, name: str) -> Column:
    return F.col(name) if name in blocks.columns else F.lit(None).cast("string")


def _body(blocks: DataFrame) -> Column:
    """What a block itself shows; types that are not known show their text as a paragraph."""
    kind = F.col("type")
    text = F.coalesce("text", F.lit(""))
    url = F.coalesce(_optional(blocks, "url"), F.lit(""))
    caption = F.coalesce(_optional(blocks, "caption"), F.lit(""))
    quoted = F.replace(xml_escape(url), F.lit('"'), F.lit("&quot;"))

    def tagged(tag: str, value: Column) -> Column:
        return F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))

    def shown(value: Column, html: Column) -> Column:
        return F.when(value != "", html)

    link = F.concat(F.lit('<a href="'), quoted, F.lit('">'), xml_escape(url), F.lit("</a>"))
    # Address and caption are one under the other; a block with neither shows nothing.
    lines = F.concat_ws(
        "<br/>", shown(url, link), shown(caption, tagged("div", xml_escape(caption)))
    )
    unknown = F.coalesce(shown(text, tagged("p", xml_escape(text))), F.lit(""))
    tag = F.lit(None).cast("string")
    for name, known in TEXT_TAGS.items():
        tag = F.when(kind == name, F.lit(known)).otherwise(tag)
    body = F.concat(F.lit("<"), tag, F.lit(">"), xml_escape(text), F.lit("</"), tag, F.lit(">"))
    body = F.when(kind.isin(list(TEXT_TAGS)), body).otherwise(unknown)
    image = F.concat(F.lit('<img src="'), quoted, F.lit('"/>'))
    video = F.concat(
        F.lit('<video><source src="'), quoted, F.lit('">'), xml_escape(url), F.lit("</source></video>")
    )
    cell_tag = F.when(F.col("peer_rank") == 0, F.lit("th")).otherwise(F.lit("td"))
    cells = F.transform(
        F.coalesce("cells", F.array().cast("array<string>")),
        lambda c: F.concat(
            F.lit("<"), cell_tag, F.lit(">"), xml_escape(c), F.lit("</"), cell_tag, F.lit(">")
        ),
    )
    return (
        F.when(kind == "divider", F.lit("<hr/>"))
        .when(kind == "table_row", tagged("tr", F.array_join(cells, "")))
        .when(kind.isin(SILENT), F.lit(""))
        .when(kind.isin(LINKED), F.coalesce(shown(lines, tagged("div", lines)), F.lit("")))
        .when(kind == "link_preview", F.coalesce(shown(url, link), F.lit("")))
        .when(kind == "image", F.coalesce(shown(url, image), F.lit("")))
        .when(kind == "video", F.coalesce(shown(url, video), F.lit("")))
        .otherwise(body)
    )


def _events(ranked: DataFrame, blocks: DataFrame) -> DataFrame:
    """(page_id, key, text): what opens each block, and what closes it behind its children.

    A block that a page leads to leads on to all its children, so ``ranked`` tells which have any.
    """
    kind = F.col("type")
    children = ranked.where("block_id IS NOT NULL")
    children = children.select("page_id", F.col("parent_id").alias("block_id")).distinct()
    children = children.withColumn("_inner", F.lit(True))
    rows = blocks.join(children, ["page_id", "block_id"], "left")
    opening, closing = F.lit(""), F.lit("")
    margin = F.concat(F.lit(' style="margin-left: '), F.col("level") * 10, F.lit('px">'))
    for name, tag in LIST_TAGS.items():
        first = (kind == name) & ~F.col("_before").eqNullSafe(F.lit(name))
        last = (kind == name) & ~F.col("_after").eqNullSafe(F.lit(name))
        opening = F.when(first, F.concat(F.lit(f"<{tag}"), margin)).otherwise(opening)
        closing = F.when(last, F.lit(f"</{tag}>")).otherwise(closing)
    around, end = F.lit("<div>"), F.lit("</div>")
    for name, tag in CONTAINERS.items():
        around = F.when(kind == name, F.lit(f"<{tag}>")).otherwise(around)
        end = F.when(kind == name, F.lit(f"</{tag}>")).otherwise(end)
    width = float_text(F.lit(100.0) / F.col("peer_count"))
    column = F.concat(F.lit('<div style="width:'), width, F.lit('%; float: left">'))
    around = F.when(kind == "column", column).otherwise(around)
    own = F.concat(opening, _body(blocks))

    def event(key: Column, text: Column) -> Column:
        return F.struct(key.alias("key"), text.alias("text"))

    after = F.concat("path", F.array(F.lit(LAST)))
    events = F.when(
        F.col("_inner"),
        F.array(
            event(F.col("path"), F.concat(own, around)), event(after, F.concat(end, closing))
        ),
    ).otherwise(F.array(event(F.col("path"), F.concat(own, closing))))
    return rows.select("page_id", F.explode(events).alias("e")).select("page_id", "e.key", "e.text")


def blocks_to_html(blocks: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(page_id, part, body) of ``(page_id, block_id, parent_id, rank, type, text, cells)``.

    ``blocks`` may also have ``url`` and ``caption``. Top-level blocks have their page as parent.
    Child pages and databases are documents of their own and leave no trace. A page comes in parts,
    wherever its blocks are nested.
    """
    events = written(_events(*_levels(blocks.filter(~F.col("type").isin(SEPARATE)))), "block-events")
    counts = events.groupBy("page_id").agg(F.count(F.lit(1)).alias("_children"))
    counts = written(counts, "block-counts")
    texts = part_texts(
        _in_order(events, counts),
        ["page_id"],
        lambda r: r["text"],
        part_rows=part_rows,
    )
    return assembled(
        texts,
        ["page_id"],
        counts=counts,
        opening=F.lit("<html><body>"),
        closing=F.lit("</body></html>"),
        part_rows=part_rows,
    ).select("page_id", "part", "body")


def database_to_html(
    pages: DataFrame, database_id: str, rank: str, part_rows: int = PART_ROWS
) -> DataFrame:
    """Database rows as an HTML table, in parts, with property columns in name order."""
    names = sorted(c for c in pages.columns if c not in (database_id, rank))
    head = "<tr>" + "".join(f"<th>{n}</th>" for n in names) + "</tr>"

    def cell(name: str) -> Column:
        value = xml_escape(F.col(name).cast("string"))
        return F.concat(F.lit("<td>"), F.coalesce(value, F.lit("<div></div>")), F.lit("</td>"))

    row = F.concat(F.lit("<tr>"), *[cell(n) for n in names], F.lit("</tr>"))
    texts = part_texts(
        placed_rows(pages.select(database_id, rank, row.alias("html")), [database_id], rank),
        [database_id],
        lambda r: r["html"],
        columns=["html"],
        part_rows=part_rows,
    )
    return assembled(
        texts,
        [database_id],
        children=pages,
        opening=F.lit(f"<table>{head}"),
        closing=F.lit("</table>"),
        part_rows=part_rows,
    ).select(database_id, "part", "body")
