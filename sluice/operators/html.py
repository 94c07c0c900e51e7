"""HTML pages: typed elements, links to files, inlined images."""

from __future__ import annotations

import re
from collections.abc import Sequence
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sluice.functions.ids import element_hash, uuid5_dns
from sluice.functions.paths import absolute_url, file_name, file_suffix, url_allowed, url_path
from sluice.operators.partition import data_source_struct, metadata_struct
from sluice.session import written

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_SRC = (
    r"""(?i)<img\s(?:(?:[^>"']|"[^"]*"|'[^']*')*?\s)?src\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
)

# Tags that end a text run, and the element type their text gets.
_TYPES = {
    "h1": "Title", "h2": "Title", "h3": "Title", "h4": "Title", "h5": "Title", "h6": "Title",
    "li": "ListItem", "dt": "ListItem", "dd": "ListItem", "address": "Address",
    "p": "NarrativeText", "blockquote": "NarrativeText", "pre": "NarrativeText",
}
_BREAKS = set(_TYPES) | {
    "div", "section", "article", "header", "footer", "nav", "main", "aside", "ul", "ol", "dl",
    "table", "body", "html", "br", "hr", "form", "figure", "figcaption", "title",
}
_SKIPPED = {"script", "style", "head", "noscript", "template"}


class _PageReader(HTMLParser):
    """Collects (type, text, html, depth, link urls, link texts) in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows = []
        self.kinds = []
        self.skip = 0
        self.table = 0
        self.cells = []
        self.text = []
        self.links = []
        self.href = None
        self.anchor = []

    def flush(self):
        text = " ".join("".join(self.text).split())
        links, self.text, self.links = self.links, [], []
        if not text:
            return
        tag = self.kinds[-1] if self.kinds else None
        kind = _TYPES.get(tag, "NarrativeText" if len(text.split()) >= 5 else "UncategorizedText")
        depth = int(tag[1]) - 1 if kind == "Title" else None
        self.rows.append((kind, text, None, depth, [u for u, _ in links], [t for _, t in links]))

    def handle_starttag(self, tag, attrs):
        if tag in _SKIPPED:
            self.skip += 1
        elif tag == "table":
            if not self.table:
                self.flush()
                self.cells = []
            self.table += 1
        elif self.table:
            if tag == "tr":
                self.cells.append([])
            elif tag in ("td", "th"):
                if not self.cells:
                    self.cells.append([])
                self.cells[-1].append([])
        elif tag in _BREAKS:
            self.flush()
            if tag in _TYPES:
                self.kinds.append(tag)
        if tag == "a":
            self.href = dict(attrs).get("href")
            self.anchor = []

    def handle_endtag(self, tag):
        if tag in _SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag == "a" and self.href is not None:
            self.links.append((self.href, " ".join("".join(self.anchor).split())))
            self.href = None
        elif tag == "table" and self.table:
            self.table -= 1
            if not self.table:
                self.end_table()
        elif not self.table and tag in _BREAKS:
            self.flush()
            if tag in self.kinds:
                while self.kinds.pop() != tag:
                    pass

    def handle_data(self, data):
        if self.skip:
            return
        if self.href is not None:
            self.anchor.append(data)
        if not self.table:
            self.text.append(data)
        elif self.cells and self.cells[-1]:
            self.cells[-1][-1].append(data)

    def end_table(self):
        rows = [[" ".join("".join(c).split()) for c in row] for row in self.cells]
        text = " ".join(c for row in rows for c in row if c)
        if not text:
            return

        def safe(cell):
            return cell.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")

        body = "".join(
            "<tr>" + "".join(f"<td>{safe(c)}</td>" for c in row) + "</tr>" for row in rows
        )
        links, self.links = self.links, []
        self.rows.append(
            ("Table", text, f"<table>{body}</table>", None, [u for u, _ in links],
             [t for _, t in links])
        )

    def finish(self):
        self.close()
        if self.table:
            self.end_table()
        self.flush()
        return self.rows


_PARTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("html", T.StringType()),
            T.StructField("depth", T.LongType()),
            T.StructField("link_urls", T.ArrayType(T.StringType())),
            T.StructField("link_texts", T.ArrayType(T.StringType())),
        ]
    )
)
_PARSED = T.StructType([T.StructField("parts", _PARTS), T.StructField("error", T.StringType())])
_PARSED_ARROW = to_arrow_type(_PARSED)
_FIELDS = _PARTS.elementType.names


def _parse(batch: pa.Array) -> pa.Array:
    rows = []
    for text in batch.to_pylist():
        try:
            reader = _PageReader()
            reader.feed(text or "")
            parts = [dict(zip(_FIELDS, row)) for row in reader.finish()]
            rows.append({"parts": parts, "error": None})
        except Exception as problem:  # one broken page must not fail its task
            rows.append({"parts": [], "error": f"{type(problem).__name__}: {problem}"})
    return pa.array(rows, _PARSED_ARROW)


def parse_pages(pages: DataFrame, html: str = "body") -> DataFrame:
    """Add ``parts`` (elements of the page in order) and ``error`` (null when it parsed).

    Only the HTML travels to Python.
    """
    parse = F.arrow_udf(_PARSED)(_parse).asNondeterministic()
    parsed = pages.withColumn("_parsed", parse(F.col(html))).drop(html)
    return parsed.select(
        *[c for c in parsed.columns if c != "_parsed"], "_parsed.parts", "_parsed.error"
    )


def partition_html(documents: DataFrame) -> DataFrame:
    """DOC_INDEX columns plus ``body`` (HTML) to ELEMENTS; parse failures have no elements."""
    return _page_elements(parse_pages(documents))


def partition_html_or_fail(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The elements of ``partition_html``, and (record_id, step, error) of pages that do not parse.

    The parsed pages are written once, so the HTML is read and parsed once for both.
    """
    parsed = written(parse_pages(documents), "parsed-pages")
    errors = parsed.filter("error IS NOT NULL").select(
        F.col("identifier").alias("record_id"), F.lit("partition").alias("step"), "error"
    )
    return _page_elements(parsed), errors


def _page_elements(parsed: DataFrame) -> DataFrame:
    base = parsed.select(
        F.col("identifier").alias("record_id"),
        "filename",
        "url",
        data_source_struct(parsed).alias("data_source"),
        F.posexplode("parts").alias("pos", "p"),
    )
    links = F.zip_with(
        "p.link_urls",
        "p.link_texts",
        lambda u, t: F.struct(
            t.alias("text"), u.alias("url"), F.lit(None).cast("int").alias("start_index")
        ),
    )

    def unless_empty(values: Column) -> Column:
        return F.when(F.size(values) > 0, values)

    metadata = metadata_struct(
        filename=F.col("filename"),
        filetype=F.lit("text/html"),
        page_number=F.lit(1),
        category_depth=F.col("p.depth"),
        url=F.col("url"),
        link_urls=unless_empty(F.col("p.link_urls")),
        link_texts=unless_empty(F.col("p.link_texts")),
        links=unless_empty(links),
        text_as_html=F.col("p.html"),
        data_source=F.col("data_source"),
    )
    return base.select(
        "record_id",
        F.col("pos").cast("long").alias("pos"),
        element_hash(F.col("filename"), F.col("p.text"), F.lit(1), F.col("pos")).alias("element_id"),
        F.col("p.type").alias("type"),
        F.col("p.text").alias("text"),
        metadata.alias("metadata"),
        F.lit(None).cast("array<float>").alias("embeddings"),
    )


def _attribute_values(html: Column, pattern: str) -> Column:
    visible = F.regexp_replace(html, _HIDDEN, "")
    found = F.regexp_extract_all(visible, F.lit(pattern), F.lit(1))

    def clean(raw: Column) -> Column:
        text = F.regexp_replace(raw, r"""^["']|["']$""", "")
        for entity, char in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">")):
            text = F.replace(text, F.lit(entity), F.lit(char))
        return F.replace(text, F.lit("&amp;"), F.lit("&"))

    return F.transform(found, clean)


def file_links(html: Column, page_url: Column, allow_list: Sequence[str] | None = None) -> Column:
    """Absolute URLs of links that end in a file suffix and are allowed, in page order."""
    hrefs = F.filter(
        _attribute_values(html, _HREF),
        lambda h: ~h.startswith("#") & (file_suffix(h) != ""),
    )
    absolute = F.transform(hrefs, lambda h: absolute_url(h, page_url))
    return F.filter(absolute, lambda u: url_allowed(u, page_url, allow_list))


def extract_links(
    pages: DataFrame, html: str = "html", allow_list: Sequence[str] | None = None
) -> DataFrame:
    """One row per file link: all page columns but the HTML, plus ``pos`` and ``link``."""
    rest = [c for c in pages.columns if c != html]
    found = file_links(F.col(html), F.col("url"), allow_list)
    return pages.select(*rest, F.posexplode(found).alias("pos", "link"))


def embedded_file_documents(links: DataFrame, identifier: str, nest_under: str | None = None):
    """Each link becomes a document of its own; ``nest_under`` is the parent's path column."""
    name = file_name(url_path(F.col("link")))
    path = name
    if nest_under:
        suffix = file_suffix(F.col(nest_under))
        stem = F.substring(
            F.col(nest_under), F.lit(1), F.length(nest_under) - F.length(suffix)
        )
        path = F.concat(stem, F.lit("/"), name)
    return links.select(
        uuid5_dns(F.concat(F.col("link"), F.col(identifier))).alias("identifier"),
        name.alias("filename"),
        path.alias("fullpath"),
        F.col("link").alias("url"),
        F.create_map(F.lit("parent_url"), F.col("link")).alias("record_locator"),
        name.alias("display_name"),
        F.col(identifier).alias("parent_identifier"),
    )


def image_references(pages: DataFrame, page_id: str, html: str = "html") -> DataFrame:
    """(page_id, src, image_url) of images that are not inlined yet, distinct per page."""
    sources = F.array_distinct(_attribute_values(F.col(html), _SRC))
    return (
        pages.select(page_id, "url", F.explode(sources).alias("src"))
        .filter(~F.startswith("src", F.lit("data:image/png;base64")))
        .select(page_id, "url", "src", absolute_url(F.col("src"), F.col("url")).alias("image_url"))
        .filter(url_allowed(F.col("image_url"), F.col("url")))
        .drop("url")
    )


def inline_images(
    pages: DataFrame, assets: DataFrame, page_id: str, html: str = "html"
) -> DataFrame:
    """Replace image sources by data URIs where ``assets`` (image_url, content) has the bytes."""
    fetched = image_references(pages, page_id, html).join(assets, "image_url")
    per_page = fetched.groupBy(page_id).agg(
        F.collect_list(
            F.struct(
                F.col("src"),
                F.concat(
                    F.lit("data:image/png;base64,"),
                    F.regexp_replace(F.base64("content"), "[\r\n]", ""),
                ).alias("data"),
            )
        ).alias("_images")
    )
    joined = pages.join(per_page, page_id, "left")
    # Pages without images to swap stay in the JVM.
    swapped = F.when(F.col("_images").isNotNull(), _swap_images(F.col(html), F.col("_images")))
    return joined.withColumn(html, F.coalesce(swapped, F.col(html))).drop("_images")


# Image tags, and the places where what looks like one is none.
_IMAGE = re.compile(
    r"""(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<img\b(?:[^>"']|"[^"]*"|'[^']*')*>"""
)
_SOURCE = re.compile(r"""(?is)(\ssrc\s*=\s*)(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


SWAP_ROWS = 128


@F.arrow_udf(T.StringType())
def _swap_images(pages: pa.Array, images: pa.Array) -> pa.Array:
    """The pages with the sources of their image tags replaced; sources compare unescaped."""

    def swapped(page: str | None, found: list[dict] | None) -> str | None:
        if page is None or not found:
            return page
        data = {image["src"]: image["data"] for image in found}

        def source(match: re.Match) -> str:
            written = next(g for g in match.groups()[1:] if g is not None)
            new = data.get(unescape(written))
            return match[0] if new is None else f'{match[1]}"{new}"'

        def tag(match: re.Match) -> str:
            if match[0][:4].lower() != "<img":
                return match[0]
            return _SOURCE.sub(source, match[0], count=1)

        return _IMAGE.sub(tag, page)

    # A few pages at a time: as Python texts they take several times the space of a batch.
    pieces = [
        pa.array(
            map(
                swapped,
                pages.slice(at, SWAP_ROWS).to_pylist(),
                images.slice(at, SWAP_ROWS).to_pylist(),
            ),
            pa.string(),
        )
        for at in range(0, len(pages), SWAP_ROWS)
    ]
    return pa.concat_arrays(pieces) if pieces else pa.array([], pa.string())
