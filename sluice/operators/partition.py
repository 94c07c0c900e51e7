"""Documents to typed elements, and the clean-up of element rows.

Text rule (one element per non-blank line): lines are cut at line breaks, outer blanks are dropped
and the first rule that holds gives the type

* ``ListItem``: a bullet (``-``, ``*``, ``•``) or a number with ``.`` or ``)``, then a blank;
* ``Table``: at least two tabs or two ``|``;
* ``Address``: ends with a two-letter state and a five-digit code;
* ``NarrativeText``: ends with ``.``, ``!`` or ``?`` and has at least five words;
* ``Title``: at most 80 characters, starts with a letter, does not end with ``. ! ? , ; :``;
* ``UncategorizedText``: everything else.

Twenty elements form a page; the parent of an element is the last title before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice import schemas
from sluice.functions.flatten import flatten_struct
from sluice.functions.ids import element_hash
from sluice.operators.filters import exclude_types
from sluice.operators.sequence import previous_present
from sluice.session import written

ELEMENTS_PER_PAGE = 20

# Fixed value: media types the text and HTML routes read.
TEXT_MEDIA = ["text/plain", "text/markdown"]
HTML_MEDIA = ["text/html", "application/xhtml+xml"]
CSV_MEDIA = ["text/csv"]


def element_type(line: Column) -> Column:
    return (
        F.when(line.rlike(r"^(?:[-*•]|[0-9]+[.)]) "), "ListItem")
        .when(line.rlike(r"^[^\t]*\t[^\t]*\t") | line.rlike(r"^[^|]*\|[^|]*\|"), "Table")
        .when(line.rlike(r"(?:^|[ ,])[A-Z]{2} [0-9]{5}(?:-[0-9]{4})?\z"), "Address")
        .when(
            line.rlike(r"[.!?]\z") & line.rlike(r"^[^ ]+ +[^ ]+ +[^ ]+ +[^ ]+ +[^ ]"),
            "NarrativeText",
        )
        .when(
            (F.length(line) <= 80) & line.rlike(r"^\pL") & ~line.rlike(r"[.!?,;:]\z"), "Title"
        )
        .otherwise("UncategorizedText")
    )


def lines_of(body: Column) -> Column:
    trimmed = F.transform(
        F.split(body, "[\r\n]+"), lambda s: F.regexp_replace(s, "^[ \t\f]+|[ \t\f]+$", "")
    )
    return F.filter(trimmed, lambda s: s != "")


def data_source_struct(index: DataFrame) -> Column:
    """``metadata.data_source`` of the elements of an index row."""
    have = set(index.columns)
    parts = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.DATA_SOURCE.fields
    ]
    return F.struct(*parts)


def metadata_struct(**given: Column) -> Column:
    """Metadata struct with the given fields; all others are null."""
    return F.struct(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.METADATA.fields
        ]
    )


def with_line_offsets(documents: DataFrame) -> DataFrame:
    """Parts of documents with ``_offset``, the text lines in the parts before.

    Parts are written once; the offsets are sums over one number per part, and only documents of
    several parts take part in them.
    """
    documents = written(documents, "parts")
    several = documents.where("part > 0").select("identifier").distinct()
    before = Window.partitionBy("identifier").orderBy("part")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        documents.join(several, "identifier", "left_semi")
        .select("identifier", "part", F.size(lines_of(F.col("body"))).alias("_lines"))
        .select("identifier", "part", F.sum("_lines").over(before).alias("_offset"))
        .where("_offset > 0")
    )
    joined = documents.join(offsets, ["identifier", "part"], "left")
    return joined.withColumn("_offset", F.coalesce("_offset", F.lit(0)))


def partition_text(documents: DataFrame) -> DataFrame:
    """DOC_INDEX columns plus ``body`` (and optionally ``lang``) to ELEMENTS.

    The index columns travel with the row, so no join is needed to attach the data source. One
    input row bounds the rows of a record here, so the parent window is per record. With a column
    ``part``, a document is all rows of its identifier, in that order: positions go on from one part
    to the next, and windows are per block of positions.
    """
    have = set(documents.columns)
    offset = F.lit(0)
    if "part" in have:
        documents = with_line_offsets(documents)
        offset = F.col("_offset")
    language = F.array(F.col("lang")) if "lang" in have else F.lit(None)
    base = documents.select(
        F.col("identifier").alias("record_id"),
        F.struct(
            F.col("filename").alias("filename"),
            F.regexp_replace(F.col("fullpath"), "/?[^/]*$", "").alias("directory"),
            F.col("date_modified").alias("modified"),
            F.col("url").alias("url"),
            language.cast("array<string>").alias("languages"),
        ).alias("doc"),
        data_source_struct(documents).alias("data_source"),
        offset.cast("long").alias("offset"),
        F.posexplode(lines_of(F.col("body"))).alias("at", "text"),
    )
    typed = base.select(
        "record_id",
        (F.col("offset") + F.col("at")).alias("pos"),
        element_type(F.col("text")).alias("type"),
        "text",
        "doc",
        "data_source",
    )
    typed = typed.withColumn(
        "element_id",
        element_hash(F.col("record_id"), F.lit("/"), F.col("pos"), F.lit("")),
    ).withColumn("_title", F.when(F.col("type") == "Title", F.col("element_id")))
    typed = previous_present(typed, "_title", "_parent", bounded="part" not in have)
    page = F.floor(F.col("pos") / ELEMENTS_PER_PAGE) + 1
    metadata = metadata_struct(
        filename=F.col("doc.filename"),
        filetype=F.lit("text/plain"),
        file_directory=F.col("doc.directory"),
        page_number=page,
        parent_id=F.when(F.col("type") != "Title", F.col("_parent")),
        category_depth=F.when(F.col("type") == "Title", F.lit(0)),
        languages=F.col("doc.languages"),
        last_modified=F.col("doc.modified"),
        url=F.col("doc.url"),
        data_source=F.col("data_source"),
    )
    return typed.select(
        "record_id",
        "pos",
        "element_id",
        "type",
        "text",
        metadata.alias("metadata"),
        F.lit(None).cast("array<float>").alias("embeddings"),
    )


def partition_csv(documents: DataFrame) -> DataFrame:
    """CSV documents to one Table element.

    The element text is the cell text joined by blanks; ``text_as_html`` holds the table.
    """
    body = F.concat(F.regexp_replace(F.col("body"), "[\r\n]+$", ""), F.lit("\n"))
    # One token per cell with the delimiter after it; quoted cells may hold commas and breaks.
    cell = r'("[^"]*(?:""[^"]*)*"|[^,\r\n]*)(,|\r?\n)'
    tokens = F.regexp_extract_all(body, F.lit(cell), F.lit(0))

    def value(token: Column) -> Column:
        raw = F.regexp_replace(token, r"(,|\r?\n)\z", "")
        inner = F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"'))
        return F.when(raw.startswith('"'), inner).otherwise(raw)

    def escaped(text: Column) -> Column:
        amp = F.replace(text, F.lit("&"), F.lit("&amp;"))
        return F.replace(F.replace(amp, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    html_cells = F.transform(
        tokens,
        lambda t: F.concat(
            F.lit("<td>"),
            escaped(value(t)),
            F.when(t.endswith("\n"), F.lit("</td></tr><tr>")).otherwise(F.lit("</td>")),
        ),
    )
    html = F.concat(F.lit("<table><tr>"), F.array_join(html_cells, ""), F.lit("</table>"))
    html = F.replace(html, F.lit("<tr></table>"), F.lit("</table>"))
    text = F.array_join(F.filter(F.transform(tokens, value), lambda c: c != ""), " ")
    table = documents.select(
        F.col("identifier").alias("record_id"),
        F.lit(0).cast("long").alias("pos"),
        F.lit("Table").alias("type"),
        text.alias("text"),
        html.alias("html"),
        F.col("filename"),
        data_source_struct(documents).alias("data_source"),
    )
    return table.select(
        "record_id",
        "pos",
        element_hash(F.col("filename"), F.col("text"), F.lit(1), F.lit(0)).alias("element_id"),
        "type",
        "text",
        metadata_struct(
            filename=F.col("filename"),
            filetype=F.lit("text/csv"),
            page_number=F.lit(1),
            text_as_html=F.col("html"),
            data_source=F.col("data_source"),
        ).alias("metadata"),
        F.lit(None).cast("array<float>").alias("embeddings"),
    )


def is_supported(media: Column) -> Column:
    return F.coalesce(media.isin(TEXT_MEDIA + HTML_MEDIA + CSV_MEDIA), F.lit(False))


def route_media(
    documents: DataFrame, raise_unsupported: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Supported documents, and an ERRORS row for each unsupported one (or a failed job)."""
    known = is_supported(F.col("media"))
    message = F.concat(F.lit("unsupported file type: "), F.coalesce(F.col("media"), F.lit("?")))
    if raise_unsupported:
        guarded = F.when(known, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        return documents.filter(guarded), documents.limit(0).select(
            F.col("identifier").alias("record_id"), F.lit("").alias("step"), message.alias("error")
        )
    errors = documents.filter(~known).select(
        F.col("identifier").alias("record_id"), F.lit("partition").alias("step"),
        message.alias("error"),
    )
    return documents.filter(known), errors


def attach_data_source(elements: DataFrame, index: DataFrame) -> DataFrame:
    """Copy document metadata onto landed elements as ``metadata.data_source``.

    No broadcast hint: the index grows with the corpus. A record with very many elements skews
    the element side only, which adaptive skew handling splits because the index side is unique.
    """
    source = index.select(
        F.col("identifier").alias("record_id"), data_source_struct(index).alias("_source")
    )
    joined = elements.join(source, "record_id")
    return joined.withColumn(
        "metadata", F.col("metadata").withField("data_source", F.col("_source"))
    ).drop("_source")


def metadata_exclude(elements: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop metadata keys. A dotted name walks from the element; a missing path drops nothing."""
    for name in names:
        path = name if "." in name else f"metadata.{name}"
        top, *rest = path.split(".")
        if not rest:
            elements = elements.drop(top)
            continue
        node = elements.schema[top].dataType if top in elements.columns else None
        for part in rest[:-1]:
            inner = isinstance(node, T.StructType) and part in node.names
            node = node[part].dataType if inner else None
        if isinstance(node, T.StructType) and rest[-1] in node.names:
            elements = elements.withColumn(top, F.col(top).dropFields(".".join(rest)))
    return elements


def metadata_include(elements: DataFrame, names: Sequence[str]) -> DataFrame:
    present = [f.name for f in elements.schema["metadata"].dataType.fields if f.name in names]
    return elements.withColumn("metadata", F.struct(*[F.col(f"metadata.`{n}`") for n in present]))


def flatten_metadata(elements: DataFrame) -> DataFrame:
    return flatten_struct(elements, "metadata", keep=["data_source_record_locator"])


def postprocess(
    elements: DataFrame,
    element_exclude: Sequence[str] = (),
    exclude: Sequence[str] = (),
    include: Sequence[str] = (),
    fields: Sequence[str] | None = None,
    flatten: bool = False,
) -> DataFrame:
    """Type filter, metadata keys, top-level fields, flattening: in this order.

    ``record_id`` and ``pos`` identify the row and are always kept.
    """
    if exclude and include:
        raise ValueError("metadata keys can be excluded or included, not both")
    out = exclude_types(elements, element_exclude)
    if exclude:
        out = metadata_exclude(out, exclude)
    elif include:
        out = metadata_include(out, include)
    if fields is not None:
        kept = [c for c in out.columns if c in fields or c in ("record_id", "pos")]
        out = out.select(*kept)
    if flatten and "metadata" in out.columns:
        out = flatten_metadata(out)
    return out
