"""Chunking of elements.

Rules. Elements are joined with a blank line. A chunk takes the next element while the joined text
stays within ``max_characters`` and the chunk is shorter than ``new_after_n_chars``. An element
longer than the maximum stays alone and is cut into windows of ``max_characters`` that overlap by
``overlap``. ``by_title`` also opens a chunk at each title (and, without multipage sections, at a
page change) and then merges neighbours while the merged chunk is shorter than
``combine_text_under_n_chars`` and the result fits. ``overlap_all`` prefixes each further chunk of
a record with the last ``overlap`` characters of the chunk before; room for it is kept free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.packing import pack
from sluice.operators.sequence import dense_position, ordered_lag
from sluice.session import written

SEPARATOR = "\n\n"
MAX_CHARACTERS = 500
STRATEGIES = ("basic", "by_title")

ORIG = "array<struct<pos:bigint,element_id:string,type:string,text:string>>"


def chunk_elements(
    elements: DataFrame,
    strategy: str = "basic",
    max_characters: int = MAX_CHARACTERS,
    new_after_n_chars: int | None = None,
    combine_text_under_n_chars: int | None = None,
    multipage_sections: bool = True,
    overlap: int = 0,
    overlap_all: bool = False,
    include_orig_elements: bool = True,
    **options,
) -> DataFrame:
    """ELEMENTS to chunks (ELEMENTS plus ``orig``, the elements a chunk was made from).

    An unknown strategy returns the elements unchanged.
    """
    if strategy not in STRATEGIES:
        return elements
    if overlap >= max_characters:
        raise ValueError("overlap must be smaller than max_characters")
    room = max_characters - (overlap + 1 if overlap_all and overlap else 0)
    assigned = assign_chunks(
        elements, strategy, room, new_after_n_chars, combine_text_under_n_chars,
        multipage_sections, **options,
    )
    row = F.struct("pos", "element_id", "type", "text")
    # A chunk holds at most room / 2 + 2 elements, so the collected list is bounded.
    grouped = assigned.groupBy("record_id", "chunk_start").agg(
        F.array_sort(F.collect_list(row)).alias("_rows"),
        F.min_by("metadata", "pos").alias("metadata"),
    )
    first = F.element_at("_rows", 1)
    whole = F.array_join(
        F.transform("_rows", lambda r: F.coalesce(r["text"], F.lit(""))), SEPARATOR
    )
    step = room - overlap
    n_pieces = F.when(
        F.length("whole") > room, F.ceil((F.length("whole") - overlap) / step)
    ).otherwise(1)
    pieces = F.transform(
        F.sequence(F.lit(0), (F.col("n_pieces") - 1).cast("int")),
        lambda i: F.substring(F.col("whole"), i * step + 1, F.lit(room)),
    )
    orig = F.transform(
        "_rows",
        lambda r: F.struct(
            r["pos"].alias("pos"),
            r["element_id"].alias("element_id"),
            r["type"].alias("type"),
            r["text"].alias("text"),
        ),
    )
    is_table = (F.size("_rows") == 1) & (first["type"] == "Table")
    cut = grouped.select(
        "record_id",
        "chunk_start",
        whole.alias("whole"),
        F.when(is_table, "Table").otherwise("CompositeElement").alias("type"),
        "metadata",
        orig.cast(ORIG).alias("orig"),
    ).withColumn("n_pieces", n_pieces)
    cut = cut.select(
        "record_id",
        "chunk_start",
        "type",
        "metadata",
        "orig",
        "n_pieces",
        F.posexplode(pieces).alias("piece", "text"),
    )
    if overlap_all and overlap:
        # Taken before the windows, so that those which find the chunk before carry no whole texts.
        cut = cut.withColumn("_ending", F.right("text", F.lit(overlap)))
    cut = dense_position(cut, "pos", order=["chunk_start", "piece"], **_seq(options))
    if overlap_all and overlap:
        cut = ordered_lag(cut, "_ending", "_prior", order="pos", **_seq(options))
        # Pieces of one element already overlap.
        cut = cut.withColumn(
            "text",
            F.when(
                (F.col("piece") == 0) & F.col("_prior").isNotNull(),
                F.concat("_prior", F.lit(" "), F.col("text")),
            ).otherwise(F.col("text")),
        ).drop("_prior", "_ending")
    metadata = (
        F.col("metadata")
        .withField("is_continuation", F.when(F.col("piece") > 0, F.lit(True)))
        .withField("parent_id", F.lit(None).cast("string"))
        .withField("category_depth", F.lit(None).cast("long"))
    )
    kind = F.when((F.col("type") == "Table") & (F.col("n_pieces") > 1), "TableChunk").otherwise(
        F.col("type")
    )
    chunks = cut.select(
        "record_id",
        "pos",
        F.sha2(F.concat_ws("#", "record_id", "chunk_start", "piece"), 256)
        .substr(1, 32)
        .alias("element_id"),
        kind.alias("type"),
        "text",
        metadata.alias("metadata"),
        F.lit(None).cast("array<float>").alias("embeddings"),
        "orig",
    )
    return chunks if include_orig_elements else chunks.drop("orig")


def _seq(options: dict) -> dict:
    return {k: v for k, v in options.items() if k in ("block_rows", "bounded")}


def assign_chunks(
    elements: DataFrame,
    strategy: str,
    max_characters: int,
    new_after_n_chars: int | None = None,
    combine_text_under_n_chars: int | None = None,
    multipage_sections: bool = True,
    **options,
) -> DataFrame:
    """Elements with ``chunk_start``, the position of the first element of their chunk."""
    rows = elements.withColumn(
        "_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")
    )
    starts = None
    if strategy == "by_title":
        opens = F.col("type") == "Title"
        if not multipage_sections:
            rows = rows.withColumn("_page", F.coalesce(F.col("metadata.page_number"), F.lit(-1)))
            rows = ordered_lag(rows, "_page", "_page_before", **_seq(options))
            opens = opens | (F.col("_page_before") != F.col("_page"))
        rows = rows.withColumn("_opens", F.coalesce(opens, F.lit(False)))
        starts = "_opens"
    packed = pack(
        rows,
        key="record_id",
        order="pos",
        size="_chars",
        limit=max_characters,
        soft=new_after_n_chars,
        sep=len(SEPARATOR),
        starts=starts,
        out="chunk_start",
        **options,
    )
    if strategy == "by_title" and combine_text_under_n_chars:
        packed = _combine(
            packed, max_characters, combine_text_under_n_chars, multipage_sections, options
        )
    return packed.drop("_chars", "_opens", "_page", "_page_before")


def _combine(packed: DataFrame, limit: int, under: int, multipage: bool, options: dict):
    """Merge neighbouring chunks while the open one is short and the next one fits."""
    sep = len(SEPARATOR)
    page_break = F.lit(False) if multipage else F.col("_page_before") != F.col("_page")
    heads = packed.withColumn("_break", F.coalesce(page_break, F.lit(False)))
    small = heads.groupBy("record_id", "chunk_start").agg(
        (F.sum(F.col("_chars") + sep) - sep).alias("_len"),
        F.min_by("_break", "pos").alias("_break"),
    )
    # One narrow row per chunk; written once because several steps below read it.
    small = written(small, "chunks")
    small = dense_position(small, "_nth", order="chunk_start", **_seq(options))
    merged = pack(
        small,
        key="record_id",
        order="_nth",
        size="_len",
        limit=limit,
        soft=under,
        sep=sep,
        starts="_break",
        out="_first_nth",
        **options,
    )
    firsts = small.select(
        "record_id", F.col("_nth").alias("_first_nth"), F.col("chunk_start").alias("_merged")
    )
    target = merged.join(firsts, ["record_id", "_first_nth"]).select(
        "record_id", "chunk_start", "_merged"
    )
    return (
        packed.join(target, ["record_id", "chunk_start"])
        .withColumn("chunk_start", F.col("_merged"))
        .drop("_merged")
    )
