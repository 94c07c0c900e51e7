"""Partitioning, element clean-up, sequences, chunking, embedding and HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import ids
from sluice.operators import chunk, embed, filters, hashing, html, partition, schema_fit, sequence
from sluice.operators.batching import batch_by_bytes, columnar_batch
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.registry import query
from sluice.plans.roles import table


@query(
    "partition_text",
    o.with_(
        o.LINES,
        "SELECT record_id, pos, element_id, type, text, filename, page_number, parent_id, "
        "category_depth, file_directory, lang, version FROM parts",
    ),
)
def partition_text(spark, sf):
    return roles.parts(spark, sf).select(
        "record_id",
        "pos",
        "element_id",
        "type",
        "text",
        F.col("metadata.filename").alias("filename"),
        F.col("metadata.page_number").alias("page_number"),
        F.col("metadata.parent_id").alias("parent_id"),
        F.col("metadata.category_depth").alias("category_depth"),
        F.col("metadata.file_directory").alias("file_directory"),
        F.col("metadata.languages")[0].alias("lang"),
        F.col("metadata.data_source.version").alias("version"),
    )


@query("partition_html")
def partition_html(spark, sf):
    return html.partition_html(roles.page_documents(spark, sf)).select(
        "record_id", "pos", "element_id", "type", "text"
    )


@query(
    "partition_csv_records",
    """SELECT 'part-' || p_partkey AS record_id, 'Table' AS type,
      'p_partkey p_name p_brand ' || p_partkey || ' ' || p_name || ', x ' || p_brand AS text,
      '<table><tr><td>p_partkey</td><td>p_name</td><td>p_brand</td></tr><tr><td>' || p_partkey ||
      '</td><td>' || p_name || ', x</td><td>' || p_brand || '</td></tr></table>' AS html
    FROM part""",
)
def partition_csv_records(spark, sf):
    from sluice.sources.records import rows_to_documents

    rows = table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit(", x")).alias("p_name"), "p_brand"
    )
    documents = rows_to_documents(rows, "part", "p_partkey")
    return partition.partition_csv(documents).select(
        "record_id", "type", "text", F.col("metadata.text_as_html").alias("html")
    )


_MEDIA = "CASE doc_id % 4 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'image/x-raw' WHEN 2 THEN " \
    "'text/html' END"


def _with_media(spark, sf):
    kind = F.col("doc_id") % 4
    media = (
        F.when(kind == 0, "text/plain").when(kind == 1, "image/x-raw").when(kind == 2, "text/html")
    )
    return roles.documents(spark, sf).withColumn("media", media)


@query(
    "unsupported_to_empty",
    o.with_(
        o.DOCS,
        f"SELECT identifier AS record_id, 'partition' AS step, 'unsupported file type: ' || "
        f"coalesce({_MEDIA}, '?') AS error FROM docs WHERE doc_id % 4 IN (1, 3)",
    ),
)
def unsupported_to_empty(spark, sf):
    return partition.route_media(_with_media(spark, sf))[1]


@query(
    "supported_media",
    o.with_(o.DOCS, f"SELECT identifier, {_MEDIA} AS media FROM docs WHERE doc_id % 4 IN (0, 2)"),
)
def supported_media(spark, sf):
    return partition.route_media(_with_media(spark, sf))[0].select("identifier", "media")


@query(
    "exclude_element_types",
    o.with_(
        o.LINES,
        "SELECT record_id, pos, type FROM parts WHERE type NOT IN ('Title', 'ListItem')",
    ),
)
def exclude_element_types(spark, sf):
    rows = filters.exclude_types(roles.parts(spark, sf), ["Title", "ListItem"])
    return rows.select("record_id", "pos", "type")


@query(
    "metadata_exclude",
    o.with_(
        o.LINES,
        "SELECT record_id, pos, text, 'text/plain' AS filetype, page_number, version, "
        "false AS has_languages, false AS has_url FROM parts",
    ),
)
def metadata_exclude(spark, sf):
    rows = partition.metadata_exclude(
        roles.parts(spark, sf),
        ["languages", "metadata.data_source.url", "nowhere.text", "parent_id"],
    )
    metadata = rows.schema["metadata"].dataType
    return rows.select(
        "record_id",
        "pos",
        "text",
        F.col("metadata.filetype").alias("filetype"),
        F.col("metadata.page_number").alias("page_number"),
        F.col("metadata.data_source.version").alias("version"),
        F.lit("languages" in metadata.names).alias("has_languages"),
        F.lit("url" in metadata["data_source"].dataType.names).alias("has_url"),
    )


@query(
    "metadata_include",
    o.with_(
        o.LINES,
        "SELECT record_id, pos, '{\"filename\":\"' || filename || '\",\"page_number\":' || "
        "page_number || ',\"languages\":[\"' || lang || '\"]}' AS metadata FROM parts",
    ),
)
def metadata_include(spark, sf):
    rows = partition.metadata_include(
        roles.parts(spark, sf), ["filename", "page_number", "languages"]
    )
    return rows.select("record_id", "pos", F.to_json("metadata").alias("metadata"))


@query("fields_include", o.with_(o.LINES, "SELECT record_id, pos, text, type FROM parts"))
def fields_include(spark, sf):
    return partition.postprocess(roles.parts(spark, sf), fields=["text", "type"])


@query(
    "flatten_metadata",
    o.with_(
        o.LINES,
        """SELECT record_id, pos, filename, page_number, file_directory, version AS
          data_source_version, date_created AS data_source_date_created,
          '{"protocol":"s3","remote_file_path":"' || fullpath || '"}' AS data_source_record_locator
        FROM parts""",
    ),
)
def flatten_metadata(spark, sf):
    rows = partition.flatten_metadata(roles.parts(spark, sf))
    return rows.select(
        "record_id",
        "pos",
        "filename",
        "page_number",
        "file_directory",
        "data_source_version",
        "data_source_date_created",
        F.to_json("data_source_record_locator").alias("data_source_record_locator"),
    )


@query(
    "postprocess_elements",
    o.with_(
        o.LINES,
        "SELECT record_id, pos, text, type, filename, page_number FROM parts WHERE type <> 'Title'",
    ),
)
def postprocess_elements(spark, sf):
    return partition.postprocess(
        roles.parts(spark, sf),
        element_exclude=["Title"],
        include=["filename", "page_number"],
        fields=["text", "type", "metadata"],
        flatten=True,
    )


@query(
    "should_include_embedded",
    o.with_(o.ELEMENTS, "SELECT id FROM elements WHERE embeddings IS NOT NULL"),
)
def should_include_embedded(spark, sf):
    rows = filters.has_embedding(roles.elements(spark, sf))
    return rows.select(
        ids.enhanced_element_id(F.col("element_id"), F.col("record_id")).alias("id")
    )


@query(
    "attach_data_source",
    o.with_(
        o.LINES,
        "SELECT record_id, pos, 'v' || lang AS version, fullpath AS url, date_created FROM parts "
        "WHERE lang <> 'fr'",
    ),
)
def attach_data_source(spark, sf):
    index = roles.documents(spark, sf).filter("lang <> 'fr'")
    index = index.withColumn("version", F.concat(F.lit("v"), "lang"))
    landed = partition.metadata_exclude(roles.parts(spark, sf), ["data_source"])
    return partition.attach_data_source(landed, index).select(
        "record_id",
        "pos",
        F.col("metadata.data_source.version").alias("version"),
        F.col("metadata.data_source.url").alias("url"),
        F.col("metadata.data_source.date_created").alias("date_created"),
    )


# Page numbers that come back after other pages, and missing ones.
_PAGED = """
paged AS (
  SELECT *, CASE WHEN pos % 7 = 6 THEN NULL ELSE (pos // 3) % 2 + 1 END AS page FROM parts
),
flagged AS (
  SELECT *, CASE WHEN pos > 0 AND
      lag(page) OVER (PARTITION BY record_id ORDER BY pos) IS NOT DISTINCT FROM page
    THEN 0 ELSE 1 END AS opens FROM paged
),
runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY record_id ORDER BY pos) AS run FROM flagged
),
sequenced AS (
  SELECT *, row_number() OVER (PARTITION BY record_id, run ORDER BY pos) - 1 AS seq FROM runs
)"""


def _paged(spark, sf):
    pos = F.col("pos")
    page = F.when(pos % 7 != 6, F.floor(pos / 3) % 2 + 1)
    rows = roles.parts(spark, sf)
    return rows.withColumn("page", page).withColumn(
        "metadata", F.col("metadata").withField("page_number", page)
    )


@query("seq_on_page",
       o.with_(o.LINES + "," + _PAGED, "SELECT record_id, pos, page, seq FROM sequenced"))
def seq_on_page(spark, sf):
    # Small blocks, so that runs cross block borders.
    rows = _paged(spark, sf).select("record_id", "pos", "page")
    return sequence.seq_on_page(rows, "page", "seq", block_rows=4)


_HASHED = (
    o.LINES
    + ","
    + _PAGED
    + """,
hashed AS (
  SELECT *, substr(sha256(filename || text || coalesce(page::varchar, 'None') || seq), 1, 32)
    AS new_id FROM sequenced
)"""
)


@query(
    "assign_hash_ids",
    o.with_(
        _HASHED,
        "SELECT h.record_id, h.pos, h.new_id AS element_id, p.new_id AS parent_id FROM hashed h "
        "LEFT JOIN hashed p ON p.record_id = h.record_id AND p.element_id = h.parent_id",
    ),
)
def assign_hash_ids(spark, sf):
    return hashing.assign_hash_ids(_paged(spark, sf).drop("page"), strict=True).select(
        "record_id", "pos", "element_id", F.col("metadata.parent_id").alias("parent_id")
    )


@query(
    "remap_parent_ids",
    o.with_(
        o.LINES
        + """,
olds AS (SELECT *, 'e' || pos // 2 AS old_id, 'e' || pos // 5 AS old_parent FROM parts),
news AS (SELECT record_id, old_id, max_by('n' || pos, pos) AS new_id FROM olds GROUP BY ALL)""",
        "SELECT o.record_id, o.pos, n.new_id AS parent_id FROM olds o LEFT JOIN news n "
        "ON n.record_id = o.record_id AND n.old_id = o.old_parent",
    ),
)
def remap_parent_ids(spark, sf):
    pos = F.col("pos")

    def numbered(prefix, number):
        return F.concat(F.lit(prefix), number.cast("string"))

    rows = roles.parts(spark, sf).select(
        "record_id",
        "pos",
        numbered("e", F.floor(pos / 2)).alias("old_id"),
        numbered("n", pos).alias("element_id"),
        F.struct(numbered("e", F.floor(pos / 5)).alias("parent_id")).alias("metadata"),
    )
    return hashing.remap_parent_ids(rows, strict=True).select(
        "record_id", "pos", F.col("metadata.parent_id").alias("parent_id")
    )


@query(
    "next_element_edges",
    o.with_(
        o.LINES,
        "SELECT record_id, element_id AS src, lag(element_id) OVER (PARTITION BY record_id ORDER BY"
        " pos) AS dst FROM parts QUALIFY dst IS NOT NULL",
    ),
)
def next_element_edges(spark, sf):
    rows = roles.parts(spark, sf).select("record_id", "pos", "element_id")
    chained = sequence.ordered_lag(rows, "element_id", "dst", block_rows=8)
    return chained.filter("dst IS NOT NULL").select(
        "record_id", F.col("element_id").alias("src"), "dst"
    )


# Greedy packing, element by element; all records advance together.
def _packing(source: str, fits: str, opens: str = "false", sep: int = 2) -> str:
    return f"""
packed AS (
  SELECT record_id, pos, size, 0::bigint AS start, size AS held, 1::bigint AS n
  FROM {source} WHERE pos = 0
  UNION ALL
  SELECT e.record_id, e.pos,  e.size,
    CASE WHEN {fits} AND NOT ({opens}) THEN p.start ELSE e.pos END,
    CASE WHEN {fits} AND NOT ({opens}) THEN p.held + {sep} + e.size ELSE e.size END,
    CASE WHEN {fits} AND NOT ({opens}) THEN p.n + 1 ELSE 1 END
  FROM packed p JOIN {source} e ON e.record_id = p.record_id AND e.pos = p.pos + 1
)"""


_SIZED = """
sized AS (
  SELECT record_id, pos, length(text)::bigint AS size, type, text, page_number, element_id,
    filename, type = 'Title' AS opens FROM parts
)"""


def chunk_ctes(
    limit: int,
    soft: int | None = None,
    overlap: int = 0,
    titled: bool = False,
    kept: str = "true",
) -> str:
    """CTEs up to ``chunks`` for greedy chunking of the elements that satisfy ``kept``."""
    fits = f"p.held + 2 + e.size <= {limit}" + (f" AND p.held < {soft}" if soft else "")
    step = limit - overlap
    return (
        "RECURSIVE "
        + o.LINES
        + ","
        + _SIZED.replace("FROM parts", f"FROM parts WHERE {kept}")
        + ","
        + _packing("sized", fits, "e.opens" if titled else "false")
        + f""",
grouped AS (
  SELECT record_id, p.start, string_agg(text, chr(10) || chr(10) ORDER BY p.pos) AS whole,
    count(*) AS n_elements, min(e.type) AS one_type, string_agg(e.element_id, ',' ORDER BY p.pos)
      AS members, min_by(page_number, p.pos) AS page_number
  FROM packed p JOIN sized e USING (record_id, pos) GROUP BY 1, 2
),
cut AS (
  SELECT *, CASE WHEN length(whole) > {limit} THEN
    ceil((length(whole) - {overlap}) / {step}.0)::bigint ELSE 1 END AS n_pieces FROM grouped
),
pieces AS (
  SELECT *, unnest(range(n_pieces)) AS piece FROM cut
),
chunks AS (
  SELECT *, substr(whole, piece * {step} + 1, {limit}) AS text,
    row_number() OVER (PARTITION BY record_id ORDER BY start, piece) - 1 AS pos,
    substr(sha256(record_id || '#' || start || '#' || piece), 1, 32) AS chunk_id,
    CASE WHEN n_elements = 1 AND one_type = 'Table' THEN
      CASE WHEN n_pieces > 1 THEN 'TableChunk' ELSE 'Table' END ELSE 'CompositeElement' END AS type
  FROM pieces
)"""
    )


# Content ids of the chunks.
HASHED_CHUNKS = """,
lagged AS (
  SELECT c.*, d.filename, d.date_created, d.date_modified, d.fullpath, CASE WHEN pos > 0 AND
    lag(page_number) OVER (PARTITION BY record_id ORDER BY pos) IS NOT DISTINCT FROM page_number
    THEN 0 ELSE 1 END AS opens
  FROM chunks c JOIN docs d ON d.identifier = c.record_id
),
spans AS (SELECT *, sum(opens) OVER (PARTITION BY record_id ORDER BY pos) AS run FROM lagged),
hashed AS (
  SELECT *, substr(sha256(filename || text || page_number ||
    (row_number() OVER (PARTITION BY record_id, run ORDER BY pos) - 1)), 1, 32) AS element_id
  FROM spans
)"""

_BASIC = chunk_ctes(500, 400, 20)


def _chunk_columns(chunks):
    return chunks.select(
        "record_id",
        "pos",
        "type",
        "text",
        F.coalesce("metadata.is_continuation", F.lit(False)).alias("is_continuation"),
        F.array_join(F.transform("orig", lambda e: e["element_id"]), ",").alias("members"),
    )


@query(
    "chunk_basic",
    o.with_(
        _BASIC, "SELECT record_id, pos, type, text, piece > 0 AS is_continuation, members FROM chunks"
    ),
)
def chunk_basic(spark, sf):
    chunks = chunk.chunk_elements(
        roles.parts(spark, sf), "basic", 500, new_after_n_chars=400, overlap=20,
        bounded=True,
    )
    return _chunk_columns(chunks)


@query(
    "chunk_membership",
    o.with_(
        _BASIC,
        "SELECT record_id, p.pos AS element_pos, start AS chunk_start FROM packed p",
    ),
)
def chunk_membership(spark, sf):
    # Small blocks: groups cross block borders and exit maps are composed.
    assigned = chunk.assign_chunks(
        roles.parts(spark, sf), "basic", 500, new_after_n_chars=400, block_rows=8
    )
    return assigned.select("record_id", F.col("pos").alias("element_pos"), "chunk_start")


_TITLED = (
    "RECURSIVE "
    + o.LINES
    + ","
    + _SIZED
    + ""","""
    + """
paged AS (
  SELECT * EXCLUDE (opens), type = 'Title' OR coalesce(lag(page_number) OVER (PARTITION BY record_id ORDER BY pos)
    <> page_number, false) AS opens,
    coalesce(lag(page_number) OVER (PARTITION BY record_id ORDER BY pos) <> page_number, false)
      AS new_page
  FROM sized
),"""
    + _packing("paged", "p.held + 2 + e.size <= 600", "e.opens")
    + """,
heads AS (
  SELECT record_id, start, sum(size + 2) - 2 AS size FROM packed GROUP BY 1, 2
),
nth AS (
  SELECT h.record_id, h.start AS first_pos, h.size::bigint AS size, e.new_page,
    row_number() OVER (PARTITION BY h.record_id ORDER BY h.start) - 1 AS pos
  FROM heads h JOIN paged e ON e.record_id = h.record_id AND e.pos = h.start
),
"""
    + _packing(
        "nth", "p.held + 2 + e.size <= 600 AND p.held < 200", "e.new_page"
    ).replace("packed", "merged")
    + """,
targets AS (
  SELECT m.record_id, n.first_pos AS chunk, f.first_pos AS merged_chunk
  FROM merged m JOIN nth n ON n.record_id = m.record_id AND n.pos = m.pos
  JOIN nth f ON f.record_id = m.record_id AND f.pos = m.start
)"""
)


@query(
    "chunk_by_title",
    o.with_(
        _TITLED,
        """SELECT p.record_id, t.merged_chunk AS chunk_start, count(*) AS n_elements,
          sum(p.size + 2)::bigint - 2 AS n_chars
        FROM packed p JOIN targets t ON t.record_id = p.record_id AND t.chunk = p.start
        GROUP BY 1, 2""",
    ),
)
def chunk_by_title(spark, sf):
    assigned = chunk.assign_chunks(
        roles.parts(spark, sf),
        "by_title",
        600,
        combine_text_under_n_chars=200,
        multipage_sections=False,
        bounded=True,
    )
    return assigned.groupBy("record_id", "chunk_start").agg(
        F.count(F.lit(1)).alias("n_elements"),
        (F.sum(F.length("text") + 2) - 2).alias("n_chars"),
    )


@query("chunk_passthrough", o.with_(o.LINES, "SELECT record_id, pos, element_id FROM parts"))
def chunk_passthrough(spark, sf):
    chunks = chunk.chunk_elements(roles.parts(spark, sf), "by_page_layout")
    return chunks.select("record_id", "pos", "element_id")


@query(
    "rehash_after_chunk",
    o.with_(_BASIC + HASHED_CHUNKS, "SELECT record_id, pos, element_id FROM hashed"),
)
def rehash_after_chunk(spark, sf):
    chunks = chunk.chunk_elements(
        roles.parts(spark, sf), "basic", 500, new_after_n_chars=400, overlap=20,
        bounded=True,
    )
    return hashing.assign_hash_ids(chunks).select("record_id", "pos", "element_id")


@query(
    "attach_orig_elements",
    o.with_(
        _BASIC,
        """SELECT record_id, c.pos AS chunk_pos, unnest(string_split(members, ',')) AS element_id
        FROM chunks c WHERE piece = 0""",
    ),
)
def attach_orig_elements(spark, sf):
    chunks = chunk.chunk_elements(
        roles.parts(spark, sf), "basic", 500, new_after_n_chars=400, overlap=20,
        bounded=True,
    )
    return chunks.filter("metadata.is_continuation IS NULL").select(
        "record_id", F.col("pos").alias("chunk_pos"), F.explode("orig.element_id").alias(
            "element_id"
        )
    )


@query(
    "chunk_overlap_all",
    o.with_(
        chunk_ctes(369, None, 30),
        """SELECT record_id, pos, type, CASE WHEN piece = 0 AND pos > 0 THEN
          right(lag(text) OVER (PARTITION BY record_id ORDER BY pos), 30) || ' ' || text
          ELSE text END AS text FROM chunks""",
    ),
)
def chunk_overlap_all(spark, sf):
    return chunk.chunk_elements(
        roles.parts(spark, sf), "basic", 400, overlap=30, overlap_all=True
    ).select("record_id", "pos", "type", "text")


_JSON_SIZE = "strlen('{\"type\":\"' || type || '\",\"text\":' || to_json(text)::varchar || '}')"


@query(
    "batch_by_bytes",
    o.with_(
        "RECURSIVE "
        + o.LINES
        + f""",
sized AS (SELECT record_id, pos, {_JSON_SIZE}::bigint AS size FROM parts),"""
        + _packing("sized", "p.held + e.size <= 2000 AND p.n < 5", sep=0),
        "SELECT record_id, pos, start AS batch_start, size FROM packed",
    ),
)
def batch_by_bytes_query(spark, sf):
    rows = roles.parts(spark, sf)
    size = F.octet_length(F.to_json(F.struct("type", "text"))).cast("long")
    rows = rows.select("record_id", "pos", size.alias("size"))
    return batch_by_bytes(rows, F.col("size"), 2000, 5, min_size=20)


@query(
    "columnar_batch",
    o.with_(
        "numbered AS (SELECT *, (row_number() OVER (ORDER BY c_custkey) - 1) // 64 AS batch_no "
        "FROM customer)",
        "SELECT batch_no, string_agg(c_custkey::varchar, ',' ORDER BY c_custkey) AS ids, "
        "string_agg(c_mktsegment, ',' ORDER BY c_custkey) AS segments, count(*) AS n "
        "FROM numbered GROUP BY 1",
    ),
)
def columnar_batch_query(spark, sf):
    from sluice.operators.batching import batch_by_count

    rows = batch_by_count(
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_custkey"], 64
    )
    lists = columnar_batch(rows, ["c_custkey", "c_mktsegment"], "batch_no", "c_custkey")
    return lists.select(
        "batch_no",
        F.array_join(F.transform("c_custkey", lambda k: k.cast("string")), ",").alias("ids"),
        F.array_join("c_mktsegment", ",").alias("segments"),
        F.size("c_custkey").cast("long").alias("n"),
    )


@query(
    "has_text",
    o.with_(o.LINES, "SELECT record_id, pos, pos % 3 > 0 AS has_text FROM parts"),
)
def has_text(spark, sf):
    pos = F.col("pos")
    text = F.when(pos % 6 == 0, F.lit("")).when(pos % 3 != 0, F.col("text"))
    rows = roles.parts(spark, sf)
    return rows.select("record_id", "pos", filters.has_text(text).alias("has_text"))


@query(
    "embed_elements",
    o.with_(o.LINES, "SELECT record_id, pos, 16 AS dimension, true AS is_unit FROM parts"),
)
def embed_elements(spark, sf):
    rows = embed.embed_elements(roles.parts(spark, sf), "hash", dimension=16)
    return rows.select(
        "record_id",
        "pos",
        F.size("embeddings").alias("dimension"),
        embed.is_unit_vector(F.col("embeddings")).alias("is_unit"),
    )


@query(
    "embed_dimension",
    "SELECT vec_id, len(embedding) AS dimension, round(sqrt(list_sum(list_transform(embedding, "
    "lambda x: x::double * x::double))), 6) AS norm, abs(sqrt(list_sum(list_transform(embedding, "
    "lambda x: x::double * x::double))) - 1) <= 1e-3 AS is_unit FROM embeddings",
)
def embed_dimension(spark, sf):
    rows = table(spark, sf, "embeddings")
    vector = F.col("embedding")
    return rows.select(
        "vec_id",
        embed.embed_dimension(vector).cast("long").alias("dimension"),
        F.round(embed.vector_norm(vector), 6).alias("norm"),
        embed.is_unit_vector(vector).alias("is_unit"),
    )


_PAGES = r"""
added AS (
  SELECT page_id, url, html || '<p><a class="f" href="/files/' || page_id ||
    '.pdf?a=1&amp;b=2">file</a><a href=''//cdn.example.com/x/' || page_id ||
    '.doc''>far</a><img alt="i" src="/img/' || page_id || '.png"/></p>' AS html
  FROM pages
),
hrefs AS (
  SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS site,
    unnest(list_transform(regexp_extract_all(regexp_replace(html,
      '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'),
      '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1),
      lambda h: replace(regexp_replace(h, '^["'']|["'']$', '', 'g'), '&amp;', '&'))) AS href
  FROM added
),
resolved AS (
  SELECT page_id, url, site, CASE
      WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || href
      WHEN starts_with(href, 'http') THEN href
      ELSE site || '/' || regexp_replace(href, '^/+', '') END AS link
  FROM hrefs
  WHERE NOT starts_with(href, '#') AND
    regexp_matches(regexp_extract(regexp_replace(href, '/+$', ''), '[^/]*$'), '^.+\.[^.]+\z')
),
links AS (SELECT * FROM resolved WHERE starts_with(link, site))"""


@query("extract_links", o.with_(_PAGES, "SELECT page_id, link FROM links"))
def extract_links(spark, sf):
    return html.extract_links(roles.pages(spark, sf)).select("page_id", "link")


@query(
    "embedded_file_documents",
    o.with_(
        _PAGES
        + f""",
files AS (
  SELECT *, regexp_extract(regexp_extract(link, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$') AS name,
    {o.uuid5("url")} AS parent FROM links
)""",
        f"""SELECT {o.uuid5("(link || parent)")} AS identifier, name AS filename,
          page_id || '/' || name AS fullpath, link AS url, parent AS parent_identifier FROM files""",
    ),
)
def embedded_file_documents(spark, sf):
    pages = roles.pages(spark, sf).select(
        "url",
        "html",
        ids.uuid5_dns(F.col("url")).alias("identifier"),
        F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("path"),
    )
    links = html.extract_links(pages)
    return html.embedded_file_documents(links, "identifier", "path").select(
        "identifier", "filename", "fullpath", "url", "parent_identifier"
    )


@query(
    "inline_images",
    o.with_(
        _PAGES,
        """SELECT page_id, replace(html, 'src="/img/' || page_id || '.png"',
          'src="data:image/png;base64,' || base64(encode('png' || page_id)) || '"') AS html
        FROM added""",
    ),
)
def inline_images(spark, sf):
    pages = roles.pages(spark, sf)
    fetched = html.image_references(pages, "page_id").select(
        "image_url",
        F.encode(F.concat(F.lit("png"), F.col("page_id").cast("string")), "UTF-8").alias("content"),
        "page_id",
    )
    # Two pages of one site never share an image here; the asset table is keyed by its address.
    assets = fetched.groupBy("image_url").agg(F.min("content").alias("content"))
    return html.inline_images(pages, assets, "page_id").select("page_id", "html")


@query(
    "drop_empty_results",
    o.with_(
        o.DOCS + ",\nfound AS (SELECT doc_id, unnest(string_split(body, ' ')) AS word FROM docs)",
        "SELECT doc_id, word FROM found WHERE word <> ''",
    ),
)
def drop_empty_results(spark, sf):
    rows = roles.documents(spark, sf).select(
        "doc_id", F.explode(F.split("body", " ")).alias("word")
    )
    return rows.filter(F.col("word") != "")


@query(
    "limit_messages",
    "SELECT event_id FROM events ORDER BY event_id LIMIT 100",
)
def limit_messages(spark, sf):
    return table(spark, sf, "events").select("event_id").orderBy("event_id").limit(100)


_TARGET = "record_id string, pos long, text string, metadata struct<filename:string," \
    "links:array<struct<url:string>>,coordinates:struct<system:string>>, extra string"


@query(
    "fit_to_schema",
    "SELECT c_custkey AS C_CUSTKEY, c_name, NULL::varchar AS note, c_acctbal::decimal(18,2) AS "
    "c_acctbal FROM customer",
)
def fit_to_schema(spark, sf):
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(
        "C_CUSTKEY long, c_name string, note string, c_acctbal decimal(18,2)"
    )
    return schema_fit.fit_to_schema(table(spark, sf, "customer"), target, case_sensitive=False)


@query(
    "fit_nested_schema",
    o.with_(
        o.ELEMENTS,
        """SELECT record_id, pos, text, '{"filename":"' || filename || '"' ||
          CASE WHEN links_json IS NOT NULL THEN
            ',"links":[{"url":"http://a.example/' || doc_id || '"}]' ELSE '' END ||
          CASE WHEN system IS NOT NULL THEN ',"coordinates":{"system":"PixelSpace"}' ELSE '' END
          || '}' AS metadata FROM elements""",
    ),
)
def fit_nested_schema(spark, sf):
    from pyspark.sql.types import StructType

    fitted = schema_fit.fit_nested_schema(
        roles.elements(spark, sf), StructType.fromDDL(_TARGET)
    )
    return fitted.withColumn("metadata", F.to_json("metadata"))


# What the target lacks, and how many elements have it.
_DROPPED = {
    **dict.fromkeys(
        [
            "element_id", "type", "metadata.filetype", "metadata.file_directory",
            "metadata.page_number", "metadata.languages", "metadata.last_modified", "metadata.url",
            "metadata.data_source",
        ],
        "*",
    ),
    "embeddings": "embeddings",
    "metadata.parent_id": "parent_id",
    "metadata.category_depth": "category_depth",
    "metadata.link_urls": "link_urls",
    "metadata.links.text": "links_json",
    "metadata.links.start_index": "links_json",
    "metadata.is_continuation": "is_continuation",
    "metadata.detection_class_prob": "detection_class_prob",
    "metadata.coordinates.points": "points",
    "metadata.coordinates.layout_width": "layout_width",
    "metadata.coordinates.layout_height": "layout_height",
}


@query(
    "dropped_columns_report",
    o.with_(
        o.ELEMENTS,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{path}' AS path, count({column}) AS n_rows FROM elements"
            for path, column in _DROPPED.items()
        )
        + ") WHERE n_rows > 0",
    ),
)
def dropped_columns_report(spark, sf):
    from pyspark.sql.types import StructType

    return schema_fit.dropped_columns_report(
        roles.elements(spark, sf), StructType.fromDDL(_TARGET)
    )
