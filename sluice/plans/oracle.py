"""SQL text of the roles the test tables play, for the side-by-side check."""

from __future__ import annotations

DNS = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(expr: str) -> str:
    h = f"sha1(unhex('{DNS}') || encode({expr}))"
    return (
        f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
        f"translate(substr({h},17,1), '0123456789abcdef', '89ab89ab89ab89ab') || "
        f"substr({h},18,3) || '-' || substr({h},21,12))"
    )


def js(expr: str) -> str:
    """JSON text of a string expression."""
    return f"to_json({expr})::varchar"


def iso(epoch: str) -> str:
    return f"strftime(make_timestamp(({epoch})::bigint * 1000000), '%Y-%m-%dT%H:%M:%S')"


def rfc3339(epoch: str) -> str:
    return f"strftime(make_timestamp((({epoch}) * 1000000)::bigint), '%Y-%m-%dT%H:%M:%S.%fZ')"


PATH = "'s3://corpus/' || source || '/' || lang || '/' || doc_id || '.txt'"

# One row per document.
DOCS = f"""
docs AS (
  SELECT doc_id, lang, source,
    {uuid5(f"({PATH})")} AS identifier,
    doc_id || '.txt' AS filename,
    {PATH} AS fullpath,
    source || '/' || lang || '/' || doc_id || '.txt' AS rel_path,
    sha256(text) AS version,
    (1700000000 + doc_id * 3600)::varchar || '.0' AS date_created,
    {iso("1700000060 + doc_id * 3600")} AS date_modified,
    '1750000000.5' AS date_processed,
    strlen(text)::bigint AS filesize_bytes,
    regexp_replace(text, '(?m)^([^ \\n]+)\\.$', '\\1', 'g') AS body
  FROM documents
)"""

TYPE = r"""
CASE
  WHEN regexp_matches(text, '^(?:[-*•]|[0-9]+[.)]) ') THEN 'ListItem'
  WHEN regexp_matches(text, '^[^\t]*\t[^\t]*\t') OR regexp_matches(text, '^[^|]*\|[^|]*\|')
    THEN 'Table'
  WHEN regexp_matches(text, '(?:^|[ ,])[A-Z]{2} [0-9]{5}(?:-[0-9]{4})?\z') THEN 'Address'
  WHEN regexp_matches(text, '[.!?]\z') AND
       regexp_matches(text, '^[^ ]+ +[^ ]+ +[^ ]+ +[^ ]+ +[^ ]') THEN 'NarrativeText'
  WHEN length(text) <= 80 AND regexp_matches(text, '^\pL') AND
       NOT regexp_matches(text, '[.!?,;:]\z') THEN 'Title'
  ELSE 'UncategorizedText'
END"""

# One row per element, as text partitioning makes them.
LINES = (
    DOCS
    + r""",
raw_lines AS (
  SELECT *, list_filter(
      list_transform(regexp_split_to_array(body, '[\r\n]+'),
                     lambda s: regexp_replace(s, '^[ \t\f]+|[ \t\f]+$', '', 'g')),
      lambda s: s <> '') AS lines
  FROM docs
),
lines AS (
  SELECT identifier AS record_id, doc_id, lang, source, filename, fullpath, version, date_created,
    date_modified, date_processed, filesize_bytes,
    unnest(lines) AS text, (generate_subscripts(lines, 1) - 1)::bigint AS pos
  FROM raw_lines
),
typed AS (
  SELECT *, """
    + TYPE
    + r""" AS type,
    substr(sha256(record_id || '/' || pos || ''), 1, 32) AS element_id,
    (pos // 20 + 1)::bigint AS page_number
  FROM lines
),
parts AS (
  SELECT *, CASE WHEN type <> 'Title' THEN
      last_value(CASE WHEN type = 'Title' THEN element_id END IGNORE NULLS)
        OVER (PARTITION BY record_id ORDER BY pos
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS parent_id,
    CASE WHEN type = 'Title' THEN 0 END::bigint AS category_depth,
    'text/plain' AS filetype,
    regexp_replace(fullpath, '/?[^/]*$', '') AS file_directory
  FROM typed
)"""
)

# Elements with the optional metadata the staging queries need.
ELEMENTS = (
    LINES
    + f""",
elements AS (
  SELECT *,
    {uuid5("(element_id || record_id)")} AS id,
    fullpath AS url,
    date_modified AS last_modified,
    [lang] AS languages,
    CASE WHEN pos % 3 = 0 THEN [[0.0, pos::double], [10.5, pos::double]] END AS points,
    CASE WHEN pos % 3 = 0 THEN 'PixelSpace' END AS system,
    CASE WHEN pos % 3 = 0 THEN 612.0::double END AS layout_width,
    CASE WHEN pos % 3 = 0 THEN 792.5::double END AS layout_height,
    CASE WHEN pos % 4 = 1 THEN ['http://a.example/' || doc_id, 'http://b.example/' || pos] END
      AS link_urls,
    CASE WHEN pos % 4 = 1 THEN '[{{"text":"t' || pos || '","url":"http://a.example/' || doc_id ||
      '","start_index":' || pos || '}}]' END AS links_json,
    CASE WHEN pos % 5 = 2 THEN true END AS is_continuation,
    CASE WHEN pos % 2 = 0 THEN 0.25 + (pos % 4) * 0.125 END::double AS detection_class_prob,
    CASE WHEN pos % 6 = 5 THEN NULL ELSE [((pos % 8) * 0.25)::float, 1.5::float] END AS embeddings,
    CASE WHEN pos % 6 = 5 THEN NULL ELSE
      ((pos % 8) * 0.25)::double::varchar || ',1.5' END AS vector_csv,
    '{{"protocol":"s3","remote_file_path":"' || fullpath || '"}}' AS locator_json,
    '[{{"read":{{"users":["' || lang || '"],"groups":["' || source || '"]}}}}]' AS permissions_json
  FROM parts
)"""
)

# Messages: a channel per conversation modulo 7, one thread per conversation.
MESSAGES = """
messages AS (
  SELECT 'C' || (conv_id % 7) AS channel,
    (1704067200 + conv_id * 7200 + turn * 60)::varchar || '.000100' AS ts,
    CASE WHEN turn > 0 THEN (1704067200 + conv_id * 7200)::varchar || '.000100' END AS thread_ts,
    CASE WHEN turn = 0 AND conv_id % 5 = 0 THEN
      (1704067200 + conv_id * 7200 + 200000)::varchar || '.000200' END AS latest_reply,
    CASE WHEN conv_id % 11 = 3 THEN
      (1704067200 + conv_id * 7200 + turn * 60 + 300000)::varchar || '.000300' END AS edited_ts,
    text, conv_id, turn, role
  FROM conversations
)"""

PACKAGES = (
    MESSAGES
    + """,
dated AS (
  SELECT *, strftime(make_timestamp((floor(coalesce(thread_ts, ts)::double))::bigint * 1000000),
                     '%Y-%m-%d') AS day
  FROM messages
),
packages AS (
  SELECT channel, day, sha256(channel || '-' || day) AS identifier,
    max(greatest(ts::decimal(20,6), coalesce(latest_reply::decimal(20,6), 0),
                 coalesce(edited_ts::decimal(20,6), 0)))::varchar AS version,
    min(ts::decimal(20,6))::varchar AS oldest,
    max(ts::decimal(20,6))::varchar AS latest,
    count(*) AS n_messages
  FROM dated GROUP BY channel, day
)"""
)


def with_(ctes: str, query: str) -> str:
    return f"WITH {ctes}\n{query}"
