"""The registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.bpe import round_trip
from sluice.llm.centroids import CLUSTERS, ROUNDS, cluster_vectors
from sluice.llm.common import table
from sluice.llm.exact_dedup import exact_dedup
from sluice.llm.fingerprints import edit_report
from sluice.llm.language_id import identify_documents, identify_pages
from sluice.llm.language_id import train as train_languages
from sluice.llm.lm_scoring import held_out_scores
from sluice.llm.mixing import mix
from sluice.llm.near_dedup import near_duplicates
from sluice.llm.prefix_trie import prefix_trie
from sluice.llm.token_counts import token_counts
from sluice.llm.token_files import token_file_round_trip
from sluice.llm.url_filters import url_verdicts
from sluice.llm.warc import archive_report

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query(
    "op4_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
    FROM d JOIN g USING (text_sha256)
    """,
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ADDRESS = (
    r"lower(regexp_extract({u}, '(?s)^(.*?)://', 1)) || '://' || "
    r"lower(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1)) || "
    r"regexp_extract({u}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"
)
CANONICAL = (
    r"'http://' || regexp_replace(lower(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1)), "
    r"'^(?:www|m)\.', '') || "
    r"regexp_replace(regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/+$', '') || "
    r"CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END"
)
# The SQL engine's patterns have no look-ahead, so parameters are filtered as a list.
KEPT_QUERY = (
    r"list_aggregate(list_filter(string_split(regexp_extract({u}, "
    r"'(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)', 1), '&'), lambda p: NOT regexp_matches(p, "
    r"'^(?:utm_[^=&]*|ref|fbclid|gclid)(?:=.*)?$')), 'string_agg', '&')"
)


@query(
    "op6_url_filters",
    f"""
    WITH RECURSIVE rules(verdict, rule, rule_host, rule_path) AS (VALUES
        ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
        ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
        ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
    p AS (
      SELECT page_id, html, CASE WHEN contains(url, '://') THEN url END AS u,
        coalesce(lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    fits AS (
      SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS own
      FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
        AND starts_with(path, rule_path)
      GROUP BY page_id),
    q AS (SELECT page_id, u, coalesce({KEPT_QUERY.format(u="u")}, '') AS kept FROM p
          WHERE u IS NOT NULL),
    forms AS (
      SELECT page_id, {ADDRESS.format(u="u")} AS a, {CANONICAL.format(u="u", q="kept")} AS b
      FROM q),
    links AS (
      SELECT p.page_id, unnest(list_concat(
        regexp_extract_all(html, '(?is)<link\\s[^>]*rel="canonical"[^>]*href="([^">]*://[^">]*)"', 1),
        regexp_extract_all(html,
          '(?is)<meta\\s[^>]*http-equiv="refresh"[^>]*content="[^">]*url=([^">]*://[^">]*)"', 1)
      )) AS t FROM p WHERE u IS NOT NULL),
    targets AS (SELECT page_id, t, coalesce({KEPT_QUERY.format(u="t")}, '') AS kept FROM links),
    edges AS (
      SELECT a, b FROM forms
      UNION SELECT a, {CANONICAL.format(u="t", q="kept")} FROM targets JOIN forms USING (page_id)),
    both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
    reach(node, root) AS (
      SELECT a, a FROM both_ways
      UNION SELECT b, root FROM reach JOIN both_ways ON node = a),
    groups AS (SELECT node, min(root) AS component FROM reach GROUP BY node),
    shared AS (
      SELECT component, CASE WHEN bool_or(own = 'allow') THEN 'allow' ELSE 'block' END AS verdict
      FROM fits JOIN forms USING (page_id) JOIN groups ON node = a GROUP BY component)
    SELECT p.page_id, host, path, rule, coalesce(own, shared.verdict, 'allow') AS verdict
    FROM p LEFT JOIN fits USING (page_id) LEFT JOIN forms USING (page_id)
      LEFT JOIN groups ON node = a LEFT JOIN shared USING (component)
    """,
)
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


@query(
    "op8_mixing",
    r"""
    WITH d AS (
      SELECT doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS size
      FROM documents),
    s AS (
      SELECT source, sum(size)::bigint AS source_size,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
      FROM d GROUP BY source),
    levels AS (
      SELECT source_size, weight,
        row_number() OVER (ORDER BY source_size::double / weight, source NULLS LAST) AS place,
        (1.5::double * (sum(source_size) OVER ())::double - 2.0::double * coalesce(sum(source_size)
            OVER (ORDER BY source_size::double / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double)
          / (sum(weight) OVER (ORDER BY source_size::double / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::double AS level
      FROM s),
    water AS (
      SELECT coalesce(arg_min(level, place) FILTER (weight * level <= 2.0 * source_size), 0.0)
        AS level
      FROM levels),
    t AS (
      SELECT source, source_size,
        CASE WHEN weight * level > 2.0 * source_size THEN 2.0::double * source_size
             ELSE weight * level END::double AS target
      FROM s, water),
    r AS (
      SELECT doc_id, size, source_size, target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END::double AS rate,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint
          / (2.0::double ^ 52) AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
      (size * (floor(rate) + (draw < rate - floor(rate))::int))::bigint AS taken
    FROM r
    """,
)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_file_round_trip(table(spark, sf_dir, "documents"), path)


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return round_trip(table(spark, sf_dir, "documents"), path)


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(table(spark, sf_dir, "documents"))


@query(
    "op1_near_dedup",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3),
          lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) END) AS shingle
      FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
    links AS (
      SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * common >= 85 * (na.n + nb.n - common)),
    reach(node, root) AS (
      SELECT doc_id, doc_id FROM documents
      UNION SELECT b, root FROM reach JOIN links ON node = a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents LEFT JOIN n USING (doc_id)
      JOIN (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node)
        USING (doc_id)
    """,
)
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(table(spark, sf_dir, "documents"))


@query(
    "op5_warc",
    """
    WITH p AS (
      SELECT page_id, strlen(coalesce(html, ''))::bigint AS payload_bytes,
        sha1(encode(coalesce(html, ''))) AS payload_digest
      FROM pages),
    w AS (
      SELECT payload_digest, max(page_id) AS winner FROM p WHERE payload_bytes >= 1000
      GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN winner IS NULL OR page_id IS NOT DISTINCT FROM winner THEN 'response'
           ELSE 'revisit' END AS record_type,
      CASE WHEN page_id IS DISTINCT FROM winner THEN winner END AS refers_to
    FROM p LEFT JOIN w USING (payload_digest)
    """,
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(table(spark, sf_dir, "pages")).drop("error")


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_documents(table(spark, sf_dir, "documents"))


@query("language_id_pages")
def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train_languages(table(spark, sf_dir, "documents"))
    return identify_pages(table(spark, sf_dir, "pages"), model)


@query("op11_token_counts")
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), path)


def _centroid_sql() -> str:
    """One pair of steps a round: vectors to their nearest centroid, centroids to their means."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
    steps = [
        """
        k AS MATERIALIZED (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v,
            row_number() OVER (ORDER BY vec_id, embedding) AS place
          FROM embeddings
          WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64)""",
        f"""
        c0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::varchar) NULLS LAST, v) - 1
            AS cluster, v AS c
          FROM k QUALIFY cluster < {CLUSTERS})""",
    ]
    for n in range(ROUNDS + 1):
        steps.append(f"""
        a{n} AS MATERIALIZED (
          SELECT place, any_value(vec_id) AS vec_id, any_value(v) AS v,
            arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
          FROM (SELECT place, vec_id, v, cluster, {distance}::bigint AS distance FROM k, c{n})
          GROUP BY place)""")
        steps.append(f"""
        m{n} AS (
          SELECT cluster, list(mean ORDER BY i) AS c FROM (
            SELECT cluster, i, floor(sum(v[i])::double / count(*))::bigint AS mean
            FROM a{n}, range(1, 65) r(i) GROUP BY cluster, i)
          GROUP BY cluster),
        c{n + 1} AS MATERIALIZED (
          SELECT cluster, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (cluster))""")
    return f"""
    WITH {",".join(steps)}
    SELECT vec_id, cluster::int AS cluster, distance,
      sum(distance) OVER (PARTITION BY cluster)::bigint AS cluster_inertia,
      sum(distance) OVER ()::bigint AS inertia,
      sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)
    """


@query("op12_centroid_clustering", _centroid_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


# CRC-32 (reflected polynomial 0xEDB88320) of a decimal number's characters, bit by bit.
CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, "
    "list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
    "lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"
)


@query(
    "op13_prefix_trie",
    f"""
    WITH t AS (
      SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
        sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
      FROM conversations WHERE conv_id IS NOT NULL),
    c AS (
      SELECT conv_id, list({{d: digest, b: bytes}} ORDER BY turn NULLS FIRST, digest) AS own
      FROM t GROUP BY conv_id),
    h AS (SELECT conv_id, own, conv_id - conv_id % 5 AS base, {CRC32} % 9 AS h FROM c),
    r AS (
      SELECT h.conv_id, list_concat(coalesce(c.own[1:h], []), h.own[h + 1:]) AS path
      FROM h LEFT JOIN c ON c.conv_id = base),
    p AS MATERIALIZED (
      SELECT conv_id, depth, len(path) = depth AS ends, coalesce(path[depth].b, 0) AS bytes,
        sha256(array_to_string(list_transform(path[1:depth], lambda x: x.d), ',')) AS node,
        sha256(array_to_string(list_transform(path[1:depth - 1], lambda x: x.d), ',')) AS up
      FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM r)),
    n AS MATERIALIZED (
      SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up,
        (count(*) - 1) * any_value(bytes) AS saved,
        sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (ends), ''))
          AS ends_sha256
      FROM p GROUP BY node, depth),
    k AS (SELECT up AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up),
    g AS (
      SELECT p.node, sum(saved)::bigint AS saved_tokens,
        count(*) FILTER (k.node IS NULL) AS n_leaves
      FROM n LEFT JOIN k USING (node) JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth
      GROUP BY p.node)
    SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs,
      coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
    FROM n LEFT JOIN k USING (node) JOIN g USING (node)
      LEFT JOIN n u ON n.depth > 0 AND u.node = n.up
    """,
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
