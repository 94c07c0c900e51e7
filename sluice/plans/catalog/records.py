"""Record stores, messages, tickets, wiki, mail and CRM payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.dates import format_rfc3339
from sluice.operators import batching, filters
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.registry import query
from sluice.plans.roles import table
from sluice.sources import blocks, drives, messages, records, tickets

_BATCHES = """
numbered AS (
  SELECT c_custkey::varchar AS id, (row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS batch_no,
    c_custkey FROM customer
),
batches AS (
  SELECT batch_no, count(*) AS n_items, min(c_custkey) AS first_id, max(c_custkey) AS last_id,
    '{' || string_agg('"' || id || '": null', ', ' ORDER BY id) || '}' AS payload
  FROM numbered GROUP BY batch_no
)"""


@query(
    "sql_index_batches",
    o.with_(
        _BATCHES,
        f"SELECT {o.uuid5('payload')} AS identifier, n_items, 'customer-c_custkey-[' || first_id "
        "|| '..' || last_id || ']' AS display_name, batch_no FROM batches",
    ),
)
def sql_index_batches(spark, sf):
    index = records.index_batches(table(spark, sf, "customer"), "customer", "c_custkey")
    return index.select("identifier", "n_items", "display_name", "batch_no")


@query(
    "batch_identity",
    o.with_(
        """items AS (
          SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 200 AS batch_no,
            '"' || o_orderkey || '": "' || o_orderstatus || '"' AS item,
            o_orderkey::varchar AS id FROM orders
        )""",
        f"""SELECT batch_no, count(*) AS n_items,
          {o.uuid5("('{' || string_agg(item, ', ' ORDER BY id) || '}')")} AS identifier
        FROM items GROUP BY batch_no""",
    ),
)
def batch_identity(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    batches = batching.batch_rows(orders, "o_orderkey", 200, version="o_orderstatus")
    return batches.select("batch_no", "n_items", "identifier")


@query(
    "batch_by_count",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, batch_no FROM (SELECT *, "
    "(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, l_returnflag) - 1) // 100 "
    "AS batch_no FROM lineitem)",
)
def batch_by_count(spark, sf):
    order = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_shipdate", "l_discount", "l_tax", "l_returnflag",
    ]
    rows = table(spark, sf, "lineitem").select(*order)
    return batching.batch_by_count(rows, order, 100).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "batch_no"
    )


@query(
    "sql_fetch_records",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey BETWEEN 200 AND 499",
)
def sql_fetch_records(spark, sf):
    customers = table(spark, sf, "customer")
    batches = records.index_batches(customers, "customer", "C_CUSTKEY".lower())
    some = batches.filter(F.col("batch_no").between(2, 4))
    return records.fetch_records(
        customers, some, "C_CUSTKEY", ["c_name", "c_acctbal", "c_custkey"]
    )


@query(
    "fetch_by_batch_ids",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def fetch_by_batch_ids(spark, sf):
    customers = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    batches = records.index_batches(customers, "customer", "c_custkey", 50)
    orders = table(spark, sf, "orders")
    return records.fetch_records(orders, batches, "o_custkey", ["o_orderkey"]).select(
        "o_orderkey", "o_custkey"
    )


@query(
    "sql_rows_to_documents",
    """
    SELECT 'part-' || p_partkey || '-' || substr(sha256('p_partkey,p_name,p_retailprice'), 1, 8)
        AS identifier,
      'part-' || p_partkey || '-' || substr(sha256('p_partkey,p_name,p_retailprice'), 1, 8)
        || '.csv' AS filename,
      'p_partkey,p_name,p_retailprice' || chr(10) || p_partkey || ',' || p_name || ',' ||
        p_retailprice || chr(10) AS body
    FROM part
    """,
)
def sql_rows_to_documents(spark, sf):
    fields = ["p_partkey", "p_name", "p_retailprice"]
    rows = table(spark, sf, "part").select(*fields)
    return records.rows_to_documents(rows, "part", "P_PARTKEY", fields).select(
        "identifier", "filename", "body"
    )


_OBJECT_ID = "lpad(hex(1700000000 + o_orderkey), 8, '0') || '0000000000000000'"


@query(
    "mongo_records_to_documents",
    f"""
    SELECT lower({_OBJECT_ID}) AS identifier, lower({_OBJECT_ID}) || '.txt' AS filename,
      o_orderstatus || chr(10) || o_custkey || chr(10) || o_orderpriority AS body,
      strftime(make_timestamp((1700000000 + o_orderkey) * 1000000), '%Y-%m-%dT%H:%M:%S')
        || '+00:00' AS date_created
    FROM orders
    """,
)
def mongo_records_to_documents(spark, sf):
    seconds = F.lit(1700000000).cast("long") + F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        F.lower(F.concat(F.lpad(F.hex(seconds), 8, "0"), F.repeat(F.lit("0"), 16))).alias("_id"),
        F.struct("o_orderstatus", F.struct("o_custkey", "o_orderpriority").alias("c")).alias("o"),
    )
    return records.mongo_documents(rows, "orders").select(
        "identifier", "filename", "body", "date_created"
    )


@query(
    "es_records_to_documents",
    """
    SELECT 'idx-' || event_id || '-' || substr(sha256('a,b'), 1, 8) AS identifier,
      event_type || chr(10) || user_id || chr(10) || 'None' || chr(10) || props AS body,
      (event_id % 5)::varchar AS version
    FROM events
    """,
)
def es_records_to_documents(spark, sf):
    hits = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("_id"),
        (F.col("event_id") % 5).alias("_version"),
        F.struct(
            "event_type",
            F.struct("user_id", F.lit(None).cast("string").alias("gone")).alias("u"),
            "props",
        ).alias("_source"),
    )
    return records.search_documents(hits, "idx", ["a", "b"]).select("identifier", "body", "version")


@query(
    "couchbase_records_to_documents",
    "SELECT 'travel-' || c_custkey AS identifier, c_name || chr(10) || c_mktsegment AS body, "
    "c_custkey::varchar AS document_id FROM customer",
)
def couchbase_records_to_documents(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return records.bucket_documents(rows, "travel", "c_custkey").select(
        "identifier", "body", F.col("record_locator")["document_id"].alias("document_id")
    )


@query(
    "astra_records_to_documents",
    "SELECT s_suppkey || '.csv' AS identifier, '_id,s_name,note' || chr(13) || chr(10) || s_suppkey"
    " || ',' || s_name || ',\"a, \"\"b\"\"\"' || chr(13) || chr(10) AS body FROM supplier",
)
def astra_records_to_documents(spark, sf):
    rows = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("_id"), "s_name", F.lit('a, "b"').alias("note")
    )
    return records.collection_documents(rows).select("identifier", "body")


@query(
    "airtable_tables_to_documents",
    f"""
    SELECT {o.uuid5("('base' || c_mktsegment)")} AS identifier, part,
      CASE WHEN part = 0 THEN ',c_name,created_time,id' || chr(10) ELSE '' END ||
      string_agg(nth || ',' || c_name || ',2024-01-01T00:00:00.000Z,rec' || c_custkey || chr(10), ''
                 ORDER BY nth) AS body
    FROM (SELECT *, nth // 100 AS part FROM (
      SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS nth
      FROM customer))
    GROUP BY c_mktsegment, part
    """,
)
def airtable_tables_to_documents(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_mktsegment",
        "c_custkey",
        F.concat(F.lit("rec"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit("2024-01-01T00:00:00.000Z").alias("created_time"),
        "c_name",
    )
    return records.table_documents(
        rows, "c_mktsegment", "base", "c_custkey", part_rows=100
    ).select("identifier", "part", "body")


@query(
    "sort_columns",
    "SELECT n_name, n_nationkey, n_regionkey FROM nation",
)
def sort_columns(spark, sf):
    from sluice.operators.schema_fit import sort_columns as by_name

    return by_name(table(spark, sf, "nation").select("n_regionkey", "n_name", "n_nationkey"))


@query(
    "messages_daily_packages",
    o.with_(
        o.PACKAGES,
        "SELECT identifier, substr(identifier, 1, 16) || '.xml' AS filename, channel, day, version,"
        " version AS date_modified, oldest AS date_created, latest, n_messages FROM packages",
    ),
)
def messages_daily_packages(spark, sf):
    index = messages.daily_packages(roles.messages(spark, sf))
    return index.select(
        "identifier",
        "filename",
        "channel",
        "day",
        "version",
        "date_modified",
        "date_created",
        F.col("record_locator")["latest"].alias("latest"),
        "n_messages",
    )


@query(
    "package_version_max",
    o.with_(
        o.MESSAGES,
        "SELECT channel, max(greatest(ts::decimal(20,6), coalesce(latest_reply::decimal(20,6), 0),"
        " coalesce(edited_ts::decimal(20,6), 0)))::varchar AS version FROM messages GROUP BY 1",
    ),
)
def package_version_max(spark, sf):
    newest = messages.newest([F.col("ts"), F.col("latest_reply"), F.col("edited_ts")])
    rows = roles.messages(spark, sf).select("channel", newest.alias("v"))
    return rows.groupBy("channel").agg(F.max("v").alias("v")).select(
        "channel", F.col("v.text").alias("version")
    )


@query(
    "recency_order",
    o.with_(
        o.PACKAGES,
        "SELECT channel, identifier, version, row_number() OVER (PARTITION BY channel ORDER BY "
        "coalesce(try_cast(version AS double), 0) DESC, identifier) AS nth FROM packages",
    ),
)
def recency_order(spark, sf):
    index = messages.daily_packages(roles.messages(spark, sf))
    return messages.recency_order(index.select("channel", "identifier", "version"), "channel")


@query(
    "messages_attachments",
    o.with_(
        o.MESSAGES,
        """SELECT sha256(channel || '-' || ts || '-F' || turn) AS identifier,
          'F' || turn || '-' || CASE WHEN turn % 2 = 0 THEN 'a_b' || conv_id ELSE 'T' || turn END
            AS filename,
          ts AS version, 'F' || turn AS file_id,
          CASE WHEN turn % 3 = 0 THEN 'https://x.example/' || turn END AS url
        FROM messages WHERE role <> 'system' AND turn > 0""",
    ),
)
def messages_attachments(spark, sf):
    rows = roles.messages(spark, sf)
    turn = F.col("turn").cast("string")
    file = F.struct(
        F.when(F.col("turn") > 0, F.concat(F.lit("F"), turn)).alias("id"),
        F.when(
            F.col("turn") % 2 == 0, F.concat(F.lit("a/\\b"), F.col("conv_id").cast("string"))
        ).alias("name"),
        F.concat(F.lit("T"), turn).alias("title"),
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("https://x.example/"), turn)).alias(
            "permalink"
        ),
        F.lit(1704067200).alias("created"),
    )
    files = F.when(F.col("role") != "system", F.array(file))
    return messages.attachments(rows.withColumn("files", files)).select(
        "identifier", "filename", "version", F.col("record_locator")["file_id"].alias("file_id"),
        "url",
    )


def _xml(expr: str) -> str:
    return f"replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(
    "thread_to_xml",
    o.with_(
        o.PACKAGES
        + f""",
threads AS (
  SELECT sha256(channel || '-' || day) AS identifier, coalesce(thread_ts, ts)::double AS root,
    '<message><text>' || string_agg({_xml("text")}, ' &lt;reply&gt; ' ORDER BY ts::double, text) ||
    '</text></message>' AS xml
  FROM dated GROUP BY 1, 2
)""",
        """SELECT identifier, 0::bigint AS part, substr(identifier, 1, 16) || '.xml' AS filename,
          '<?xml version=''1.0'' encoding=''utf-8''?>' || chr(10) || '<messages>' ||
          string_agg(xml, '' ORDER BY root DESC) || '</messages>' AS body
        FROM threads GROUP BY identifier""",
    ),
)
def thread_to_xml(spark, sf):
    return messages.package_xml(roles.messages(spark, sf))


@query(
    "channel_to_text",
    """
    WITH ranked AS (
      SELECT event_type AS channel, epoch_us(ts) AS at, props || ' ' || event_id AS text,
        row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, props || ' ' || event_id) AS n
      FROM events
    )
    SELECT channel AS identifier, channel || '.txt' AS filename,
      string_agg(text, chr(10) ORDER BY n) AS body
    FROM ranked WHERE n <= 100 GROUP BY channel
    """,
)
def channel_to_text(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("channel"),
        (F.unix_micros(roles.utc("ts")) / 1000000).alias("ts"),
        F.concat_ws(" ", "props", F.col("event_id").cast("string")).alias("text"),
    )
    return messages.channel_text(rows, messages.CHANNEL_LIMIT).select("identifier", "filename", "body")


@query(
    "cap_per_group",
    "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
    "ORDER BY ts, event_id) AS n FROM events) WHERE n <= 3",
)
def cap_per_group(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return filters.cap_per_group(rows, "user_id", [F.col("ts"), F.col("event_id")], 3).select(
        "user_id", "event_id"
    )


_LINE_ORDER = (
    "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax"
)


def _comments(spark, sf):
    order = [c.strip() for c in _LINE_ORDER.split(",")]
    rows = table(spark, sf, "lineitem")
    # Rank of a line within its order, as a ticket system would deliver comments.
    from pyspark.sql import Window

    window = Window.partitionBy("l_orderkey").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window))


_COMMENTS = f"""
comments AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS rank,
    l_suppkey, l_returnflag, l_partkey
  FROM lineitem
)"""


@query(
    "tickets_to_text",
    o.with_(
        _COMMENTS
        + """,
texts AS (
  SELECT l_orderkey, string_agg('comment' || chr(10) || 'author_id: ' || l_suppkey || chr(10) ||
    CASE WHEN l_returnflag <> 'N' THEN 'body: ' || l_returnflag || chr(10) ELSE '' END ||
    'id: ' || l_partkey || chr(10), '' ORDER BY rank) AS body
  FROM comments GROUP BY 1
)""",
        """SELECT o_orderkey::varchar AS identifier, o_orderkey || '.txt' AS filename,
          'ticket' || chr(10) || 'description: ' || o_orderpriority || chr(10) || 'id: ' ||
          o_orderkey || chr(10) || 'subject: ' || o_orderstatus || chr(10) || coalesce(body, '')
          AS body
        FROM orders LEFT JOIN texts ON l_orderkey = o_orderkey""",
    ),
)
def tickets_to_text(spark, sf):
    heads = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("subject"),
        F.col("o_orderpriority").alias("description"),
        F.lit(None).cast("string").alias("created_at"),
    )
    comments = _comments(spark, sf).select(
        F.col("l_orderkey").alias("ticket_id"),
        "rank",
        F.col("l_suppkey").alias("author_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("body"),
        F.lit(None).cast("string").alias("created_at"),
        F.col("l_partkey").alias("id"),
    )
    return tickets.tickets_to_text(heads, comments).select("identifier", "filename", "body")


# Two tickets that have all lines of even and of odd orders as comments.
_GIANT_TICKETS = f"""
nths AS (
  SELECT l_orderkey % 2 AS id, row_number() OVER (PARTITION BY l_orderkey % 2
      ORDER BY l_orderkey, {_LINE_ORDER}) - 1 AS nth,
    'comment' || chr(10) || 'author_id: ' || l_suppkey || chr(10) || 'id: ' || l_partkey || chr(10)
      AS line
  FROM lineitem
),
giants AS (
  SELECT id, nth // 4096 AS part,
    CASE WHEN nth // 4096 = 0 THEN 'ticket' || chr(10) || 'id: ' || id || chr(10) ELSE '' END ||
    string_agg(line, '' ORDER BY nth) AS body
  FROM nths GROUP BY id, nth // 4096
)"""


def _giant_tickets(spark, sf):
    none = F.lit(None).cast("string")
    order = ["l_orderkey", *[c.strip() for c in _LINE_ORDER.split(",")]]
    lines = table(spark, sf, "lineitem")
    heads = lines.select((F.col("l_orderkey") % 2).alias("id")).distinct()
    heads = heads.select("id", *[none.alias(c) for c in ("subject", "description", "created_at")])
    comments = lines.select(
        (F.col("l_orderkey") % 2).alias("ticket_id"),
        *order,
        F.col("l_suppkey").alias("author_id"),
        none.alias("body"),
        none.alias("created_at"),
        F.col("l_partkey").alias("id"),
    )
    return tickets.tickets_to_text(heads, comments, order=order)


@query(
    "parts_of_one_document",
    o.with_(
        _GIANT_TICKETS,
        "SELECT id::varchar AS identifier, part, strlen(body)::bigint AS n_bytes, "
        "sha256(body) AS digest FROM giants",
    ),
)
def parts_of_one_document(spark, sf):
    """Documents of thousands of children: one identity, in ordered parts."""
    return _giant_tickets(spark, sf).select(
        "identifier",
        "part",
        F.octet_length("body").cast("long").alias("n_bytes"),
        F.sha2("body", 256).alias("digest"),
    )


@query(
    "write_parts_as_one_file",
    o.with_(
        _GIANT_TICKETS,
        "SELECT id || '.txt' AS path, sum(strlen(body))::bigint AS n_bytes, "
        "sha256(string_agg(body, '' ORDER BY part)) AS digest FROM giants GROUP BY id",
    ),
)
def write_parts_as_one_file(spark, sf):
    """The parts of a document streamed into one file, read back whole, range by range."""
    from sluice.operators.digests import file_digests
    from sluice.operators.files import write_documents
    from sluice.plans.catalog.documents import scratch

    folder = scratch(spark, "tickets")
    documents = _giant_tickets(spark, sf).withColumnRenamed("filename", "path")
    written = write_documents(documents, folder).agg(F.sum("n_bytes")).first()[0]
    back = file_digests(spark, folder, "*.txt")
    assert written == back.agg(F.sum("n_bytes")).first()[0]
    return back


@query(
    "articles_to_html",
    """SELECT page_id::varchar AS identifier, 'articles/' || page_id || '.html' AS fullpath,
      '<body class=''Document'' >' || CASE WHEN page_id % 2 = 0 THEN '<h1>caf' || chr(233) || ' ' ||
      page_id || '</h1>' ELSE '' END || html || '</body>' AS html FROM pages""",
)
def articles_to_html(spark, sf):
    page = F.col("page_id").cast("string")
    rows = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("caf\\u00e9 "), page)).alias("title"),
        F.col("html").alias("body"),
        "url",
        F.lit("2024-01-01T00:00:00+00:00").alias("created_at"),
        F.lit("2024-01-02T00:00:00+00:00").alias("updated_at"),
    )
    return tickets.articles_to_html(rows).select("identifier", "fullpath", "html")


@query(
    "wiki_pages_to_html",
    """WITH kept AS (SELECT *, page_id % 5 AS space_id, row_number() OVER (PARTITION BY page_id % 5
        ORDER BY page_id) AS n FROM pages)
      SELECT page_id::varchar AS identifier, space_id || '/' || page_id || '.html' AS fullpath,
      '<body class=''Document'' ><h1>' || url || '</h1>' || html || '</body>' AS html,
      (page_id % 9)::varchar AS version, '1704067200.0' AS date_created,
      '1704070800.5' AS date_modified
      FROM kept WHERE n <= 20""",
)
def wiki_pages_to_html(spark, sf):
    rows = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        (F.col("page_id") % 5).alias("space_id"),
        F.col("page_id").alias("rank"),
        F.col("url").alias("title"),
        F.col("html").alias("body"),
        F.lit("2024-01-01T00:00:00.000Z").alias("created_at"),
        F.lit("2024-01-01T01:00:00.500Z").alias("version_at"),
        (F.col("page_id") % 9).alias("version_number"),
    )
    return tickets.wiki_pages_to_html(rows, 20).select(
        "identifier", "fullpath", "html", "version", "date_created", "date_modified"
    )


def _issue_sources(spark, sf):
    orders = table(spark, sf, "orders")
    key = F.concat(F.lit("K-"), F.col("o_orderkey").cast("string"))
    rows = orders.select(
        key.alias("key"), F.col("o_orderstatus").alias("status"), "o_orderkey", "o_orderpriority"
    )
    boards = rows.filter(F.col("o_orderkey") % 2 == 0).drop("o_orderpriority")
    keys = rows.filter(F.col("o_orderkey") % 3 == 0)
    projects = rows.filter(F.col("o_orderkey") % 5 < 4)
    return [boards, keys, projects]


_ISSUES = """
found AS (
  SELECT o_orderkey, o_orderstatus, 0 AS source_rank FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL SELECT o_orderkey, o_orderstatus, 1 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, o_orderstatus, 2 FROM orders WHERE o_orderkey % 5 < 4
),
issues AS (
  SELECT 'K-' || o_orderkey AS key, any_value(o_orderstatus) AS status,
    min(source_rank) AS source_rank FROM found GROUP BY o_orderkey
)"""


@query("issues_union_dedupe",
       o.with_(_ISSUES, "SELECT key, status, source_rank FROM issues WHERE status IN ('F', 'O')"))
def issues_union_dedupe(spark, sf):
    return tickets.issues_union_dedupe(_issue_sources(spark, sf), statuses=["F", "O"]).select(
        "key", "status", "source_rank"
    )


@query("first_seen_wins", o.with_(_ISSUES, "SELECT key, source_rank FROM issues"))
def first_seen_wins(spark, sf):
    sources = _issue_sources(spark, sf)
    rows = sources[0].select("key", F.lit(0).alias("source_rank"))
    for rank, source in enumerate(sources[1:], 1):
        rows = rows.unionByName(source.select("key", F.lit(rank).alias("source_rank")))
    return filters.first_seen_wins(rows, "key", ["source_rank"])


@query(
    "issues_to_text",
    o.with_(
        _COMMENTS
        + """,
texts AS (
  SELECT l_orderkey, string_agg(l_suppkey || '|||' || l_returnflag || chr(10) || chr(10) || chr(10),
    '|||' ORDER BY rank) AS comments FROM comments GROUP BY 1
),
seps AS (SELECT chr(10) || chr(10) || chr(10) AS r, chr(10) || '        ' AS i)""",
        """SELECT o_orderkey::varchar AS identifier, 'P-' || o_orderkey || '.txt' AS filename,
          'IssueID_IssueKey:' || o_orderkey || '|||P-' || o_orderkey || r || r ||
          CASE WHEN o_orderkey % 2 = 0 THEN 'ProjectID_Key:P|||Project' || r ELSE '' END || r ||
          i || 'IssueType:Order' || i || r || i || 'Status:' || o_orderstatus || i || r ||
          i || 'Priority:' || o_orderpriority || i || r || i || 'AssigneeID_Name:{}|||{}' || i || r ||
          i || 'ReporterAdr_Name:' || o_custkey || '|||{}' || i || r ||
          i || 'Labels:a|||b' || i || r || i || 'Components:' || i || r || i ||
          r || '' || r || coalesce(comments, '') || r ||
          i || 'S' || o_custkey || i || r || i || '{}' || i || r || i || '' || i || r || i AS body
        FROM orders CROSS JOIN seps LEFT JOIN texts ON l_orderkey = o_orderkey""",
    ),
)
def issues_to_text(spark, sf):
    none = F.lit(None).cast("string")
    key = F.concat(F.lit("P-"), F.col("o_orderkey").cast("string"))
    even = F.col("o_orderkey") % 2 == 0
    issues = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        key.alias("key"),
        F.when(even, F.lit("P")).alias("project_key"),
        F.when(even, F.lit("Project")).alias("project_name"),
        F.lit("Order").alias("issue_type"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        none.alias("assignee_id"),
        none.alias("assignee_name"),
        F.col("o_custkey").cast("string").alias("reporter_email"),
        none.alias("reporter_name"),
        F.array(F.lit("a"), F.lit("b")).alias("labels"),
        F.lit(None).cast("array<string>").alias("components"),
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("summary"),
        none.alias("description"),
        F.lit(None).cast("array<string>").alias("attachments"),
    )
    comments = _comments(spark, sf).select(
        F.concat(F.lit("P-"), F.col("l_orderkey").cast("string")).alias("key"),
        "rank",
        F.col("l_suppkey").alias("author"),
        F.col("l_returnflag").alias("body"),
    )
    return tickets.issues_to_text(issues, comments).select("identifier", "filename", "body")


@query(
    "issue_attachments",
    "SELECT 'P-' || l_orderkey || '-' || l_partkey AS identifier, 'P-' || l_orderkey || '/f' || "
    "l_linenumber || '.pdf' AS fullpath, l_suppkey AS filesize_bytes, '1704067200.0' AS "
    "date_created FROM lineitem",
)
def issue_attachments(spark, sf):
    file = F.struct(
        F.col("l_partkey").alias("id"),
        F.concat(F.lit("f"), F.col("l_linenumber").cast("string"), F.lit(".pdf")).alias("filename"),
        F.lit("2024-01-01T00:00:00.000+0000").alias("created"),
        F.col("l_suppkey").alias("size"),
        F.lit("https://x.example/a").alias("content"),
    )
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("P-"), F.col("l_orderkey").cast("string")).alias("key"),
        F.array(file).alias("attachments"),
    )
    return tickets.issue_attachments(rows).select(
        "identifier", "fullpath", "filesize_bytes", "date_created"
    )


@query(
    "crm_records_to_xml",
    f"""SELECT c_custkey::varchar AS identifier, 'Account/' || c_custkey || '.xml' AS fullpath,
      '<?xml version=''1.0'' encoding=''utf-8''?>' || chr(10) || '<root><item>Id: ' || c_custkey ||
      '</item><item>Info.Name: ' || {_xml("c_name || '<&>'")} || '</item><item>Info.Deep.Segment: '
      || c_mktsegment || '</item><item>Gone: None</item></root>' AS body FROM customer""",
)
def crm_records_to_xml(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("Id"),
        F.struct(
            F.concat("c_name", F.lit("<&>")).alias("Name"),
            F.struct(F.col("c_mktsegment").alias("Segment")).alias("Deep"),
        ).alias("Info"),
        F.lit(None).cast("string").alias("Gone"),
    )
    return drives.crm_records_to_xml(rows, "Account").select("identifier", "fullpath", "body")


@query(
    "crm_mails_to_eml",
    """SELECT event_id::varchar AS identifier,
      'MIME-Version: 1.0' || chr(10) || 'Date: ' || strftime(ts, '%a, %d %b %Y %H:%M:%S') ||
      ' -0000' || chr(10) || 'Message-ID: m' || event_id || chr(10) || 'Subject: ' || event_type ||
      chr(10) || 'From: None' || chr(10) || 'To: u' || user_id || '@x.example' || chr(10) ||
      'Content-Type: multipart/alternative; boundary="00000000000095c9b205eff92630"' || chr(10) ||
      '--00000000000095c9b205eff92630' || chr(10) || 'Content-Type: text/plain; charset="UTF-8"' ||
      chr(10) || props || chr(10) || '--00000000000095c9b205eff92630' || chr(10) ||
      'Content-Type: text/html; charset="UTF-8"' || chr(10) || '<p>' || props || '</p>' || chr(10) ||
      '--00000000000095c9b205eff92630--' || chr(10) AS body
    FROM events""",
)
def crm_mails_to_eml(spark, sf):
    epoch = F.unix_micros(roles.utc("ts")) / 1000000
    rows = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("Id"),
        format_rfc3339(epoch).alias("MessageDate"),
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("MessageIdentifier"),
        F.col("event_type").alias("Subject"),
        F.lit(None).cast("string").alias("FromAddress"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@x.example")).alias(
            "ToAddress"
        ),
        F.col("props").alias("TextBody"),
        F.concat(F.lit("<p>"), F.col("props"), F.lit("</p>")).alias("HtmlBody"),
    )
    return drives.crm_mails_to_eml(rows).select("identifier", "body")


@query(
    "graph_drive_items_index",
    """SELECT 'i' || s_suppkey AS identifier, 'team/n' || s_nationkey || '/' || s_name AS fullpath,
      'n' || s_nationkey || '/' || s_name AS rel_path, 'e' || s_suppkey AS version,
      '1704067200.0' AS date_modified,
      CASE WHEN s_suppkey % 3 = 0 THEN sha256('{"denied":[],"permissions":[]}') END
        AS permissions_version
    FROM supplier""",
)
def graph_drive_items_index(spark, sf):
    rows = table(spark, sf, "supplier")
    items = rows.select(
        F.concat(F.lit("i"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("/drive/root:/team/n"), F.col("s_nationkey").cast("string")).alias(
            "parent_path"
        ),
        F.concat(F.lit("e"), F.col("s_suppkey").cast("string")).alias("etag"),
        F.lit(None).cast("string").alias("created"),
        F.lit("2024-01-01T00:00:00Z").alias("modified"),
    )
    empty = F.filter(
        F.array(
            F.struct(
                F.lit("read").alias("op"),
                F.array(F.lit("")).alias("users"),
                F.array(F.lit("")).alias("groups"),
            )
        ),
        lambda p: F.lit(False),
    )
    delivered = rows.filter(F.col("s_suppkey") % 3 == 0).select(
        F.concat(F.lit("i"), F.col("s_suppkey").cast("string")).alias("doc_id"),
        empty.alias("permissions_data"),
    )
    return drives.index_graph_items(items, delivered, "team/", "u@x.example").select(
        "identifier", "fullpath", "rel_path", "version", "date_modified", "permissions_version"
    )


@query(
    "mail_index",
    """SELECT 'm' || c_custkey AS identifier,
      substr(sha256('m' || c_custkey), 1, 16) || '.eml' AS filename, c_mktsegment AS version
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name IN ('ASIA', 'EUROPE')""",
)
def mail_index(spark, sf):
    region = table(spark, sf, "region").select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.col("r_name").alias("name"),
    )
    nation = table(spark, sf, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent_id"),
        F.col("n_name").alias("name"),
    )
    mails = table(spark, sf, "customer").select(
        F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("folder_id"),
        F.col("c_mktsegment").alias("change_key"),
        F.lit("2024-01-01T00:00:00Z").alias("created"),
        F.lit("2024-01-01T00:00:00Z").alias("modified"),
        F.lit("https://x.example").alias("url"),
        F.col("c_name").alias("subject"),
    )
    return drives.index_mail(
        region.unionByName(nation), mails, ["asia", "Europe"], "u@x.example"
    ).select("identifier", "filename", "version")


def _blocks(spark, sf):
    """Orders as pages, their lines as blocks: headings, lists and nested paragraphs."""
    rows = _comments(spark, sf)
    page = F.concat(F.lit("p"), F.col("l_orderkey").cast("string"))
    name = F.concat(page, F.lit("-"), F.col("rank").cast("string"))
    kind = (
        F.when(F.col("rank") == 1, "heading_1")
        .when(F.col("l_returnflag") == "R", "bulleted_list_item")
        .otherwise("paragraph")
    )
    nested = F.col("rank") == 3
    return rows.select(
        page.alias("page_id"),
        name.alias("block_id"),
        F.when(nested, F.concat(page, F.lit("-2"))).otherwise(page).alias("parent_id"),
        "rank",
        kind.alias("type"),
        F.concat_ws(" ", F.col("l_partkey").cast("string"), F.lit("&"), "l_linestatus").alias(
            "text"
        ),
        F.lit(None).cast("array<string>").alias("cells"),
    )


@query(
    "block_tree_to_html",
    o.with_(
        f"""
lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS rank
  FROM lineitem
),
blocks AS (
  SELECT l_orderkey, rank, rank = 3 AS nested,
    CASE WHEN rank = 1 THEN 'h1' WHEN l_returnflag = 'R' THEN 'li' ELSE 'p' END AS tag,
    l_partkey || ' &amp; ' || l_linestatus AS text
  FROM lines
),
tops AS (
  SELECT *, lag(tag) OVER (PARTITION BY l_orderkey, nested ORDER BY rank) AS before,
    lead(tag) OVER (PARTITION BY l_orderkey, nested ORDER BY rank) AS after
  FROM blocks
),
rendered AS (
  SELECT l_orderkey, rank, nested,
    CASE WHEN tag = 'li' AND before IS DISTINCT FROM 'li' THEN '<ul style="margin-left: ' ||
      CASE WHEN nested THEN 10 ELSE 0 END || 'px">' ELSE '' END ||
    '<' || tag || '>' || text || '</' || tag || '>' AS opening,
    CASE WHEN tag = 'li' AND after IS DISTINCT FROM 'li' THEN '</ul>' ELSE '' END AS closing
  FROM tops
)""",
        """SELECT 'p' || r.l_orderkey AS page_id, 0::bigint AS part, '<html><body>' ||
          string_agg(r.opening || CASE WHEN r.rank = 2 AND n.rank IS NOT NULL THEN
            '<div>' || n.opening || n.closing || '</div>' ELSE '' END || r.closing,
            '' ORDER BY r.rank) || '</body></html>' AS body
        FROM rendered r LEFT JOIN (SELECT * FROM rendered WHERE nested) n
          ON r.l_orderkey = n.l_orderkey
        WHERE NOT r.nested GROUP BY r.l_orderkey""",
    ),
)
def block_tree_to_html(spark, sf):
    return blocks.blocks_to_html(_blocks(spark, sf))


@query(
    "peer_rank",
    o.with_(
        _COMMENTS,
        "SELECT 'p' || l_orderkey || '-' || rank AS block_id, "
        "CASE WHEN rank = 3 THEN 0 WHEN rank > 3 THEN rank - 2 ELSE rank - 1 END AS peer_rank, "
        "CASE WHEN rank = 3 THEN 1 ELSE count(*) OVER (PARTITION BY l_orderkey) - "
        "max(CASE WHEN rank = 3 THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) END AS "
        "peer_count, CASE WHEN rank = 3 THEN 1 ELSE 0 END AS level FROM comments",
    ),
)
def peer_rank(spark, sf):
    return blocks.block_levels(_blocks(spark, sf)).select(
        "block_id",
        F.col("peer_rank").cast("long").alias("peer_rank"),
        "peer_count",
        "level",
    )


@query(
    "database_to_html",
    """SELECT n_regionkey, 0::bigint AS part,
      '<table><tr><th>area</th><th>n_name</th></tr>' ||
      string_agg('<tr><td><div></div></td><td>' || n_name || '</td></tr>', '' ORDER BY n_nationkey)
      || '</table>' AS body FROM nation GROUP BY n_regionkey""",
)
def database_to_html(spark, sf):
    rows = table(spark, sf, "nation").select(
        "n_regionkey", "n_nationkey", "n_name", F.lit(None).cast("string").alias("area")
    )
    return blocks.database_to_html(rows, "n_regionkey", "n_nationkey")
