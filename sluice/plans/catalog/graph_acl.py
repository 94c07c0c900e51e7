"""Graph tables, closure and access lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators.incremental import classify_changes
from sluice.functions.permissions import permissions_json
from sluice.operators import access, acl, closure, graph
from sluice.plans import oracle as o
from sluice.plans import roles
from sluice.plans.catalog.elements import chunk_ctes
from sluice.plans.catalog.registry import query
from sluice.plans.roles import table

def _with_entities(spark, sf):
    docs = roles.documents(spark, sf)
    rows = roles.parts(spark, sf)
    names = docs.select(F.col("identifier").alias("record_id"), "lang", "source")
    pos = F.col("pos")

    def item(kind, column):
        return F.concat(F.lit(f'{{"type":"{kind}","entity":"'), F.col(column), F.lit('"}'))

    listed = F.concat(
        F.lit("["), item("LANG", "lang"), F.lit(","), item("SRC", "source"), F.lit("]")
    )
    whole = F.concat(
        F.lit('{"items":['),
        item("SRC", "source"),
        F.lit('],"relationships":[{"from":"'),
        F.col("source"),
        F.lit('","relationship":"written_in","to":"'),
        F.col("lang"),
        F.lit('"}]}'),
    )
    entities = (
        F.when(pos % 11 == 1, listed).when(pos % 11 == 4, whole).when(pos % 11 == 7, "not json")
    )
    return (
        rows.join(names, "record_id")
        .withColumn("metadata", F.col("metadata").withField("entities", entities))
        .drop("lang", "source")
    )


@query(
    "graph_entity_edges",
    o.with_(
        o.LINES,
        """SELECT element_id AS src, 'DocumentElement' AS src_label, lang AS dst,
          'Entity' AS dst_label, 'HAS_ENTITY' AS relationship FROM parts WHERE pos % 11 = 1
        UNION ALL SELECT element_id, 'DocumentElement', source, 'Entity', 'HAS_ENTITY'
          FROM parts WHERE pos % 11 IN (1, 4)
        UNION ALL SELECT lang, 'Entity', 'LANG', 'Entity', 'ENTITY_TYPE' FROM parts
          WHERE pos % 11 = 1
        UNION ALL SELECT source, 'Entity', 'SRC', 'Entity', 'ENTITY_TYPE' FROM parts
          WHERE pos % 11 IN (1, 4)
        UNION ALL SELECT source, 'Entity', lang, 'Entity', 'written_in' FROM parts
          WHERE pos % 11 = 4""",
    ),
)
def graph_entity_edges(spark, sf):
    return graph.entity_edges(_with_entities(spark, sf))


@query(
    "graph_nodes",
    o.with_(
        o.LINES,
        """SELECT identifier AS id, 'Document' AS label, filename AS name, date_created,
          NULL::varchar AS text FROM docs
        UNION ALL SELECT element_id, 'DocumentElement', NULL, NULL, text FROM parts
        UNION ALL SELECT DISTINCT id, 'Entity', NULL, NULL, NULL FROM (
          SELECT lang AS id FROM parts WHERE pos % 11 IN (1, 4)
          UNION ALL SELECT source FROM parts WHERE pos % 11 IN (1, 4)
          UNION ALL SELECT 'LANG' FROM parts WHERE pos % 11 = 1
          UNION ALL SELECT 'SRC' FROM parts WHERE pos % 11 IN (1, 4))""",
    ),
)
def graph_nodes(spark, sf):
    nodes = graph.graph_nodes(roles.documents(spark, sf), _with_entities(spark, sf))
    return nodes.select("id", "label", "name", "date_created", "text")


@query(
    "graph_structure_edges",
    o.with_(
        o.LINES,
        """SELECT element_id AS src, lag(element_id) OVER (PARTITION BY record_id ORDER BY pos) AS
          dst, 'NEXT_ELEMENT' AS relationship FROM parts QUALIFY dst IS NOT NULL
        UNION ALL SELECT element_id, record_id, 'PART_OF_DOCUMENT' FROM parts""",
    ),
)
def graph_structure_edges(spark, sf):
    edges = graph.structure_edges(roles.documents(spark, sf), roles.parts(spark, sf))
    return edges.select("src", "dst", "relationship")


@query(
    "graph_chunk_edges",
    o.with_(
        chunk_ctes(500)
        + """,
origins AS (
  SELECT record_id, chunk_id, unnest(string_split(members, ',')) AS element_id FROM chunks
)""",
        """SELECT chunk_id AS src, 'Chunk' AS src_label, lag(chunk_id) OVER (PARTITION BY record_id
          ORDER BY pos) AS dst, 'Chunk' AS dst_label, 'NEXT_CHUNK' AS relationship FROM chunks
          QUALIFY dst IS NOT NULL
        UNION ALL SELECT chunk_id, 'Chunk', record_id, 'Document', 'PART_OF_DOCUMENT' FROM chunks
        UNION ALL SELECT element_id, 'DocumentElement', chunk_id, 'Chunk', 'PART_OF_CHUNK'
          FROM origins
        UNION ALL SELECT element_id, 'DocumentElement', record_id, 'Document',
          'PART_OF_DOCUMENT' FROM origins""",
    ),
)
def graph_chunk_edges(spark, sf):
    from sluice.operators.chunk import chunk_elements

    chunks = chunk_elements(roles.parts(spark, sf), "basic", 500, bounded=True)
    return graph.structure_edges(roles.documents(spark, sf), chunks, bounded=True)


@query(
    "stage_graph",
    o.with_(
        o.LINES
        + """,
edges AS (
  SELECT element_id AS src, 'DocumentElement' AS src_label, record_id AS dst,
    'Document' AS dst_label, 'PART_OF_DOCUMENT' AS relationship FROM parts
  UNION ALL SELECT * FROM (
    SELECT element_id, 'DocumentElement', lag(element_id) OVER (PARTITION BY record_id ORDER BY
      pos) AS dst, 'DocumentElement', 'NEXT_ELEMENT' FROM parts QUALIFY dst IS NOT NULL)
),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY relationship, src_label, dst_label ORDER BY src, dst)
    - 1) // 1000 AS batch_no FROM edges
)""",
        """SELECT relationship, src_label, dst_label, batch_no, count(*) AS n, min(src) AS first,
          max(src) AS last FROM placed GROUP BY ALL""",
    ),
)
def stage_graph(spark, sf):
    edges = graph.structure_edges(roles.documents(spark, sf), roles.parts(spark, sf), bounded=True)
    kind = ["relationship", "src_label", "dst_label"]
    batches = graph.merge_batches(edges, kind, ["src", "dst"])
    return batches.groupBy(*kind, "batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("src").alias("first"), F.max("src").alias("last")
    )


_MERGE = (
    o.LINES
    + """,
nodes AS (
  SELECT identifier AS id, 'Document' AS label, filename AS name, lang AS text FROM docs
),
newer AS (
  SELECT identifier AS id, 'Document' AS label, 'new-' || filename AS name, NULL::varchar AS text
  FROM docs WHERE doc_id % 3 = 0
)"""
)


@query(
    "graph_merge",
    o.with_(
        _MERGE,
        "SELECT n.id, n.label, coalesce(m.name, n.name) AS name, coalesce(m.text, n.text) AS text "
        "FROM nodes n LEFT JOIN newer m USING (id)",
    ),
)
def graph_merge(spark, sf):
    docs = roles.documents(spark, sf)
    nodes = docs.select(
        F.col("identifier").alias("id"),
        F.lit("Document").alias("label"),
        F.col("filename").alias("name"),
        F.col("lang").alias("text"),
    )
    newer = docs.filter(F.col("doc_id") % 3 == 0).select(
        F.col("identifier").alias("id"),
        F.lit("Document").alias("label"),
        F.concat(F.lit("new-"), "filename").alias("name"),
        F.lit(None).cast("string").alias("text"),
    )
    return graph.merge_nodes(nodes, newer)


@query(
    "graph_delete_record",
    o.with_(
        o.LINES,
        """SELECT 'node' AS kind, identifier AS id FROM docs WHERE doc_id % 4 > 0
        UNION ALL SELECT 'node', element_id FROM parts WHERE doc_id % 4 > 0
        UNION ALL SELECT 'edge', element_id FROM parts WHERE doc_id % 4 > 0
        UNION ALL SELECT 'edge', element_id FROM parts WHERE doc_id % 4 > 0 AND pos > 0""",
    ),
)
def graph_delete_record(spark, sf):
    docs, rows = roles.documents(spark, sf), roles.parts(spark, sf)
    nodes = graph.graph_nodes(docs, rows)
    edges = graph.structure_edges(docs, rows, bounded=True)
    gone = docs.filter(F.col("doc_id") % 4 == 0).select(F.col("identifier").alias("record_id"))
    kept_nodes, kept_edges = graph.delete_record(nodes, edges, gone)
    return kept_nodes.select(F.lit("node").alias("kind"), "id").unionByName(
        kept_edges.select(F.lit("edge").alias("kind"), F.col("src").alias("id"))
    )


_FOLDERS = """
folders AS (
  SELECT 'R' || r_regionkey AS child, 'root' AS parent, r_name AS name FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_name FROM customer
)"""


def _folders(spark, sf):
    def keyed(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    region = table(spark, sf, "region").select(
        keyed("R", "r_regionkey").alias("child"),
        F.lit("root").alias("parent"),
        F.col("r_name").alias("name"),
    )
    nation = table(spark, sf, "nation").select(
        keyed("N", "n_nationkey").alias("child"),
        keyed("R", "n_regionkey").alias("parent"),
        F.col("n_name").alias("name"),
    )
    customer = table(spark, sf, "customer").select(
        keyed("C", "c_custkey").alias("child"),
        keyed("N", "c_nationkey").alias("parent"),
        F.col("c_name").alias("name"),
    )
    return region.unionByName(nation).unionByName(customer)


@query(
    "tree_closure",
    "WITH RECURSIVE "
    + _FOLDERS
    + """,
reach AS (
  SELECT DISTINCT parent AS root, parent AS node, 0 AS depth FROM folders
  UNION ALL SELECT r.root, f.child, r.depth + 1 FROM reach r JOIN folders f ON f.parent = r.node
)
SELECT root, node, depth FROM reach""",
)
def tree_closure(spark, sf):
    return closure.tree_closure(_folders(spark, sf))


@query(
    "tree_intervals",
    "WITH RECURSIVE "
    + _FOLDERS
    + """,
reach AS (
  SELECT child AS root, child AS node, 0 AS depth FROM folders
  UNION ALL SELECT r.root, f.child, r.depth + 1 FROM reach r JOIN folders f ON f.parent = r.node
),
sizes AS (SELECT root AS id, count(*) AS n_nodes FROM reach GROUP BY 1)
SELECT child AS id, n_nodes, CASE substr(child, 1, 1) WHEN 'R' THEN 0 WHEN 'N' THEN 1 ELSE 2
    END::bigint AS depth,
  CASE substr(child, 1, 1) WHEN 'R' THEN child ELSE (SELECT max(r.root) FROM reach r
    WHERE r.node = child AND r.root LIKE 'R%') END AS root
FROM folders JOIN sizes ON id = child""",
)
def tree_intervals(spark, sf):
    """Subtree sizes, depths and roots from the labels of a tour of every tree."""
    nodes = _folders(spark, sf).select(F.col("child").alias("id"), F.col("parent").alias("parent_id"))
    size = ((F.col("leave") - F.col("enter") + 1) / 2).cast("long")
    return closure.tree_intervals(nodes).select("id", size.alias("n_nodes"), "depth", "root")


@query(
    "ancestor_tests",
    """SELECT 'R' || l_linenumber % 5 AS above, 'C' || o_custkey AS below,
      l_linenumber % 5 = n_regionkey AS is_above
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
      JOIN nation ON n_nationkey = c_nationkey""",
)
def ancestor_tests(spark, sf):
    """For every line: is a region above the customer of its order? No closure is made."""
    nodes = _folders(spark, sf).select(F.col("child").alias("id"), F.col("parent").alias("parent_id"))
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    pairs = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("R"), (F.col("l_linenumber") % 5).cast("string")).alias("above"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("below"),
    )
    return closure.ancestor_tests(pairs, closure.tree_intervals(nodes))


@query(
    "node_paths",
    o.with_(
        _FOLDERS,
        """SELECT a.child AS id, a.name AS path FROM folders a WHERE parent = 'root'
        UNION ALL SELECT b.child, a.name || '/' || b.name FROM folders a JOIN folders b
          ON b.parent = a.child WHERE a.parent = 'root'
        UNION ALL SELECT c.child, a.name || '/' || b.name || '/' || c.name FROM folders a
          JOIN folders b ON b.parent = a.child JOIN folders c ON c.parent = b.child
          WHERE a.parent = 'root'""",
    ),
)
def node_paths(spark, sf):
    rows = _folders(spark, sf).select(
        F.col("child").alias("id"), F.col("parent").alias("parent_id"), "name"
    )
    return closure.node_paths(rows)


# Grants: an order is a document, its lines are grants to suppliers.
_DRIVE_ROLES = """(CASE l_linenumber % 7 WHEN 0 THEN 'owner' WHEN 1 THEN 'reader' WHEN 2 THEN 'writer'
  WHEN 3 THEN 'commenter' WHEN 4 THEN 'fileOrganizer' WHEN 5 THEN 'organizer' ELSE 'unknown' END)"""
_KIND = "(CASE l_returnflag WHEN 'A' THEN 'user' WHEN 'N' THEN 'group' ELSE 'anyone' END)"


def _grants(spark, sf):
    number = F.col("l_linenumber") % 7
    role = (
        F.when(number == 0, "owner")
        .when(number == 1, "reader")
        .when(number == 2, "writer")
        .when(number == 3, "commenter")
        .when(number == 4, "fileOrganizer")
        .when(number == 5, "organizer")
        .otherwise("unknown")
    )
    kind = (
        F.when(F.col("l_returnflag") == "A", "user")
        .when(F.col("l_returnflag") == "N", "group")
        .otherwise("anyone")
    )
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        kind.alias("type"),
        role.alias("role"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("id"),
    )


_ROLE_TABLE = """
role_ops(role, op) AS (VALUES ('owner','read'),('owner','update'),('owner','delete'),
  ('organizer','read'),('organizer','update'),('organizer','delete'),('fileOrganizer','read'),
  ('fileOrganizer','update'),('writer','read'),('writer','update'),('commenter','read'),
  ('reader','read'))"""


def _nested_json(grants: str, key: str = "doc_id") -> str:
    """Nested permissions as JSON per document from (doc_id, op, kind, id) rows."""

    def ids(op: str, kind: str) -> str:
        return (
            f"coalesce('[' || string_agg(DISTINCT CASE WHEN op = '{op}' AND kind = '{kind}' THEN "
            f"'\"' || id || '\"' END, ',' ORDER BY CASE WHEN op = '{op}' AND kind = '{kind}' THEN "
            f"'\"' || id || '\"' END) || ']', '[]')"
        )

    items = " || ',' || ".join(
        f"'{{\"{op}\":{{\"users\":' || {ids(op, 'user')} || ',\"groups\":' || {ids(op, 'group')} "
        "|| '}}'"
        for op in ("read", "update", "delete")
    )
    return f"SELECT {key}, '[' || {items} || ']' AS permissions FROM {grants} GROUP BY {key}"


_DRIVE = (
    _ROLE_TABLE
    + f""",
granted AS (
  SELECT l_orderkey AS doc_id, op, {_KIND} AS kind, 's' || l_suppkey AS id
  FROM lineitem JOIN role_ops ON role = {_DRIVE_ROLES} WHERE {_KIND} <> 'anyone'
)"""
)


# Orders whose lines deliver access, with or without a grant that counts.
_DELIVERED = """(SELECT * FROM granted
  UNION ALL SELECT DISTINCT l_orderkey, NULL, NULL, NULL FROM lineitem)"""


@query("acl_drive", o.with_(_DRIVE, _nested_json(_DELIVERED)))
def acl_drive(spark, sf):
    permissions = _grants(spark, sf)
    nested = acl.nest_grants(acl.drive_grants(permissions), permissions.select("doc_id"))
    return nested.select("doc_id", permissions_json(F.col("permissions_data")).alias("permissions"))


@query(
    "group_acl",
    o.with_(_DRIVE, _nested_json("(SELECT id AS doc_id, op, kind, doc_id::varchar AS id FROM granted)")),
)
def group_acl(spark, sf):
    # The roles turned round: what a principal may do with which orders.
    grants = acl.drive_grants(_grants(spark, sf)).select(
        F.col("principal_id").alias("doc_id"),
        "op",
        "principal_type",
        F.col("doc_id").cast("string").alias("principal_id"),
    )
    nested = acl.nest_grants(grants)
    return nested.select("doc_id", permissions_json(F.col("permissions_data")).alias("permissions"))


@query(
    "mapping_join",
    o.with_(
        _ROLE_TABLE,
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, op FROM lineitem JOIN role_ops ON "
        f"role = {_DRIVE_ROLES}",
    ),
)
def mapping_join(spark, sf):
    lines = table(spark, sf, "lineitem")
    number = F.col("l_linenumber") % 7
    role = F.lit(None).cast("string")
    names = ["owner", "reader", "writer", "commenter", "fileOrganizer", "organizer", "unknown"]
    for i, name in enumerate(names):
        role = F.when(number == i, F.lit(name)).otherwise(role)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.explode(acl.role_operations(role, acl.DRIVE_ROLES)).alias("op"),
    )


_GRAPH = """
given AS (
  SELECT l_orderkey AS doc_id, unnest(CASE l_linenumber % 4 WHEN 0 THEN ['read', 'update', 'delete']
      WHEN 1 THEN ['read', 'update'] WHEN 2 THEN ['read'] ELSE [] END) AS op,
    l_suppkey, l_partkey, l_returnflag
  FROM lineitem
),
granted AS (
  SELECT doc_id, op, 'user' AS kind, 'v2-' || l_suppkey AS id FROM given WHERE l_returnflag = 'A'
  UNION ALL SELECT doc_id, op, 'group', 'v1-' || l_suppkey FROM given WHERE l_returnflag = 'N'
  UNION ALL SELECT doc_id, op, 'user', 'many-' || l_partkey FROM given
)"""


@query("acl_graph", o.with_(_GRAPH, _nested_json(_DELIVERED)))
def acl_graph(spark, sf):
    lines = table(spark, sf, "lineitem")
    number = F.col("l_linenumber") % 4
    roles_of = (
        F.when(number == 0, F.array(F.lit("Owner")))
        .when(number == 1, F.array(F.lit("write"), F.lit("sp.View Only")))
        .when(number == 2, F.array(F.lit("SP.Restricted Read"), F.lit("sp.limited access")))
        .otherwise(F.array(F.lit("sp.limited access"), F.lit("something")))
    )

    def identity(prefix, kind):
        name = F.concat(F.lit(prefix), F.col("l_suppkey").cast("string"))
        none = F.lit(None).cast("struct<id:string>")
        user = F.struct(name.alias("id")) if kind == "user" else none
        group = F.struct(name.alias("id")) if kind == "group" else none
        return F.struct(user.alias("user"), group.alias("group"))

    flag = F.col("l_returnflag")
    v1 = F.when(flag != "R", identity("v1-", "group"))
    v2 = F.when(flag == "A", identity("v2-", "user"))
    many = F.array(
        F.struct(
            F.struct(F.concat(F.lit("many-"), F.col("l_partkey").cast("string")).alias("id")).alias(
                "user"
            ),
            F.lit(None).cast("struct<id:string>").alias("group"),
        )
    )
    none = F.lit(None).cast(
        "array<struct<user:struct<id:string>,group:struct<id:string>>>"
    )
    permissions = lines.select(
        F.col("l_orderkey").alias("doc_id"),
        roles_of.alias("roles"),
        v2.alias("v2"),
        v1.alias("v1"),
        none.alias("v2_many"),
        many.alias("v1_many"),
    )
    nested = acl.nest_grants(acl.graph_grants(permissions), permissions.select("doc_id"))
    return nested.select("doc_id", permissions_json(F.col("permissions_data")).alias("permissions"))


_WIKI = """
pages AS (SELECT o_orderkey AS doc_id, o_custkey % 20 AS space_id FROM orders),
restrictions AS (
  SELECT l_orderkey AS doc_id, CASE WHEN l_linenumber % 2 = 0 THEN 'read' ELSE 'update' END AS op,
    'user' AS kind, 's' || l_suppkey AS id FROM lineitem WHERE l_returnflag = 'R'
),
space AS (
  SELECT c_custkey % 20 AS space_id, CASE c_custkey % 3 WHEN 0 THEN 'read' WHEN 1 THEN 'administer'
    ELSE 'delete' END AS operation, CASE WHEN c_custkey % 3 = 2 THEN 'page' ELSE 'space' END AS
    target, 'group' AS kind, 'g' || c_custkey % 40 AS id FROM customer
),
flags AS (
  SELECT p.doc_id, p.space_id, coalesce(max(op = 'read'), false) AS vr,
    coalesce(max(op = 'update'), false) AS er
  FROM pages p LEFT JOIN restrictions r USING (doc_id) GROUP BY 1, 2
),
first AS (
  SELECT doc_id, op, kind, id FROM restrictions
  UNION SELECT doc_id, 'read', kind, id FROM restrictions WHERE op = 'update'
  UNION SELECT doc_id, 'read', kind, id FROM flags JOIN space USING (space_id)
    WHERE NOT vr AND target = 'space' AND operation IN ('read', 'administer')
  UNION SELECT doc_id, 'update', kind, id FROM flags JOIN space USING (space_id)
    WHERE NOT vr AND NOT er AND target = 'space' AND operation = 'administer'
),
granted AS (
  SELECT * FROM first
  UNION SELECT f.doc_id, 'delete', s.kind, s.id FROM flags f JOIN space s USING (space_id)
    JOIN first r ON r.doc_id = f.doc_id AND r.op = 'read' AND r.kind = s.kind AND r.id = s.id
    WHERE s.target = 'page' AND s.operation = 'delete'
)"""


def _wiki(spark, sf):
    pages = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"), (F.col("o_custkey") % 20).alias("space_id")
    )
    restrictions = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("doc_id"),
        F.when(F.col("l_linenumber") % 2 == 0, "read").otherwise("update").alias("op"),
        F.lit("user").alias("principal_type"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("principal_id"),
    )
    kind = F.col("c_custkey") % 3
    space = table(spark, sf, "customer").select(
        (F.col("c_custkey") % 20).alias("space_id"),
        F.when(kind == 0, "read").when(kind == 1, "administer").otherwise("delete").alias(
            "operation"
        ),
        F.when(kind == 2, "page").otherwise("space").alias("target_type"),
        F.lit("group").alias("principal_type"),
        F.concat(F.lit("g"), (F.col("c_custkey") % 40).cast("string")).alias("principal_id"),
    )
    return acl.wiki_access(restrictions, space, pages)


@query("acl_wiki", o.with_(_WIKI, _nested_json("granted")))
def acl_wiki(spark, sf):
    nested = acl.nest_access(_wiki(spark, sf))
    return nested.select("doc_id", permissions_json(F.col("permissions_data")).alias("permissions"))


@query(
    "page_over_space_acl",
    o.with_(_WIKI, "SELECT doc_id, op, kind AS principal_type, id AS principal_id FROM granted"),
)
def page_over_space_acl(spark, sf):
    return acl.access_rows(_wiki(spark, sf))


# Box: regions and nations are folders, customers are files.
_BOX = """
collabs AS (
  SELECT 'R' || s_nationkey % 5 AS folder_id, CASE WHEN s_suppkey % 9 = 0 THEN 'pending' ELSE
      'accepted' END AS status, s_suppkey % 8 = 1 AS hidden,
    CASE s_suppkey % 4 WHEN 0 THEN 'owner' WHEN 1 THEN 'viewer' WHEN 2 THEN 'editor' ELSE
      'previewer' END AS role,
    CASE WHEN s_suppkey % 3 = 0 THEN 'group' ELSE 'user' END AS kind, 's' || s_suppkey AS id,
    CASE WHEN s_suppkey % 6 = 0 THEN 'all_users_group' END AS group_type
  FROM supplier
  UNION ALL
  SELECT 'C' || c_custkey, 'accepted', false, 'viewer uploader', 'user', 'own' || c_custkey, NULL
  FROM customer WHERE c_custkey % 2 = 0
),
folder_grants AS (
  SELECT folder_id, unnest(CASE WHEN role IN ('owner', 'editor') THEN ['read', 'update', 'delete']
    WHEN role IN ('viewer', 'viewer uploader') THEN ['read'] ELSE [] END) AS op, kind, id
  FROM collabs WHERE status = 'accepted' AND NOT hidden AND
    NOT (kind = 'group' AND coalesce(group_type, '') = 'all_users_group')
),
ancestors AS (
  SELECT 'C' || c_custkey AS doc_id, unnest(['C' || c_custkey, 'N' || c_nationkey,
    'R' || n_regionkey]) AS folder_id FROM customer JOIN nation ON c_nationkey = n_nationkey
),
granted AS (SELECT doc_id, op, kind, id FROM ancestors JOIN folder_grants USING (folder_id))"""


def _box(spark, sf):
    supplier = table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    role = (
        F.when(key % 4 == 0, "owner")
        .when(key % 4 == 1, "viewer")
        .when(key % 4 == 2, "editor")
        .otherwise("previewer")
    )
    shared = supplier.select(
        F.concat(F.lit("R"), (F.col("s_nationkey") % 5).cast("string")).alias("folder_id"),
        F.when(key % 9 == 0, "pending").otherwise("accepted").alias("status"),
        (key % 8 == 1).alias("is_access_only"),
        role.alias("role"),
        F.when(key % 3 == 0, "group").otherwise("user").alias("type"),
        F.concat(F.lit("s"), key.cast("string")).alias("id"),
        F.when(key % 6 == 0, "all_users_group").alias("group_type"),
    )
    own = table(spark, sf, "customer").filter("c_custkey % 2 = 0").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("folder_id"),
        F.lit("accepted").alias("status"),
        F.lit(False).alias("is_access_only"),
        F.lit("viewer uploader").alias("role"),
        F.lit("user").alias("type"),
        F.concat(F.lit("own"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit(None).cast("string").alias("group_type"),
    )
    nodes = _folders(spark, sf).select(F.col("child").alias("id"), F.col("parent").alias("up"))
    is_file = F.col("id").startswith("C")
    files = nodes.where(is_file).select(F.col("id").alias("doc_id"), F.col("up").alias("folder_id"))
    folders = nodes.where(~is_file).select(
        F.col("id").alias("folder_id"), F.col("up").alias("parent_id")
    )
    return access.inherited_access(files, folders, acl.box_grants(shared.unionByName(own)))


@query(
    "acl_inheritance_join",
    o.with_(_BOX, "SELECT doc_id, op, kind AS principal_type, id AS principal_id FROM granted"),
)
def acl_inheritance_join(spark, sf):
    return _box(spark, sf).grants().withColumnRenamed("id", "doc_id")


# Every file's access is delivered, also that of files no grant reaches.
_BOX_FILES = """(SELECT * FROM granted
  UNION ALL SELECT 'C' || c_custkey, NULL, NULL, NULL FROM customer)"""


@query("acl_box", o.with_(_BOX, _nested_json(_BOX_FILES)))
def acl_box(spark, sf):
    nested = _box(spark, sf).permissions().withColumnRenamed("id", "doc_id")
    return nested.select("doc_id", permissions_json(F.col("permissions_data")).alias("permissions"))


@query(
    "acl_digest_change",
    o.with_(
        _DRIVE
        + """,
digests AS (
  SELECT doc_id, '{"denied":[],"permissions":[' || string_agg(item, ',' ORDER BY op) || ']}' AS
    payload FROM (
    SELECT d.doc_id, o.op, '{"' || o.op || '":{"groups":[' ||
      coalesce(string_agg(DISTINCT CASE WHEN kind = 'group' THEN '"' || id || '"' END, ','
        ORDER BY CASE WHEN kind = 'group' THEN '"' || id || '"' END), '') || '],"users":[' ||
      coalesce(string_agg(DISTINCT CASE WHEN kind = 'user' THEN '"' || id || '"' END, ','
        ORDER BY CASE WHEN kind = 'user' THEN '"' || id || '"' END), '') || ']}}' AS item
    FROM (SELECT DISTINCT l_orderkey AS doc_id FROM lineitem) d
    CROSS JOIN (VALUES ('read'), ('update'), ('delete')) o(op)
    LEFT JOIN granted g ON g.doc_id = d.doc_id AND g.op = o.op GROUP BY 1, 2)
  GROUP BY 1
)""",
        "SELECT o_orderkey::varchar AS identifier, sha256(payload) AS permissions_version "
        "FROM orders LEFT JOIN digests ON doc_id = o_orderkey",
    ),
)
def acl_digest_change(spark, sf):
    permissions = _grants(spark, sf)
    nested = acl.nest_grants(acl.drive_grants(permissions), permissions.select("doc_id"))
    nested = nested.withColumn("doc_id", F.col("doc_id").cast("string"))
    index = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("identifier"))
    return acl.attach_permissions(index, nested).select("identifier", "permissions_version")


@query(
    "acl_revoked",
    """
    SELECT o_orderkey::varchar AS identifier,
      CASE WHEN bool_or(l_returnflag <> 'R' AND l_linenumber % 7 < 6) THEN 'acl' ELSE 'none' END
        AS change
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
    """,
)
def acl_revoked(spark, sf):
    """All grants become link access, which no principal holds: every lost grant is a change."""
    before = _grants(spark, sf)
    after = before.withColumn("type", F.lit("anyone"))
    index = before.select(F.col("doc_id").cast("string").alias("identifier")).distinct()

    def access(permissions):
        nested = acl.nest_grants(acl.drive_grants(permissions), permissions.select("doc_id"))
        return acl.attach_permissions(
            index, nested.withColumn("doc_id", F.col("doc_id").cast("string"))
        )

    state = access(before).select(
        "identifier",
        F.lit(1.0).alias("processed_at"),
        F.lit("v").alias("version"),
        "permissions_version",
    )
    now = access(after).select(
        "identifier",
        F.lit("0").alias("date_modified"),
        F.lit("v").alias("version"),
        "permissions_version",
        F.lit(False).alias("reprocess"),
    )
    change = F.when(F.col("change") == "acl", "acl").otherwise("none")
    return classify_changes(now, state).select("identifier", change.alias("change"))
