"""Reachability over parent-child edges (folders, pages, databases).

For trees, ``tree_intervals`` labels every node by where a tour of its tree enters and leaves it, so
that asking whether one node is above another is a comparison of numbers and no closure is stored.
``tree_closure`` lists the pairs themselves, which are as many as its answer has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import written

SIBLING_GROUPS = 64


def tree_closure(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(root, node, depth) of every node reachable from each root, roots included at depth 0.

    ``edges`` is ``(parent, child)``. Each round joins only the newest nodes to their children and
    drops what was reached before, so it ends at any depth and cycles end too. The frontier is
    written every round: that cuts the growing lineage and survives lost executors. Hub nodes skew
    the edge side of the join, which adaptive execution splits.
    """
    edges = edges.select("parent", "child").distinct()
    if roots is None:
        start = edges.select(F.col("parent").alias("root")).distinct()
    else:
        start = roots.select(F.col(roots.columns[0]).alias("root")).distinct()
    start = start.select("root", F.col("root").alias("node"), F.lit(0).alias("depth"))
    frontier = written(start, "reached")
    reached = frontier
    depth = 0
    while True:
        depth += 1
        step = (
            frontier.join(edges, F.col("node") == F.col("parent"))
            .select("root", F.col("child").alias("node"), F.lit(depth).alias("depth"))
            .distinct()
            .join(reached.select("root", "node"), ["root", "node"], "left_anti")
        )
        frontier = written(step, "reached")
        if frontier.isEmpty():
            return reached
        reached = reached.unionByName(frontier)


def node_paths(nodes: DataFrame, sep: str = "/") -> DataFrame:
    """(id, path) of a forest given as ``(id, parent_id, name)``; roots have no known parent.

    Nodes of a cycle have no root above them and no path.
    """
    known = nodes.select(F.col("id").alias("parent_id")).distinct()
    rooted = nodes.join(known, "parent_id", "left_anti")
    frontier = written(rooted.select("id", F.col("name").alias("path")), "paths")
    done = frontier
    while True:
        step = nodes.alias("n").join(
            frontier.alias("f"), F.col("n.parent_id") == F.col("f.id")
        ).select("n.id", F.concat_ws(sep, F.col("f.path"), F.col("n.name")).alias("path"))
        frontier = written(step, "reached")
        if frontier.isEmpty():
            return done
        done = done.unionByName(frontier)


def _tour(nodes: DataFrame) -> DataFrame:
    """(id, out, next_id, next_out): the events of entering and leaving nodes, and what follows each.

    Siblings follow each other in any order that is fixed. They are chained within groups by hash,
    and the groups of a parent with each other, so that no parent's children must meet in a task.
    """
    known = nodes.select(F.col("id").alias("parent_id"), F.lit(True).alias("_known"))
    rows = nodes.join(known, "parent_id", "left").select(
        "id",
        F.when(F.col("_known"), F.col("parent_id")).alias("parent_id"),
        F.pmod(F.xxhash64("id"), F.lit(SIBLING_GROUPS)).alias("group"),
    )
    rows = written(rows, "tree-nodes")
    children = rows.where("parent_id IS NOT NULL")
    follows = F.lead("id").over(Window.partitionBy("parent_id", "group").orderBy("id"))
    chained = children.withColumn("_follows", follows)
    groups = children.groupBy("parent_id", "group").agg(F.min("id").alias("_first"))
    after = F.lead("_first").over(Window.partitionBy("parent_id").orderBy("group"))
    heads = groups.withColumn("_after", after)
    follow = chained.join(heads, ["parent_id", "group"]).select(
        "id", F.coalesce("_follows", "_after").alias("sibling")
    )
    first = groups.groupBy(F.col("parent_id").alias("id")).agg(
        F.min_by("_first", "group").alias("child")
    )
    links = rows.join(follow, "id", "left").join(first, "id", "left")
    leaf = F.col("child").isNull()
    enter = F.struct(
        F.lit(0).alias("out"),
        F.coalesce("child", "id").alias("next_id"),
        F.when(leaf, 1).otherwise(0).alias("next_out"),
    )
    leave = F.struct(
        F.lit(1).alias("out"),
        F.coalesce("sibling", "parent_id").alias("next_id"),
        F.when(F.col("sibling").isNotNull(), 0).otherwise(1).alias("next_out"),
    )
    return links.select("id", F.explode(F.array(enter, leave)).alias("e")).select("id", "e.*")


def tree_intervals(nodes: DataFrame) -> DataFrame:
    """(id, root, depth, enter, leave) of a forest given as ``(id, parent_id)``, ids being unique.

    Node a is above node b, or is b, if both have one root and a.enter <= b.enter and
    b.leave <= a.leave; a node's subtree has (leave - enter + 1) / 2 nodes. A node whose parent is
    null or unknown is a root. The tour of a tree is a list of events, ranked by pointer doubling:
    a chain of n nodes takes about as many rounds as 2 n has binary digits. Nodes that no root leads
    to are on or below a cycle and are left out.
    """
    # Steps to the end, and by how much more nodes are left than entered on the way.
    weight = F.when(F.col("next_out") == 1, 1).otherwise(-1)
    ends = F.col("next_id").isNull()
    rows = written(
        _tour(nodes.select("id", "parent_id")).select(
            "id",
            "out",
            "next_id",
            "next_out",
            F.when(ends, 0).otherwise(1).cast("long").alias("steps"),
            F.when(ends, 0).otherwise(weight).cast("long").alias("more"),
            F.when(ends, F.col("id")).alias("root"),
        ),
        "tour",
    )
    done, open_ = rows.where("next_id IS NULL"), rows.where("next_id IS NOT NULL")
    for _ in range(rows.count().bit_length() + 1):
        if open_.isEmpty():
            break
        on = [("id", "next_id"), ("out", "next_out"), ("next_id", "_id"), ("next_out", "_out")]
        on += [("steps", "_steps"), ("more", "_more"), ("root", "_root")]
        ahead = done.unionByName(open_).select(*[F.col(a).alias(b) for a, b in on])
        rows = written(
            open_.drop("root")
            .join(ahead, ["next_id", "next_out"])
            .select(
                "id",
                "out",
                F.col("_id").alias("next_id"),
                F.col("_out").alias("next_out"),
                (F.col("steps") + F.col("_steps")).alias("steps"),
                (F.col("more") + F.col("_more")).alias("more"),
                F.col("_root").alias("root"),
            ),
            "tour",
        )
        done = done.unionByName(rows.where("next_id IS NULL"))
        open_ = rows.where("next_id IS NOT NULL")
    into, out = done.where("out = 0"), done.where("out = 1")
    sizes = into.where("id = root").select("root", F.col("steps").alias("_all"))
    return (
        into.join(out.select("id", F.col("steps").alias("_left")), "id")
        .join(sizes, "root")
        .select(
            "id",
            "root",
            (F.col("more") - 1).alias("depth"),
            (F.col("_all") - F.col("steps")).alias("enter"),
            (F.col("_all") - F.col("_left")).alias("leave"),
        )
    )


def ancestor_tests(pairs: DataFrame, intervals: DataFrame) -> DataFrame:
    """``pairs`` (above, below) with ``is_above``: whether the one is an ancestor of the other.

    A node is no ancestor of itself. Pairs with a node that has no interval are false.
    """
    names = ["id", "root", "enter", "leave"]
    one = intervals.select(*[F.col(n).alias("above" if n == "id" else f"_a_{n}") for n in names])
    two = intervals.select(*[F.col(n).alias("below" if n == "id" else f"_b_{n}") for n in names])
    inside = (
        (F.col("_a_root") == F.col("_b_root"))
        & (F.col("_a_enter") < F.col("_b_enter"))
        & (F.col("_b_leave") < F.col("_a_leave"))
    )
    found = pairs.join(one, "above", "left").join(two, "below", "left")
    return found.select("above", "below", F.coalesce(inside, F.lit(False)).alias("is_above"))
