"""Landed payloads to documents."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.operators import access, acl, closure, filters, graph, incremental
from sluice.sources import blocks, listings, messages, records, tickets
from sluice.sources.parts import assembled, part_texts, placed_rows


def message(channel, ts, **more):
    return (channel, ts, more.get("thread_ts"), more.get("latest_reply"), more.get("edited_ts"),
            more.get("text", "t"))


MESSAGE = "channel string, ts string, thread_ts string, latest_reply string, edited_ts string, " \
    "text string"


def packages(spark, rows):
    got = messages.daily_packages(spark.createDataFrame(rows, MESSAGE)).collect()
    return {r["day"]: r for r in got}


def test_late_activity_keeps_the_identifier(spark):
    first = packages(spark, [message("C", "1700000000.1"), message("C", "1700000100.2")])
    assert first["2023-11-14"]["version"] == "1700000100.2"
    assert first["2023-11-14"]["identifier"] == hashlib.sha256(b"C-2023-11-14").hexdigest()
    later = packages(
        spark,
        [message("C", "1700000000.1", latest_reply="1800000000.5"),
         message("C", "1700000100.2", edited_ts="9999999999")],
    )
    assert later["2023-11-14"]["identifier"] == first["2023-11-14"]["identifier"]
    # The comparison is by number, not by text.
    assert later["2023-11-14"]["version"] == "9999999999"
    assert later["2023-11-14"]["date_created"] == "1700000000.1"


def test_replies_belong_to_the_day_of_their_root(spark):
    rows = [message("C", "1700000000"), message("C", "1700100000", thread_ts="1700000000")]
    assert list(packages(spark, rows)) == ["2023-11-14"]


def test_large_packages_come_in_parts(spark):
    rows = [message("C", str(1700000000 + i), thread_ts="1700000000", text=f"<m{i}>")
            for i in range(25)]
    frame = spark.createDataFrame(rows, MESSAGE)
    whole = messages.package_xml(frame).collect()
    assert len(whole) == 1 and whole[0]["body"].count("&lt;reply&gt;") == 24
    parts = messages.package_xml(frame, part_rows=10).orderBy("part").collect()
    assert [p["part"] for p in parts] == [0, 1, 2]
    assert {p["identifier"] for p in parts} == {whole[0]["identifier"]}
    assert "".join(p["body"] for p in parts) == whole[0]["body"]


def test_parts_are_partitioned_as_one_document(spark):
    from sluice.operators.partition import partition_text

    rows = [message("C", str(1700000000 + i), thread_ts="1700000000", text=f"line {i}\nmore {i}")
            for i in range(25)]
    frame = spark.createDataFrame(rows, MESSAGE)
    whole = partition_text(messages.package_documents(frame)).orderBy("pos").collect()
    cut = partition_text(messages.package_documents(frame, part_rows=4)).orderBy("pos").collect()
    assert [r["pos"] for r in cut] == list(range(50))
    assert cut == whole


def test_issues_and_tables_join_to_the_whole(spark):
    """Every number of children around the border of a part gives the same document."""
    from sluice.sources.blocks import database_to_html

    for n in (0, 1, 4, 5, 9):
        pages = spark.createDataFrame([(1, k, f"v{k}") for k in range(n)], "db int, r int, name string")
        whole = [r["body"] for r in database_to_html(pages, "db", "r").collect()]
        parts = database_to_html(pages, "db", "r", part_rows=4).orderBy("part").collect()
        assert "".join(p["body"] for p in parts) == "".join(whole)
        assert len(parts) == -(-n // 4)
    heads = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    children = spark.createDataFrame([(1, i, str(i)) for i in range(8)], "k int, r int, text string")
    texts = part_texts(placed_rows(children, ["k"], "r"), ["k"], lambda r: r["text"], part_rows=4)
    found = assembled(
        texts, ["k"], heads, children, F.concat("name", F.lit("<")), F.lit(">"), part_rows=4
    )
    assert {(r["k"], r["part"]): r["body"] for r in found.collect()} == {
        (1, 0): "a<0123", (1, 1): "4567>", (2, 0): "b<>",
    }


def test_part_texts_keep_order_and_rows(spark):
    rows = spark.createDataFrame([("k", i, str(i)) for i in range(23)], "k string, r int, t string")
    placed = placed_rows(rows, ["k"], "r")
    got = part_texts(placed, ["k"], lambda r: r["t"], ["t"], between=",", part_rows=10)
    texts = [r["text"] for r in got.orderBy("part").collect()]
    assert "".join(texts) == ",".join(map(str, range(23))) and len(texts) == 3


def test_relative_path_cuts_the_root_once(spark):
    rows = spark.createDataFrame([("root/a/root/b.txt", 5, "file")],
                                 "path string, size long, type string")
    row = listings.index_files(rows, "root/").first()
    assert row["rel_path"] == "a/root/b.txt" and row["filename"] == "b.txt"


def test_single_file_must_be_single(spark):
    rows = spark.createDataFrame(
        [("d/a", 5, "file"), ("d/b", 5, "file"), ("e/a", 0, "file")],
        "path string, size long, type string",
    )
    assert listings.hydrate_single_file(rows, "d/a").first()["filename"] == "a"
    for path in ("d", "e", "none"):
        with pytest.raises(Exception, match="expected one file"):
            listings.hydrate_single_file(rows, path).collect()


def test_sample_is_stable_and_whole_when_small(spark):
    index = spark.createDataFrame([(str(i),) for i in range(30)], "identifier string")
    once = {r[0] for r in listings.sample_files(index, 5, seed=1).collect()}
    assert once == {r[0] for r in listings.sample_files(index.repartition(3), 5, seed=1).collect()}
    assert listings.sample_files(index, 99).count() == 30


def test_globs(spark):
    paths = ["a/b.txt", "a/c/d.txt", "x.md", "a[1].txt", None]
    rows = spark.createDataFrame([(p,) for p in paths], "fullpath string")

    def kept(*globs):
        return {r[0] for r in rows.filter(
            filters.matches_any_glob(F.col("fullpath"), globs)).collect()}

    assert kept("a*.txt") == {"a/b.txt", "a/c/d.txt", "a[1].txt"}
    assert kept("?.md", "a[[]1].txt") == {"x.md", "a[1].txt"}
    assert kept("[!a]*") == {"x.md"}
    assert kept() == set()


def test_duplicate_versions_in_a_batch_fail(spark):
    from sluice.operators.batching import batch_rows

    rows = spark.createDataFrame([("a", "1"), ("a", "2")], "id string, v string")
    with pytest.raises(Exception, match="duplicate identifiers"):
        batch_rows(rows, "id", 10, "v").collect()
    assert batch_rows(rows.unionByName(rows).select("id"), "id", 10).first()["n_items"] == 1


def test_id_column_falls_back_to_other_case():
    assert records.resolve_column(["ID", "x"], "id") == "ID"
    assert records.resolve_column(["ID", "id"], "id") == "id"


def test_object_id_time(spark):
    rows = spark.createDataFrame([("659daefa0000000000000000",)], "i string")
    got = rows.select(records.object_id_time(F.col("i"))).first()[0]
    assert got == "2024-01-09T20:39:22+00:00"


def test_ticket_text_skips_missing_values(spark):
    heads = spark.createDataFrame(
        [(1, None, "d\ne", "s")], "id long, created_at string, description string, subject string"
    )
    comments = spark.createDataFrame(
        [(1, 2, 8, "b2", None, 20), (1, 1, 7, None, "now", 10)],
        "ticket_id long, rank int, author_id long, body string, created_at string, id long",
    )
    assert tickets.tickets_to_text(heads, comments).first()["body"] == (
        "ticket\ndescription: d\ne\nid: 1\nsubject: s\n"
        "comment\nauthor_id: 7\ncreated_at: now\nid: 10\ncomment\nauthor_id: 8\nbody: b2\nid: 20\n"
    )


def test_nested_blocks(spark):
    rows = [
        ("p", "1", "p", 1, "heading_1", "T", None),
        ("p", "2", "p", 2, "bulleted_list_item", "a", None),
        ("p", "3", "p", 3, "bulleted_list_item", "b", None),
        ("p", "4", "3", 1, "paragraph", "in", None),
        ("p", "5", "p", 4, "table", None, None),
        ("p", "6", "5", 1, "table_row", None, ["h"]),
        ("p", "7", "5", 2, "table_row", None, ["v"]),
        ("p", "8", "p", 5, "child_page", "gone", None),
    ]
    frame = spark.createDataFrame(
        rows, "page_id string, block_id string, parent_id string, rank int, type string, "
        "text string, cells array<string>",
    )
    assert blocks.blocks_to_html(frame).first()["body"] == (
        '<html><body><h1>T</h1><ul style="margin-left: 0px"><li>a</li><li>b</li>'
        "<div><p>in</p></div></ul><table><tr><th>h</th></tr><tr><td>v</td></tr></table>"
        "</body></html>"
    )


BLOCK = (
    "page_id string, block_id string, parent_id string, rank int, type string, text string, "
    "cells array<string>, url string, caption string"
)


def test_every_block_type_is_shown(spark):
    shown = {
        "equation": ("x < y", None, None, "<div>x &lt; y</div>"),
        "template": ("t", None, None, "<div>t</div>"),
        "link_to_page": ("id-1", None, None, "<div>id-1</div>"),
        "bookmark": (None, 'http://a/?q="&', "c", '<div><a href="http://a/?q=&quot;&amp;">'
                     'http://a/?q="&amp;</a><br/><div>c</div></div>'),
        "embed": (None, "u", None, '<div><a href="u">u</a></div>'),
        "file": (None, None, "c", "<div><div>c</div></div>"),
        "pdf": (None, None, None, ""),
        "link_preview": (None, "u", None, '<a href="u">u</a>'),
        "image": (None, "u", "c", '<img src="u"/>'),
        "video": (None, "u", None, '<video><source src="u">u</source></video>'),
        "divider": ("x", None, None, "<hr/>"),
        "breadcrumb": ("x", None, None, ""),
        "table_of_contents": ("x", None, None, ""),
        "unsupported": ("x", None, None, ""),
        "never_heard_of": ("new", None, None, "<p>new</p>"),
        "also_unknown": (None, None, None, ""),
        "code": ("a<b", None, None, "<pre>a&lt;b</pre>"),
    }
    rows = [
        (kind, kind + "1", kind, 1, kind, text, None, url, caption)
        for kind, (text, url, caption, _) in shown.items()
    ]
    found = blocks.blocks_to_html(spark.createDataFrame(rows, BLOCK)).collect()
    assert {r["page_id"]: r["body"] for r in found} == {
        kind: f"<html><body>{html}</body></html>" for kind, (*_, html) in shown.items()
    }


def rendered(rows, page):
    """A page from its blocks, child by child."""
    below = {}
    for row in rows:
        if row[0] == page and row[4] != "child_page":
            below.setdefault(row[2], []).append(row)
    tags = {"paragraph": "p", "numbered_list_item": "li", "bulleted_list_item": "li"}
    lists = {"numbered_list_item": "ol", "bulleted_list_item": "ul"}

    def html(parent, level):
        out, peers = "", sorted(below.get(parent, []), key=lambda r: r[3])
        for k, (_, name, _, _, kind, text, *_) in enumerate(peers):
            listed = lists.get(kind)
            if listed and (k == 0 or peers[k - 1][4] != kind):
                out += f'<{listed} style="margin-left: {level * 10}px">'
            if kind in tags:
                out += f"<{tags[kind]}>{text}</{tags[kind]}>"
            if name in below:
                width = f'<div style="width:{100 / len(peers)}%; float: left">'
                start = {"table": "<table>", "column": width}.get(kind, "<div>")
                end = "</table>" if kind == "table" else "</div>"
                out += start + html(name, level + 1) + end
            if listed and (k + 1 == len(peers) or peers[k + 1][4] != kind):
                out += f"</{listed}>"
        return out

    return f"<html><body>{html(page, 0)}</body></html>"


def test_block_trees_against_plain_python(spark, monkeypatch):
    """Bushy and deep trees, columns, unreachable blocks, small windows and small parts."""
    import random

    draw = random.Random(8)
    kinds = ["paragraph", "numbered_list_item", "bulleted_list_item", "table", "column", "child_page"]
    rows = []
    for page in ("p", "q"):
        for k in range(60):
            kind = draw.choice(kinds[:5] if k else ["paragraph"])
            parent = page if k == 0 or draw.random() < 0.3 else f"{page}{draw.randrange(k)}"
            rows.append((page, f"{page}{k}", parent, k, kind, f"t{k}", None, None, None))
    rows += [("p", "out", "nowhere", 1, "paragraph", "x", None, None, None)]
    rows += [("p", "out2", "out", 1, "paragraph", "x", None, None, None)]
    rows += [("r", f"r{k}", f"r{k - 1}" if k else "r", 1, "paragraph", str(k), None, None, None)
             for k in range(40)]
    frame = spark.createDataFrame(rows, BLOCK)
    expected = {page: rendered(rows, page) for page in "pqr"}

    def bodies(**options):
        found = {}
        for row in blocks.blocks_to_html(frame, **options).orderBy("page_id", "part").collect():
            found[row["page_id"]] = found.get(row["page_id"], "") + row["body"]
        return found

    assert bodies() == expected
    assert bodies(part_rows=7) == expected
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 5)
    assert bodies(part_rows=7) == expected


def test_blocks_below_themselves_raise(spark):
    rows = [("p", "a", "b", 1, "paragraph", "", None, None, None),
            ("p", "b", "a", 1, "paragraph", "", None, None, None)]
    with pytest.raises(ValueError, match="below itself"):
        blocks.block_levels(spark.createDataFrame(rows, BLOCK))


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "parent string, child string")
    roots = spark.createDataFrame([("a",)], "r string")
    got = sorted((r["node"], r["depth"]) for r in closure.tree_closure(edges, roots).collect())
    assert got == [("a", 0), ("b", 1), ("c", 2)]


META = "record_id string, pos long, element_id string, text string, embeddings array<float>, " \
    "metadata struct<entities:string>"


def entity_counts(spark, entities):
    rows = spark.createDataFrame([("d", 0, "e", "t", None, (entities,))], META)
    edges = graph.entity_edges(rows)
    ends = edges.select(F.col("src").alias("n")).unionByName(edges.select(F.col("dst").alias("n")))
    return ends.distinct().count(), edges.distinct().count()


def test_entities_as_list_or_object(spark):
    listed = '[{"type":"PERSON","entity":"John"},{"type":"x"},{"type":"ORG","entity":"Acme"}]'
    assert entity_counts(spark, listed) == (5, 4)
    whole = (
        '{"items":[{"type":"PERSON","entity":"John"},{"type":"ORG","entity":"Acme"}],'
        '"relationships":[{"from":"John","relationship":"works_for","to":"Acme"}]}'
    )
    assert entity_counts(spark, whole) == (5, 5)
    assert entity_counts(spark, "broken") == (0, 0)


def test_missing_grants_differ_from_none(spark):
    index = spark.createDataFrame([("a",), ("b",)], "identifier string")
    nested = spark.createDataFrame([("a",)], "doc_id string").withColumn(
        "permissions_data", acl.empty_permissions()
    )
    got = {r["identifier"]: r["permissions_version"]
           for r in acl.attach_permissions(index, nested).collect()}
    assert got["a"] is not None and got["b"] is None


def test_changes(spark):
    schema = "identifier string, date_modified string, version string, permissions_version string, " \
        "reprocess boolean"
    index = spark.createDataFrame(
        [("new", "1", "v", None, None), ("same", "5", "v", None, None),
         ("late", "11", "v", None, None), ("text", "Monday", "w", None, None),
         ("acl", "5", "v", "x", None), ("force", "5", "v", None, True)], schema)
    state = spark.createDataFrame(
        [(n, 10.0, "v", None) for n in ("same", "late", "text", "acl", "force", "gone")],
        "identifier string, processed_at double, version string, permissions_version string")
    got = {r["identifier"]: r["change"] for r in incremental.classify_changes(index, state).collect()}
    assert got == {"new": "new", "same": "unchanged", "late": "modified", "text": "version",
                   "acl": "acl", "force": "forced"}
    assert [r[0] for r in incremental.removed_documents(index, state).collect()] == ["gone"]


def test_errors_fail_the_run(spark):
    errors = spark.createDataFrame([("r", "embed", "boom")],
                                   "record_id string, step string, error string")
    with pytest.raises(RuntimeError, match="embed failed for r: boom"):
        incremental.fail_on_errors(errors)
    incremental.fail_on_errors(errors.limit(0))


def test_caps_above_the_group_limit(spark):
    rows = spark.range(6000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    for n in (3, 1500):
        kept = filters.cap_per_group(rows, "g", [F.col("v").desc()], n)
        got = {r["g"]: (r["n"], r["low"]) for r in kept.groupBy("g").agg(
            F.count("*").alias("n"), F.min("v").alias("low")).collect()}
        assert got == {0: (n, 5998 - 2 * (n - 1)), 1: (n, 5999 - 2 * (n - 1))}


def test_tree_intervals(spark):
    """Random forests, hubs, unknown parents, a cycle; ancestry by numbers agrees with walking up."""
    import random

    draw = random.Random(3)
    parents = {0: None, 1: 77777}
    for k in range(2, 300):
        parents[k] = 5 if k % 3 == 0 and k > 5 else draw.randrange(k)
    parents |= {500: 501, 501: 502, 502: 500, 503: 500}
    nodes = spark.createDataFrame(list(parents.items()), "id long, parent_id long")
    labels = {r["id"]: r for r in closure.tree_intervals(nodes).collect()}
    assert set(labels) == set(range(300))

    def above(k):
        found = []
        while parents[k] in parents:
            k = parents[k]
            found.append(k)
        return found

    for k, row in labels.items():
        chain = above(k)
        assert row["depth"] == len(chain) and row["root"] == ([k] + chain)[-1]
    sizes = {k: 1 + sum(k in above(j) for j in range(300)) for k in (0, 1, 5, 17, 299)}
    assert sizes == {k: (labels[k]["leave"] - labels[k]["enter"] + 1) // 2 for k in sizes}
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(400)] + [(4, 4), (500, 501)]
    pairs += [(5, 9), (0, 999)]
    found = closure.ancestor_tests(
        spark.createDataFrame(pairs, "above long, below long"), closure.tree_intervals(nodes)
    )
    assert {(r["above"], r["below"]): r["is_above"] for r in found.collect()} == {
        (a, b): b < 300 and a < 300 and a in above(b) for a, b in pairs
    }


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    n = 20_000
    nodes = spark.range(n).select("id", (F.col("id") - 1).alias("parent_id"))
    rounds = []
    whole = closure.written
    monkeypatch.setattr(
        closure, "written", lambda df, label: rounds.append(label) or whole(df, label)
    )
    ends = closure.tree_intervals(nodes).agg(F.max("depth"), F.min("enter"), F.max("leave")).first()
    assert tuple(ends) == (n - 1, 0, 2 * n - 1)
    assert rounds.count("tour") <= 18


def expected_access(files, folders, grants):
    """Grants of every file: its own and those of the folders above, walked one by one."""
    parents, found = dict(folders), {}
    for doc, folder in files:
        places, at = {doc}, folder
        while at is not None:
            places.add(at)
            at = parents.get(at)
        found[doc] = {g[1:] for g in grants if g[0] in places}
    return found


def test_access_down_folders(spark):
    """A deep chain, a bushy tree, unknown parents, files without grants, repeated grants."""
    import random

    draw = random.Random(6)
    folders = [("r0", None)] + [(f"r{k}", f"r{k - 1}") for k in range(1, 70)]
    folders += [(f"t{k}", f"t{draw.randrange(k)}" if k else None) for k in range(40)]
    folders += [("lost", "unknown")]
    names = [name for name, _ in folders]
    files = [(f"f{k}", draw.choice([*names, "unknown", None])) for k in range(80)]
    ops, kinds = ["read", "update", "delete"], ["user", "group"]
    grants = [
        (draw.choice([*names, *[f for f, _ in files]]), draw.choice(ops), draw.choice(kinds), f"p{draw.randrange(6)}")
        for _ in range(90)
    ] * 2
    found = access.inherited_access(
        spark.createDataFrame(files, "doc_id string, folder_id string"),
        spark.createDataFrame(folders, "folder_id string, parent_id string"),
        spark.createDataFrame(grants, "folder_id string, op string, principal_type string, principal_id string"),
    )
    expected = expected_access(files, folders, grants)
    got = {doc: set() for doc, _ in files}
    for row in found.grants().collect():
        got[row["id"]].add(tuple(row)[1:])
    assert got == expected
    lists = {r["id"]: r["permissions_data"] for r in found.permissions().collect()}
    assert set(lists) == set(expected)
    for doc, grant in expected.items():
        for entry in lists[doc]:
            for kind, values in (("user", entry["users"]), ("group", entry["groups"])):
                assert values == sorted(p for op, k, p in grant if (op, k) == (entry["op"], kind))
    # A set is stored once.
    ids = [r["set_id"] for r in found.sets.collect()]
    assert len(ids) == len(set(ids))


def test_folders_within_themselves_raise(spark):
    folders = spark.createDataFrame([("a", "b"), ("b", "a")], "folder_id string, parent_id string")
    grants = spark.createDataFrame(
        [("a", "read", "user", "u")], "folder_id string, op string, principal_type string, principal_id string"
    )
    files = spark.createDataFrame([("f", "a")], "doc_id string, folder_id string")
    with pytest.raises(ValueError, match="within itself"):
        access.inherited_access(files, folders, grants)


def test_paths_name_their_folders(spark):
    paths = spark.createDataFrame([("a/b/c.txt",), ("a/d.txt",), ("e.txt",)], "path string")
    schema = "folder_id string, op string, principal_type string, principal_id string"
    grants = spark.createDataFrame(
        [("a", "read", "user", "x"), ("a/b", "update", "group", "y"), ("e.txt", "read", "user", "z")],
        schema,
    )
    found = {}
    for row in access.path_access(paths, grants).grants().collect():
        found.setdefault(row["id"], set()).add(row["principal_id"])
    assert found == {"a/b/c.txt": {"x", "y"}, "a/d.txt": {"x"}, "e.txt": {"z"}}


def test_space_access_by_arrays(spark):
    """Restricted and open pages, administrators, deleters who may not read, unlisted pages."""
    pages = spark.createDataFrame([(k, 1 if k < 6 else 2) for k in range(8)], "doc_id int, space_id int")
    restrictions = spark.createDataFrame(
        [(0, "read", "user", "a"), (1, "update", "user", "b"), (2, "read", "group", "d"),
         (2, "update", "user", "c"), (2, "update", "user", "c"), (9, "read", "user", "z")],
        "doc_id int, op string, principal_type string, principal_id string",
    )
    space = spark.createDataFrame(
        [(1, "read", "space", "group", "r"), (1, "administer", "space", "user", "m"),
         (1, "delete", "page", "group", "d"), (1, "delete", "page", "group", "r"),
         (1, "read", "page", "user", "no"), (3, "read", "space", "user", "other")],
        "space_id int, operation string, target_type string, principal_type string, principal_id string",
    )
    found = {}
    access_of = acl.wiki_access(restrictions, space, pages)
    for row in acl.access_rows(access_of).collect():
        found.setdefault(row["doc_id"], set()).add((row["op"], row["principal_id"]))
    open_page = {("read", "r"), ("read", "m"), ("update", "m"), ("delete", "r")}
    assert found[0] == {("read", "a")}
    assert found[1] == {("update", "b"), ("read", "b"), ("read", "r"), ("read", "m"), ("delete", "r")}
    assert found[2] == {("read", "d"), ("update", "c"), ("read", "c"), ("delete", "d")}
    assert found[3] == found[4] == found[5] == open_page
    assert found[9] == {("read", "z")} and set(found) == {0, 1, 2, 3, 4, 5, 9}
    nested = {r["doc_id"]: r["permissions_data"] for r in acl.nest_access(access_of).collect()}
    assert nested[3][0]["users"] == ["m"] and nested[3][0]["groups"] == ["r"]
    plan = access_of._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_grants_of_folders_are_not_stored_for_each_file(spark):
    """Many files with own grants below a folder of many grants: stored grants do not multiply."""
    files = spark.range(300).select(F.concat(F.lit("f"), "id").alias("doc_id"), F.lit("top").alias("folder_id"))
    folders = spark.createDataFrame([("top", None)], "folder_id string, parent_id string")
    schema = "folder_id string, op string, principal_type string, principal_id string"
    rows = [("top", "read", "user", f"p{k:03d}") for k in range(200)]
    rows += [(f"f{k}", "read", "user", f"own{k}") for k in range(299)] + [("f7", "read", "user", "p007")]
    found = access.inherited_access(files, folders, spark.createDataFrame(rows, schema))
    stored = sum(
        t.agg(F.coalesce(F.sum(F.size("grants")), F.lit(0))).first()[0] for t in (found.sets, found.more)
    )
    assert stored == 200 + 299
    assert found.grants().count() == 300 * 200 + 299
    lists = {r["id"]: r["permissions_data"][0]["users"] for r in found.permissions().collect()}
    common = [f"p{k:03d}" for k in range(200)]
    assert lists["f7"] == ["own7", *common] and lists["f299"] == common


def test_files_of_one_set_are_expanded_by_many_tasks(spark, monkeypatch):
    """All files below one folder, half of them with the same grant of their own, none in a few."""
    files = spark.range(4000).select(
        F.concat(F.lit("f"), "id").alias("doc_id"), F.when(F.col("id") > 9, "top").alias("folder_id")
    )
    folders = spark.createDataFrame([("top", None)], "folder_id string, parent_id string")
    schema = "folder_id string, op string, principal_type string, principal_id string"
    rows = [("top", "read", "user", f"p{k:02d}") for k in range(50)]
    rows += [(f"f{k}", "update", "user", "own") for k in range(0, 4000, 2)]
    monkeypatch.setattr(access, "TASK_GRANTS", 1000, raising=False)
    monkeypatch.setattr(access, "COPY_ROWS", 100, raising=False)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = access.inherited_access(files, folders, spark.createDataFrame(rows, schema))
        grants = found.grants().withColumn("task", F.spark_partition_id())
        most = grants.groupBy("task").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        assert most < 50 * 1000
        assert grants.count() == grants.select("id", "op", "principal_id").distinct().count()
        assert grants.count() == 3990 * 50 + 2000
        lists = found.permissions().withColumn("task", F.spark_partition_id())
        assert lists.groupBy("task").count().agg(F.max("count")).first()[0] < 1000
        plain = F.size(F.col("permissions_data")[1]["users"]) == 0
        below = lists.where(F.size(F.col("permissions_data")[0]["users"]) > 0)
        kinds = below.groupBy("task").agg(F.count_distinct(plain).alias("n")).groupBy("n").count().collect()
        assert {r["n"]: r["count"] for r in kinds}.get(1, 0) > 10  # equal lists are kept apart
        sizes = lists.select(*[F.size(F.col("permissions_data")[k]["users"]).alias(f"n{k}") for k in (0, 1)])
        counted = sorted((r[0], r[1], r["count"]) for r in sizes.groupBy(*sizes.columns).count().collect())
        assert counted == [(0, 0, 5), (0, 1, 5), (50, 0, 1995), (50, 1, 1995)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_blocks_meet_paths_and_children_in_one_step(spark):
    rows = [
        ("p", "a", "p", 1, "toggle", "A"), ("p", "b", "a", 1, "toggle", "B"),
        ("p", "c", "b", 1, "paragraph", "C"), ("p", "d", "p", 2, "paragraph", "D"),
        ("p", "x", "gone", 1, "toggle", "X"), ("p", "y", "x", 1, "paragraph", "Y"),
        ("q", None, "q", 1, "toggle", "N"), ("q", "z", None, 2, "paragraph", "Z"),
    ]
    schema = "page_id string, block_id string, parent_id string, rank long, type string, text string"
    frame = spark.createDataFrame(rows, schema)
    frame = frame.withColumn("cells", F.lit(None).cast("array<string>"))
    events = blocks._events(*blocks._levels(frame))
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2
    found = blocks.blocks_to_html(frame).collect()
    assert sorted((r["page_id"], r["part"], r["body"]) for r in found) == [
        ("p", 0, "<html><body><p>A</p><div><p>B</p><div><p>C</p></div></div><p>D</p></body></html>"),
        ("q", 0, "<html><body><p>Z</p></body></html>"),
    ]


def test_children_counted_before(spark):
    rows = spark.createDataFrame([("a", n, f"{n}") for n in range(7)] + [("b", 0, "0")],
                                 "key string, nth long, text string")
    texts = part_texts(rows, ["key"], lambda r: r["text"], part_rows=3)
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_children"))
    ends = {"opening": F.lit("<"), "closing": F.lit(">"), "part_rows": 3}
    found = [
        sorted((r["key"], r["part"], r["body"]) for r in made.collect())
        for made in (
            assembled(texts, ["key"], children=rows, **ends),
            assembled(texts, ["key"], counts=counts, **ends),
        )
    ]
    assert found[0] == found[1]
    assert found[1] == [("a", 0, "<012"), ("a", 1, "345"), ("a", 2, "6>"), ("b", 0, "<0>")]
