"""Invariants of partitioning, ids, chunking, embedding and HTML."""

import base64
import json
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.operators import chunk, embed, hashing, html, orig_elements, partition
from sluice.operators.incremental import fail_on_errors, status_report
from sluice.plans import roles
from sluice.plans.flow import Flow


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    rows = roles.parts(spark, sf_dir).cache()
    yield rows
    # Later tests look at plans, which must not read the cache.
    rows.unpersist()


def test_parents_resolve(parts):
    hashed = hashing.assign_hash_ids(parts, strict=True)
    ids = hashed.select("record_id", F.col("element_id").alias("parent"))
    children = hashed.filter("metadata.parent_id IS NOT NULL").select(
        "record_id", F.col("metadata.parent_id").alias("parent")
    )
    assert children.join(ids, ["record_id", "parent"], "left_anti").isEmpty()


def test_unknown_parent_fails_when_strict(spark):
    rows = spark.createDataFrame(
        [("r", 0, "a", "b", ("missing",))],
        "record_id string, pos long, element_id string, old_id string, "
        "metadata struct<parent_id:string>",
    )
    with pytest.raises(Exception, match="unknown parent id"):
        hashing.remap_parent_ids(rows, strict=True).collect()
    assert hashing.remap_parent_ids(rows).first()["metadata"]["parent_id"] is None


def test_order_of_input_does_not_matter(parts):
    def digest(rows):
        chunks = chunk.chunk_elements(rows, "by_title", 300, combine_text_under_n_chars=80)
        return chunks.select(
            F.sum(F.xxhash64("record_id", "pos", "text", "type").cast("decimal(38,0)"))
        ).first()[0]

    assert digest(parts) == digest(parts.orderBy(F.xxhash64("element_id")).repartition(7))


@pytest.mark.parametrize("strategy", ["basic", "by_title"])
def test_chunks_cover_the_text(parts, strategy):
    chunks = chunk.chunk_elements(parts, strategy, 200)
    assert chunks.agg(F.max(F.length("text"))).first()[0] <= 200
    kept = chunks.filter("metadata.is_continuation IS NULL").select(
        "record_id", F.explode("orig").alias("o")
    )
    assert kept.count() == parts.count()
    assert kept.select("record_id", "o.pos").distinct().count() == parts.count()
    # Without overlap the pieces of a record put its text together again.
    rows = chunks.select("record_id", "pos", "text", "metadata.is_continuation").collect()
    texts = {}
    for r in sorted(rows, key=lambda r: (r["record_id"], r["pos"])):
        glue = "" if r["is_continuation"] else "\n\n"
        before = texts.get(r["record_id"])
        texts[r["record_id"]] = r["text"] if before is None else before + glue + r["text"]
    whole = {}
    for r in parts.select("record_id", "pos", "text").orderBy("record_id", "pos").collect():
        before = whole.get(r["record_id"])
        whole[r["record_id"]] = r["text"] if before is None else before + "\n\n" + r["text"]
    assert texts == whole


def test_title_opens_a_chunk(parts):
    assigned = chunk.assign_chunks(parts, "by_title", 10_000)
    inside = assigned.filter("type = 'Title' AND pos <> chunk_start")
    assert inside.isEmpty()


def test_overlap_all_repeats_the_tail(parts):
    chunks = chunk.chunk_elements(parts, "basic", 300, overlap=25, overlap_all=True)
    rows = chunks.collect()
    texts = {(r["record_id"], r["pos"]): r["text"] for r in rows}
    assert max(map(len, texts.values())) <= 300
    for (record, pos), value in texts.items():
        if pos:
            assert value[:20] in texts[record, pos - 1] + value[:20]


def test_unknown_strategy_passes_through(parts):
    assert chunk.chunk_elements(parts, "by_mood") is parts


def test_embedding_keeps_rows_without_text(spark):
    rows = spark.createDataFrame(
        [(0, "a", None), (1, "", [1.0]), (2, None, None)],
        "pos int, text string, embeddings array<float>",
    )
    got = {r["pos"]: r["embeddings"] for r in embed.embed_elements(rows, dimension=8).collect()}
    assert len(got[0]) == 8 and got[1] == [1.0] and got[2] is None
    assert embed.encoder_dimension("hash", dimension=8) == 8


def test_encoder_count_must_match(spark):
    def short(texts):
        return [[0.0]] * (len(texts) - 1)

    rows = spark.createDataFrame([(i, "x") for i in range(5)], "pos int, text string")
    with pytest.raises(Exception, match="4 vectors for 5 texts|vectors for"):
        embed.embed_elements(rows, lambda: short).collect()


def test_encoder_names_are_taken_once():
    with pytest.raises(ValueError, match="already registered"):
        embed.register_encoder("hash", embed.hash_encoder)


PAGE = """
<p><A HREF=report.xlsx>bare</A> <a class="x" href='/files/slides.pptx'>rooted</a>
<a href="https://other.example/data.csv?a=1&amp;b=2">elsewhere</a> <a name="anchor">none</a>
<!-- <a href="hidden.pdf"> --><script>'<a href="script.pdf">'</script><a href="#top.x">t</a>
"""


def test_file_links(spark):
    pages = spark.createDataFrame(
        [("https://docs.example/guide/intro", PAGE)], "url string, html string"
    )
    links = [r["link"] for r in html.extract_links(pages).orderBy("pos").collect()]
    assert links == ["https://docs.example/report.xlsx", "https://docs.example/files/slides.pptx"]
    both = html.extract_links(pages, allow_list=["https://other", "https://docs"]).collect()
    assert len(both) == 3 and any("data.csv" in r["link"] for r in both)


def test_html_elements(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><h1>Head <b>line</b></h1>"
        "<p>Some words in a row &amp; more.</p><ul><li>one</li><li><a href='/x'>two</a></li></ul>"
        "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>&lt;2&gt;</td></tr></table>"
        "<address>1 Road</address>tail</body></html>"
    )
    broken = "<p>open <b>never closed <table><tr><td>cell"
    docs = spark.createDataFrame(
        [("d", "d.html", "http://x", page), ("e", "e.html", "http://x", broken)],
        "identifier string, filename string, url string, body string",
    )
    rows = html.partition_html(docs).orderBy("record_id", "pos").collect()
    first = [(r["type"], r["text"]) for r in rows if r["record_id"] == "d"]
    assert first == [
        ("Title", "Head line"),
        ("NarrativeText", "Some words in a row & more."),
        ("ListItem", "one"),
        ("ListItem", "two"),
        ("Table", "a b 1 <2>"),
        ("Address", "1 Road"),
        ("UncategorizedText", "tail"),
    ]
    table = next(r for r in rows if r["type"] == "Table")
    assert "<td>&lt;2&gt;</td>" in table["metadata"]["text_as_html"]
    assert [r["text"] for r in rows if r["record_id"] == "e"] == ["open never closed", "cell"]


def test_pages_that_do_not_parse_are_kept_as_errors(spark):
    docs = spark.createDataFrame(
        [
            ("a", "a.html", "http://x/a", "<p>Fine</p>"),
            ("b", "b.html", "http://x/b", "<p>Lost</p><![x[ y"),
            ("c", "c.html", "http://x/c", None),
            ("b", "b.html", "http://x/b", "<![x[ y"),
        ],
        "identifier string, filename string, url string, body string",
    )
    flow = Flow(docs).partition_html_or_fail()
    assert [(r["record_id"], r["text"]) for r in flow.rows.collect()] == [("a", "Fine")]
    assert {(r["record_id"], r["step"]) for r in flow.errors.collect()} == {("b", "partition")}
    assert all(r["error"].startswith("AssertionError: ") for r in flow.errors.collect())
    assert [tuple(r) for r in status_report(flow.errors).collect()] == [("partition", 2, 1)]
    with pytest.raises(RuntimeError, match="partition failed for b"):
        fail_on_errors(flow.errors)
    assert flow.key == Flow(docs).partition("html").key
    assert Flow(docs.limit(1)).partition_html_or_fail().errors.isEmpty()


def test_text_types(spark):
    lines = {
        "- item": "ListItem",
        "12. item": "ListItem",
        "A Short Heading": "Title",
        "This sentence has five words.": "NarrativeText",
        "a\tb\tc": "Table",
        "1 Main Street, Springfield, IL 62704": "Address",
        "12345": "UncategorizedText",
    }
    rows = spark.createDataFrame([(k,) for k in lines], "t string")
    got = rows.select("t", partition.element_type(F.col("t")).alias("k")).collect()
    assert {r["t"]: r["k"] for r in got} == lines


def test_csv_table(spark):
    docs = spark.createDataFrame(
        [("d", "d.csv", 'a,b\n"x, ""y""","line\nbreak"\n')],
        "identifier string, filename string, body string",
    )
    row = partition.partition_csv(docs).first()
    assert row["text"] == 'a b x, "y" line\nbreak'
    assert row["metadata"]["text_as_html"] == (
        "<table><tr><td>a</td><td>b</td></tr><tr><td>x, \"y\"</td><td>line\nbreak</td></tr></table>"
    )


def test_metadata_lists_are_exclusive(parts):
    with pytest.raises(ValueError, match="not both"):
        partition.postprocess(parts, exclude=["a"], include=["b"])


def test_orig_elements_round_trip(spark):
    original = [{"text": "Hello, world!", "metadata": {"page": 1, "text_as_html": "<p>"}}]
    packed = base64.b64encode(zlib.compress(json.dumps(original).encode())).decode()
    rows = spark.createDataFrame([(packed,), ("junk",), (None,)], "p string")
    got = rows.select(orig_elements.light_orig_elements(F.col("p")).alias("r")).collect()
    assert [r["r"] for r in got] == ['[{"metadata":{"page":1}}]', None, None]


def test_packed_chunks_decode(parts):
    chunks = orig_elements.pack_orig_elements(chunk.chunk_elements(parts, "basic", 500))
    row = chunks.select("orig", "metadata.orig_elements").first()
    decoded = json.loads(zlib.decompress(base64.b64decode(row["orig_elements"])))
    assert [e["element_id"] for e in decoded] == [e["element_id"] for e in row["orig"]]


def test_unsupported_media(spark):
    docs = spark.createDataFrame(
        [("a", "text/plain"), ("b", "image/x")], "identifier string, media string"
    )
    known, errors = partition.route_media(docs)
    assert [r["identifier"] for r in known.collect()] == ["a"]
    assert [r["record_id"] for r in errors.collect()] == ["b"]
    with pytest.raises(Exception, match="unsupported file type"):
        partition.route_media(docs, raise_unsupported=True)[0].collect()


def test_flow_key_depends_on_settings(spark, sf_dir):
    flow = Flow(roles.documents(spark, sf_dir)).partition()
    assert flow.key == Flow(roles.documents(spark, sf_dir)).partition().key
    assert flow.key != flow.chunk("basic", max_characters=99).key


def test_images_are_swapped_at_their_tags(spark):
    page = (
        "<p>src=\"/a.png\"</p><IMG SRC=/a.png><img alt='>' src = '/b.png?x=1&amp;y=2'>"
        '<a src="/a.png">no image</a><!-- <img src="/a.png"> --><img src="/gone.png">'
    )
    pages = spark.createDataFrame([(1, "http://s.example/p", page), (2, "http://s.example/q", "x")],
                                  "page_id int, url string, html string")
    assets = spark.createDataFrame(
        [("http://s.example/a.png", bytearray(b"A")), ("http://s.example/b.png?x=1&y=2", bytearray(b"B"))],
        "image_url string, content binary",
    )
    got = {r["page_id"]: r["html"] for r in html.inline_images(pages, assets, "page_id").collect()}
    data = "data:image/png;base64,"
    assert got[1] == page.replace("SRC=/a.png", f'SRC="{data}QQ=="').replace(
        "'/b.png?x=1&amp;y=2'", f'"{data}Qg=="'
    )
    assert got[2] == "x"


def test_maps_of_destinations_make_no_json_of_their_entries(spark, sf_dir):
    """Only maps are asked for, so no value is printed as JSON beside its text."""
    from sluice.operators import staging

    for stage in (staging.stage_kdbai, staging.stage_chroma, staging.stage_qdrant):
        rows = stage(roles.elements(spark, sf_dir))
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert ", json, " not in plan


def test_images_are_swapped_over_slices_of_a_batch():
    import pyarrow as pa

    from sluice.operators import html as pages_html

    n = 2 * pages_html.SWAP_ROWS + 7
    texts = pa.array([f'<img src="/{k}.png">' if k % 5 else None for k in range(n)])
    images = pa.array([[{"src": f"/{k}.png", "data": f"data:{k}"}] for k in range(n)])
    got = pages_html._swap_images.func(texts, images).to_pylist()
    assert got == [f'<img src="data:{k}">' if k % 5 else None for k in range(n)]
    assert pages_html._swap_images.func(texts[:0], images[:0]).to_pylist() == []
