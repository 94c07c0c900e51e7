import collections
import hashlib
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from sluice.llm import near_dedup
from sluice.llm.common import components
from sluice.llm.exact_dedup import DigestIndex, digests, drop_duplicates, exact_dedup
from tests.llm.conftest import changed, make_docs, words

ROOT = Path(__file__).parents[2]


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def expected_exact(rows):
    groups = collections.defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    found = []
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        found.append((doc_id, keep, len(ids), doc_id == keep, sha(text)))
    return sorted(found, key=str)


def test_exact(odd_docs, odd_rows):
    found = [tuple(r) for r in exact_dedup(odd_docs).collect()]
    assert sorted(found, key=str) == expected_exact(odd_rows)


def test_exact_empty(no_docs):
    assert exact_dedup(no_docs).count() == 0
    assert drop_duplicates(no_docs).count() == 0


LOAD = """
import sys
from sluice.llm.exact_dedup import DigestIndex, digests, exact_dedup
from sluice.session import local_session

spark = local_session(2, **{"spark.sql.warehouse.dir": sys.argv[3]})
docs = spark.createDataFrame([tuple(x.split("=")) for x in sys.argv[2].split(",")], "id string, text string")
docs = docs.selectExpr("cast(id AS long) AS doc_id", "text")
answers = exact_dedup(docs, DigestIndex(spark, "texts", sys.argv[1], 3))
print("ANSWERS", sorted((r.doc_id, r.keep_id, r.kept) for r in answers.collect()))
print("INDEX", sorted(r.keep_id for r in DigestIndex(spark, "texts", sys.argv[1]).rows().collect()))
try:
    DigestIndex(spark, "texts", sys.argv[1], 4)
except ValueError as problem:
    print("REFUSED", problem)
"""


def test_index_outlives_its_process(tmp_path):
    """Two processes, each with a catalog of its own, load the same index."""
    def load(rows, k):
        command = [sys.executable, "-c", LOAD, str(tmp_path / "index"), rows, str(tmp_path / f"w{k}")]
        done = subprocess.run(command, capture_output=True, text=True, timeout=300, cwd=ROOT)
        assert done.returncode == 0, done.stderr
        return dict(line.split(" ", 1) for line in done.stdout.splitlines() if line[:1].isupper())

    first = load("10=old,11=other", 1)
    assert first["ANSWERS"] == "[(10, 10, True), (11, 11, True)]"
    second = load("20=old,21=new", 2)
    assert second["ANSWERS"] == "[(20, 10, False), (21, 21, True)]"
    assert second["INDEX"] == "[10, 11, 21]"
    assert "3 buckets" in second["REFUSED"]


def test_compacted_index(spark):
    index = DigestIndex(spark, buckets=3)
    for k in range(4):
        index.append(digests(make_docs(spark, [(10 * k + i, f"{k}-{i}", "", "") for i in range(9)])))
    small = index.compacted()
    key = lambda r: (bytes(r.digest), r.keep_id)
    assert sorted(map(key, small.rows().collect())) == sorted(map(key, index.rows().collect()))
    assert len(small.rows().inputFiles()) == 3 < len(index.rows().inputFiles())
    again = exact_dedup(make_docs(spark, [(99, "2-5", "", "")]), small).first()
    assert (again.keep_id, again.kept) == (25, False)
    assert index.rows().count() == small.rows().count() == 36


def test_index_keeps_earlier_loads(spark):
    index = DigestIndex(spark, buckets=3)
    index.append(digests(make_docs(spark, [(5, "a", "", ""), (4, "a", "", ""), (3, "b", "", "")])))
    again = exact_dedup(make_docs(spark, [(9, "a", "", ""), (8, "c", "", "")]), index).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in again} == {(9, 5, False), (8, 8, True)}
    assert index.rows().count() == 3
    fresh = digests(make_docs(spark, [(7, "d", "", "")])).groupBy("digest").count()
    joined = fresh.join(index.rows().hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 3 out of 3" in plan


def test_rows_that_stay(odd_docs, odd_rows):
    left = drop_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    found = [(r.doc_id, r.text) for r in left.collect()]
    assert len(found) == len({r[1] or "" for r in odd_rows})
    assert len({t or "" for _, t in found}) == len(found)
    keep = {(r[1], r[4]) for r in expected_exact(odd_rows)}
    assert {(i, sha(t)) for i, t in found} == keep


def shingles(text):
    parts = (text or "").encode().lower().split()
    if not parts:
        return set()
    if len(parts) < 5:
        return {tuple(parts)}
    return {tuple(parts[k : k + 5]) for k in range(len(parts) - 4)}


def expected_near(rows, similarity=85):
    """Classes by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if i is None or j is None or not x or not y:
                continue
            common = len(x & y)
            if 100 * common >= similarity * (len(x) + len(y) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    found = []
    for i, x in sets:
        component = None if i is None else find(i)
        found.append((i, len(x), component, i == component))
    return sorted(found, key=str)


def near(docs):
    return sorted((tuple(r) for r in near_dedup.near_duplicates(docs).collect()), key=str)


def test_near(odd_docs, odd_rows):
    assert near(odd_docs) == expected_near(odd_rows)


def test_near_empty(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_near_chains_and_groups(spark):
    """Chains whose ends are not alike, a group with a base in the middle, and boilerplate."""
    base, chain = words(7, 200), [words(8, 200)]
    for k in range(6):
        chain.append(changed(chain[-1], k, 2))
    rows = [(100 - k, text, "", "") for k, text in enumerate(chain)]
    rows += [(200 + k, changed(base, k, 1 + k % 4), "", "") for k in range(40)] + [(220, base, "", "")]
    common = words(9, 60)
    rows += [(300 + k, common + " " + words(50 + k, 60), "", "") for k in range(20)]
    assert near(make_docs(spark, rows)) == expected_near(rows)


def test_near_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    base = words(17, 150)
    rows = [(k, changed(base, k, 2 + k % 3), "", "") for k in range(60)]
    assert near(make_docs(spark, rows)) == expected_near(rows)


def likeness(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_near_at_80(spark, sf_dir):
    """Pairs between 0.80 and 0.85 are linked when 80 is asked for, and by the pipeline stage."""
    bases = [words(400 + k, 1000) for k in range(30)]
    rows = [(2 * k, base, "", "") for k, base in enumerate(bases)]
    rows += [(2 * k + 1, changed(base, k, 19 + k % 3), "", "") for k, base in enumerate(bases)]
    rows += [(1000, words(500, 1000), "", ""), (1001, changed(words(500, 1000), 5, 25), "", "")]
    alike = [likeness(rows[k][1], rows[30 + k][1]) for k in range(30)]
    assert all(0.8 <= x < 0.85 for x in alike) and likeness(rows[60][1], rows[61][1]) < 0.8
    docs = make_docs(spark, rows)
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 80).collect()}
    assert found == {i: i if i >= 1000 else i - i % 2 for i in found} and len(found) == 62
    assert {r.component_id for r in near_dedup.near_duplicates(docs).collect()} == set(found)
    left = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()}
    assert left == {2 * k for k in range(30)} | {1000, 1001}


def test_near_stage_on_the_table(spark, docs, sf_dir):
    """The stage against all pairs at 80; the table has pairs between 80 and 85."""
    rows = [(r.doc_id, shingles(r.text)) for r in docs.select("doc_id", "text").collect()]
    edges = [(i, i) for i, _ in rows]
    for k, (i, x) in enumerate(rows):
        for j, y in rows[:k]:
            common = len(x & y)
            if common and 100 * common >= 80 * (len(x) + len(y) - common):
                edges.append((i, j))
    linked = components(spark.createDataFrame(edges, "a long, b long"))
    expected = {r.node for r in linked.where("node = component").collect()}
    left = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()}
    assert left == expected


def test_more_chunks_share_a_key_within_one_error():
    rows = np.arange(2 * near_dedup.VALUES, dtype=np.uint16).reshape(2, -1)
    rows[1] = rows[0]
    chunk_of = np.arange(near_dedup.VALUES) * near_dedup.MORE_CHUNKS // near_dedup.VALUES
    for chunk in range(near_dedup.MORE_CHUNKS):
        rows[1, np.flatnonzero(chunk_of == chunk)[: 1 if chunk == 4 else 2]] += 999
    assert (rows[0] != rows[1]).sum() == 2 * near_dedup.MORE_CHUNKS - 1
    keys = near_dedup.chunk_keys(rows, near_dedup.MORE_CHUNKS)
    assert (keys[0] == keys[1]).any()


def test_repeated_id_connects_its_texts(spark):
    a, b = words(21, 80), words(22, 80)
    rows = [(1, a, "", ""), (5, b, "", ""), (5, a, "", ""), (7, b, "", "")]
    found = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(make_docs(spark, rows)).collect()}
    assert found == {(1, 1), (5, 1), (7, 1)}


def test_near_copies_of_each_text_of_a_repeated_id(spark):
    a, b = words(23, 200), words(24, 200)
    rows = [(5, a, "", ""), (5, b, "", "")]
    rows += [(7, changed(a, 1, 2), "", ""), (8, changed(b, 2, 2), "", ""), (9, words(25, 200), "", "")]
    found = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(make_docs(spark, rows)).collect()}
    assert found == {(5, 5), (7, 5), (8, 5), (9, 9)}


def test_chunks_share_a_key_within_one_error():
    rows = np.arange(2 * near_dedup.VALUES, dtype=np.uint16).reshape(2, -1)
    rows[1] = rows[0]
    # Two errors in all chunks but one, which has a single error: 25 in all.
    for chunk, begin in enumerate(near_dedup.CHUNK_STARTS):
        rows[1, begin : begin + (1 if chunk == 4 else 2)] += 999
    assert (rows[0] != rows[1]).sum() == near_dedup.MAX_DISTANCE
    keys = near_dedup.chunk_keys(rows)
    assert (keys[0] == keys[1]).any()


@pytest.mark.parametrize("n", [3, 60, 900, 20_000])
def test_bitmaps_never_rule_out_a_link(n):
    draw = np.random.default_rng(n)
    for share in (0.7, 0.84, 0.86, 0.95, 1.0):
        both = draw.integers(0, 1 << 63, max(1, int(n * share))).astype(np.uint64)
        rest = draw.integers(0, 1 << 63, 2 * (n - len(both))).astype(np.uint64)
        a = np.concatenate([both, rest[::2]])
        b = np.concatenate([both, rest[1::2]])
        linked = 100 * len(both) >= 85 * (len(a) + len(b) - len(both))
        bits = near_dedup.bitmap_of(a), near_dedup.bitmap_of(b)
        may = near_dedup.may_link(len(a), len(b), *bits, 85)
        assert may or not linked
        if n == 60 and share < 0.8:
            assert not may


@pytest.mark.parametrize("n", [1, 2, 40])
def test_components(spark, n):
    edges = [(k, k + 1) for k in range(n)] + [(1000, 1000 + k) for k in range(1, 9)]
    edges += [(77777, 77777), (5, 5), (None, 3), (1004, 1000)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    expected = {k: 0 for k in range(n + 1)} | {1000 + k: 1000 for k in range(9)} | {77777: 77777}
    expected.setdefault(5, 5)
    assert found == expected
