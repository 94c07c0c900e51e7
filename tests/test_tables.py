"""Replace-by-record tables, file writers and batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sluice.operators import external, files, staging, tables
from sluice.operators.tables import RecordTable
from sluice.plans import roles


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def old(spark):
    return spark.createDataFrame(
        [(f"r{i % 5}", i, "old") for i in range(20)], "record_id string, n int, load string"
    )


@pytest.fixture
def new(spark):
    return spark.createDataFrame(
        [("r1", 100, "new"), ("r9", 101, "new")], "record_id string, n int, load string"
    )


def test_overwrite_is_idempotent(spark, tmp_path, old, new):
    table = RecordTable(spark, str(tmp_path / "t"), buckets=4)
    table.append(old)
    table.overwrite_records(new)
    once = rows_of(table.read())
    table.overwrite_records(new)
    assert rows_of(table.read()) == once
    expected = [r for r in rows_of(old) if r[0] != "r1"] + rows_of(new)
    assert once == sorted(expected)


def test_untouched_buckets_are_not_rewritten(spark, tmp_path, old):
    table = RecordTable(spark, str(tmp_path / "t"), buckets=16)
    table.append(old)

    def files_of():
        found = {}
        for name in table.read().inputFiles():
            found.setdefault(name.split("_bucket=")[1].split("/")[0], set()).add(name)
        return found

    before = files_of()
    table.overwrite_records(old.filter("record_id = 'r2'"))
    after = files_of()
    assert set(after) == set(before) and len(before) > 2
    assert sum(before[b] != after[b] for b in before) == 1


def test_the_table_outlives_its_object(spark, tmp_path, old, new):
    RecordTable(spark, str(tmp_path / "t"), buckets=4).append(old)
    again = RecordTable(spark, str(tmp_path / "t"), buckets=4)
    assert not again.create_if_missing(new.schema)
    again.overwrite_records(new)
    assert again.read().schema.names == old.schema.names
    assert again.read().filter("record_id = 'r1'").count() == 1


def test_writes_without_rows_change_nothing(spark, tmp_path, old):
    table = RecordTable(spark, str(tmp_path / "t"), buckets=4)
    assert table.schema() is None and table.create_if_missing(old.schema)
    table.overwrite_records(old.limit(0))
    assert table.read().count() == 0
    table.append(old)
    table.overwrite_records(old.limit(0))
    table.append(old.limit(0))
    assert rows_of(table.read()) == rows_of(old)


def test_schema_grows(spark, tmp_path, old):
    table = RecordTable(spark, str(tmp_path / "t"), buckets=2)
    table.append(old)
    wider = old.limit(1).withColumn("extra", F.lit("x"))
    table.append(wider)
    assert "extra" not in table.read().columns
    table.append(wider, merge_schema=True)
    assert table.read().filter("extra = 'x'").count() == 1
    assert table.read().count() == 22


def test_upsert_keeps_one_row_per_id(spark, old):
    arriving = spark.createDataFrame(
        [("a", "2"), ("a", "1"), ("c", "3")], "id string, v string"
    )
    existing = spark.createDataFrame([("a", "0"), ("b", "0")], "id string, v string")
    assert rows_of(tables.upsert_rows(existing, arriving)) == [("a", "1"), ("b", "0"), ("c", "3")]


def test_table_without_record_column_only_appends(spark):
    existing = spark.createDataFrame([("x",)], "text string")
    arriving = spark.createDataFrame([("r", "y")], "record_id string, text string")
    assert tables.replace_records(existing, arriving).count() == 2


def test_prefix_delete_with_hash_in_record_id(spark):
    tail = "#" + "0" * 8 + "-0000-5000-8000-" + "0" * 12
    rows = spark.createDataFrame([("a#b" + tail,), ("a" + tail,)], "id string")
    gone = spark.createDataFrame([("a",)], "record_id string")
    assert rows_of(tables.delete_by_prefix(rows, gone)) == [("a#b" + tail,)]


def test_batches_are_never_empty():
    sizes = [50, 3, 3, 3, 60, 1]
    got = list(external.batches(sizes, 2, 10, lambda n: n))
    assert got == [[50], [3, 3], [3], [60], [1]]
    assert list(external.batches([], 2, 10, lambda n: n)) == []


def test_registry_rejects_a_taken_name():
    registry = external.Registry()
    registry.register_source("s3", print)
    registry.register_destination("s3", print)
    with pytest.raises(ValueError):
        registry.register_source("s3", print)
    with pytest.raises(ValueError):
        registry.register_destination("s3", print)


def test_documents_as_files(spark, tmp_path, sf_dir):
    parts = roles.parts(spark, sf_dir).withColumn("path", F.col("record_id"))
    documents = files.json_documents(parts, "path", part_rows=5)
    first = files.write_documents(documents, str(tmp_path / "out"))
    n = first.agg(F.count("*"), F.sum("n_bytes")).first()
    again = files.write_documents(documents, str(tmp_path / "out"))
    assert again.agg(F.count("*"), F.sum("n_bytes")).first() == n
    names = os.listdir(tmp_path / "out")
    assert len(names) == n[0] and not [x for x in names if x.endswith(".tmp")]
    total = 0
    for name in names:
        with open(tmp_path / "out" / name, encoding="utf-8") as f:
            items = json.load(f)
        total += len(items)
    assert total == parts.count()
    assert len(names) == parts.select("record_id").distinct().count()
    assert documents.where("part > 1").count() > 0


def test_elements_move_once_into_documents(spark, tmp_path, monkeypatch):
    """Elements with gaps, repeated positions, no path, and documents of several parts."""
    rows = [("a", n, f"a{n}") for n in range(7)] + [("b", 0, "b"), ("c", 0, "c"), ("c", 0, "c")]
    rows += [("d", n, f"d{n}") for n in (0, 9)] + [("e", n % 3, f"e{n}") for n in range(6)] + [(None, 0, "x")]
    frame = spark.createDataFrame(rows, "path string, pos long, text string")
    monkeypatch.setattr(files, "element_json", lambda elements: F.col("text"))
    documents = files.json_documents(frame, "path", part_rows=3)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    found = sorted((r["path"] or "", r["part"], r["body"]) for r in documents.collect())
    assert found == [
        ("", 0, "[]"),
        ("a.json", 0, "[a0,a1,a2"), ("a.json", 1, ",a3,a4,a5"), ("a.json", 2, ",a6]"),
        ("b.json", 0, "[b]"), ("c.json", 0, "[c,c]"), ("d.json", 0, "[d0]"), ("d.json", 3, ",d9"),
        ("e.json", 0, "[e0,e3,e1,e4,e2,e5"),
    ]
    dealt = files._dealt(documents.where("path IS NOT NULL"), files.SEGMENT_PARTS)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    files.write_documents(documents.where("path IS NOT NULL"), str(tmp_path)).collect()
    assert (tmp_path / "a.json").read_text() == "[a0,a1,a2,a3,a4,a5,a6]"
    assert sorted(os.listdir(tmp_path)) == [f"{name}.json" for name in "abcde"]


def test_unparsed_lines_are_kept(spark, tmp_path):
    path = tmp_path / "x.ndjson"
    path.write_text('{"element_id":"a","text":"t"}\nnot json\n')
    rows = files.read_element_files(spark, str(path), "ndjson").cache()
    assert rows.filter("_corrupt_record IS NOT NULL").count() == 1
    assert rows.filter("element_id = 'a'").count() == 1


def test_vector_rules_of_the_document_store(spark, sf_dir):
    rows = roles.elements(spark, sf_dir)
    with pytest.raises(Exception, match="no vectors"):
        staging.stage_astradb(rows).collect()
    with pytest.raises(Exception, match="vectors and the store"):
        staging.stage_astradb(rows, generate_embeddings=True).collect()


def test_missing_listed_field_fails(spark, sf_dir):
    with pytest.raises(KeyError):
        staging.stage_milvus(roles.elements(spark, sf_dir), fields=["nowhere"])


def test_many_files_of_one_task_are_all_reported(spark, tmp_path):
    from pyspark.sql import functions as F

    from sluice.operators.files import REPORT_ROWS, write_documents

    n = REPORT_ROWS + 5
    rows = spark.range(0, n, 1, 1).select(
        F.concat((F.col("id") % 3).cast("string"), F.lit("/"), F.col("id").cast("string")).alias("path"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("body"),
    )
    found = {r["path"]: r["n_bytes"] for r in write_documents(rows, str(tmp_path)).collect()}
    assert found == {f"{k % 3}/{k}": len(f"t{k}") for k in range(n)}
    assert len(list(tmp_path.glob("*/*"))) == n


def _long_documents(spark):
    """a: one segment of two parts, b: just two, c: two and a part, d: from part 6 on; parts of three."""
    n_parts = {"a": 1, "x/b": 4, "x/c": 5, "d": 9}
    rows = [
        (path, n, f"{path}{n}é\n" * n) for path, k in n_parts.items() for n in range(k) if path != "d" or n > 5
    ]
    expected = {}
    for path, _, body in sorted(rows):
        expected[path] = expected.get(path, "") + body
    return spark.createDataFrame(rows[::-1], "path string, part long, body string"), expected


def test_segments_of_a_document_are_one_file(spark, tmp_path):
    documents, expected = _long_documents(spark)
    for _ in range(2):
        found = files.write_documents(documents, str(tmp_path), segment_parts=2)
        sizes = {r["path"]: r["n_bytes"] for r in found.collect()}
        assert sizes == {p: len(t.encode()) for p, t in expected.items()}
    there = {str(f.relative_to(tmp_path)): f for f in tmp_path.rglob("*") if f.is_file()}
    assert {p: f.read_text("utf-8") for p, f in there.items() if not p.endswith(".crc")} == expected


def test_no_task_gets_all_parts_of_a_document(spark, tmp_path, monkeypatch):
    held = []
    joined_up = files._joined_up

    def watched(segments, folder, run):
        held.extend(tuple(r) for r in segments.select("path", "segment", "n_bytes").collect())
        return joined_up(segments, folder, run)

    monkeypatch.setattr(files, "_joined_up", watched)
    documents = spark.range(0, 1000, 1, 3).selectExpr("'a' AS path", "id AS part", "repeat('t', 10) AS body")
    found = files.write_documents(documents, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [("a", 10_000)]
    assert max(n for _, _, n in held) == 10 * files.SEGMENT_PARTS and len(held) == 16


def test_documents_are_put_together_without_offsets(spark, tmp_path, monkeypatch):
    from pyarrow import fs

    opened = fs.FileSystem.from_uri
    monkeypatch.setattr(files, "qualified", lambda spark, folder: folder)
    assert opened(str(tmp_path))[1] == str(tmp_path)  # a folder that is not known to be mounted
    documents, expected = _long_documents(spark)
    files.write_documents(documents, str(tmp_path), segment_parts=2)
    for path, text in expected.items():
        assert (tmp_path / path).read_text("utf-8") == text


def test_digests_go_on_from_range_to_range(spark, tmp_path):
    import hashlib

    from sluice.operators import digests

    (tmp_path / "below").mkdir()
    sizes = {"a.txt": 1, "b.txt": 99, "c.txt": 100, "below/d.txt": 1001}
    for name, n in sizes.items():
        (tmp_path / name).write_bytes(os.urandom(n))
    expected = {
        name: (n, hashlib.sha256((tmp_path / name).read_bytes()).hexdigest()) for name, n in sizes.items()
    }
    for pattern, names in (("*.txt", ["a.txt", "b.txt", "c.txt"]), ("*/*.txt", ["below/d.txt"])):
        for range_bytes in (100, 333, digests.RANGE_BYTES):
            rows = digests.file_digests(spark, str(tmp_path), pattern, range_bytes).collect()
            assert {r["path"]: (r["n_bytes"], r["digest"]) for r in rows} == {p: expected[p] for p in names}


def test_state_of_a_digest_is_handed_on():
    import hashlib

    from sluice.operators.digests import ResumableSha256, _crypto

    library, data = _crypto(), os.urandom(500)
    assert library is not None
    for cut in (0, 1, 63, 64, 65, 300, 500):
        first = ResumableSha256(library)
        first.update(data[:cut])
        second = ResumableSha256(library, first.state())
        second.update(data[cut:])
        assert second.hexdigest() == hashlib.sha256(data).hexdigest()


def test_overwrite_of_few_buckets_moves_rows_once(spark, tmp_path):
    grouped = []

    class Watched(RecordTable):
        def _write(self, rows, mode, grouped_=True):
            grouped.append((mode, grouped_))
            super()._write(rows, mode, grouped_)

    for buckets in (8, 64):
        target = Watched(spark, str(tmp_path / str(buckets)), buckets=buckets)
        target.append(keyed_rows(spark, [(str(n % 50), n) for n in range(200)]))
        arriving = keyed_rows(spark, [(str(n % 10), -n) for n in range(20)])
        for _ in range(2):
            target.overwrite_records(arriving)
            found = sorted(tuple(r) for r in target.read().select("record_id", "n").collect())
            kept = [(str(n % 50), n) for n in range(200) if n % 50 >= 10]
            assert found == sorted(kept + [(str(n % 10), -n) for n in range(20)])
    few, many = ("overwrite", False), ("overwrite", True)
    assert grouped == [("append", True), few, few, ("append", True), many, many]


def test_smallest_row_of_a_key_travels_once(spark):
    rows = keyed_rows(spark, [("a", 2), ("a", 1), ("b", None), ("b", 3), (None, 1)])
    found = tables.one_row_per_key(rows, "record_id")
    assert "min_by" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("a", 1), ("b", None), (None, 1)], key=str
    )


def keyed_rows(spark, rows):
    return spark.createDataFrame(rows, "record_id string, n long")


def test_elements_of_loads_are_not_joined_with_their_documents(spark, tmp_path):
    from sluice.plans.catalog.sinks import _rows

    texts = [(n, f"Some words of {n}.\nNumber {n} ends here.", "en", "web") for n in range(40)]
    texts += [texts[6], texts[6], (None, "No number.", "en", "web")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    docs.repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    existing, arriving = _rows(spark, str(tmp_path))
    plan = existing._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    # Three copies of document 6 are nine rows an element, as each copy meets each.
    assert existing.count() == 2 * (31 + 9) and arriving.where("type <> 'x'").count() == 2 * (13 + 9)
