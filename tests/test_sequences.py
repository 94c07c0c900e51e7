"""Ordered operators against plain Python, with one record holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import packing, sequence
from sluice.operators.batching import batch_by_count, global_position, position_in_group


def skewed(seed=3, big=400):
    """(record, pos, page, size): one large record, some small ones, in random order."""
    rng = random.Random(seed)
    rows = []
    for record, n in [("big", big), ("s1", 1), ("s2", 7), ("s3", 16), ("s4", 17)]:
        page = 1
        for pos in range(n):
            if rng.random() < 0.08:
                page = rng.choice([1, 2, None])
            rows.append((record, pos, page, rng.choice([0, 1, 3, 5, 8, 30])))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return skewed()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "record_id string, pos long, page int, size long")


def by_record(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("block", [4, 16, 10_000])
def test_seq_on_page(frame, rows, block):
    expected = {}
    for record, items in by_record(rows).items():
        seq, before = 0, object()
        for _, pos, page, _ in items:
            seq = seq + 1 if page == before else 0
            before = page
            expected[record, pos] = seq
    got = sequence.seq_on_page(frame, "page", "seq", block_rows=block).collect()
    assert {(r["record_id"], r["pos"]): r["seq"] for r in got} == expected


@pytest.mark.parametrize("block", [4, 10_000])
def test_neighbours(frame, rows, block):
    expected = {}
    for record, items in by_record(rows).items():
        for i, (_, pos, _, _) in enumerate(items):
            before = items[i - 1][3] if i else None
            after = items[i + 1][3] if i + 1 < len(items) else None
            expected[record, pos] = (before, after)
    got = sequence.neighbours(frame, "size", "b", "a", block_rows=block).collect()
    assert {(r["record_id"], r["pos"]): (r["b"], r["a"]) for r in got} == expected


@pytest.mark.parametrize("block", [4, 10_000])
def test_previous_present(frame, rows, block):
    expected = {}
    for record, items in by_record(rows).items():
        last = None
        for _, pos, page, _ in items:
            expected[record, pos] = last
            last = page if page is not None else last
    got = sequence.previous_present(frame, "page", "p", block_rows=block).collect()
    assert {(r["record_id"], r["pos"]): r["p"] for r in got} == expected


def test_dense_position(frame, rows):
    gaps = frame.withColumn("pos", F.col("pos") * 7)
    got = sequence.dense_position(gaps, "nth", block_rows=50).collect()
    assert all(r["nth"] * 7 == r["pos"] for r in got) and len(got) == len(rows)


def greedy(items, limit, soft, sep, max_rows, starts):
    out, start, held, n = [], None, 0, 0
    for _, pos, page, size in items:
        fits = (
            start is not None
            and held + sep + size <= limit
            and held < soft
            and n < max_rows
            and held <= limit
        )
        if not fits or (starts and page == 2):
            start, held, n = pos, size, 1
        else:
            held, n = held + sep + size, n + 1
        out.append(start)
    return out


@pytest.mark.parametrize(
    ("limit", "soft", "sep", "max_rows", "starts"),
    [
        (12, None, 2, None, False),
        (12, 6, 2, None, True),
        (20, None, 0, 4, False),
        (None, None, 0, 3, False),
        (9, None, 1, None, True),
    ],
)
@pytest.mark.parametrize("supers", [2, 1024])
def test_pack_across_blocks(frame, rows, monkeypatch, limit, soft, sep, max_rows, starts, supers):
    monkeypatch.setattr(packing, "SUPER_BLOCKS", supers)
    flagged = frame.withColumn("opens", F.coalesce(F.col("page") == 2, F.lit(False)))
    got = packing.pack(
        flagged, "record_id", "pos", "size", limit, soft=soft, sep=sep, max_rows=max_rows,
        starts="opens" if starts else None, out="g", block_rows=8,
    ).collect()
    big = 1 << 60
    expected = {}
    for record, items in by_record(rows).items():
        groups = greedy(items, limit or big, soft or big, sep, max_rows or big, starts)
        expected.update({(record, r[1]): g for r, g in zip(items, groups)})
    assert {(r["record_id"], r["pos"]): r["g"] for r in got} == expected


def test_pack_example(spark):
    sizes = [5, 5, 3, 9, 1, 2]
    rows = spark.createDataFrame([("r", i, n) for i, n in enumerate(sizes)],
                                 "record_id string, pos long, size long")
    got = packing.pack(rows, "record_id", "pos", "size", 10, out="g").orderBy("pos").collect()
    assert [r["g"] for r in got] == [0, 0, 2, 3, 3, 5]


def test_global_position(spark):
    numbers = list(range(1000))
    random.Random(1).shuffle(numbers)
    rows = spark.createDataFrame([(n,) for n in numbers], "k long").repartition(4)
    placed = global_position(rows, ["k"], partitions=4).collect()
    assert all(r["position"] == r["k"] for r in placed) and len(placed) == 1000
    batches = batch_by_count(rows, ["k"], 100).groupBy("batch_no").count().collect()
    assert sorted((r["batch_no"], r["count"]) for r in batches) == [(i, 100) for i in range(10)]


def test_position_in_group(frame, rows):
    got = position_in_group(frame.select("record_id", "pos"), ["record_id"], ["pos"]).collect()
    assert all(r["nth"] == r["pos"] for r in got) and len(got) == len(rows)


def test_positions_of_few_groups_leave_the_rows_in_place(spark):
    """Rows of a giant group are not brought together to learn where the group begins."""
    from sluice.operators.batching import position_in_group

    frame = spark.range(20_000).select((F.col("id") % 2).alias("record_id"), F.col("id").alias("pos"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40000")
    try:
        placed = position_in_group(frame, ["record_id"], ["pos"])
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan
    assert placed.filter("nth <> floor(pos / 2)").isEmpty()
