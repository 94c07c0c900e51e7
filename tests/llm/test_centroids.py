import hashlib
import math

import numpy as np
import pytest

from sluice.llm import centroids

SCHEMA = (
    "vec_id long, embedding array<double>, label int, cluster string, distance string, id string, "
    "v string, planes string, inertia string"
)


def make_vectors(spark, rows):
    return spark.createDataFrame([(*row, 1, *("x",) * 6) for row in rows], SCHEMA)


def expected(rows, clusters, rounds):
    """The same with Python integers, pair by pair."""
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]

    def start(row):
        i = row[0]
        digest = "" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()
        return i is None, digest, row[1]

    middles = [v for _, v in sorted(kept, key=start)[:clusters]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), k) for k, c in enumerate(middles))

    for _ in range(rounds):
        places = [nearest(v)[1] for _, v in kept]
        for k in range(len(middles)):
            own = [v for (_, v), at in zip(kept, places) if at == k]
            if own:
                middles[k] = [sum(column) // len(own) for column in zip(*own)]
    last = [nearest(v) for _, v in kept]
    total = sum(d for d, _ in last)
    found = []
    for (i, _), (distance, k) in zip(kept, last):
        inertia = sum(d for d, at in last if at == k)
        digest = hashlib.sha256(",".join(map(str, middles[k])).encode()).hexdigest()
        found.append((i, k, distance, inertia, total, digest))
    return sorted(found, key=str)


def order(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def random_rows(n, scale=0.3, seed=4):
    draw = np.random.default_rng(seed)
    return [(k, (draw.normal(size=64) * scale).tolist()) for k in range(n)]


def test_planes_and_dot_products():
    draw = np.random.default_rng(1)
    for planes in (1, 9, 27):
        a, b = draw.integers(0, 1 << planes, (17, 64)), draw.integers(0, 1 << planes, (5, 64))
        x, y = centroids.pack(a, planes), centroids.pack(b, planes)
        assert x.shape == (17, planes) and x.dtype == np.uint64
        assert (centroids.unpack(x) == a).all()
        assert (centroids.dot_products(x, y) == a @ b.T).all()
    full = np.full((1, 64), (1 << 27) - 1)
    packed = centroids.pack(full, 27)
    assert centroids.dot_products(packed, packed)[0, 0] == 64 * ((1 << 27) - 1) ** 2


def test_against_plain_python(spark):
    rows = random_rows(150)
    found = centroids.cluster_vectors(make_vectors(spark, rows).repartition(5), clusters=7)
    assert order(found) == expected(rows, 7, 5)


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert order(centroids.cluster_vectors(table)) == expected(rows, 40, 5)


def test_odd_rows(spark):
    """Nulls, wrong lengths, non-finite components, ties, repeated rows and keys, large components."""
    inf, nan = float("inf"), float("nan")
    one, other = [0.25] * 64, [-0.25] * 64
    rows = [
        *random_rows(20),
        (30, None),
        (31, []),
        (32, [0.5] * 63),
        (33, [0.5] * 65),
        (34, [0.5] * 63 + [None]),
        (35, [0.5] * 63 + [inf]),
        (36, [-inf] + [0.5] * 63),
        (37, [0.5] * 63 + [nan]),
        (38, one),
        (38, one),
        (39, other),
        (40, [0.0] * 64),  # as far from the one as from the other
        (41, one),
        (42, [200_000.0] * 63 + [-200_000.0]),
        (None, one),
        (None, None),
    ]
    for clusters in (4, 60):
        found = centroids.cluster_vectors(make_vectors(spark, rows), clusters=clusters, rounds=3)
        assert order(found) == expected(rows, clusters, 3)


def test_equal_vectors_leave_clusters_empty(spark):
    """Equal starting centroids: the first takes all, the others stay as they are."""
    rows = [(k, [0.5] * 64) for k in range(200)]
    found = centroids.cluster_vectors(make_vectors(spark, rows))
    assert order(found) == expected(rows, 40, 5)
    assert {r.cluster for r in found.collect()} == {0}


def test_empty_table(spark):
    rows = [(1, None), (2, [1.0])]
    empty = centroids.cluster_vectors(make_vectors(spark, []))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"
    assert centroids.cluster_vectors(make_vectors(spark, rows)).collect() == []


def test_too_large(spark):
    for x in (1e300, -3e5, 262_144.0):
        with pytest.raises(ValueError, match="between"):
            centroids.cluster_vectors(make_vectors(spark, [(1, [x] * 64)]))


def test_blocks_are_short_with_many_clusters(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_COUNTS", 1)
    rows = random_rows(90, seed=9)
    found = centroids.cluster_vectors(make_vectors(spark, rows), clusters=5, rounds=2)
    assert order(found) == expected(rows, 5, 2)
