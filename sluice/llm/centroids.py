"""K-means over integer vectors by bit planes and population counts.

Components become integers, and all of them are shifted by the smallest one of the table, which
changes no distance. Plane b of a vector is one uint64 whose bit k is bit b of component k, so a
vector of 64 components below 2^B is B numbers. The dot product of two vectors is the sum over pairs
of planes of 2^(i + j) times the bits that plane i of the one and plane j of the other have in
common. It is exact, and with the squared lengths it gives exact squared distances.

A round is one pass over the table of planes. Tasks hand on sums and counts per cluster; the driver
sees one row per cluster and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import staged

COMPONENTS = 64  # bits of a plane
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
MOST = 1 << 26  # components must be smaller, so that squared distances and their sums fit a long
ROWS = 2048  # vectors compared at once
BLOCK_COUNTS = 1 << 22  # counts held at once, by weight, vector and centroid


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Rows of 64 integers from 0 up to 2^``planes`` as rows of ``planes`` uint64."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def unpack(packed: np.ndarray) -> np.ndarray:
    """The integers of rows of planes."""
    octets = np.ascontiguousarray(packed)[:, :, None].view(np.uint8)
    bits = np.unpackbits(octets, axis=2, bitorder="little").astype(np.int64)
    return (bits << np.arange(packed.shape[1])[None, :, None]).sum(axis=1)


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of every row of ``left`` with every row of ``right``, from their planes."""
    planes = left.shape[1]
    # Common bits by weight: at most 64 for each of the pairs of planes that share a weight.
    common = np.zeros((2 * planes - 1, len(left), len(right)), np.uint16)
    for i in range(planes):
        for j in range(planes):
            common[i + j] += np.bitwise_count(left[:, i, None] & right[None, :, j])
    total = np.zeros((len(left), len(right)), np.int64)
    for weight, counts in enumerate(common):
        total += counts.astype(np.int64) << weight
    return total


def nearest(packed: np.ndarray, values: np.ndarray, centroids: np.ndarray):
    """(cluster, squared distance) of every row; of equal distances, the smallest cluster.

    ``packed`` are the planes of ``values``; ``centroids`` are planes too.
    """
    squares = (values**2).sum(axis=1)[:, None] + (unpack(centroids) ** 2).sum(axis=1)[None, :]
    distances = squares - 2 * dot_products(packed, centroids)
    cluster = distances.argmin(axis=1)
    return cluster, distances[np.arange(len(packed)), cluster]


def kept(vectors: DataFrame, vector: str) -> Column:
    """Whether a row's vector has exactly 64 components, all of them finite numbers."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce((F.size(vector) == COMPONENTS) & finite, F.lit(False))


@dataclass
class Planes:
    """The table of planes: rows (id, planes) and what all of them share."""

    rows: DataFrame
    planes: int
    shift: int  # the smallest component
    centroids: np.ndarray  # (clusters, 64) integers


def packed_table(
    vectors: DataFrame, key: str, vector: str, clusters: int, scale: int, seed: int
) -> Planes | None:
    """The kept vectors as planes, and the starting centroids; None if no vector is kept."""
    integers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = vectors.where(kept(vectors, vector)).select(
        F.col(key).cast("long").alias("id"), integers.alias("v")
    )
    ends = rows.agg(
        F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")
    ).first()
    if ends["low"] is None:
        return None
    if max(-ends["low"], ends["high"]) >= MOST:
        raise ValueError(f"components times {scale} must be between -{MOST} and {MOST}")
    shift = int(ends["low"])
    planes = max(1, (int(ends["high"]) - shift).bit_length())
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    centroids = np.array([row["v"] for row in first], np.float64).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                values = part["v"].flatten().to_numpy().reshape(-1, COMPONENTS).astype(np.int64)
                data = pack(values - shift, planes)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array([row.tobytes() for row in data], pa.binary())],
                    ["id", "planes"],
                )

    packed = staged(rows.mapInArrow(run, "id long, planes binary"), "planes")
    return Planes(packed, planes, shift, centroids)


def _blocks(batches: Iterator[pa.RecordBatch], planes: int, clusters: int):
    """(ids, planes, values) of runs of rows, short enough for a block of counts by weight."""
    rows = max(16, min(ROWS, BLOCK_COUNTS // (2 * planes * clusters)))
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            data = np.frombuffer(b"".join(part["planes"].to_pylist()), np.uint64)
            packed = data.reshape(-1, planes)
            yield part["id"], packed, unpack(packed)


def cluster_sums(table: Planes) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (count, sums of components) of the vectors nearest to it, less the shift.

    Every task adds up its own vectors, so a cluster that holds most of them is no hot key.
    """
    planes, centroids = table.planes, pack(table.centroids - table.shift, table.planes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), COMPONENTS), np.int64)
        counts = np.zeros(len(centroids), np.int64)
        for _, packed, values in _blocks(batches, planes, len(centroids)):
            cluster, _ = nearest(packed, values, centroids)
            order = cluster.argsort(kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(values[order], starts, axis=0)
            counts += np.bincount(cluster, minlength=len(centroids))
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(full, COMPONENTS)),
                pa.array(np.tile(np.arange(COMPONENTS), len(full))),
                pa.array(sums[full].reshape(-1)),
                pa.array(np.repeat(counts[full], COMPONENTS)),
            ],
            ["cluster", "place", "total", "count"],
        )

    parts = table.rows.mapInArrow(run, "cluster long, place long, total long, count long")
    found: dict[int, tuple[int, list[int]]] = {}
    rows = parts.groupBy("cluster", "place").agg(
        F.sum("total").alias("total"), F.sum("count").alias("count")
    )
    for row in rows.collect():  # a row per cluster and component
        _, sums = found.setdefault(row["cluster"], (row["count"], [0] * COMPONENTS))
        sums[row["place"]] = row["total"]
    return found


def moved(table: Planes) -> np.ndarray:
    """The centroids after a round: componentwise floor of the mean; empty clusters stay."""
    centroids = table.centroids.copy()
    for cluster, (count, sums) in cluster_sums(table).items():
        centroids[cluster] = [total // count + table.shift for total in sums]
    return centroids


def assigned(table: Planes) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    planes, centroids = table.planes, pack(table.centroids - table.shift, table.planes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, packed, values in _blocks(batches, planes, len(centroids)):
            cluster, distance = nearest(packed, values, centroids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["id", "cluster", "distance"],
            )

    return table.rows.mapInArrow(run, "id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = 2,
) -> DataFrame:
    """One row per kept vector: ``key``, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors are kept that have exactly 64 components, none of them null, NaN or infinite. Component
    x becomes floor(``scale`` * x). The centroids start as the kept vectors whose
    sha256("seed:key") is smallest, in that order, and move ``rounds`` times. Vectors that share a
    key count one by one, in the order of their components; vectors without key are clustered too,
    but start no cluster while others are left. With fewer vectors than clusters, there are as many
    clusters as vectors; without vectors, no rows. Ties go to the smaller cluster. Extra columns are
    ignored. Components of 2^26 or more after scaling raise a ValueError, as distances would not fit
    a long.
    """
    spark = vectors.sparkSession
    table = packed_table(vectors, key, vector, clusters, scale, seed)
    if table is None:
        return spark.createDataFrame(
            [],
            f"`{key}` long, cluster int, distance long, cluster_inertia long, inertia long, "
            "centroid_sha256 string",
        )
    for _ in range(rounds):
        table.centroids = moved(table)
    found = staged(assigned(table), "assigned")
    inertia = {
        row["cluster"]: row["inertia"]
        for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    }
    total = sum(inertia.values())
    of_cluster = [
        (c, inertia[c], total, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(table.centroids.tolist())
        if c in inertia
    ]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # A row per cluster.
    to = F.broadcast(spark.createDataFrame(of_cluster, names))
    return found.join(to, "cluster").select(
        F.col("id").alias(key),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
    )
