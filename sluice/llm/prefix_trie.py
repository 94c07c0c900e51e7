"""The trie of conversation prefixes, by minimal-perfect-hash node tables.

1. Every conversation is a path of turns. The digest of its first d turns is the exclusive or of
   the hashes of (turn, place) of 256 bits, so prefixes of one conversation are running sums:
   conversations are cut into segments of ``SEGMENT`` turns, which need one sum each of what comes
   before. Equal digests are verified: they must have the same parent digest everywhere.
2. Rows (conversation, depth, digest) are dealt to shards of bounded size by segment. A shard
   enumerates its distinct digests and gives each a slot by a minimal perfect hash function; the
   digest stored in the slot is compared with the one asked for. Members, smallest member and ends
   are scattered into flat arrays by slot, and shards add up by digest.
3. Every node's own values (its saved tokens, whether it is a leaf) are placed once, in the segment
   of its smallest member. Shards add them up through arrays of parent slots, deepest first. What a
   segment has below it enters at its last turn, and shards add up by digest again.

No conversation, first turn or node has to fit into a task: a conversation of any length is many
segments, and a node that many share comes as one row from each shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import staged

SHARED = 9  # a conversation shares fewer than this many first turns with another
EVERY = 5  # the number of conversations that share them
SEGMENT = 1024  # turns
SHARD_ROWS = 1 << 16
LOAD = 2  # bits a key in a level of the hash function
LEVELS = 64
END_IDS = 4096  # ids joined at a time, for the digest of the ends

LANES = [f"d{k}" for k in range(4)]
PARENT = [f"p{k}" for k in range(4)]
NODE = "d0 long, d1 long, d2 long, d3 long"


class NodeTable:
    """A minimal perfect hash function over distinct digests, with the digests by slot.

    Level by level, the keys that are alone at their bit take it, and the others go on to the next
    level. A key's slot is the rank of its bit, so n keys have the slots 0 to n - 1.
    """

    def __init__(self, keys: np.ndarray):
        """``keys`` are rows of four uint64; repeated rows are allowed."""
        self.bits: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        left = distinct = np.unique(keys, axis=0)
        taken = 0
        for level in range(LEVELS):
            if not len(left):
                break
            places = self._places(left, level, LOAD * len(left))
            alone = np.bincount(places, minlength=LOAD * len(left)) == 1
            self.bits.append(alone)
            self.before.append(taken + np.cumsum(alone) - alone)
            taken += int(alone.sum())
            left = left[~alone[places]]
        if len(left):
            raise RuntimeError("digests that no level of the hash function tells apart")
        self.digests = np.empty_like(distinct)
        self.digests[self._slots(distinct)] = distinct

    def __len__(self) -> int:
        return len(self.digests)

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = keys[:, level % 4] + np.uint64(level) * (keys[:, (level + 1) % 4] | np.uint64(1))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            places = self._places(keys[left], level, len(bits))
            hit = bits[places]
            slots[left[hit]] = before[places[hit]]
            left = left[~hit]
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that are not in the table, told by their digests."""
        slots = self._slots(keys)
        found = slots >= 0
        same = (self.digests[slots[found]] == keys[found]).all(axis=1)
        slots[np.flatnonzero(found)[~same]] = -1
        return slots


def _lanes(rows: pa.Table, names: list[str]) -> np.ndarray:
    return np.stack([rows[name].to_numpy() for name in names], axis=1).view(np.uint64)


def _positions(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, digest, n_bytes) with ``place``, from 0 within the conversation.

    Conversations are ranked within range partitions. Of those in a partition, only the first may
    have turns in partitions before it, so there is at most one offset a partition.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    parts = staged(
        turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()),
        "turns",
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        parts.groupBy("conv_id", "part")
        .count()
        .withColumn("before", F.sum("count").over(earlier))
        .where("before IS NOT NULL")
        .select("conv_id", "part", "before")
    )
    rank = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order)) - 1
    return (
        parts.withColumn("rank", rank)
        .join(F.broadcast(offsets), ["conv_id", "part"], "left")  # a row a partition at most
        .select(
            "conv_id",
            (F.col("rank") + F.coalesce("before", F.lit(0))).cast("long").alias("place"),
            "digest",
            "n_bytes",
        )
    )


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the one it shares them with."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % SHARED).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, length) and their turns (conv_id, length, depth, digest, n_bytes).

    Conversation c starts with the first h turns of c - c % 5, h being crc32(c) % 9, and goes on
    with its own turns after its first h.
    """
    placed = staged(_positions(turns), "places")
    counts = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    counts = staged(
        counts.withColumn("base", F.col("conv_id") - F.col("conv_id") % EVERY).withColumn(
            "h", F.when(F.col("base") == F.col("conv_id"), 0).otherwise(shared_turns(F.col("conv_id")))
        ),
        "conversations",
    )
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = staged(
        counts.join(bases, "base", "left").select(
            "conv_id",
            "base",
            "h",
            (F.col("h") - taken).alias("short"),
            (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        ),
        "conversations",
    )
    own = (
        placed.join(convs, "conv_id")
        .where("place >= h")
        .withColumn("depth", F.col("place") + 1 - F.col("short"))
    )
    first = placed.where((F.col("place") < SHARED - 1) & (F.col("conv_id") % EVERY == 0))
    shared = (
        convs.where("h > 0")
        .join(first.withColumnRenamed("conv_id", "base"), "base")
        .where("place < h")
        .withColumn("depth", F.col("place") + 1)
    )
    names = ["conv_id", "length", "depth", "digest", "n_bytes"]
    paths = staged(own.select(names).unionByName(shared.select(names)), "paths")
    return convs.select("conv_id", "length"), paths


def _segment() -> Column:
    return F.expr(f"(depth - 1) div {SEGMENT}")


def prefixes(paths: DataFrame) -> DataFrame:
    """``paths`` with the digest of the prefix (d0 to d3) and of its parent (p0 to p3), by segment."""
    hashes = [F.xxhash64(F.lit(k), "digest", "depth").alias(f"x{k}") for k in range(4)]
    rows = paths.select(
        "conv_id",
        "length",
        "depth",
        "n_bytes",
        _segment().alias("segment"),
        *hashes,
    )
    unit = Window.partitionBy("conv_id", "segment")
    up_to = unit.orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carries = (
        rows.where(F.col("length") > SEGMENT)
        .groupBy("conv_id", "segment")
        .agg(*[F.bit_xor(f"x{k}").alias(f"x{k}") for k in range(4)])
        .select(
            "conv_id", "segment", *[F.bit_xor(f"x{k}").over(earlier).alias(f"c{k}") for k in range(4)]
        )
        .where("segment > 0")
    )
    summed = rows.withColumns({f"s{k}": F.bit_xor(f"x{k}").over(up_to) for k in range(4)})
    digest = [
        F.col(f"s{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0).cast("long"))) for k in range(4)
    ]
    return summed.join(carries, ["conv_id", "segment"], "left").select(
        "conv_id",
        "segment",
        "depth",
        "n_bytes",
        (F.col("depth") == F.col("length")).alias("ends"),
        *[d.alias(name) for d, name in zip(digest, LANES)],
        *[d.bitwiseXOR(F.col(f"x{k}")).alias(PARENT[k]) for k, d in enumerate(digest)],
    )


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("conv_id", "segment"), F.lit(shards)).cast("int").alias("shard")


def _scattered(rows: DataFrame, shards: int) -> DataFrame:
    """Per shard and node: digest, parent, depth, n_bytes, members, smallest member."""

    def run(part: pa.Table) -> pa.Table:
        keys = _lanes(part, LANES)
        table = NodeTable(keys)
        slots = table.slots(keys)
        count = np.zeros(len(table), np.int64)
        np.add.at(count, slots, 1)
        member = np.full(len(table), np.iinfo(np.int64).max)
        np.minimum.at(member, slots, part["conv_id"].to_numpy())
        row_of = np.empty(len(table), np.int64)
        row_of[slots] = np.arange(len(slots))
        lanes = _lanes(part, PARENT)
        if not (lanes[row_of][slots] == lanes).all():
            raise RuntimeError("different prefixes have one digest")
        first = part.take(pa.array(row_of)).select([*LANES, *PARENT, "depth", "n_bytes"])
        return first.append_column("n_convs", pa.array(count)).append_column(
            "conv_id", pa.array(member)
        )

    parents = NODE.replace("d", "p")
    return (
        rows.withColumn("shard", _shard(shards))
        .groupBy("shard")
        .applyInArrow(
            run, f"{NODE}, {parents}, depth long, n_bytes long, n_convs long, conv_id long"
        )
    )


def _accumulated(rows: DataFrame, placed: DataFrame, shards: int) -> DataFrame:
    """Per shard and node: the sums of leaves and saved tokens over its subtree within the shard.

    ``placed`` is (conv_id, segment, depth, leaves, saved): values at the turn of a conversation.
    """

    segment = SEGMENT

    def run(part: pa.Table, values: pa.Table) -> pa.Table:
        names = [*LANES, "leaves", "saved"]
        if not part.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in names})
        keys, parents = _lanes(part, LANES), _lanes(part, PARENT)
        table = NodeTable(np.concatenate([keys, np.zeros((1, 4), np.uint64)]))
        slots = table.slots(keys)
        depths = part["depth"].to_numpy()
        depth = np.zeros(len(table), np.int64)
        depth[slots] = depths
        # The parent of a segment's first turn lies in another segment, but for the root.
        inner = (depths - 1) % segment != 0
        inner |= depths == 1
        parent = np.full(len(table), -1, np.int64)
        parent[slots[inner]] = table.slots(parents[inner])
        # Values stand at a conversation's depth; its rows tell the slot.
        at = dict(zip(zip(part["conv_id"].to_pylist(), depths.tolist()), slots.tolist()))
        sums = np.zeros((2, len(table)), np.int64)
        if values.num_rows:
            turns = zip(values["conv_id"].to_pylist(), values["depth"].to_pylist())
            target = np.array([at[turn] for turn in turns], np.int64)
            np.add.at(sums[0], target, values["leaves"].to_numpy())
            np.add.at(sums[1], target, values["saved"].to_numpy())
        order = np.argsort(-depth, kind="stable")
        starts = np.flatnonzero(np.diff(depth[order], prepend=-1))
        for begin, end in zip(starts, [*starts[1:], len(order)]):  # deepest first
            level = order[begin:end]
            level = level[parent[level] >= 0]
            for line in sums:
                np.add.at(line, parent[level], line[level])
        full = np.flatnonzero(sums.any(axis=0))
        lanes = table.digests[full].view(np.int64)
        columns = [*(lanes[:, k] for k in range(4)), sums[0][full], sums[1][full]]
        return pa.table(dict(zip(names, columns)))

    return (
        rows.withColumn("shard", _shard(shards))
        .groupBy("shard")
        .cogroup(placed.withColumn("shard", _shard(shards)).groupBy("shard"))
        .applyInArrow(run, f"{NODE}, leaves long, saved long")
    )


def _with_carries(values: DataFrame) -> DataFrame:
    """``values`` and, for segments with others below, what those hold, at the segment's last turn."""
    later = Window.partitionBy("conv_id").orderBy(F.desc("segment"))
    below = (
        values.groupBy("conv_id", "segment")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        .withColumn("leaves", F.sum("leaves").over(later))
        .withColumn("saved", F.sum("saved").over(later))
    )
    # Every segment above the deepest owned one gets what is below it, also those that own nothing.
    above = Window.partitionBy("conv_id").orderBy("segment")
    spans = below.where("segment > 0").withColumn(
        "from", F.coalesce(F.lag("segment").over(above), F.lit(0))
    )
    carried = spans.withColumn("into", F.explode(F.sequence("from", F.col("segment") - 1))).select(
        "conv_id",
        F.col("into").alias("segment"),
        ((F.col("into") + 1) * SEGMENT).alias("depth"),
        "leaves",
        "saved",
    )
    return values.unionByName(carried)


def _end_digests(ends: DataFrame) -> DataFrame:
    """(d0 to d3, ends_sha256): SHA-256 of the ascending ids that end at a node, joined by commas.

    Ids are sorted by range and joined in runs, so that the pass over a node's ids, sequential by
    the nature of the digest, streams over few rows.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = _lanes(batch, LANES), batch["conv_id"].to_pylist()
            change = (keys[1:] != keys[:-1]).any(axis=1)
            starts = [0, *(np.flatnonzero(change) + 1).tolist(), len(ids)]
            cuts = [
                cut
                for begin, end in zip(starts, starts[1:])
                for cut in range(begin, end, END_IDS)
            ]
            texts = [
                ",".join(map(str, ids[begin:end])) for begin, end in zip(cuts, [*cuts[1:], len(ids)])
            ]
            rows = batch.take(pa.array(cuts))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(texts)], [*rows.schema.names, "ids"]
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        names = [*LANES, "ends_sha256"]

        def out(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * len(names)
            types = [pa.int64()] * 4 + [pa.string()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            done = []
            for *lanes, ids in zip(*(batch[name].to_pylist() for name in [*LANES, "ids"])):
                if lanes != key:
                    if state is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = lanes, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield out(done)
        if state is not None:
            yield out([(*key, state.hexdigest())])

    runs = (
        ends.select(*LANES, "conv_id")
        .repartitionByRange(*LANES, "conv_id")
        .sortWithinPartitions(*LANES, "conv_id")
        .mapInArrow(join, f"{NODE}, conv_id long, ids string")
    )
    return (
        runs.repartition(*LANES)
        .sortWithinPartitions(*LANES, "conv_id")
        .mapInArrow(digest, f"{NODE}, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Columns: conv_id (smallest member), depth, parent_conv_id (of the parent; null for the root),
    n_convs (members), n_children, n_leaves, saved_tokens, ends_sha256. ``conversations`` has
    conv_id, turn, role and text. Turns are ordered by turn, null first; turns that tie, repeated
    rows among them, all count and stand in the order of the digest of role and text. Null roles and
    texts are empty. Rows without conv_id belong to no conversation and are left out. Every other
    conversation is a member of the root, also one that has no turns when rebuilt. Without
    conversations there are no nodes. Extra columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(role).cast("string")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.sha2(F.concat(size, F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    convs, paths = rebuilt(turns)
    rows = staged(prefixes(paths), "prefixes")
    least = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, -(-rows.count() // SHARD_ROWS))

    # The root has every conversation as a member, and is the first node of every path.
    zero = [F.lit(0).cast("long").alias(name) for name in LANES]
    root = (
        convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
        .where("n_convs > 0")
        .withColumns({name: F.lit(0).cast("long") for name in [*LANES, "depth", "n_bytes"]})
    )
    one_parent = " AND ".join(f"min({p}) = max({p})" for p in PARENT)
    inner = (
        _scattered(rows, shards)
        .groupBy(*LANES)
        .agg(
            *[F.min(name).alias(name) for name in PARENT],
            F.expr(f"IF({one_parent}, min(depth), raise_error('prefixes share a digest'))").alias(
                "depth"
            ),
            F.min("n_bytes").alias("n_bytes"),
            F.sum("n_convs").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
        )
    )
    nodes = staged(inner.unionByName(root, allowMissingColumns=True), "nodes")
    children = nodes.where("depth > 0").groupBy(*PARENT).agg(F.count("*").alias("n_children"))
    children = children.select(*[F.col(p).alias(d) for p, d in zip(PARENT, LANES)], "n_children")
    grown = staged(
        nodes.join(children, LANES, "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
        ),
        "grown",
    )
    values = (
        grown.where("depth > 0")
        .select(
            "conv_id",
            _segment().alias("segment"),
            "depth",
            (F.col("n_children") == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        )
        .where("leaves > 0 OR saved > 0")
    )
    sums = (
        _accumulated(rows, _with_carries(values), shards)
        .groupBy(*LANES)
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    ends = rows.where("ends").select(*LANES, "conv_id")
    ends = ends.unionByName(convs.where("length = 0").select(*zero, "conv_id"))
    parents = grown.select(
        *[F.col(d).alias(p) for d, p in zip(LANES, PARENT)], F.col("conv_id").alias("parent_conv_id")
    )
    known = staged(
        grown.join(staged(sums, "sums"), LANES, "left").join(
            staged(_end_digests(ends), "ends"), LANES, "left"
        ),
        "known",
    )
    return known.join(parents, PARENT, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),  # a root without children
        F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
