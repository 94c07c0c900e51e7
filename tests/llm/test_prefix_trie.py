import hashlib
import random
import zlib

import numpy as np
import pytest

from sluice.llm import prefix_trie as trie

SCHEMA = (
    "conv_id long, turn long, role string, text string, depth string, digest string, d0 string, "
    "p0 string, segment string, place string, n string, base string, shard string, ids string"
)


def make_turns(spark, rows):
    return spark.createDataFrame([(*row, *("x",) * 10) for row in rows], SCHEMA)


def turn_digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def expected(rows):
    """The trie as nested dictionaries."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, turn_digest(*t[1:])))
    members, ends, last = {}, {}, {(): 0}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        path = tuple(t[1:] for t in own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
            if d:
                last[path[:d]] = len(path[d - 1][1].encode())
        ends.setdefault(path, []).append(conv)
    below = {node: [] for node in members}
    for node in members:
        if node:
            below[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in below[node]) or 1
        saved[node] = (len(members[node]) - 1) * last[node] + sum(saved[x] for x in below[node])
    return sorted(
        (
            (
                min(members[node]),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(members[node]),
                len(below[node]),
                leaves[node],
                saved[node],
                hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
            for node in members
        ),
        key=str,
    )


def order(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_node_table():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        keys = draw.integers(0, 1 << 63, (n, 4), np.uint64)
        table = trie.NodeTable(np.concatenate([keys, keys]))
        slots = table.slots(keys)
        assert sorted(slots.tolist()) == list(range(n)) and len(table) == n
        assert (table.digests[slots] == keys).all()
        other = draw.integers(0, 1 << 63, (50, 4), np.uint64)
        assert (table.slots(other) == -1).all()
    # Keys that agree in all but one lane.
    keys = np.zeros((300, 4), np.uint64)
    keys[:, 3] = np.arange(300)
    assert len(trie.NodeTable(keys)) == 300


def test_shared_turns(spark):
    ids = [0, 1, -7, 12345678901, -(2**62)]
    found = spark.createDataFrame([(i,) for i in ids], "conv_id long").select(
        trie.shared_turns(trie.F.col("conv_id"))
    )
    assert [r[0] for r in found.collect()] == [zlib.crc32(str(i).encode()) % 9 for i in ids]


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    found = order(trie.prefix_trie(table))
    assert found == expected(rows)
    assert any(row[3] > 1 and row[1] > 0 for row in found)


@pytest.fixture(scope="module")
def odd_turns():
    """Nulls, ties, repeated rows, copies, negative ids, missing bases, one long conversation."""
    draw = random.Random(3)
    rows = []
    for conv in [*range(-12, 30), 1003, 1004]:
        if conv == 10:
            continue  # 11 to 14 have no base
        for turn in range(draw.randint(1, 12)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), draw.choice("abc")))
    rows += [(40, k, "user", "é" * (k % 3)) for k in range(60)]
    rows += [(41, k, "user", "é" * (k % 3)) for k in range(60)]
    rows += [(45, k, "user", "é" * (k % 3)) for k in range(35)]
    rows += [(50, None, None, None), (50, None, "user", None), (50, 1, None, "a"), (50, 1, "a", None)]
    rows += [(51, 0, "user", "x"), (51, 0, "user", "x"), (51, 0, "assistant", "x")]
    rows += [(None, 0, "user", "a"), (None, None, None, None)]
    rows += [(c, k, "user", "same") for c in range(60, 90) for k in range(2)]
    rows += [(95, 0, "user", "long " * 50_000), (96, 0, "user", "long " * 50_000)]
    return rows


def test_odd_rows(spark, odd_turns):
    assert order(trie.prefix_trie(make_turns(spark, odd_turns).repartition(5))) == expected(odd_turns)


@pytest.mark.parametrize("segment, rows", [(1, 7), (4, 40), (7, 1000)])
def test_segments_and_shards(spark, odd_turns, monkeypatch, segment, rows):
    """Paths over many segments, dealt to many shards, and ends in runs."""
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "SHARD_ROWS", rows)
    monkeypatch.setattr(trie, "END_IDS", 3)
    assert order(trie.prefix_trie(make_turns(spark, odd_turns).repartition(5))) == expected(odd_turns)


def test_turnless(spark):
    """A conversation whose own turns all give way to those of a missing base is at the root only."""
    conv = next(c for c in range(11, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(conv, 0, "user", "a"), (conv, 1, "user", "b")]
    found = order(trie.prefix_trie(make_turns(spark, rows)))
    assert found == expected(rows) and len(found) == 1
    assert found[0][:6] == (conv, 0, None, 1, 0, 1)


def test_equal_digests_of_different_prefixes_are_noticed(spark, monkeypatch):
    rows = [(5, 0, "user", "a"), (5, 1, "user", "c"), (15, 0, "user", "b"), (15, 1, "user", "c")]
    whole = trie.prefixes

    def spoilt(paths):
        same = trie.F.when(trie.F.col("depth") == 2, 7).otherwise(trie.F.col("d0")).cast("long")
        return whole(paths).withColumns(
            {"d0": same, "d1": same, "d2": same, "d3": same}
        )

    monkeypatch.setattr(trie, "prefixes", spoilt)
    with pytest.raises(Exception, match="digest"):
        trie.prefix_trie(make_turns(spark, rows)).collect()


def test_empty_table(spark):
    assert trie.prefix_trie(make_turns(spark, [])).collect() == []
    assert trie.prefix_trie(make_turns(spark, [(None, 1, "user", "a")])).collect() == []
