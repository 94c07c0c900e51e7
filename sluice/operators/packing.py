"""Greedy packing of consecutive rows into groups with size limits.

Whether a row still fits depends on where its group started, so packing is sequential inside a
record. It is still exact and parallel for a record of any size: rows are split into blocks of
positions, every block computes where a group started at each possible entry would leave the
block, these exit maps are composed in two levels, and then all blocks are packed independently
from their known entries. Records that fit one block skip all of that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import written

BLOCK_ROWS = 65_536
SUPER_BLOCKS = 1_024
_NO_LIMIT = 1 << 62


class _Limits:
    """Size rules of a group; the same rules drive the jump table and the streaming pass."""

    def __init__(self, limit, soft, sep, max_rows):
        self.limit = _NO_LIMIT if limit is None else limit
        self.soft = _NO_LIMIT if soft is None else soft
        self.sep = sep
        self.max_rows = _NO_LIMIT if max_rows is None else max_rows

    def jump(self, size: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For a group opened at each row: the row that opens the next group."""
        n = len(size)
        rows = np.arange(n, dtype=np.int64)
        reach = np.concatenate(([0], np.cumsum(size + self.sep)))
        hard_stop = np.searchsorted(reach, reach[:-1] + self.limit + self.sep, "right") - 1
        soft_stop = np.searchsorted(reach, reach[:-1] + self.soft + self.sep, "left")
        forced = np.append(np.flatnonzero(starts), n)
        forced_stop = forced[np.searchsorted(forced, rows, "right").clip(max=len(forced) - 1)]
        stop = np.minimum(np.minimum(hard_stop, soft_stop), forced_stop)
        stop = np.minimum(stop, rows + min(self.max_rows, n))
        return np.clip(stop, rows + 1, n)


def pack(
    df: DataFrame,
    key: str,
    order: str,
    size: str,
    limit: int | None,
    soft: int | None = None,
    sep: int = 0,
    max_rows: int | None = None,
    starts: str | None = None,
    min_size: int = 0,
    out: str = "group_start",
    block_rows: int = BLOCK_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Add ``out``: the position at which the row's group starts.

    ``order`` must be a dense 0-based position inside ``key``. A row opens a new group when it is
    flagged by ``starts``, when the group would pass ``limit`` (sizes plus ``sep`` between rows),
    when the group already holds ``soft`` or more, or when it holds ``max_rows`` rows. A row above
    the limit stays alone.
    """
    per_row = min_size + sep
    reach = []
    if limit is not None and per_row > 0:
        reach.append(limit // per_row + 2)
    if max_rows is not None:
        reach.append(max_rows)
    rules = _Limits(limit, soft, sep, max_rows)
    if min_size:
        too_small = F.raise_error(F.lit(f"{size} below the declared minimum {min_size}"))
        df = df.withColumn(size, F.when(F.col(size) >= min_size, F.col(size)).otherwise(too_small))
    work = df.withColumn(
        "_starts", (F.col(starts) if starts else F.lit(False)) | (F.col(size) > rules.limit)
    )
    if bounded or not reach:
        # A group without a bounded reach cannot be cut into blocks; the record is one block.
        work = work.withColumn("_block", F.lit(0).cast("long"))
        entries = None
    else:
        halo = min(reach)
        block_rows = max(block_rows, 2 * halo)
        work = work.withColumn("_block", F.floor(F.col(order) / block_rows))
        entries = _entries(work, key, order, size, rules, halo, block_rows)
    if entries is None:
        work = work.withColumn("_open", F.lit(-1).cast("long")).withColumn(
            "_entry", F.lit(-1).cast("long")
        )
    else:
        work = work.join(entries, [key, "_block"], "left").withColumns(
            {c: F.coalesce(c, F.lit(-1)) for c in ("_open", "_entry")}
        )
    # The window asks for rows clustered by record and block, which an earlier window on the record
    # may already have done; the sort is then dropped as redundant too.
    clustered = Window.partitionBy(key, "_block").orderBy(order)
    arranged = work.withColumn("_in_block", F.row_number().over(clustered)).sortWithinPartitions(
        key, "_block", order
    )
    # Only these narrow columns travel to Python; the rest of the row waits in the JVM.
    group = _packer(rules)("_in_block", order, size, "_starts", "_open", "_entry")
    return arranged.withColumn(out, group).drop("_starts", "_block", "_open", "_entry", "_in_block")


def _packer(rules: _Limits):
    """Group start of each row of a partition that is sorted by record, block and position."""
    limit, soft, sep, max_rows = rules.limit, rules.soft, rules.sep, rules.max_rows

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        start, held, rows = 0, 0, 0
        for batch in batches:
            out = []
            for in_block, at, n, forced, open_at, entry in zip(*[c.to_pylist() for c in batch]):
                if in_block == 1:
                    # Rows before the entry belong to the group left open by the block before.
                    start, held, rows = open_at, _NO_LIMIT, 0
                if at < entry:
                    out.append(open_at)
                    continue
                fits = held + sep + n <= limit and held < soft and rows < max_rows
                if forced or not fits:
                    start, held, rows = at, n, 1
                else:
                    held, rows = held + sep + n, rows + 1
                out.append(start)
            yield pa.array(out, pa.int64())

    # The result depends on the row order, so the optimizer must not move or repeat the call.
    return F.arrow_udf(T.LongType())(run).asNondeterministic()


def _entries(
    work: DataFrame, key: str, order: str, size: str, rules: _Limits, halo: int, block_rows: int
) -> DataFrame:
    """(key, block, open, entry) for every block after the first of a multi-block record."""
    key_type = work.schema[key].dataType
    slim = work.select(
        F.col(key).alias("k"),
        F.col("_block").alias("b"),
        F.col(order).alias("at"),
        F.col(size).alias("n"),
        F.col("_starts").alias("s"),
    )
    large = slim.filter("b > 0").select("k").distinct()
    slim = slim.join(large, "k", "left_semi")
    offset = F.col("at") - F.col("b") * block_rows
    # The head of a block is also read by the block before, whose last group may reach into it.
    copies = F.when(
        (F.col("b") > 0) & (offset < halo), F.array(F.col("b"), F.col("b") - 1)
    ).otherwise(F.array(F.col("b")))
    haloed = slim.select("k", F.explode(copies).alias("b"), "at", "n", "s")

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        base = int(pdf["b"].iat[0]) * block_rows
        at = pdf["at"].to_numpy() - base
        inside = int((at < block_rows).sum())
        if not np.array_equal(at, np.arange(len(at))):
            raise ValueError("packing needs dense positions inside a record")
        nxt = rules.jump(pdf["n"].to_numpy(np.int64), pdf["s"].to_numpy(bool)).tolist()
        leave = [0] * inside
        last = [0] * inside
        for i in range(inside - 1, -1, -1):
            j = nxt[i]
            if j >= inside:
                leave[i], last[i] = j - inside, i
            else:
                leave[i], last[i] = leave[j], last[j]
        width = min(halo + 1, inside)
        return pd.DataFrame(
            {
                "k": [pdf["k"].iat[0]],
                "b": [int(pdf["b"].iat[0])],
                "leave": [leave[:width]],
                "last": [last[:width]],
            }
        )

    map_schema = T.StructType(
        [
            T.StructField("k", key_type),
            T.StructField("b", T.LongType()),
            T.StructField("leave", T.ArrayType(T.LongType())),
            T.StructField("last", T.ArrayType(T.LongType())),
        ]
    )
    maps = haloed.groupBy("k", "b").applyInPandas(exits, map_schema)
    maps = written(maps.withColumn("g", F.floor(F.col("b") / SUPER_BLOCKS)), "exits")

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("b")
        path = None
        for leave in pdf["leave"]:
            step = np.asarray(leave, dtype=np.int64)
            path = step if path is None else step[np.minimum(path, len(step) - 1)]
        return pd.DataFrame(
            {"k": [pdf["k"].iat[0]], "g": [int(pdf["g"].iat[0])], "leave": [path.tolist()]}
        )

    super_schema = T.StructType(
        [
            T.StructField("k", key_type),
            T.StructField("g", T.LongType()),
            T.StructField("leave", T.ArrayType(T.LongType())),
        ]
    )
    supers = maps.groupBy("k", "g").applyInPandas(compose, super_schema)

    def super_entries(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("g")
        entry, out = 0, []
        for leave in pdf["leave"]:
            out.append(entry)
            entry = int(leave[min(entry, len(leave) - 1)])
        return pd.DataFrame({"k": pdf["k"].to_numpy(), "g": pdf["g"].to_numpy(), "e": out})

    entry_schema = T.StructType(
        [
            T.StructField("k", key_type),
            T.StructField("g", T.LongType()),
            T.StructField("e", T.LongType()),
        ]
    )
    by_super = supers.groupBy("k").applyInPandas(super_entries, entry_schema)

    def block_entries(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("b")
        entry = int(pdf["e"].iat[0])
        rows = []
        for k, b, leave, last in zip(pdf["k"], pdf["b"], pdf["leave"], pdf["last"]):
            i = min(entry, len(leave) - 1)
            entry = int(leave[i])
            nxt = int(b) + 1
            rows.append((k, nxt, int(b) * block_rows + int(last[i]), nxt * block_rows + entry))
        return pd.DataFrame(rows, columns=["k", "b", "_open", "_entry"])

    block_schema = T.StructType(
        [
            T.StructField("k", key_type),
            T.StructField("b", T.LongType()),
            T.StructField("_open", T.LongType()),
            T.StructField("_entry", T.LongType()),
        ]
    )
    resolved = (
        maps.join(by_super, ["k", "g"]).groupBy("k", "g").applyInPandas(block_entries, block_schema)
    )
    return resolved.select(
        F.col("k").alias(key), F.col("b").alias("_block"), "_open", "_entry"
    )
