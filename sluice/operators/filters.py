"""Document and element predicates. Each is one declarative filter that Catalyst can push down."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUP_SHARES = 32


def glob_regex(pattern: str) -> str:
    """Anchored regular expression of a shell pattern; ``*`` also crosses ``/``."""
    out, i = "", 0
    while i < len(pattern):
        ch = pattern[i]
        i += 1
        if ch == "*":
            out += ".*"
        elif ch == "?":
            out += "."
        elif ch == "[":
            end = pattern.find("]", i + 1 if pattern[i : i + 1] not in ("!", "]") else i + 2)
            if end < 0:
                out += r"\["
                continue
            body = pattern[i:end].replace("\\", r"\\").replace("[", r"\[").replace("&", r"\&")
            i = end + 1
            if body.startswith("!"):
                body = "^" + body[1:]
            elif body.startswith("^"):
                body = "\\" + body
            out += f"[{body}]"
        else:
            out += re.escape(ch)
    return f"(?s)^(?:{out})$"


def matches_any_glob(path: Column, patterns: Sequence[str]) -> Column:
    """True when the path matches any pattern; no pattern or no path matches nothing."""
    if not patterns:
        return F.lit(False)
    alternatives = [path.rlike(glob_regex(p)) for p in patterns]
    hit = alternatives[0]
    for other in alternatives[1:]:
        hit = hit | other
    return F.coalesce(hit, F.lit(False))


def within_size(size: Column, max_size: int | None) -> Column:
    """Unknown and zero sizes pass; a limit of zero or none disables the test."""
    if not max_size:
        return F.lit(True)
    return (F.coalesce(size, F.lit(0)) == 0) | (size <= max_size)


def filter_documents(
    index: DataFrame, globs: Sequence[str] | None = None, max_size: int | None = None
) -> DataFrame:
    """Conjunction of the configured document predicates as one filter."""
    keep = within_size(F.col("filesize_bytes"), max_size)
    if globs is not None:
        keep = keep & matches_any_glob(F.col("fullpath"), globs)
    return index.filter(keep)


def keep_listed_records(records: DataFrame, kept: DataFrame, key: str = "identifier") -> DataFrame:
    """Records whose key survived an earlier filter."""
    return records.join(kept.select(key), key, "left_semi")


def exclude_types(elements: DataFrame, types: Sequence[str]) -> DataFrame:
    if not types:
        return elements
    return elements.filter(F.coalesce(~F.col("type").isin(list(types)), F.lit(True)))


def has_embedding(elements: DataFrame, column: str = "embeddings") -> DataFrame:
    """Elements with a vector; an empty vector counts as present."""
    return elements.filter(F.col(column).isNotNull())


def has_text(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def status_in(df: DataFrame, column: str, statuses: Sequence[str] | None) -> DataFrame:
    return df if not statuses else df.filter(F.col(column).isin(list(statuses)))


def folder_in(df: DataFrame, column: str, folders: Sequence[str]) -> DataFrame:
    """Folder names compare without case."""
    return df.filter(F.lower(column).isin([f.lower() for f in folders]))


def between_dates(
    df: DataFrame, column: str, oldest: float | None = None, latest: float | None = None
) -> DataFrame:
    """Rows whose time lies between two epochs, both inclusive; a missing bound is open.

    The column is a number (epoch seconds) or a time. For a time, the bounds become literals of its
    type (UTC where it has no zone), so the stored column is compared and the scan can skip files.
    """

    def bound(epoch: float) -> Column:
        kind = df.schema[column].dataType
        if isinstance(kind, T.TimestampType):
            return F.timestamp_micros(F.lit(round(epoch * 1_000_000)))
        if isinstance(kind, T.TimestampNTZType):
            moment = datetime.fromtimestamp(0, UTC) + timedelta(microseconds=round(epoch * 1e6))
            return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)
        return F.lit(epoch)

    if oldest is not None:
        df = df.filter(F.col(column) >= bound(oldest))
    if latest is not None:
        df = df.filter(F.col(column) <= bound(latest))
    return df


def cap_per_group(
    df: DataFrame, group: str | Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """First ``n`` rows per group in the given order (a report limit, not a sample).

    Rows are ranked within shares of a group first, and the first ``n`` of each share among each
    other. So a hot group is spread over ``GROUP_SHARES`` tasks, and the last one reads ``n`` rows
    of each share, for every ``n``.
    """
    keys = [group] if isinstance(group, str) else list(group)
    share = F.pmod(F.monotonically_increasing_id(), F.lit(GROUP_SHARES))
    within = Window.partitionBy(*keys, "_share").orderBy(*order)
    among = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_share", share)
        .withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(among))
        .filter(F.col("_rank") <= n)
        .drop("_rank", "_share")
    )


def first_seen_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the first in the given order. Partial aggregation handles hot keys."""
    rest = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    first = df.groupBy(key).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("_r"))
    return first.select(*[F.col(f"_r.`{c}`") if c != key else F.col(key) for c in df.columns])
