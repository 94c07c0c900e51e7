"""Batched destinations as data sources that Spark writes to by name.

Every task cuts its rows into batches and hands them to ``send``. What tasks have sent is reported to
the driver as commit messages; ``finish`` runs once, after all tasks of the job are through, and
``cancel`` if the job fails. So a destination that makes rows visible in ``finish`` shows a load as a
whole or not at all.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from sluice.operators.files import qualified

MAX_ROWS = 100


@dataclass
class Sent(WriterCommitMessage):
    """What one task has sent."""

    partition: int
    batches: int
    rows: int
    size: int


def row_sizes(batch: pa.RecordBatch, size_column: str | None) -> np.ndarray:
    """Bytes of each row: those of ``size_column``, else the share that all columns have in memory."""
    if size_column:
        return batch.column(size_column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.full(batch.num_rows, -(-batch.nbytes // max(batch.num_rows, 1)), np.int64)


def cut_batches(
    stream: Iterable[pa.RecordBatch],
    max_rows: int | None,
    max_bytes: int | None,
    size_column: str | None = None,
) -> Iterator[tuple[pa.Table, int]]:
    """(rows, their bytes): greedy batches of a stream, whatever batches it arrives in.

    No batch is empty; a row above ``max_bytes`` is a batch of its own.
    """
    held: list[pa.RecordBatch] = []
    rows = used = 0
    for batch in stream:
        ends = np.concatenate([[0], np.cumsum(row_sizes(batch, size_column))])
        begin = 0
        while begin < batch.num_rows:
            end = batch.num_rows
            if max_rows:
                end = min(end, begin + max_rows - rows)
            if max_bytes:
                fits = np.searchsorted(ends, ends[begin] + max_bytes - used, "right") - 1
                end = min(end, int(fits))
            if not rows:
                end = max(end, begin + 1)
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                rows, used = rows + end - begin, used + int(ends[end] - ends[begin])
                begin = end
            if begin < batch.num_rows:
                yield pa.Table.from_batches(held), used
                held, rows, used = [], 0, 0
    if held:
        yield pa.Table.from_batches(held), used


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, send: Callable, finish: Callable, cancel: Callable):
        def number(name: str, default: int | None = None) -> int | None:
            return int(options[name]) if options.get(name) else default

        self.max_bytes = number("max_bytes")
        self.max_rows = number("max_rows", None if self.max_bytes else MAX_ROWS)
        self.size_column = options.get("size_column")
        self.send, self.finish, self.cancel = send, finish, cancel

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        partition = TaskContext.get().partitionId()
        sent = Sent(partition, 0, 0, 0)
        for rows, size in cut_batches(iterator, self.max_rows, self.max_bytes, self.size_column):
            self.send(rows, partition, sent.batches)
            sent = Sent(partition, sent.batches + 1, sent.rows + rows.num_rows, sent.size + size)
        return sent

    def commit(self, messages: Sequence[Sent | None]) -> None:
        self.finish([m for m in messages if m is not None])

    def abort(self, messages: Sequence[Sent | None]) -> None:
        self.cancel([m for m in messages if m is not None])


def _nothing(sent: Sequence[Sent]) -> None:
    pass


def register_batch_destination(
    spark: SparkSession,
    name: str,
    send: Callable[[pa.Table, int, int], None],
    finish: Callable[[Sequence[Sent]], None] = _nothing,
    cancel: Callable[[Sequence[Sent]], None] = _nothing,
) -> None:
    """Make ``df.write.format(name).mode("append").save()`` send batches.

    ``send`` gets the rows of a batch, the partition, and the number of the batch in it; a task that
    is repeated sends its batches again under the same numbers, so ``send`` replaces by them.
    Options: ``max_rows`` (100 where no bytes are given), ``max_bytes``, ``size_column``.
    """

    class Destination(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return _Writer(dict(self.options), send, finish, cancel)

    spark.dataSource.register(Destination)


def register_file_destination(spark: SparkSession, name: str, folder: str) -> None:
    """Make ``df.write.format(name).mode("append").save()`` write a JSON Lines file per batch.

    Files are ``batches/<partition>-<number>.json`` below ``folder``, published whole, so a repeated
    task replaces its own. ``report/sent.json`` has a line per task (partition, batches, rows, size)
    and is written when all tasks are through; without it the load is not complete.
    """
    target = qualified(spark, folder)

    def publish(name: str, rows: pa.Table, attempt: str) -> None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(target)
        path = f"{root}/{name}"
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        staged = f"{root}/_{attempt}-{name.replace('/', '-')}"
        with store.open_output_stream(staged) as out:
            for row in rows.to_pylist():
                out.write(json.dumps(row, default=str).encode() + b"\n")
        store.move(staged, path)

    def send(rows: pa.Table, partition: int, number: int) -> None:
        attempt = str(TaskContext.get().taskAttemptId())
        publish(f"batches/{partition}-{number}.json", rows, attempt)

    def finish(sent: Sequence[Sent]) -> None:
        publish("report/sent.json", pa.Table.from_pylist([asdict(s) for s in sent]), "report")

    register_batch_destination(spark, name, send, finish)
