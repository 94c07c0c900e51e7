"""SHA-256 of files of any size.

The digest of a file is sequential, but no task has to read the file whole: what SHA-256 carries from
one block to the next is about a hundred bytes. Each round, a task reads the next range of a file and
hands on the state, for all files side by side. Small files are done in the first round.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.files import qualified
from sluice.session import written

RANGE_BYTES = 256 << 20  # of a file that one task reads
TASK_BYTES = 64 << 20  # of small files a task reads
READ_BYTES = 1 << 20
_SCHEMA = "path string, n_bytes long, done long, state binary, digest string"


def _crypto() -> ctypes.CDLL | None:
    """The library that Python's own hashlib calls, or None where it has no plain SHA-256."""
    try:
        import _hashlib

        library = ctypes.CDLL(_hashlib.__file__)
        for name, kinds in (
            ("SHA256_Init", [ctypes.c_void_p]),
            ("SHA256_Update", [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]),
            ("SHA256_Final", [ctypes.c_void_p, ctypes.c_void_p]),
        ):
            getattr(library, name).argtypes = kinds
    except (ImportError, OSError, AttributeError):
        return None
    sound = ResumableSha256(library).hexdigest() == hashlib.sha256().hexdigest()
    return library if sound else None


class ResumableSha256:
    """SHA-256 whose state can be handed on, which hashlib's cannot."""

    _CONTEXT = 112  # bytes of SHA256_CTX

    def __init__(self, library: ctypes.CDLL, state: bytes | None = None) -> None:
        self._library = library
        self._context = ctypes.create_string_buffer(self._CONTEXT)
        if state is None:
            library.SHA256_Init(self._context)
        else:
            self._context.raw = state

    def update(self, data: bytes) -> None:
        self._library.SHA256_Update(self._context, data, len(data))

    def state(self) -> bytes:
        return self._context.raw

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        self._library.SHA256_Final(out, ctypes.create_string_buffer(self.state(), self._CONTEXT))
        return out.raw.hex()


def file_digests(
    spark: SparkSession, folder: str, pattern: str = "*", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(path below the folder, n_bytes, digest) of the files ``pattern`` finds, SHA-256 in hex.

    Empty files are not listed by Spark. Without a resumable SHA-256 on an executor, a file is
    streamed by one task.
    """
    below = qualified(spark, folder).rstrip("/")

    def read_on(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(below)
        library = _crypto()
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                digest = ResumableSha256(library, row["state"]) if library else hashlib.sha256()
                upto = row["n_bytes"]
                if library:
                    upto = min(upto, row["done"] + range_bytes)
                with store.open_input_file(f"{root}/{row['path']}") as file:
                    file.seek(row["done"])
                    while row["done"] < upto:
                        data = file.read(min(READ_BYTES, upto - row["done"]))
                        if not data:
                            raise OSError(f"{row['path']} ends at {row['done']}")
                        digest.update(data)
                        row["done"] += len(data)
                if upto == row["n_bytes"]:
                    row["digest"], row["state"] = digest.hexdigest(), None
                else:
                    row["state"] = digest.state()
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    # The listing of binary files does not read them.
    found = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{pattern}")
    start = len(spark._jvm.org.apache.hadoop.fs.Path(below).toString()) + 2
    left = found.select(
        F.expr(f"substring(path, {start})").alias("path"),
        F.col("length").alias("n_bytes"),
        F.lit(0).cast("long").alias("done"),
        F.lit(None).cast("binary").alias("state"),
        F.lit(None).cast("string").alias("digest"),
    )
    rounds = []
    while True:
        share = F.least(F.lit(range_bytes), F.col("n_bytes") - F.col("done"))
        n_bytes = left.agg(F.sum(share)).first()[0]
        if rounds and n_bytes is None:
            break
        tasks = max(-(-(n_bytes or 0) // TASK_BYTES), spark.sparkContext.defaultParallelism)
        after = written(left.repartition(tasks).mapInArrow(read_on, _SCHEMA), "digests")
        rounds.append(after.filter("digest IS NOT NULL"))
        left = after.filter("digest IS NULL")
    return reduce(DataFrame.unionByName, rounds).select("path", "n_bytes", "digest")
