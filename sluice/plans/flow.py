"""The whole ingest as one chain of DataFrame steps.

Every step is lazy; nothing runs until rows are written or read. ``stage_table`` puts a step's
output into a table keyed by the step settings, so a later run skips the records it already has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.ids import config_hash
from sluice.operators import chunk, embed, hashing, partition
from sluice.operators.filters import filter_documents
from sluice.operators.html import partition_html, partition_html_or_fail
from sluice.operators.incremental import changed_documents, skip_existing_output
from sluice.operators.tables import RecordTable

TEXT = "text"
HTML = "html"
CSV = "csv"

_PARTITIONERS = {
    TEXT: partition.partition_text,
    HTML: partition_html,
    CSV: partition.partition_csv,
}


class Flow:
    """Documents (index columns and body) on their way to a destination.

    ``errors`` has (record_id, step, error) of the records that a step could not process, for
    ``status_report`` and ``fail_on_errors``; it is None while no step keeps them.
    """

    def __init__(
        self, rows: DataFrame, settings: Sequence[dict] = (), errors: DataFrame | None = None
    ):
        self.rows = rows
        self.settings = list(settings)
        self.errors = errors

    def _next(self, rows: DataFrame, **settings) -> Flow:
        return Flow(rows, [*self.settings, settings], self.errors)

    def filter(self, globs: Sequence[str] | None = None, max_size: int | None = None) -> Flow:
        rows = filter_documents(self.rows, globs, max_size)
        return self._next(rows, step="filter", globs=globs, max_size=max_size)

    def changed_since(self, state: DataFrame) -> Flow:
        """Only documents that are new or changed against the state of the last run."""
        return self._next(changed_documents(self.rows, state), step="changed")

    def partition(self, kind: str = TEXT, **postprocess) -> Flow:
        rows = partition.postprocess(_PARTITIONERS[kind](self.rows), **postprocess)
        return self._next(rows, step="partition", kind=kind, **postprocess)

    def partition_html_or_fail(self, **postprocess) -> Flow:
        """As ``partition(HTML)``, but keeps the pages that do not parse as ``errors``."""
        rows, errors = partition_html_or_fail(self.rows)
        if self.errors is not None:
            errors = self.errors.unionByName(errors)
        rows = partition.postprocess(rows, **postprocess)
        settings = dict(step="partition", kind=HTML, **postprocess)
        return Flow(rows, [*self.settings, settings], errors)

    def hash_ids(self) -> Flow:
        # All elements of a record came out of one input row here, so windows are per record.
        rows = hashing.assign_hash_ids(self.rows, bounded=True)
        return self._next(rows, step="hash_ids")

    def chunk(self, strategy: str = "basic", **options) -> Flow:
        chunks = chunk.chunk_elements(self.rows, strategy, bounded=True, **options)
        if strategy in chunk.STRATEGIES:
            # Chunks have no parents, so only their ids are assigned.
            chunks = hashing.assign_hash_ids(chunks, bounded=True, parents=False)
        return self._next(chunks, step="chunk", strategy=strategy, **options)

    def embed(self, encoder: str | Callable = "hash", **options) -> Flow:
        rows = embed.embed_elements(self.rows, encoder, **options)
        return self._next(rows, step="embed", encoder=str(encoder), **options)

    def stage(self, stager: Callable[..., DataFrame], **options) -> Flow:
        return self._next(
            stager(self.rows, **options), step="stage", stager=stager.__name__, **options
        )

    def write(self, table: RecordTable) -> None:
        table.overwrite_records(self.rows)

    @property
    def key(self) -> str:
        """Hash of all step settings so far."""
        return config_hash({"steps": self.settings})

    def stage_table(self, table: RecordTable) -> Flow:
        """Append the records the table does not have for these settings, and read from it."""
        key = self.key
        rows = self.rows.withColumn("config_hash", F.lit(key))
        table.create_if_missing(rows.schema)
        done = table.read().select("record_id", "config_hash").distinct()
        table.append(skip_existing_output(rows, done, key))
        stored = table.read().filter(F.col("config_hash") == key).drop("config_hash")
        return Flow(stored, self.settings, self.errors)
