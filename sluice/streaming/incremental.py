"""Change detection over a stream of index rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import parse_timestamp
from sluice.operators.incremental import changed_documents
from sluice.operators.tables import RecordTable
from sluice.session import written


def process_changes(
    state: RecordTable, process: Callable[[DataFrame], None]
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: compare index rows with the state table, process the changed ones and
    record their new state. The changes are computed once. ``process`` must be repeatable, as a
    batch may run again."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        changed = written(changed_documents(batch, state.read()), "changes")
        if changed.isEmpty():
            return
        process(changed)
        state.upsert(
            changed.select(
                "identifier",
                parse_timestamp(F.col("date_modified")).alias("processed_at"),
                "version",
                "permissions_version",
            ),
            "identifier",
        )

    return handle
