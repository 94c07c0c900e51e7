"""What has to be processed again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import parse_timestamp


def classify_changes(index: DataFrame, state: DataFrame) -> DataFrame:
    """Index with ``change``: new, forced, modified, version, acl or unchanged.

    ``state`` is ``(identifier, processed_at, version, permissions_version)`` of what was
    processed. An access list that was not delivered is no change.
    """
    before = state.select(
        "identifier",
        F.lit(True).alias("_known"),
        F.col("processed_at").alias("_at"),
        F.col("version").alias("_version"),
        F.col("permissions_version").alias("_acl"),
    )
    joined = index.join(before, "identifier", "left")
    change = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.coalesce("reprocess", F.lit(False)), "forced")
        .when(parse_timestamp(F.col("date_modified")) > F.col("_at"), "modified")
        .when(F.col("version") != F.col("_version"), "version")
        .when(
            F.col("permissions_version").isNotNull()
            & ~F.col("permissions_version").eqNullSafe(F.col("_acl")),
            "acl",
        )
        .otherwise("unchanged")
    )
    return joined.withColumn("change", change).drop("_known", "_at", "_version", "_acl")


def changed_documents(index: DataFrame, state: DataFrame) -> DataFrame:
    return classify_changes(index, state).filter("change <> 'unchanged'")


def removed_documents(index: DataFrame, state: DataFrame) -> DataFrame:
    return state.select("identifier").join(index, "identifier", "left_anti")


def skip_existing_output(records: DataFrame, outputs: DataFrame, config_hash: str) -> DataFrame:
    """Records without an output of the same step settings."""
    done = outputs.filter(F.col("config_hash") == config_hash).select("record_id")
    return records.join(done, "record_id", "left_anti")


def status_report(errors: DataFrame) -> DataFrame:
    """Failures and distinct failed records per step."""
    return errors.groupBy("step").agg(
        F.count(F.lit(1)).alias("failures"),
        F.count_distinct("record_id").alias("records"),
    )


def fail_on_errors(errors: DataFrame) -> None:
    """Fail the run when any record failed; only one row is read."""
    first = errors.head(1)
    if first:
        row = first[0]
        raise RuntimeError(f"{row['step']} failed for {row['record_id']}: {row['error']}")
