"""Element tables on plain Parquet with replace-by-record writes.

The logic of a write is a join (``replace_records``, ``upsert_rows``). ``RecordTable`` stores rows
partitioned by a hash of the record id, and replacing records is a dynamic partition overwrite:
Spark writes the partitions those records fall into beside the table, moves them into place when all
tasks are done, and leaves all others alone. As for any table of plain files, one writer at a time
may replace records; for more, a table format's ``MERGE`` (``merge_rows``) takes its place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.schema_fit import fit_to_schema
from sluice.session import written

BUCKETS = 64
FEW_BUCKETS = 16  # a task may write a file for each of so many
BUCKET = "_bucket"
SCHEMA_BUCKET = -1  # an empty partition whose file holds the schema of the table


def replace_records(existing: DataFrame, arriving: DataFrame, key: str = "record_id") -> DataFrame:
    """Existing rows of other records plus all arriving rows."""
    if key not in existing.columns:
        return existing.unionByName(arriving, allowMissingColumns=True)
    ids = arriving.select(key).distinct()
    kept = existing.join(ids, key, "left_anti")
    return kept.unionByName(arriving, allowMissingColumns=True)


def one_row_per_key(rows: DataFrame, key: str) -> DataFrame:
    """Of several rows with one key the smallest stays.

    Found by partial aggregation, so many copies of one key never meet in one task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    order = F.struct(*[F.col(f"`{c}`") for c in _orderable(rows)])
    # A row that is its own order travels once.
    alone = _orderable(rows) == rows.columns
    smallest = F.min(row) if alone else F.min_by(row, order)
    return rows.groupBy(key).agg(smallest.alias("_row")).select("_row.*")


def upsert_rows(existing: DataFrame, arriving: DataFrame, key: str = "id") -> DataFrame:
    """Insert or replace by primary id."""
    return replace_records(existing, one_row_per_key(arriving, key), key)


def _orderable(df: DataFrame) -> list[str]:
    unordered = ("map<", "variant")
    return [
        f.name
        for f in df.schema.fields
        if not any(word in f.dataType.simpleString() for word in unordered)
    ]


def delete_by_prefix(rows: DataFrame, record_ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Drop ``record#uuid`` ids of the given records; a record id may itself hold a ``#``."""
    record = F.substring(F.col(id_column), F.lit(1), F.length(id_column) - 37)
    gone = record_ids.select(F.col("record_id").alias("_record")).distinct()
    return rows.withColumn("_record", record).join(gone, "_record", "left_anti").drop("_record")


def append_by_name(existing: DataFrame, arriving: DataFrame) -> DataFrame:
    """Append the columns the table has, matched by name."""
    return existing.unionByName(fit_to_schema(arriving, existing.schema))


def merge_append(existing: DataFrame, arriving: DataFrame) -> DataFrame:
    """Append and take over new columns; either side's missing columns are null."""
    return existing.unionByName(arriving, allowMissingColumns=True)


class RecordTable:
    """A Parquet table at ``path``, partitioned by a hash of ``key`` into ``buckets``.

    ``buckets`` must be the same whenever the table is opened.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str = "record_id", buckets: int = BUCKETS
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.buckets = buckets

    def schema(self) -> T.StructType | None:
        """The columns of the table; None if it does not exist."""
        try:
            return self.spark.read.parquet(f"{self.path}/{BUCKET}={SCHEMA_BUCKET}").schema
        except AnalysisException:
            return None

    def _set_schema(self, schema: T.StructType) -> None:
        empty = self.spark.createDataFrame([], schema).coalesce(1)
        empty.write.mode("overwrite").parquet(f"{self.path}/{BUCKET}={SCHEMA_BUCKET}")

    def create_if_missing(self, schema: T.StructType) -> bool:
        """Make an empty table; false when it is there already."""
        if self.schema() is not None:
            return False
        self._set_schema(schema)
        return True

    def _target(self, rows: DataFrame, merge_schema: bool) -> T.StructType:
        """The schema of the table after a write; with ``merge_schema`` it takes new columns over."""
        schema = self.schema()
        if schema is None:
            self._set_schema(rows.schema)
            return self.schema()
        extra = [f for f in rows.schema.fields if f.name not in schema.names]
        if merge_schema and extra:
            self._set_schema(T.StructType([*schema.fields, *extra]))
            return self.schema()
        return schema

    def _stored(self) -> DataFrame:
        """The rows with their bucket."""
        stored = T.StructType([*self.schema().fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(stored).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def _placed(self, rows: DataFrame) -> DataFrame:
        bucket: Column = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        return rows.withColumn(BUCKET, bucket)

    def _write(self, rows: DataFrame, mode: str, grouped: bool = True) -> None:
        # Rebalancing groups rows by bucket and splits a bucket that is much larger than others.
        (
            (rows.hint("rebalance", BUCKET) if grouped else rows)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )

    def append(self, rows: DataFrame, merge_schema: bool = False) -> None:
        """Add rows; unknown columns are dropped, or added to the table with ``merge_schema``."""
        fitted = fit_to_schema(rows, self._target(rows, merge_schema))
        self._write(self._placed(fitted), "append")

    def overwrite_records(self, rows: DataFrame, merge_schema: bool = False) -> None:
        """Replace all rows of the arriving records. Writing the same rows twice changes nothing.

        The arriving rows are computed once. Only the buckets they fall into, whose numbers the
        driver reads, are read and rewritten. Where buckets are few, rows are written by the tasks
        that compare their keys, which saves moving all of them once more.
        """
        fitted = fit_to_schema(rows, self._target(rows, merge_schema))
        arriving = written(self._placed(fitted), "arriving")
        touched = [row[BUCKET] for row in arriving.select(BUCKET).distinct().collect()]
        if not touched:
            return
        before = self._stored().where(F.col(BUCKET).isin(touched))
        kept = before.join(arriving.select(self.key).distinct(), self.key, "left_anti")
        self._write(kept.unionByName(arriving), "overwrite", self.buckets > FEW_BUCKETS)

    def upsert(self, rows: DataFrame, id_column: str = "id") -> None:
        """Insert or replace by id; the table must be partitioned by that id."""
        if id_column != self.key:
            raise ValueError(f"the table is partitioned by {self.key}, not by {id_column}")
        self.overwrite_records(one_row_per_key(rows, id_column))


def merge_rows(rows: DataFrame, table: str, key: str = "id") -> None:
    """Insert or replace by ``key`` in a table whose format knows MERGE; it must be on the class
    path."""
    source = one_row_per_key(rows, key).alias("source")
    matching = F.expr(f"{table}.{key} = source.{key}")
    source.mergeInto(table, matching).whenMatched().updateAll().whenNotMatched().insertAll().merge()
