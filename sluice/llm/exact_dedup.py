"""Exact dedup: a persistent digest index, bucketed and sorted by hash.

New rows are reduced to their digests, the digests that the index has are taken out by a sort-merge
anti-join that reads the index bucket by bucket, and the rest is appended. Only digests and ids are
shuffled; each text is read once to be hashed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import shared_path, staged, text_or_empty


class DigestIndex:
    """A bucketed table of (digest, keep_id): the document that stays for each text.

    The table lives at ``path`` in the shared folder, and beside it, at ``path``-buckets, the number
    of its buckets. Later sessions, also those whose catalog knows nothing of it, open it by the
    same path: it is declared in their catalog over the files that are there. ``buckets`` is fixed
    when the index is made (a large corpus wants some 100 MB per bucket), and opening it with another
    number is an error. ``name`` is that of the table in the catalog.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str | None = None,
        path: str | None = None,
        buckets: int | None = None,
    ):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.path = path or shared_path(spark, "digest-index")
        stored = self._stored_buckets()
        if stored is None:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            count = spark.createDataFrame([(self.buckets,)], "buckets int")
            count.write.parquet(f"{self.path}-buckets")
        elif buckets in (None, stored):
            self.buckets = stored
        else:
            raise ValueError(f"the index at {self.path} has {stored} buckets, not {buckets}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        known = spark.sql(f"DESCRIBE FORMATTED {self.name}").where("col_name = 'Location'").first()
        if known["data_type"].split(":", 1)[-1].lstrip("/") != self.path.split(":", 1)[-1].lstrip("/"):
            raise ValueError(f"the table {self.name} lives at {known['data_type']}")

    def _stored_buckets(self) -> int | None:
        try:
            return self.spark.read.parquet(f"{self.path}-buckets").first()["buckets"]
        except AnalysisException:  # no such path
            return None

    def rows(self) -> DataFrame:
        """The index as a bucketed scan."""
        return self.spark.table(self.name)

    def compacted(self, path: str | None = None) -> DigestIndex:
        """A copy of the index at another path, with one sorted file for each bucket.

        Every append adds a file to the buckets it touches, and Spark sorts a bucket of several
        files anew when it is read. The old index stays as it is until its files are removed.
        """
        to = DigestIndex(self.spark, path=path, buckets=self.buckets)
        # Read as plain files, so that the shuffle that makes a task of each bucket is planned.
        files = self.spark.read.schema(self.rows().schema).parquet(self.path)
        to._write(files.repartition(self.buckets, "digest"))
        return to

    def append(self, digests: DataFrame) -> None:
        """Adds the digests (digest, doc_id) that are new.

        Of one load, the largest doc_id stays for each digest; a digest that is already in the
        index keeps its document.
        """
        fresh = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        # Written, as the anti-join would else be planned below the aggregate, on every copy.
        fresh = staged(fresh, "fresh")
        known = self.rows().select("digest")
        self._write(fresh.join(known.hint("merge"), "digest", "left_anti"))

    def _write(self, rows: DataFrame) -> None:
        (
            rows.select("digest", F.col("keep_id").cast("long").alias("keep_id"))
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row: the SHA-256 of the text in UTF-8; null counts as empty."""
    return docs.select("doc_id", F.unhex(F.sha2(text_or_empty(), 256)).alias("digest"))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts are one group; null is the empty text. Without an ``index``, the rows are loaded
    into a new one in two loads, larger ids first, so the largest doc_id of a group stays. With an
    index, texts it has are dropped in favour of its documents. Rows without doc_id stay only for
    texts of which no row has an id. Repeated rows (same id, same text) get equal answers, see
    ``drop_duplicates`` for rows. Extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    narrow = staged(digests(docs), "digests")
    if index is None:
        index = DigestIndex(spark)
        low, high = narrow.agg(F.min("doc_id"), F.max("doc_id")).first()
        middle = F.lit(None if low is None else (low + high) // 2).cast("long")
        upper = F.coalesce(F.col("doc_id") > middle, F.lit(False))
        loads = [narrow.where(upper), narrow.where(~upper)]
    else:
        loads = [narrow]
    for load in loads:
        index.append(load)
    sizes = narrow.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = staged(sizes.join(index.rows(), "digest"), "groups")
    return narrow.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each text.

    Repeated rows (same id, same text) are one document and one of them stays; only such rows are
    shuffled with their texts. The join key is a struct, so no column name of ``docs`` can clash.
    """
    answers = staged(exact_dedup(docs), "exact-dedup")
    kept = answers.where("kept").groupBy("doc_id", "text_sha256").count()
    key = F.struct(F.col("doc_id"), F.sha2(text_or_empty(), 256).alias("text_sha256"))
    # Null ids are equal here: a struct of null is not null, so it joins.
    right = kept.select(
        F.struct("doc_id", "text_sha256").alias("_key"), (F.col("count") > 1).alias("_again")
    )
    rows = docs.select(key.alias("_key"), F.struct(*_columns(docs)).alias("_row")).join(
        right.alias("r"), "_key"
    )
    if kept.where("count > 1").isEmpty():
        return rows.select("_row.*")
    once = rows.where("NOT _again").select("_row.*")
    again = rows.where("_again").dropDuplicates(["_key"]).select("_row.*")
    return once.unionByName(again)


def _columns(docs: DataFrame):
    return [F.col(f"`{name}`") for name in docs.columns]
