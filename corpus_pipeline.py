"""A corpus pipeline: language ID, exact dedup, near dedup, mixing of sources, BPE.

Every stage takes (spark, docs, sf_dir) and judges all rows that the stage before has kept. All but
the last return the columns of ``docs``, whatever these are; the last returns one row per emitted
document with the digest of its ids and of the text decoded from them. Null texts count as empty.
Rows that repeat another are judged alike, and exact dedup keeps one of them. An empty table passes
every stage as an empty table. Names of ``docs`` cannot clash with those that the stages use.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.bpe import round_trip
from sluice.llm.common import staged, table, text_or_empty
from sluice.llm.exact_dedup import drop_duplicates
from sluice.llm.language_id import document_evidence, identify, train
from sluice.llm.mixing import emit
from sluice.llm.near_dedup import near_duplicates

NEAR_SIMILARITY = 80  # per cent of shingles in common, of the near_dedup stage

# Stages that SQL cannot express (a fitted model, a tokenizer): tested against plain Python.
ORACLE_SQL = None


def _without(docs: DataFrame, key, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``dropped`` (_key); no names can clash."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    rows = docs.select(key.alias("_key"), row.alias("_row"))
    return rows.join(dropped, "_key", "left_anti").select("_row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like one of the languages of the corpus; rejected ones go.

    Empty texts, texts without letters and texts unlike any language are rejected.
    """
    key = F.struct("doc_id", "source", "lang", F.xxhash64(text_or_empty()).alias("hash"))
    evidence = document_evidence(docs).withColumn("hash", F.xxhash64("text"))
    judged = identify(evidence, train(docs), ["source"])
    same = F.struct("doc_id", "source", F.col("declared").alias("lang"), "hash")
    dropped = judged.where("NOT accepted").select(same.alias("_key")).distinct()
    return _without(docs, key, staged(dropped, "rejected"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest doc_id."""
    return drop_duplicates(docs)


def _with_own_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _row) of every row, where no id is null or stands for several rows.

    Such ids are replaced by a negative hash of the row's id and text.
    """
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"),
        text_or_empty().alias("text"),
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"),
    )
    shared = docs.groupBy(doc_id.alias("_id")).count().where("count > 1 OR _id IS NULL")
    shared = staged(shared.select("_id", F.lit(True).alias("_shared")), "shared-ids")
    if shared.isEmpty():
        return rows
    own = -F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 62)) - 1
    return rows.join(shared, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        F.when(F.col("_shared"), own).otherwise(F.col("doc_id")).alias("doc_id"), "text", "_row"
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest doc_id.

    Rows that share an id, or have none, are judged each by its own text.
    """
    rows = _with_own_ids(docs)
    found = near_duplicates(rows.select("doc_id", "text"), NEAR_SIMILARITY)
    dropped = staged(found.where("NOT kept").select("doc_id").distinct(), "near-copies")
    return rows.join(dropped, "doc_id", "left_anti").select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return emit(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every emitted document."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what passes between two stages is a table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
