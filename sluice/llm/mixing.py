"""Mixing sources to target weights.

Words are summed per source, targets are filled by weight up to a cap, and every document is emitted
floor(rate) times plus once more when its seeded hash falls below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ranked, staged, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2.0
SEED = "mix"


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeat: float = MAX_REPEAT,
) -> DataFrame:
    """(source, source_size, target) from (source, size); the null source is one, and the last.

    Sources in code point order weigh ``weights``, repeating. They share ``share`` times all words;
    a target stops at ``max_repeat`` times its source, and what is over goes to the others by
    weight until none is above. That is a water level: each round is one sum over the sources,
    with the sources below the last level counted as full, until no more of them fill up.
    """
    if not 0 <= share <= max_repeat:
        raise ValueError("the share must lie between 0 and the largest repetition")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    by_rank = F.array(*[F.lit(w) for w in weights])
    sources = staged(
        ranked(totals, order, "_rank").select(
            "source",
            "source_size",
            by_rank[(F.col("_rank") % len(weights)).cast("int")].alias("weight"),
        ),
        "sources",
    )
    level, full = 0.0, -1
    while True:
        over = _is_full(level, max_repeat)
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(over, F.col("source_size")).otherwise(0)).alias("held"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(over).alias("full"),
        ).first()
        if row["all"] is None or not row["open"] or row["full"] == full:
            break
        full = row["full"]
        level = (share * row["all"] - max_repeat * row["held"]) / row["open"]
    return sources.select(
        "source",
        "source_size",
        F.when(_is_full(level, max_repeat), F.lit(max_repeat) * F.col("source_size"))
        .otherwise(F.col("weight") * F.lit(level))
        .cast("double")
        .alias("target"),
    )


def _is_full(level: float, max_repeat: float) -> Column:
    return F.col("weight") * F.lit(level) > F.lit(max_repeat) * F.col("source_size")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def mix(docs: DataFrame, seed: str = SEED, **settings) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, rate, copies, taken.

    Null texts have no words. Sources without words have target and rate 0. Rows that repeat an id
    share its draw, so reruns and repeated rows agree. Extra columns are ignored; an empty table
    gives no rows.
    """
    sizes = staged(
        docs.select("doc_id", "source", word_count(text_or_empty()).alias("size")), "sizes"
    )
    targets = source_targets(sizes, **settings).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    extra = (draw(F.col("doc_id"), seed) < F.col("rate") - whole).cast("long")
    return (
        sizes.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("rate", rate)
        .withColumn("copies", whole + extra)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "rate",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def emit(docs: DataFrame, seed: str = SEED, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with all its columns.

    Rates belong to sources, so the documents meet only the table of sources; the texts are not
    shuffled for it unless that table is too large to send.
    """
    sizes = staged(
        docs.select("source", word_count(text_or_empty()).alias("size")), "sizes"
    )
    rates = source_targets(sizes, **settings).select(
        F.struct("source").alias("_source"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0)
        .alias("_rate"),
    )
    extra = (draw(F.col("_row.doc_id"), seed) < F.col("_rate") - F.floor("_rate")).cast("int")
    copies = F.floor("_rate").cast("int") + extra
    return (
        docs.select(
            F.struct("source").alias("_source"),
            F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"),
        )
        .join(rates, "_source")
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies)))
        .select("_row.*")
    )
