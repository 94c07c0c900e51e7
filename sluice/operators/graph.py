"""Lexical graph of documents, elements, chunks and entities as node and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.batching import position_in_group
from sluice.operators.sequence import ordered_lag

# Labels and relationship names.
DOCUMENT = "Document"
CHUNK = "Chunk"
ELEMENT = "DocumentElement"
ENTITY = "Entity"
PART_OF_DOCUMENT = "PART_OF_DOCUMENT"
PART_OF_CHUNK = "PART_OF_CHUNK"
NEXT_CHUNK = "NEXT_CHUNK"
NEXT_ELEMENT = "NEXT_ELEMENT"
ENTITY_TYPE = "ENTITY_TYPE"
HAS_ENTITY = "HAS_ENTITY"

MERGE_BATCH = 1_000

_ITEMS = "array<struct<type:string,entity:string>>"
_ENTITIES = (
    f"struct<items:{_ITEMS},"
    "relationships:array<struct<to:string,from:string,relationship:string>>>"
)


def _label(elements: DataFrame):
    if "orig" not in elements.columns:
        return F.lit(ELEMENT)
    return F.when(F.col("orig").isNotNull(), F.lit(CHUNK)).otherwise(F.lit(ELEMENT))


def original_elements(elements: DataFrame) -> DataFrame:
    """(record_id, chunk_id, element_id, text) of the elements that chunks were made from."""
    return elements.select(
        "record_id", F.col("element_id").alias("chunk_id"), F.explode("orig").alias("o")
    ).select("record_id", "chunk_id", F.col("o.element_id"), F.col("o.text"))


def parsed_entities(elements: DataFrame) -> DataFrame:
    """Entity items and relationships of each element.

    ``metadata.entities`` is JSON, either a list of items or an object with ``items`` and
    ``relationships``. Text that does not parse, and items without type or entity, are skipped.
    """
    raw = F.col("metadata.entities")
    is_list = raw.rlike(r"^\s*\[")
    as_list = F.from_json(F.when(is_list, raw), _ITEMS)
    as_object = F.from_json(F.when(~is_list, raw), _ENTITIES)
    return elements.filter(raw.isNotNull()).select(
        "record_id",
        "element_id",
        _label(elements).alias("label"),
        F.coalesce(as_list, as_object["items"]).alias("items"),
        as_object["relationships"].alias("relationships"),
    )


def graph_nodes(index: DataFrame, elements: DataFrame) -> DataFrame:
    """(id, label, name, date_created, date_modified, text, embeddings), one row per id and label.

    Repeated nodes merge: of each property the largest non-null value stays, which does not
    depend on row order.
    """
    null = F.lit(None).cast("string")
    no_vector = F.lit(None).cast("array<float>")
    documents = index.select(
        F.col("identifier").alias("id"),
        F.lit(DOCUMENT).alias("label"),
        F.col("filename").alias("name"),
        "date_created",
        "date_modified",
        null.alias("text"),
        no_vector.alias("embeddings"),
    )

    def bare(ids: DataFrame, label) -> DataFrame:
        return ids.select(
            "id",
            label.alias("label"),
            null.alias("name"),
            null.alias("date_created"),
            null.alias("date_modified"),
            F.when(F.col("text") != "", F.col("text")).alias("text"),
            "embeddings",
        )

    parts = bare(
        elements.select("*", F.col("element_id").alias("id")), _label(elements)
    )
    nodes = documents.unionByName(parts)
    if "orig" in elements.columns:
        origins = original_elements(elements).select(
            F.col("element_id").alias("id"), "text", no_vector.alias("embeddings")
        )
        nodes = nodes.unionByName(bare(origins, F.lit(ELEMENT)))
    ends = entity_edges(elements).filter(f"dst_label = '{ENTITY}'")
    named = ends.select(F.col("dst").alias("id")).unionByName(
        ends.filter(f"src_label = '{ENTITY}'").select(F.col("src").alias("id"))
    )
    entities = named.select("id", null.alias("text"), no_vector.alias("embeddings"))
    nodes = nodes.unionByName(bare(entities, F.lit(ENTITY)))
    properties = ["name", "date_created", "date_modified", "text", "embeddings"]
    return nodes.groupBy("id", "label").agg(*[F.max(p).alias(p) for p in properties])


def structure_edges(index: DataFrame, elements: DataFrame, **options) -> DataFrame:
    """NEXT_*, PART_OF_DOCUMENT and PART_OF_CHUNK edges."""
    labelled = elements.withColumn("_label", _label(elements))
    chained = labelled.select(
        "record_id", "pos", F.struct(F.col("element_id").alias("id"), "_label").alias("_node")
    )
    chained = ordered_lag(chained, "_node", "_previous", **options)
    following = chained.filter(F.col("_previous").isNotNull()).select(
        F.col("_node.id").alias("src"),
        F.col("_node._label").alias("src_label"),
        F.col("_previous.id").alias("dst"),
        F.col("_previous._label").alias("dst_label"),
        F.when(F.col("_node._label") == CHUNK, NEXT_CHUNK).otherwise(NEXT_ELEMENT).alias("relationship"),
    )
    documents = index.select(F.col("identifier").alias("record_id"))
    belongs = labelled.join(documents, "record_id", "left_semi").select(
        F.col("element_id").alias("src"),
        F.col("_label").alias("src_label"),
        F.col("record_id").alias("dst"),
        F.lit(DOCUMENT).alias("dst_label"),
        F.lit(PART_OF_DOCUMENT).alias("relationship"),
    )
    edges = following.unionByName(belongs)
    if "orig" in elements.columns:
        origins = original_elements(elements)
        edges = edges.unionByName(
            origins.select(
                F.col("element_id").alias("src"),
                F.lit(ELEMENT).alias("src_label"),
                F.col("chunk_id").alias("dst"),
                F.lit(CHUNK).alias("dst_label"),
                F.lit(PART_OF_CHUNK).alias("relationship"),
            )
        ).unionByName(
            origins.select(
                F.col("element_id").alias("src"),
                F.lit(ELEMENT).alias("src_label"),
                F.col("record_id").alias("dst"),
                F.lit(DOCUMENT).alias("dst_label"),
                F.lit(PART_OF_DOCUMENT).alias("relationship"),
            )
        )
    return edges


def entity_edges(elements: DataFrame) -> DataFrame:
    """HAS_ENTITY, ENTITY_TYPE and free relationships."""
    parsed = parsed_entities(elements)
    items = parsed.select("element_id", "label", F.explode("items").alias("i")).filter(
        F.col("i.type").isNotNull() & F.col("i.entity").isNotNull()
    )
    has = items.select(
        F.col("element_id").alias("src"),
        F.col("label").alias("src_label"),
        F.col("i.entity").alias("dst"),
        F.lit(ENTITY).alias("dst_label"),
        F.lit(HAS_ENTITY).alias("relationship"),
    )
    kinds = items.select(
        F.col("i.entity").alias("src"),
        F.lit(ENTITY).alias("src_label"),
        F.col("i.type").alias("dst"),
        F.lit(ENTITY).alias("dst_label"),
        F.lit(ENTITY_TYPE).alias("relationship"),
    )
    related = (
        parsed.select(F.explode("relationships").alias("r"))
        .filter(
            F.col("r.from").isNotNull()
            & F.col("r.to").isNotNull()
            & F.col("r.relationship").isNotNull()
        )
        .select(
            F.col("r.from").alias("src"),
            F.lit(ENTITY).alias("src_label"),
            F.col("r.to").alias("dst"),
            F.lit(ENTITY).alias("dst_label"),
            F.col("r.relationship").alias("relationship"),
        )
    )
    return has.unionByName(kinds).unionByName(related)


def merge_nodes(existing: DataFrame, arriving: DataFrame) -> DataFrame:
    """Merge by (label, id): an arriving non-null property replaces the existing one."""
    properties = [c for c in existing.columns if c not in ("id", "label")]
    tagged = existing.withColumn("_new", F.lit(0)).unionByName(
        arriving.withColumn("_new", F.lit(1))
    )
    newest = [
        F.max_by(F.col(p), F.when(F.col(p).isNotNull(), F.col("_new"))).alias(p)
        for p in properties
    ]
    return tagged.groupBy("id", "label").agg(*newest)


def merge_edges(existing: DataFrame, arriving: DataFrame) -> DataFrame:
    return existing.unionByName(arriving).distinct()


def merge_batches(rows: DataFrame, group: list[str], order: list[str], size: int = MERGE_BATCH):
    """Batches of one statement each: rows of one label (or relationship and labels), ``size`` per
    batch. One label holds most rows, so batches come from a distributed order."""
    placed = position_in_group(rows, group, order, "_nth")
    return placed.withColumn("batch_no", F.floor(F.col("_nth") / size)).drop("_nth")


def delete_record(
    nodes: DataFrame, edges: DataFrame, record_ids: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Remove documents, everything that is part of them, and the edges that touch either."""
    documents = record_ids.select(F.col("record_id").alias("id")).distinct()
    parts = (
        edges.filter(F.col("relationship") == PART_OF_DOCUMENT)
        .join(documents.withColumnRenamed("id", "dst"), "dst", "left_semi")
        .select(F.col("src").alias("id"))
    )
    gone = documents.unionByName(parts).distinct()
    kept_nodes = nodes.filter(F.col("label") == ENTITY).unionByName(
        nodes.filter(F.col("label") != ENTITY).join(gone, "id", "left_anti")
    )
    kept_edges = edges.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(
        gone.withColumnRenamed("id", "dst"), "dst", "left_anti"
    )
    return kept_nodes, kept_edges
