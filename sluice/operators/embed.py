"""Embedding of element texts in batches, with pluggable encoders."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_SIZE = 32

Encoder = Callable[[list[str]], list[list[float]]]


def hash_encoder(dimension: int = 16) -> Encoder:
    """Deterministic unit vectors from text digests, for tests and plumbing."""

    def encode(texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            raw = b""
            i = 0
            while len(raw) < dimension * 4:
                raw += hashlib.sha256(f"{i}:{text}".encode()).digest()
                i += 1
            vector = np.frombuffer(raw[: dimension * 4], dtype="<u4").astype(np.float64)
            vector = vector / 2**31 - 1.0
            norm = float(np.linalg.norm(vector)) or 1.0
            out.append((vector / norm).astype(np.float32).tolist())
        return out

    return encode


_ENCODERS: dict[str, Callable[..., Encoder]] = {"hash": hash_encoder}


def register_encoder(name: str, factory: Callable[..., Encoder]) -> None:
    """Add a named encoder factory; the factory runs once per task, on the executor."""
    if name in _ENCODERS:
        raise ValueError(f"encoder {name} is already registered")
    _ENCODERS[name] = factory


def encoder_factory(name: str | Callable[..., Encoder], **options) -> Callable[[], Encoder]:
    factory = _ENCODERS[name] if isinstance(name, str) else name
    return lambda: factory(**options)


def embed_elements(
    elements: DataFrame,
    encoder: str | Callable[..., Encoder] = "hash",
    batch_size: int = BATCH_SIZE,
    text: str = "text",
    out: str = "embeddings",
    **options,
) -> DataFrame:
    """Fill ``embeddings`` of all elements with text; other rows pass unchanged.

    Narrow: rows stay in their partitions, and only the text travels to Python. The encoder is
    made once per task and called with ``batch_size`` texts at a time.
    """
    factory = encoder_factory(encoder, **options)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = None
        for batch in batches:
            encode = encode or factory()
            texts = batch.to_pylist()
            vectors: list = [None] * len(texts)
            at = [i for i, t in enumerate(texts) if t]
            for first in range(0, len(at), batch_size):
                part = at[first : first + batch_size]
                made = encode([texts[i] for i in part])
                if len(made) != len(part):
                    raise ValueError(f"encoder returned {len(made)} vectors for {len(part)} texts")
                for i, vector in zip(part, made):
                    vectors[i] = vector
            yield pa.array(vectors, pa.list_(pa.float32()))

    # Not repeated by the optimizer: a model call is expensive.
    vector = F.arrow_udf(T.ArrayType(T.FloatType()))(run).asNondeterministic()
    made = elements.withColumn("_vector", vector(F.col(text)))
    kept = F.coalesce("_vector", F.col(out)) if out in elements.columns else F.col("_vector")
    return made.withColumn(out, kept).drop("_vector")


def embed_dimension(vector: Column) -> Column:
    return F.size(vector)


def vector_norm(vector: Column) -> Column:
    squares = F.aggregate(
        vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def is_unit_vector(vector: Column, tolerance: float = 1e-3) -> Column:
    return F.abs(vector_norm(vector) - 1.0) <= tolerance


def encoder_dimension(encoder: str | Callable[..., Encoder] = "hash", **options) -> int:
    """Dimension found by encoding one short sample text."""
    return len(encoder_factory(encoder, **options)()(["Q"])[0])
