"""Token ids in binary files that give any token directly.

Ids are split into chunks of eight bits. Level 0 holds the low chunk of every token, a bitmap tells
which tokens continue, and level k + 1 holds the next chunks of those that do. A rank directory
holds the number of set bits before every 512th bit, so the place of a token in the next level is one
directory entry and the bits of one block. A token is read with at most four such steps and without
decoding its neighbours.

A file holds a run of documents in ascending doc_id order:

    magic, block, number in block, documents, tokens, levels   6 little-endian 64-bit integers
    per document: id, id is null, first token, 3 x 64 bit; then the number of tokens
    per level: entries, chunks (1 byte each), bitmap (64-bit words), directory (64 bit per 512 bits)
    a line feed

Every part starts at a multiple of eight bytes. Sorted by block and number, files are in doc_id
order.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.bpe import SPACE, slices
from sluice.llm.common import shared_path, staged, text_or_empty

MAGIC = int.from_bytes(b"DACFILE1", "little")
END_ID = 1
FILE_TOKENS = 4_000_000
CHUNK_BITS = 8
BLOCK_BITS = 512
MEMORY = 1 << 19  # pieces remembered by a worker; only speed depends on it

# The pattern of the word tokenizer, and what ends the last token of a piece.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+")
# The same for texts in small letters below LATIN_END, with letters and numbers spelt out.
LATIN_END = "\u0180"
_L = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f"
_N = r"0-9\xb2\xb3\xb9\xbc-\xbe"
# No two of letters, numbers and the apostrophe begin alike, so letters, the most frequent, go first.
LATIN_PIECES = re.compile(
    rf"[{_L}]+|[{_N}]|'(?:s|t|re|ve|m|ll|d)|[^{SPACE}{_L}{_N}]+"
)
WORD_END = "</w>"


class Coder:
    """A tokenizer of the tokenizers library that drops white space and marks the ends of words.

    No token of such a tokenizer crosses a border of its pattern, so a text's ids are those of its
    pieces. Pieces are remembered as the bytes of their ids; the library is asked for all new pieces
    of some documents at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, place in vocabulary.items():
            self.ends[place] = token.endswith(WORD_END)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def _split(self, text: str) -> list[str] | None:
        """The pieces of a text, or None if the library should see it as it is."""
        for special in self.special:
            if special in text:
                return None
        if text.isascii():
            return LATIN_PIECES.findall(text.lower())
        low = unicodedata.normalize("NFC", text).lower()
        # Sigma has two small forms, and small letters may compose anew.
        if "Σ" in text or not unicodedata.is_normalized("NFC", low) or low.lower() != low:
            return None
        return (LATIN_PIECES if max(low) < LATIN_END else PIECES).findall(low)

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width)

    def _learn(self, pieces: list[str]) -> None:
        ids = self._encoded(" ".join(pieces))
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(pieces):  # the library knows other letters and cuts a piece once more
            for piece in pieces:
                self.known[piece] = self._encoded(piece).tobytes()
            return
        data, size = ids.tobytes(), self.width.itemsize
        begin = 0
        for piece, end in zip(pieces, (ends * size).tolist()):
            self.known[piece] = data[begin:end]
            begin = end

    def encode_all(self, texts: list[str]) -> list[bytes]:
        split = [self._split(text) for text in texts]
        new = set().union(*filter(None, split)).difference(self.known)
        if len(self.known) + len(new) > MEMORY:
            self.known.clear()
            new = set().union(*filter(None, split))
        new = list(new)
        for begin in range(0, len(new), 4096):
            self._learn(new[begin : begin + 4096])
        known = self.known.__getitem__
        return [
            self._encoded(text).tobytes() if pieces is None else b"".join(map(known, pieces))
            for text, pieces in zip(texts, split)
        ]


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def build_file(block: int, number: int, ids: list, sizes: list[int], tokens: np.ndarray) -> bytes:
    """The bytes of a file but the last; ``ids`` and ``sizes`` per document, ``tokens`` of all."""
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype("<i8")
    null = np.array([i is None for i in ids], "<i8")
    known = np.array([0 if i is None else i for i in ids], "<i8")
    levels = []
    left = tokens.astype(np.uint32)
    while True:
        more = left >> CHUNK_BITS != 0
        bits = np.zeros(-(-max(len(left), 1) // BLOCK_BITS) * BLOCK_BITS, bool)
        bits[: len(left)] = more
        counts = bits.reshape(-1, BLOCK_BITS).sum(axis=1)
        directory = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
        levels.append(
            np.array([len(left)], "<i8").tobytes()
            + _padded((left & 0xFF).astype(np.uint8).tobytes())
            + np.packbits(bits, bitorder="little").tobytes()
            + directory.tobytes()
        )
        left = left[more] >> CHUNK_BITS
        if not len(left):
            break
    head = np.array([MAGIC, block, number, len(ids), len(tokens), len(levels)], "<i8")
    table = np.stack([known, null, starts[:-1]], axis=1).astype("<i8")
    return b"".join([head.tobytes(), table.tobytes(), starts[-1:].tobytes(), *levels])


class TokenFile:
    """Reads one file; any token or run of tokens without decoding others."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, "<i8", 6)
        if head[0] != MAGIC:
            raise ValueError("not a token file")
        self.block, self.number, documents, self.n_tokens, levels = map(int, head[1:])
        at = 48
        table = np.frombuffer(data, "<i8", documents * 3 + 1, at)
        at += table.nbytes
        rows = table[:-1].reshape(-1, 3)
        self.doc_ids = [None if null else int(i) for i, null in rows[:, :2]]
        self.starts = np.append(rows[:, 2], table[-1])
        self.levels = []
        for _ in range(levels):
            size = int(np.frombuffer(data, "<i8", 1, at)[0])
            at += 8
            chunks = np.frombuffer(data, np.uint8, size, at)
            at += size + -size % 8
            blocks = -(-max(size, 1) // BLOCK_BITS)
            bitmap = np.frombuffer(data, np.uint8, blocks * BLOCK_BITS // 8, at)
            at += bitmap.nbytes
            directory = np.frombuffer(data, "<i8", blocks + 1, at)
            at += directory.nbytes
            self.levels.append((chunks, bitmap, directory))

    def _rank(self, level: int, i: int) -> int:
        """Set bits of a level before bit i."""
        _, bitmap, directory = self.levels[level]
        block = i // BLOCK_BITS
        bits = np.unpackbits(
            bitmap[block * BLOCK_BITS // 8 : i // 8 + 1], bitorder="little"
        )[: i - block * BLOCK_BITS]
        return int(directory[block]) + int(bits.sum())

    def token(self, i: int) -> int:
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[i]) << shift
            if not bitmap[i // 8] >> i % 8 & 1:
                break
            i, shift = self._rank(level, i), shift + CHUNK_BITS
        return value

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Tokens begin to end (without it); of each level only the run that they need is read."""
        if not 0 <= begin <= end <= self.n_tokens:
            raise IndexError((begin, end))
        out = np.zeros(end - begin, np.uint32)
        where = np.arange(end - begin)
        shift = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            out[where] |= chunks[begin:end].astype(np.uint32) << np.uint32(shift)
            bits = np.unpackbits(bitmap[begin // 8 : -(-end // 8)], bitorder="little")
            more = bits[begin % 8 : begin % 8 + end - begin].astype(bool)
            where = where[more]
            if not len(where):
                break
            begin = self._rank(level, begin)
            end, shift = begin + len(where), shift + CHUNK_BITS
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


def _blocks(docs: DataFrame, blocks: int) -> Column:
    """The block of a row: ascending ranges of doc_id with about as many rows each.

    The borders are quantiles of all ids, taken in one pass over the id column. Null ids come first.
    """
    marks = [k / blocks for k in range(1, blocks)]
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), marks, 20 * blocks)).first()
    borders = sorted(set(found[0] or []))
    if not borders:
        return F.lit(0)
    # The count of borders not above the id, by bisection in the expression.
    def bisect(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("doc_id") < borders[middle], bisect(low, middle)).otherwise(
            bisect(middle + 1, high)
        )

    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(bisect(0, len(borders)))


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``docs`` (block, doc_id, text) to (block, doc_id, width, ids), ids as bytes, end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = coder(tokenizer_path)
        end = np.array([END_ID], model.width).tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [found + end for found in model.encode_all(part["text"].to_pylist())]
                width = np.full(len(ids), model.width.itemsize, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part["block"], part["doc_id"], pa.array(width), pa.array(ids, pa.binary())],
                    ["block", "doc_id", "width", "ids"],
                )

    return docs.mapInArrow(run, "block int, doc_id long, width int, ids binary")


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, file_tokens: int = FILE_TOKENS
) -> None:
    """Encodes the texts of ``docs`` and writes the files to ``path``, in ascending doc_id order.

    Rows are dealt to ranges of ids, sorted there (spilling if need be) and streamed into files of
    at most ``file_tokens`` tokens, or one longer document. Only ids are shuffled, texts are not.
    Null texts count as empty and have the end id only; rows that repeat an id follow each other;
    rows without id come first.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    )
    rows = rows.select(_blocks(docs, 2 * parts).cast("int").alias("block"), "doc_id", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, held = None, 0, 0
        ids: list = []
        pieces: list[np.ndarray] = []

        def file() -> pa.RecordBatch:
            image = build_file(block, number, ids, [len(p) for p in pieces], np.concatenate(pieces))
            return pa.RecordBatch.from_arrays([pa.array([image], pa.binary())], ["image"])

        for batch in batches:
            for row_block, doc_id, width, data in zip(
                *(batch[name].to_pylist() for name in ("block", "doc_id", "width", "ids"))
            ):
                tokens = np.frombuffer(data, f"<u{width}")
                if ids and (row_block != block or held + len(tokens) > file_tokens):
                    yield file()
                    number, held, ids, pieces = number + 1, 0, [], []
                if row_block != block:
                    block, number = row_block, 0
                ids.append(doc_id)
                pieces.append(tokens)
                held += len(tokens)
        if ids:
            yield file()

    images = (
        encode_documents(rows, tokenizer_path)
        .repartition(parts, "block")
        .sortWithinPartitions("block", F.col("doc_id").asc_nulls_first())
        .mapInArrow(build, "image binary")
    )
    # The text writer puts the bytes of a row and a line feed into a file; the feed ends the format.
    images.select(F.col("image").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).text(path)


def read_token_files(spark, path: str) -> DataFrame:
    """One row per document in the files, with its place, first token, size and checksum there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                data = content.as_py()
                if not data:
                    continue
                file = TokenFile(data)
                crc = [
                    zlib.crc32(file.document(k).astype("<u4").tobytes())
                    for k in range(len(file.doc_ids))
                ]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file.block] * n, pa.int32()),
                        pa.array([file.number] * n, pa.int32()),
                        pa.array(range(n), pa.int64()),
                        pa.array(file.doc_ids, pa.int64()),
                        pa.array(file.starts[:-1], pa.int64()),
                        pa.array(np.diff(file.starts), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["block", "number", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        run,
        "block int, number int, place long, doc_id long, local_start long, n_tokens long, "
        "ids_crc32 long",
    )


def token_offsets(spark, path: str) -> DataFrame:
    """One row per document in the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before: those of earlier blocks (one row per block is
    summed), of earlier files of the block, and of the file. An empty folder gives no rows.
    """
    read = staged(read_token_files(spark, path), "token-files")
    files = read.groupBy("block", "number").agg(F.sum("n_tokens").alias("n"))
    blocks = files.groupBy("block").agg(F.sum("n").alias("n"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(
        "block", F.coalesce(F.sum("n").over(earlier.orderBy("block")), F.lit(0)).alias("base")
    )
    offsets = files.join(before, "block").select(
        "block",
        "number",
        (
            F.col("base")
            + F.coalesce(F.sum("n").over(earlier.partitionBy("block").orderBy("number")), F.lit(0))
        ).alias("base"),
    )
    return read.join(offsets, ["block", "number"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_file_round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes the files of ``docs`` to the shared folder and reads them back: ``token_offsets``."""
    path = shared_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer_path)
    return token_offsets(docs.sparkSession, path)
