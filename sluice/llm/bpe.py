"""Byte-level BPE by a contiguous rank array.

A word is a list of part boundaries with the rank of every pair of neighbours beside it. The
smallest rank is found by a scan, its inner boundary is deleted, and the ranks of the two new
neighbours are looked up again, until no pair has a rank. Words longer than ``LONG_WORD`` bytes, for which repeated
scans would cost the square of their length, take the same merges from a heap.

The vocabulary is read from a public tokenizer file on every worker; its path is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from sluice.llm.common import staged, text_or_empty

# White space, and the pattern that splits text before the merges.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
    r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+"
)
# The same for texts below LATIN_END, with the letters and numbers spelt out.
LATIN_END = "\u0250"
_L = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_N = r"0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{SPACE}{_L}{_N}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

LONG_WORD = 200  # bytes; beyond it a heap replaces the scan, with the same result
MEMORY = 24 << 20  # bytes of pieces remembered by a worker; only speed depends on it
PIECE_BYTES = 250  # about what a remembered piece takes besides its ids
GATHER = 1 << 17  # ids whose strings are gathered at once
LONG_PIECE = 64  # characters; longer pieces are forgotten after use
NO_RANK = 1 << 62
SLICE_ROWS, SLICE_CHARS = 512, 1 << 21


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, as letter to byte.

    Printable Latin-1 bytes stand for themselves, the others follow from U+0100 in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if chr(b) not in letters)
    letters.update({chr(256 + k): b for k, b in enumerate(rest)})
    return letters


class Strings:
    """Byte strings by number in one table; those of runs of numbers are joined at once."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.table = np.frombuffer(b"".join(strings), np.uint8)

    def _gathered(self, numbers: np.ndarray) -> bytes:
        sizes = self.sizes[numbers]
        stops = np.cumsum(sizes)
        places = np.repeat(self.starts[numbers] - (stops - sizes), sizes)
        return self.table[places + np.arange(len(places))].tobytes()

    def joined(self, numbers: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """For each run of ``numbers`` up to one of ``ends``, its strings in a row."""
        cuts = np.concatenate([[0], np.cumsum(self.sizes[numbers])])[np.concatenate([[0], ends])]
        data = b"".join(
            self._gathered(numbers[k : k + GATHER]) for k in range(0, len(numbers), GATHER)
        )
        return [data[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def check_kind(path: str, data: dict) -> None:
    """Raise if a tokenizer file asks for anything but the pattern and the merges of this module."""
    model, first = data["model"], data.get("pre_tokenizer") or {}
    wrong = [
        name
        for name, found in {
            "normalizer": data.get("normalizer"),
            "pre_tokenizer": first.get("type") != "ByteLevel" or not first.get("use_regex", True),
            "add_prefix_space": first.get("add_prefix_space"),
            "model": model.get("type", "BPE") != "BPE",
            **{
                name: model.get(name)
                for name in (
                    "dropout",
                    "continuing_subword_prefix",
                    "end_of_word_suffix",
                    "ignore_merges",
                )
            },
            "added_tokens": any(
                token.get(flag)
                for token in data.get("added_tokens", [])
                for flag in ("single_word", "lstrip", "rstrip", "normalized")
            ),
        }.items()
        if found
    ]
    if wrong:
        raise ValueError(f"{path} is no plain byte-level BPE: {', '.join(wrong)}")


class Vocabulary:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        check_kind(path, data)
        ids = data["model"]["vocab"]
        letters = byte_letters()
        tokens = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        tokens.update({i: text.encode() for text, i in self.special.items()})
        ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.width = np.dtype("<u2" if len(ordered) <= 1 << 16 else "<u4")
        self.tokens = Strings(ordered)
        self.decimals = Strings([b"%d," % i for i in range(len(ordered))])
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        # A pair of ids to rank and merged id in one number, so that the smallest is the first.
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[ids[left], ids[right]] = rank << 32 | ids[left + right]
        self.pieces = regex.compile(PIECES)
        self.cut = None
        if self.special:
            longest = sorted(self.special, key=len, reverse=True)
            self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")")
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def forget(self) -> None:
        self.known.clear()
        self.known_bytes = 0

    def merge_word(self, word: bytes) -> list[int]:
        """Ids of one word: boundaries and ranks side by side, one deletion a round."""
        if len(word) > LONG_WORD:
            return self._merge_long(word)
        rank_of = self.pairs.get
        parts = [self.byte_ids[b] for b in word]
        starts = list(range(len(word) + 1))  # part k is word[starts[k]:starts[k + 1]]
        ranks = [rank_of(pair, NO_RANK) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            k = ranks.index(best)
            parts[k] = best & 0xFFFFFFFF
            del parts[k + 1], starts[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank_of((parts[k - 1], parts[k]), NO_RANK)
            if k < len(ranks):
                ranks[k] = rank_of((parts[k], parts[k + 1]), NO_RANK)
        return parts

    def _merge_long(self, word: bytes) -> list[int]:
        parts = [self.byte_ids[b] for b in word]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (rank, k)
            for k in range(n - 1)
            if (rank := self.pairs.get((parts[k], parts[k + 1]), NO_RANK)) != NO_RANK
        ]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            if parts[k] < 0 or right >= n or self.pairs.get((parts[k], parts[right])) != rank:
                continue  # one of the two has been merged since
            parts[k], parts[right] = rank & 0xFFFFFFFF, -1
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < n:
                    found = self.pairs.get((parts[left], parts[after[left]]))
                    if found is not None:
                        heapq.heappush(heap, (found, left))
        return [p for p in parts if p >= 0]

    def split(self, text: str) -> list[str]:
        """Pieces of a text; strings of special tokens are pieces of their own."""
        pattern = LATIN_PIECES if not text or max(text) < LATIN_END else self.pieces
        if not (self.cut and self.cut.search(text)):
            return pattern.findall(text)
        pieces: list[str] = []
        for part in self.cut.split(text):
            pieces += [part] if part in self.special else pattern.findall(part)
        return pieces

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of type ``width``."""
        split = [self.split(text) for text in texts]
        if self.known_bytes > MEMORY:
            self.forget()
        long = []
        for piece in set().union(*split).difference(self.known):
            ids = (
                [self.special[piece]] if piece in self.special else self.merge_word(piece.encode())
            )
            self.known[piece] = np.array(ids, self.width).tobytes()
            if len(piece) > LONG_PIECE:
                long.append(piece)
            else:
                self.known_bytes += PIECE_BYTES + len(self.known[piece])
        known = self.known.__getitem__
        found = [b"".join(map(known, pieces)) for pieces in split]
        for piece in long:
            del self.known[piece]
        return found

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], self.width).tolist()

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of runs of ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        return [data.decode("utf-8", "replace") for data in self.tokens.joined(ids, ends)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def slices(
    batch: pa.RecordBatch, column: str, rows: int = SLICE_ROWS, size: int = SLICE_CHARS
) -> Iterator[pa.RecordBatch]:
    """The batch in runs of at most ``rows`` rows and ``size`` bytes of text, or one longer row."""
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
    begin = held = 0
    for row, length in enumerate(lengths):
        if row > begin and (row - begin >= rows or held + length > size):
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += length
    if begin < batch.num_rows:
        yield batch.slice(begin)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row; null texts count as empty and have no ids.

    One pass without a shuffle, so hot sources and repeated rows cost nothing more. Extra columns
    are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text"):
                found = model.encode_all(part["text"].to_pylist())
                ends = np.cumsum([0, *map(len, found)]) // model.width.itemsize
                values = np.frombuffer(b"".join(found), model.width).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([part["doc_id"], ids], ["doc_id", "ids"])
        model.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the column ``text`` that the ids stand for; null as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(begin, SLICE_ROWS)
                sizes = pc.fill_null(pc.list_value_length(part["ids"]), 0)
                ids = part["ids"].flatten().to_numpy(zero_copy_only=False)
                texts = model.decode_all(ids, np.cumsum(sizes.to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["ids"], pa.array(texts, pa.string())],
                    ["doc_id", "ids", "text"],
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, ids array<int>, text string"
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ids_sha256 is that of the decimal ids joined by commas. A text is encoded, and its ids are
    decoded, within one pass that hands on these four columns only; they are written once, in small
    Arrow batches. Rows are treated as by ``encode`` and ``decode``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text"):
                found = model.encode_all(part["text"].to_pylist())
                ends = np.cumsum([len(f) // model.width.itemsize for f in found])
                ids = np.frombuffer(b"".join(found), model.width)
                decimals = model.decimals.joined(ids, ends)
                texts = model.decode_all(ids, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(np.diff(ends, prepend=0)),
                        pa.array([hashlib.sha256(d[:-1]).hexdigest() for d in decimals]),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        model.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return staged(found, "encoded")
