"""Token counts by a whole-token shortcut.

Most pre-tokens of a text are themselves strings of the vocabulary, yet a vocabulary string need not
encode as its own token: the merges may take another way. So it is proved once, on the driver, which
do: every vocabulary string is merged as a word of its own, and those that end as one token are the
whole tokens. The merges of a word do not depend on what surrounds it, so a pre-token that is a whole
token counts one wherever it stands. Only the other pre-tokens are merged, and their counts are
remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sluice.llm.bpe import LONG_PIECE, MEMORY, PIECE_BYTES, SPACE, Vocabulary, slices, vocabulary
from sluice.llm.common import staged, text_or_empty

LIMIT = 1024  # tokens; texts with more are over the limit
LONG_TEXT = 1 << 20  # characters; longer texts are counted in parts of about that size
# Every pre-token ends where white space follows something else.
BORDER = re.compile(f"[^{SPACE}][{SPACE}]")


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> frozenset[str]:
    """The strings that encode as one token when they are a pre-token, special ones included.

    There are at most as many as the vocabulary has tokens.
    """
    model = vocabulary(path)
    found = set(model.special)
    for token, (begin, size) in enumerate(zip(model.tokens.starts, model.tokens.sizes)):
        word = model.tokens.table[begin : begin + size].tobytes()
        try:
            text = word.decode()
        except UnicodeDecodeError:
            continue  # part of a character, never a pre-token
        if text and text not in found and model.merge_word(word) == [token]:
            found.add(text)
    return frozenset(found)


class MergedCounts(dict):
    """Token counts of pre-tokens that are no whole tokens; forgetting them costs only time."""

    def __init__(self, model: Vocabulary):
        self.model = model
        self.bytes = 0

    def __missing__(self, piece: str) -> int:
        count = len(self.model.merge_word(piece.encode()))
        if len(piece) <= LONG_PIECE:
            if self.bytes > MEMORY:
                self.clear()
                self.bytes = 0
            self[piece] = count
            self.bytes += PIECE_BYTES
        return count


def text_parts(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """A text in parts of about ``size`` characters that end where pre-tokens end."""
    begin = 0
    while len(text) - begin > size:
        border = BORDER.search(text, begin + size)
        if border is None:
            break
        yield text[begin : border.start() + 1]
        begin = border.start() + 1
    yield text[begin:]


def count_text(model: Vocabulary, whole: frozenset[str], merged: MergedCounts, text: str) -> int:
    """The tokens of a text: one for each whole token, the merged count for each other pre-token."""
    total = 0
    cut = not any(re.search(f"[{SPACE}]", special) for special in model.special)
    for part in text_parts(text) if cut else [text]:
        pieces = model.split(part)
        rest = [piece for piece in pieces if piece not in whole]
        total += len(pieces) - len(rest) + sum(map(merged.__getitem__, rest))
    return total


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Counts are those of the tokenizers library for the byte-level BPE file at ``path``, without
    added, begin or end tokens; strings of special tokens within a text count one. ``over_limit`` is
    n_tokens > ``limit``. Null texts count as empty and have no tokens; rows without id and repeated
    rows are counted like others; extra columns are ignored; an empty table gives no rows. One pass
    without a shuffle, so hot sources cost nothing more; the broadcast is bounded by the vocabulary.
    """
    proved = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, whole = vocabulary(path), proved.value
        merged = MergedCounts(model)
        for batch in batches:
            for part in slices(batch, "text"):
                counts = [count_text(model, whole, merged, t) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pc.binary_length(part["text"]).cast(pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([count > limit for count in counts], pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
    return staged(found, "token-counts")
