"""Language-model scores from a log-frequency Bloom filter.

Training counts words and word pairs. A pair of count c is held as its quantised count
q = 1 + floor(log2 c): the filter gets the keys (pair, 1) to (pair, q). A lookup asks for (pair, 1),
(pair, 2), .. until one is missing, and takes 2^(q - 1) as the count, a lower bound. Word counts are
kept exactly, as sorted arrays. Scores are smoothed by the word distribution P1:

    P(w | v) = (min(2^(q - 1), c(v), c(w)) + K * P1(w)) / (c(v) + K)
    P1(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1))

so they sum to at most 1 over w but for false positives of the filter (below 1 % of unseen pairs).

Counts and filter come in segments, ranges of hashes. The number of segments follows the size of the
corpus, so that a segment stays small. While all segments together are below ``BROADCAST_BYTES``,
they are broadcast; beyond that, lookups travel to their segments and back in batches of documents.
Both ways give the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.bpe import slices
from sluice.llm.common import staged, text_or_empty

ADD = 0.1  # of the word distribution
K = 10.0  # weight of the word distribution against a context
BITS_PER_KEY = 10
PROBES = 7
SEGMENT_BYTES = 16 << 20  # of training text
BATCH_BYTES = 16 << 20  # of text, where lookups travel
BROADCAST_BYTES = 256 << 20
HELD_KEYS = 1 << 21  # distinct words and pairs that a task counts before it sends them
MEMORY = 1 << 17

END = np.uint64(xxhash.xxh3_64_intdigest(b"end of text"))
START = np.uint64(xxhash.xxh3_64_intdigest(b"start of text"))


class _Words(dict):
    """Hashes of words seen lately; forgetting them costs only time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_WORDS = _Words()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, contexts, starts): hashes of tokens and of those before, and where texts begin.

    Tokens are the words in lower case (A-Z) and one end; the first has the start as context.
    """
    pieces, lengths = [], []
    for text in texts:
        words = text.encode().lower().split()
        pieces.append(np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words)))
        pieces.append(np.array([END], np.uint64))
        lengths.append(len(words) + 1)
    tokens = np.concatenate(pieces) if pieces else np.empty(0, np.uint64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[: len(lengths)].astype(np.int64)
    contexts = np.roll(tokens, 1)
    contexts[starts] = START
    return tokens, contexts, starts


def pair_hashes(contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(contexts) * np.uint64(3) + tokens)


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _counted(hashes: np.ndarray, counts: np.ndarray | None = None):
    """Distinct hashes in order, and the sum of their counts."""
    if counts is None:
        return np.unique(hashes, return_counts=True)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
    if not len(first):
        return hashes, counts
    return hashes[first], np.add.reduceat(counts, first)


def _key(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and step of the probes for the keys (hash, level)."""
    one = _mixed(hashes + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return one, _mixed(one) | np.uint64(1)


def _place(one: np.ndarray, step: np.ndarray, k: int, bits: int) -> np.ndarray:
    return (one + np.uint64(k) * step) % np.uint64(bits)


def _cuts(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each segment begins among sorted hashes, and the segments that have any."""
    of = segment_of(hashes, segments)
    return np.searchsorted(of, np.arange(segments + 1)), np.unique(of)


class Segment:
    """Word counts and pair filter of one range of hashes."""

    def __init__(self, words: bytes, counts: bytes, bloom: bytes):
        self.words = np.frombuffer(words, np.uint64)
        self.counts = np.frombuffer(counts, np.uint32)
        self.bloom = np.frombuffer(bloom, np.uint8)

    @staticmethod
    def build(words, counts, pairs, pair_counts) -> tuple[bytes, bytes, bytes]:
        levels = np.floor(np.log2(pair_counts)).astype(np.int64) + 1 if len(pairs) else pair_counts
        bits = max(64, -(-int(levels.sum()) * BITS_PER_KEY // 64) * 64)
        bloom = np.zeros(bits, bool)
        for level in range(1, int(levels.max()) + 1 if len(pairs) else 1):
            one, step = _key(pairs[levels >= level], level)
            for k in range(PROBES):
                bloom[_place(one, step, k, bits)] = True
        packed = np.packbits(bloom, bitorder="little")
        return words.tobytes(), counts.astype(np.uint32).tobytes(), packed.tobytes()

    def word_counts(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.counts[at], 0).astype(np.int64)

    def levels(self, pairs: np.ndarray) -> np.ndarray:
        """The quantised count of each pair, 0 for unseen ones."""
        found = np.zeros(len(pairs), np.int64)
        open_ = np.arange(len(pairs))
        bits, level = len(self.bloom) * 8, 1
        while len(open_):
            one, step = _key(pairs[open_], level)
            for k in range(PROBES):
                place = _place(one, step, k, bits)
                byte = self.bloom[(place >> np.uint64(3)).astype(np.int64)]
                hit = (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                open_, one, step = open_[hit], one[hit], step[hit]
            found[open_] = level
            level += 1
        return found


def held_out(doc_id: Column) -> Column:
    """One document in ten, by the CRC-32 of its id; documents without id are held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def train(docs: DataFrame) -> DataFrame:
    """The segments of the texts in ``docs``: (segment, segments, words, counts, bloom, tokens).

    A task adds up the words and pairs of its documents, and sends one row to each segment that has
    any of them when it holds ``HELD_KEYS``, so there are never more rows than distinct keys. All
    documents and whole texts are counted. Segments that no word or pair falls into have no row.
    """
    size = docs.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0
    segments = max(1, -(-size // SEGMENT_BYTES))
    most = HELD_KEYS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        keys = 0

        def merged() -> tuple[np.ndarray, ...]:
            words, counts, pairs, pair_counts = map(np.concatenate, zip(*held))
            return *_counted(words, counts), *_counted(pairs, pair_counts)

        def sent() -> pa.RecordBatch:
            words, counts, pairs, pair_counts = held[0]
            cuts, found = zip(*(_cuts(hashes, segments) for hashes in (words, pairs)))
            columns: list[list] = [[], [], [], []]
            full = np.union1d(*found).tolist()
            for k in full:
                w, p = (slice(cut[k], cut[k + 1]) for cut in cuts)
                for column, values, kind in zip(
                    columns,
                    (words[w], counts[w], pairs[p], pair_counts[p]),
                    (np.uint64, np.uint32) * 2,
                ):
                    column.append(values.astype(kind).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32())] + [pa.array(column, pa.binary()) for column in columns],
                ["segment", "words", "counts", "pairs", "pair_counts"],
            )

        for batch in batches:
            for part in slices(batch, "text", 8192, 1 << 22):
                tokens, contexts, _ = token_hashes(part["text"].to_pylist())
                held.append((*_counted(tokens), *_counted(pair_hashes(contexts, tokens))))
                keys += len(held[-1][0]) + len(held[-1][2])
                if keys >= most:
                    held[:] = [merged()]
                    keys = len(held[0][0]) + len(held[0][2])
                    if keys > most // 2:
                        yield sent()
                        held.clear()
                        keys = 0
        if held:
            held[:] = [merged()]
            yield sent()
        _WORDS.clear()

    def build(table):
        def joined(name, kind):
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)

        words, counts = _counted(
            joined("words", np.uint64), joined("counts", np.uint32).astype(int)
        )
        pairs, pair_counts = _counted(
            joined("pairs", np.uint64), joined("pair_counts", np.uint32).astype(int)
        )
        parts = Segment.build(words, counts, pairs, pair_counts)
        return pa.table(
            {
                "segment": table["segment"][:1],
                "segments": pa.array([segments], pa.int32()),
                "words": pa.array([parts[0]], pa.binary()),
                "counts": pa.array([parts[1]], pa.binary()),
                "bloom": pa.array([parts[2]], pa.binary()),
                "tokens": pa.array([int(counts.sum())], pa.int64()),
            }
        )

    counted = docs.select(text_or_empty().alias("text")).mapInArrow(
        count, "segment int, words binary, counts binary, pairs binary, pair_counts binary"
    )
    schema = "segment int, segments int, words binary, counts binary, bloom binary, tokens long"
    return staged(counted.groupBy("segment").applyInArrow(build, schema), "segments")


class Totals:
    """What the formulas need of the whole corpus."""

    def __init__(self, model: DataFrame):
        size = F.octet_length("words") + F.octet_length("counts") + F.octet_length("bloom")
        row = model.agg(
            F.sum("tokens").alias("n"),
            F.sum(F.octet_length("words") / 8).cast("long").alias("v"),
            F.max("segments").alias("segments"),
            F.sum(size).alias("bytes"),
        ).first()
        self.tokens, self.words = row["n"] or 0, row["v"] or 0
        self.segments, self.bytes = row["segments"] or 1, row["bytes"] or 0
        self.mass = self.tokens + ADD * (self.words + 1)


def _scores(tokens, contexts, starts, count, context_count, level, totals: Totals):
    """Per text: n_tokens, n_known, base_score, score; all arguments but starts are per token."""
    word = (count + ADD) / totals.mass
    seen = np.where(level > 0, np.exp2(np.maximum(level - 1, 0)), 0.0)
    seen = np.minimum(seen, np.minimum(count, context_count))
    smooth = (seen + K * word) / (context_count + K)
    return (
        np.diff(np.append(starts, len(tokens))),
        np.add.reduceat((count > 0).astype(np.int64), starts),
        np.add.reduceat(np.log10(word), starts),
        np.add.reduceat(np.log10(smooth), starts),
    )


SCORE_SCHEMA = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _rows(doc_ids, columns) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [doc_ids, *[pa.array(c, kind) for c, kind in zip(columns, kinds)]],
        ["doc_id", "n_tokens", "n_known", "base_score", "score"],
    )


def _by_broadcast(docs: DataFrame, model: DataFrame, totals: Totals) -> DataFrame:
    context = docs.sparkSession.sparkContext
    parts = {}
    for row in model.select("segment", "words", "counts", "bloom").toLocalIterator():
        parts[row["segment"]] = context.broadcast(
            tuple(map(bytes, (row["words"], row["counts"], row["bloom"])))
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: Segment(*part.value) for k, part in parts.items()}

        def ask(hashes: np.ndarray, what: str) -> np.ndarray:
            """Answers for hashes in any order, each distinct one asked once."""
            distinct, back = np.unique(hashes, return_inverse=True)
            cuts = np.searchsorted(
                segment_of(distinct, totals.segments), np.arange(totals.segments + 1)
            )
            answers = np.zeros(len(distinct), np.int64)
            for k, segment in held.items():
                mine = slice(cuts[k], cuts[k + 1])
                answers[mine] = getattr(segment, what)(distinct[mine])
            return answers[back]

        documents = int(ask(np.array([END]), "word_counts")[0])
        for batch in batches:
            for part in slices(batch, "text", 4096, 1 << 21):
                tokens, contexts, starts = token_hashes(part["text"].to_pylist())
                count = ask(tokens, "word_counts")
                before = np.roll(count, 1)
                before[starts] = documents
                level = np.zeros(len(tokens), np.int64)
                both = np.flatnonzero((count > 0) & (before > 0))
                level[both] = ask(pair_hashes(contexts[both], tokens[both]), "levels")
                yield _rows(
                    part["doc_id"], _scores(tokens, contexts, starts, count, before, level, totals)
                )
        _WORDS.clear()

    return docs.mapInArrow(run, SCORE_SCHEMA)


def _by_travel(docs: DataFrame, model: DataFrame, totals: Totals) -> DataFrame:
    """Batches of documents send their distinct hashes to the segments and get the answers back."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-size // BATCH_BYTES))
    dealt = staged(
        docs.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")),
        "batches",
    )

    def asked(texts: list[str]):
        tokens, contexts, starts = token_hashes(texts)
        return tokens, contexts, starts, np.unique(np.append(tokens, END)), np.unique(
            pair_hashes(contexts, tokens)
        )

    def questions(table):
        *_, words, pairs = asked(table["text"].to_pylist())
        cuts, some = _cuts(words, totals.segments)
        pair_cuts, others = _cuts(pairs, totals.segments)
        full = np.union1d(some, others).tolist()
        return pa.table(
            {
                "batch": pa.array([table["batch"][0].as_py()] * len(full), pa.int32()),
                "segment": pa.array(full, pa.int32()),
                "words": [words[cuts[k] : cuts[k + 1]].tobytes() for k in full],
                "pairs": [pairs[pair_cuts[k] : pair_cuts[k + 1]].tobytes() for k in full],
            }
        )

    def answers(asked_of, segment):
        # A segment without keys has no row in the model.
        rows = segment.to_pylist() or [{"words": b"", "counts": b"", "bloom": bytes(8)}]
        held = Segment(*(rows[0][c] for c in ("words", "counts", "bloom")))
        words = [np.frombuffer(w, np.uint64) for w in asked_of["words"].to_pylist()]
        pairs = [np.frombuffer(p, np.uint64) for p in asked_of["pairs"].to_pylist()]
        return pa.table(
            {
                "batch": asked_of["batch"],
                "segment": asked_of["segment"],
                "counts": pa.array([held.word_counts(w).tobytes() for w in words], pa.binary()),
                "levels": pa.array([held.levels(p).tobytes() for p in pairs], pa.binary()),
            }
        )

    def score(table, found):
        tokens, contexts, starts, words, pairs = asked(table["text"].to_pylist())
        found = found.sort_by("segment")
        counts = np.frombuffer(b"".join(found["counts"].to_pylist()), np.int64)
        levels = np.frombuffer(b"".join(found["levels"].to_pylist()), np.int64)
        count = counts[np.searchsorted(words, tokens)]
        before = np.roll(count, 1)
        before[starts] = counts[np.searchsorted(words, END)]
        level = levels[np.searchsorted(pairs, pair_hashes(contexts, tokens))]
        level = np.where((count > 0) & (before > 0), level, 0)
        rows = _rows(
            table["doc_id"].combine_chunks(),
            _scores(tokens, contexts, starts, count, before, level, totals),
        )
        return pa.Table.from_batches([rows])

    questions_schema = "batch int, segment int, words binary, pairs binary"
    sent = dealt.groupBy("batch").applyInArrow(questions, questions_schema)
    returned = (
        sent.groupBy("segment")
        .cogroup(model.groupBy("segment"))
        .applyInArrow(answers, "batch int, segment int, counts binary, levels binary")
    )
    both = dealt.groupBy("batch").cogroup(returned.groupBy("batch"))
    return both.applyInArrow(score, SCORE_SCHEMA)


def score(docs: DataFrame, model: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, base_score, score, train_tokens.

    Null texts are empty and have the end only. With an untrained model every count is 0. Extra
    columns are ignored; an empty table gives no rows.
    """
    totals = Totals(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    way = _by_broadcast if totals.bytes <= broadcast_bytes else _by_travel
    return way(rows, model, totals).withColumn("train_tokens", F.lit(totals.tokens).cast("long"))


def held_out_scores(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``score`` of all rows by a model of the rows that are not held out, with ``held_out``."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return score(docs, model, broadcast_bytes).withColumn("held_out", held_out(F.col("doc_id")))
