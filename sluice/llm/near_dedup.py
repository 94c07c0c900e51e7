"""Near-duplicate classes by MinHash and a multi-index Hamming join.

1. Every document becomes its set of distinct five-word shingles, and the set a signature of 64
   MinHash values of 16 bits. Documents with equal sets are one class, and go on as one.
2. Two signatures differ in d of the 64 values; the join finds all pairs with d of at most 25. The
   signature is split into 13 chunks. By the pigeonhole principle such a pair has a chunk with at
   most one error (13 chunks with two errors each would be 26). The allowed errors are enumerated:
   a chunk gives one key for each of its values left out, so signatures that agree in a chunk but
   for one value share a key. That is 64 keys a class. Below 85 per cent, it is 15 chunks and d of
   at most 29.
3. Pairs that share a key are compared by signature, then by bitmaps of the sets, which bound the
   size of their intersection from above, then on the full sets. Only what decides the components
   is compared, see ``near_duplicates``.

At a similarity of 0.85 or more, d is above 25 with a probability of less than 1e-5 (a binomial tail
of 64 values that differ with probability 0.15); at 0.80 or more, d is above 29 with a probability
of less than 1e-5. Everything else is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.bpe import slices
from sluice.llm.common import components, staged, text_or_empty

SHINGLE_WORDS = 5
SIMILARITY = 85  # per cent
LEAST_SIMILARITY = 80
VALUES = 64
CHUNKS = 13
MORE_CHUNKS = 15  # below ``SIMILARITY``
MAX_DISTANCE = 2 * CHUNKS - 1
FILTER_BITS = 1 << 24
BITMAP_BITS = 4096
BLOCK = 2048  # signatures a side of a block of the last comparison
MEMORY = 1 << 16

_RANDOM = np.random.Generator(np.random.Philox(20))
_ODD = np.uint64(1)
WORD_FACTORS = _RANDOM.integers(0, 1 << 63, SHINGLE_WORDS, np.uint64) * np.uint64(2) + _ODD
PERMUTATIONS = _RANDOM.integers(0, 1 << 63, VALUES, np.uint64) * np.uint64(2) + _ODD
PLACE_FACTORS = _RANDOM.integers(0, 1 << 63, VALUES, np.uint64) * np.uint64(2) + _ODD
PLACE_SALTS = _RANDOM.integers(0, 1 << 63, VALUES, np.uint64)
CHUNK_OF = np.arange(VALUES) * CHUNKS // VALUES
CHUNK_STARTS = np.searchsorted(CHUNK_OF, np.arange(CHUNKS))


def chunks_for(similarity: int) -> int:
    """The number of chunks that finds pairs of the similarity."""
    return CHUNKS if similarity >= SIMILARITY else MORE_CHUNKS


class _Words(dict):
    """Hashes of words seen lately; forgetting them costs only time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_WORDS = _Words()


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text of fewer than five
    words has its whole sequence as its only shingle, one without words has none.
    """
    words = text.encode().lower().split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    if n < SHINGLE_WORDS:
        whole = (hashes * WORD_FACTORS[:n]).sum(dtype=np.uint64) + np.uint64(n)
        return _mixed(np.array([whole], np.uint64))
    sums = hashes[: n - SHINGLE_WORDS + 1] * WORD_FACTORS[0]
    for k in range(1, SHINGLE_WORDS):
        sums += hashes[k : n - SHINGLE_WORDS + 1 + k] * WORD_FACTORS[k]
    return np.unique(_mixed(sums))


def signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row of 16-bit values for each (non-empty) set."""
    joined = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((len(sets), VALUES), np.uint16)
    for k in range(VALUES):
        least = np.minimum.reduceat(joined * PERMUTATIONS[k], starts)
        out[:, k] = (_mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def bitmap_of(hashes: np.ndarray) -> np.ndarray:
    """A set as bits, one for each hash modulo ``BITMAP_BITS``, as 64-bit words."""
    bits = np.zeros(BITMAP_BITS, bool)
    bits[(hashes % np.uint64(BITMAP_BITS)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def may_link(n_a, n_b, bits_a: np.ndarray, bits_b: np.ndarray, similarity: int) -> np.ndarray:
    """Whether sets of sizes ``n_a``, ``n_b`` can have the similarity, by row of their bitmaps.

    Every common element sets a common bit, but for those that share a bit within one set: these
    are its size less its bits. So the intersection has at most as many elements as there are
    common bits and such doubles.
    """
    common = np.bitwise_count(bits_a & bits_b).sum(axis=-1).astype(np.int64)
    most = np.minimum(
        n_a - np.bitwise_count(bits_a).sum(axis=-1), n_b - np.bitwise_count(bits_b).sum(axis=-1)
    )
    most = np.minimum(common + most, np.minimum(n_a, n_b))
    return 100 * most >= similarity * (n_a + n_b - most)


def chunk_keys(signatures: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """The keys of each signature: per chunk and place in it, a hash of the chunk's other values."""
    terms = _mixed(signatures.astype(np.uint64) + PLACE_SALTS) * PLACE_FACTORS
    chunk_of = np.arange(VALUES) * chunks // VALUES
    totals = np.add.reduceat(terms, np.searchsorted(chunk_of, np.arange(chunks)), axis=1)
    return _mixed(totals[:, chunk_of] - terms + PLACE_SALTS).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_hash, signature, bitmap) of every row; null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingle_set(text) for text in part["text"].to_pylist()]
                full = [s for s in sets if len(s)]
                rows = iter(signatures_of(full)) if full else iter(())
                found = [next(rows).tobytes() if len(s) else None for s in sets]
                bits = [bitmap_of(s).tobytes() if len(s) else None for s in sets]
                digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digest, pa.binary()),
                        pa.array(found, pa.binary()),
                        pa.array(bits, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_hash", "signature", "bitmap"],
                )
        _WORDS.clear()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_shingles long, set_hash binary, signature binary, bitmap binary"
    )


def _keys(classes: DataFrame, chunks: int) -> DataFrame:
    """(key, rep) for every key of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                rows = _matrix(part["signature"])
                keys = chunk_keys(rows, chunks).reshape(-1)
                reps = np.repeat(part["rep"].to_numpy(), VALUES)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(reps)], ["key", "rep"])

    return classes.select("rep", "signature").mapInArrow(run, "key long, rep long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


def _bitmaps(column: pa.Array) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint64)
    return data.reshape(-1, BITMAP_BITS // 64)


def _near(pairs: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) that are near by signature and whose bitmaps allow the similarity."""
    max_distance = 2 * chunks_for(similarity) - 1

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("rep").alias(name),
            F.col("n_shingles").alias(f"n_{name}"),
            F.col("signature").alias(f"s_{name}"),
            F.col("bitmap").alias(f"m_{name}"),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            distance = (_matrix(batch["s_a"]) != _matrix(batch["s_b"])).sum(axis=1)
            fits = may_link(
                batch["n_a"].to_numpy(),
                batch["n_b"].to_numpy(),
                _bitmaps(batch["m_a"]),
                _bitmaps(batch["m_b"]),
                similarity,
            )
            found = batch.filter(pa.array((distance <= max_distance) & fits))
            yield found.select(["a", "b"])

    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(small * 100 >= large * similarity)
        .mapInArrow(run, "a long, b long")
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sets of the side that repeats, a few at a time; an id may have several texts.
        seen: dict[tuple[int, bytes], np.ndarray] = {}

        def known(rep: int, text: str) -> np.ndarray:
            at = rep, xxhash.xxh3_128_digest(text.encode())
            if at not in seen:
                if len(seen) >= 64:
                    seen.clear()
                seen[at] = shingle_set(text)
            return seen[at]

        for batch in batches:
            for part in slices(batch, "t_b", 128):
                keep = []
                for a, b, text_a, text_b in zip(
                    *(part[name].to_pylist() for name in ("a", "b", "t_a", "t_b"))
                ):
                    x, y = known(a, text_a), shingle_set(text_b)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= similarity * (len(x) + len(y) - common))
                yield part.filter(pa.array(keep, pa.bool_())).select(["a", "b"])
        _WORDS.clear()

    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("t_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("t_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "t_a", "t_b").mapInArrow(
        run, "a long, b long"
    )


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with the label of ``column``; a class without links is its own label."""
    to = labels.select(F.col("node").alias(column), F.col("component").alias(name))
    return rows.join(to, column, "left").withColumn(name, F.coalesce(name, column))


def _cross_pairs(members: DataFrame, similarity: int) -> DataFrame:
    """Near pairs (a, b) with different labels within each key.

    ``members`` is (key, size, rep, label, n_shingles, signature, bitmap). A key of ``size`` members
    is compared in blocks of at most ``BLOCK`` a side, so a hot key becomes many groups. Only pairs
    within the distance whose bitmaps allow the similarity leave a block, and only from the first
    key they share, so that no pair is given twice.
    """
    chunks = chunks_for(similarity)
    split = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    dealt = (
        members.withColumn("own", F.pmod(F.xxhash64("rep"), split).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), split - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
    )

    def run(key, block):
        low, high = key[1].as_py(), key[2].as_py()
        rows, bits = _matrix(block["signature"]), _bitmaps(block["bitmap"])
        sizes = block["n_shingles"].to_numpy()
        own = block["own"].to_numpy()
        reps, labels = block["rep"].to_numpy(), block["label"].to_numpy()
        keys = chunk_keys(rows, chunks)
        this = np.int64(key[0].as_py())
        first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
        found_a, found_b = [], []
        for i in first:
            rest = second[(reps[second] > reps[i]) if low == high else slice(None)]
            rest = rest[labels[rest] != labels[i]]
            near = rest[(rows[rest] != rows[i]).sum(axis=1) <= 2 * chunks - 1]
            near = near[may_link(sizes[near], sizes[i], bits[near], bits[i], similarity)]
            if not len(near):
                continue
            at = (keys[near] == keys[i]).argmax(axis=1)
            near = near[keys[i][at] == this]
            found_a.append(np.minimum(reps[near], reps[i]))
            found_b.append(np.maximum(reps[near], reps[i]))
        empty = [np.empty(0, np.int64)]
        return pa.table(
            {"a": np.concatenate(found_a or empty), "b": np.concatenate(found_b or empty)}
        )

    return dealt.groupBy("key", "low", "high").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents whose sets have ``similarity`` per cent (80 or more, the signature distance is meant
    for that) of their union in common are linked, and a component is named by its smallest doc_id.
    Which links exist decides, not how many, so comparisons are saved where the answer is known:

    * first, each class is compared with the smallest class of the key group it shares most keys
      with; most copies are linked by that;
    * then with the smallest class of its other key groups, unless already connected;
    * last, in key groups that still hold several components beside their smallest class, all near
      pairs between components are compared, in blocks.

    After that, any pair within the signature distance has been compared or is connected. Null
    texts count as empty; empty sets are linked with nothing. Rows without doc_id are linked with
    nothing and have no component (kept). Rows that repeat an id share its component. Extra columns
    are ignored; an empty table gives no rows.
    """
    if similarity < LEAST_SIMILARITY:
        raise ValueError(f"the signature distance is meant for {LEAST_SIMILARITY} per cent or more")
    read = staged(signatures(docs), "signatures")
    known = read.where("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    # A set's smallest document stands for it; a repeated id stands for its smallest set.
    sets = known.groupBy("set_hash").agg(
        F.min("doc_id").alias("rep"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
        F.first("bitmap").alias("bitmap"),
    )
    classes = staged(sets, "classes")
    keys = _keys(classes, chunks_for(similarity))
    hubs = staged(
        keys.groupBy("key")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
        .where("hub <> last"),
        "hubs",
    )
    # All members of shared keys but the smallest.
    members = staged(keys.join(hubs.select("key", "hub"), "key").where("rep <> hub"), "members")
    stars = staged(
        members.groupBy(F.col("hub").alias("a"), F.col("rep").alias("b")).agg(
            F.count("*").alias("shared")
        ),
        "stars",
    )
    near = staged(
        _near(stars.select("a", "b"), classes, similarity).distinct().join(stars, ["a", "b"]),
        "near",
    )
    texts = _texts(docs, near.select(F.col("a").alias("rep")).union(near.select("b")))

    best = near.groupBy("b").agg(F.max(F.struct("shared", (-F.col("a")).alias("a"))).alias("best"))
    first = best.select((-F.col("best.a")).alias("a"), "b")
    links = [staged(_confirmed(first, texts, similarity), "links")]
    labels = components(links[0])

    rest = near.select("a", "b").join(first, ["a", "b"], "left_anti")
    rest = _labelled(_labelled(rest, labels, "a", "label_a"), labels, "b", "label_b")
    rest = rest.where("label_a <> label_b").select("a", "b")
    links.append(staged(_confirmed(rest, texts, similarity), "links"))
    labels = components(links[0].union(links[1]))

    cross = staged(_open_pairs(members, labels, classes, similarity), "cross")
    if not cross.isEmpty():
        texts = _texts(docs, cross.select(F.col("a").alias("rep")).union(cross.select("b")))
        links.append(staged(_confirmed(cross, texts, similarity), "links"))

    # A repeated id with several sets connects their classes.
    of_set = classes.select("set_hash", "rep")
    again = known.groupBy("doc_id").count().where("count > 1").select("doc_id")
    joined = known.join(again, "doc_id").join(of_set, "set_hash")
    edges = joined.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    for found in links:
        edges = edges.unionByName(found)
    labels = components(edges)
    component = staged(
        _labelled(classes.select("set_hash", "rep"), labels, "rep", "component").select(
            "set_hash", "component"
        ),
        "components",
    )
    return (
        read.select("doc_id", "n_shingles", "set_hash")
        .join(component, "set_hash", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias(
                "component_id"
            ),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _texts(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, text) of the classes to compare, written once.

    Most texts have no candidate. A filter of ``FILTER_BITS`` bits, so of bounded size, keeps them
    from being shuffled: it passes all classes asked for and some others, which the join drops.
    """
    reps = staged(reps.distinct(), "asked")
    place = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS))
    word = F.floor(place / 64)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = reps.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), text_or_empty().alias("text"))
    likely = (
        rows.withColumn("_word", word)
        .join(F.broadcast(words), "_word")  # FILTER_BITS / 64 rows at most
        .where(F.col("_bits").bitwiseAND(bit) != 0)
        .select("rep", "text")
    )
    return staged(likely.join(reps, "rep", "left_semi"), "texts")


def _open_pairs(
    members: DataFrame, labels: DataFrame, classes: DataFrame, similarity: int
) -> DataFrame:
    """Near pairs of different components within the keys that hold several (without the hub)."""
    labelled = staged(_labelled(members.select("key", "rep"), labels, "rep", "label"), "labelled")
    open_keys = (
        labelled.groupBy("key")
        .agg(
            F.min("label").alias("first"), F.max("label").alias("last"), F.count("*").alias("size")
        )
        .where("first <> last")
        .select("key", "size")
    )
    rows = labelled.join(open_keys, "key").join(
        classes.select("rep", "n_shingles", "signature", "bitmap"), "rep"
    )
    return _cross_pairs(rows, similarity).distinct()
