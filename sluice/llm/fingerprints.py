"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every unit of a text (a line, split further at sentence ends, as many texts have one line only) is
hashed to a wide vector, and the vectors of all units are added. Two kinds of lanes make the vector:

* 8 lanes of 32 bits, the halves of four 64-bit hashes, added modulo 2^32: equal multisets of units
  have equal sums whatever their order, and others differ but for chance (256 bits);
* 128 lanes of +1 or -1, the bits of two more 64-bit hashes, added modulo 2^32: their scalar
  products estimate how many units two texts share.

Every hash reads the unit anew from a seed of its own, so units that collide in one do not in others.

Sums can be updated: the fingerprint of a text with units inserted or deleted is that of the text
plus or minus theirs (``combine``). All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import text_or_empty

UNIT_END = r"(?<=[.!?])\s+|[\r\n]+"
HASHES = 4
SIGN_HASHES = 2
LOW_32 = 0xFFFFFFFF
LANE_PAIR = 0x0000000100000001  # bits i and i + 32 of a hash, as two 32-bit counters
SIGN_HASH = HASHES  # the seed of the first hash of the signs
BLOCK_DOCS = 4096
MARKS = 64  # ids for each block, of which every so many begins one
MOST_MARKS = 1 << 18


def units(text: Column) -> Column:
    """The non-empty units of a text, trimmed."""
    parts = F.transform(F.split(text, UNIT_END), lambda u: F.trim(u))
    return F.filter(parts, lambda u: u != "")


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, not at each of its uses."""
    return F.transform(F.array(value), body)[0]


def _total(hashes: Column, term) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, h: total + term(h))


def lanes(text: Column) -> Column:
    """The vector of a text: (eq: 8 sums mod 2^32, sign: 128 sums in -2^31 .. 2^31 - 1).

    The unit counts stay below 2^31, as texts do.
    """

    def hashes(parts: Column, k: int) -> Column:
        return F.transform(parts, lambda u: F.xxhash64(F.lit(k), u))

    def halves(hs: Column) -> list[Column]:
        low = _total(hs, lambda h: h.bitwiseAND(F.lit(LOW_32)))
        high = _total(hs, lambda h: F.shiftrightunsigned(h, 32))
        return [low.bitwiseAND(F.lit(LOW_32)), high.bitwiseAND(F.lit(LOW_32))]

    def signs(hs: Column) -> Column:
        """64 sums of +1 and -1 from one hash, two counters added at a time."""
        count = F.size(hs).cast("long")

        def pair(i: Column) -> Column:
            ones = _total(
                hs,
                lambda h: F.call_function("shiftrightunsigned", h, i).bitwiseAND(F.lit(LANE_PAIR)),
            )
            return _bind(
                ones,
                lambda s: F.array(
                    s.bitwiseAND(F.lit(LOW_32)) * 2 - count, F.shiftrightunsigned(s, 32) * 2 - count
                ),
            )

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(31)), pair))

    def vector(all_hashes: Column) -> Column:
        equal = F.concat(*[F.array(*halves(all_hashes[k])) for k in range(HASHES)])
        sign = F.concat(*[signs(all_hashes[SIGN_HASH + k]) for k in range(SIGN_HASHES)])
        return F.struct(equal.alias("eq"), F.transform(sign, _wrap).alias("sign"))

    return _bind(
        units(text),
        lambda parts: _bind(
            F.array(*[hashes(parts, k) for k in range(HASHES + SIGN_HASHES)]), vector
        ),
    )


def _wrap(value: Column) -> Column:
    """The representative of a sum modulo 2^32 that is nearest to 0."""
    return F.pmod(value + (1 << 31), F.lit(1 << 32).cast("long")) - (1 << 31)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector of the units of ``a`` with those of ``b`` inserted (1) or deleted (-1)."""
    return F.struct(
        F.zip_with(
            a["eq"], b["eq"], lambda x, y: F.pmod(x + y * sign, F.lit(1 << 32).cast("long"))
        ).alias("eq"),
        F.zip_with(a["sign"], b["sign"], lambda x, y: _wrap(x + y * sign)).alias("sign"),
    )


def fingerprint(vector: Column) -> Column:
    """The vector as text: 8 hex digits for each lane."""

    def digits(value: Column) -> Column:
        return F.lpad(F.lower(F.hex(value)), 8, "0")

    equal = F.transform(vector["eq"], digits)
    sign = F.transform(vector["sign"], lambda v: digits(F.pmod(v, F.lit(1 << 32).cast("long"))))
    return F.concat(F.array_join(equal, ""), F.array_join(sign, ""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the estimated share of units in common, in [0, 1].

    Twice the scalar product over the sum of the squared lengths, which for sets of units estimates
    the Dice coefficient with an error of some 1/sqrt(128).
    """

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(
            F.zip_with(x, y, lambda u, v: u.cast("double") * v), F.lit(0.0), lambda t, v: t + v
        )

    length = dot(a["sign"], a["sign"]) + dot(b["sign"], b["sign"])
    share = F.when(length > 0, 2.0 * dot(a["sign"], b["sign"]) / length).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, vector, fingerprint) of every row; null texts count as empty."""
    vector = lanes(text_or_empty())
    return docs.select("doc_id", vector.alias("vector")).withColumn(
        "fingerprint", fingerprint(F.col("vector"))
    )


def with_next(docs: DataFrame, columns: list[Column], block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``columns`` of every row, as structs ``here`` and ``next`` (that of the next doc_id).

    The rows are dealt once to blocks of about ``block_docs`` ids. The ids that a hash marks, some
    ``MOST_MARKS`` at most, are sorted, and evenly spaced ones of them begin the blocks, which are
    found by bisection. The rows that begin a block are sent to the block before it as well; the
    first row of all goes also to the last block. Each row then finds its next one in its own block.
    Rows that repeat an id follow each other in any order; rows without id come last.
    """
    rows = docs.select("doc_id", *columns)
    n = docs.count()
    here = F.struct(*[F.col(c) for c in rows.columns]).alias("here")
    if n == 0:
        return rows.select(here, here.alias("next"))
    period = max(block_docs // MARKS, -(-n // MOST_MARKS), 1)
    first = docs.agg(F.min("doc_id")).first()[0]
    is_first = F.lit(False) if first is None else F.col("doc_id") == first
    marked = F.pmod(F.xxhash64(F.lit("block"), "doc_id"), F.lit(period)) == 0
    marked = F.coalesce(marked & ~is_first, F.lit(False))
    marks = docs.where(marked).agg(F.sort_array(F.collect_set("doc_id"))).first()[0]
    begins = marks[:: max(1, block_docs // period)]
    # As text they are one constant of the plan, however many.
    borders = F.split(F.lit(",".join(map(str, begins))), ",") if begins else F.array()
    borders = borders.cast("array<long>")
    last = F.lit(len(begins))

    # The block of an id is the number of borders up to it, found between ``low`` and ``high``.
    def step(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        above = F.col("doc_id") < F.get(borders, middle)
        return F.when(span["low"] >= span["high"], span).otherwise(
            F.struct(
                F.when(above, span["low"]).otherwise(middle + 1).alias("low"),
                F.when(above, middle).otherwise(span["high"]).alias("high"),
            )
        )

    steps = F.sequence(F.lit(1), F.lit(len(begins).bit_length() + 1))
    span = F.struct(F.lit(0).alias("low"), last.alias("high"))
    own = F.when(F.col("doc_id").isNull(), last).otherwise(F.aggregate(steps, span, step)["low"])

    def to(block: Column, after: int) -> Column:
        return F.struct(block.alias("block"), F.lit(after).alias("after"))

    dealt = (
        rows.select(here, "doc_id", is_first.alias("_first"))
        .withColumn("_own", own)
        .withColumn(
            "_begins",
            F.coalesce(
                F.col("_first") | (F.get(borders, F.col("_own") - 1) == F.col("doc_id")), F.lit(False)
            ),
        )
        .withColumn("_before", F.when(F.col("_first"), last).otherwise(F.col("_own") - 1))
        .withColumn(
            "_to",
            F.explode(
                F.when(
                    F.col("_begins"), F.array(to(F.col("_own"), 0), to(F.col("_before"), 1))
                ).otherwise(F.array(to(F.col("_own"), 0)))
            ),
        )
    )
    order = Window.partitionBy("_to.block").orderBy("_to.after", F.col("doc_id").asc_nulls_last())
    found = dealt.withColumn("next", F.lead("here").over(order)).where("_to.after = 0")
    # Only a table without any id has a row without a next one.
    return found.select("here", F.coalesce("next", "here").alias("next"))


def edited_text(text: Column, other: Column) -> Column:
    """The last floor(n / 2) code points replaced by the first as many (or all) of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(other, F.lit(1), half))


def edit_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` about its text, its edited text and the next document.

    Null texts count as empty; two empty texts are alike (1). Texts move once, with their vectors,
    to find their next one. Extra columns are ignored; an empty table gives no rows.
    """
    text = text_or_empty()
    pairs = with_next(docs, [text.alias("text"), lanes(text).alias("vector")])
    edited = pairs.withColumn("edited", edited_text(F.col("here.text"), F.col("next.text")))
    vectors = edited.withColumn("edited_vector", lanes(F.col("edited")))
    return vectors.select(
        F.col("here.doc_id").alias("doc_id"),
        F.char_length("here.text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("here.vector")).alias("fingerprint"),
        fingerprint(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("here.vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("here.vector"), F.col("next.vector")).alias("near_next"),
    )
