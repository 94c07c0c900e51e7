"""Language identification by Bayesian fusion of evidence.

The posterior of a language is the product of

* the likelihood of the whole text: byte trigrams under a naive Bayes model, tempered as trigrams
  overlap and follow each other; the temper is the one of ``TEMPERS`` that predicts the labels of
  held-out texts best;
* the likelihood of the declared language (markup or metadata), from the counts of declarations
  among the texts that read like each language;
* the prior of the host, smoothed by its domain, that by the address suffix, and that by all rows.
  Counts are grouped aggregates over all rows; a row's own vote is taken out of its host's.

The trigram model is fitted to a sample of labelled documents, about ``SAMPLE_ROWS`` a language,
chosen by the hash of the id; all other counts are over all rows. Every language that a row is
labelled with is modelled, under its primary tag (``en`` for ``en-US`` and ``EN``). The model is
sparse: it holds the buckets that a language's texts have, and all others share one probability, so
a text costs the languages that share its trigrams and not all of them. Many languages share fewer
buckets, so that the model stays below ``CELLS`` numbers.

A text's row carries the languages that the other evidence could still make the best, usually one or
two, and their priors and declarations are joined for the pairs that occur.

A text without letters is rejected, and one whose trigrams are, on average, less likely than the bar
of every language. Bars are calibrated on held-out texts: the sample is halved by the hash of the
text, and each half is judged by the model of the other. The bar of a language lies between the low
end of its own texts and the level that texts of other languages reach where theirs is not modelled.
Unseen trigrams have a fixed share of the probability, whatever the size of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.bpe import slices
from sluice.llm.common import staged, text_or_empty
from sluice.llm.url_filters import host_of

BUCKETS = 1 << 16
SAMPLE_ROWS = 4000  # labelled documents a language, about
CELLS = 1 << 23  # buckets times languages of a model
MIN_BUCKETS = 1 << 8
SMOOTHING = 0.5  # of counts of declarations
UNSEEN = 0.2  # share of the probability that is spread evenly over all buckets
OWN_LEVEL = 0.01  # quantile of a language's held-out texts
FOREIGN_LEVEL = 0.95  # quantile of texts whose language is not modelled
BAR_PLACE = 0.75  # of the way from the first to the second
FOREIGN_ROWS = 20  # below as many, a language takes the foreign level of all
PRIOR_WEIGHT = 10.0  # rows that a parent's prior counts for
TEMPERS = (1 / 3, 0.25, 0.2, 0.15, 0.1)
MARGIN = 16.0  # candidates less likely by so much (natural logarithm) than any evidence can mend go
UNKNOWN = "und"


@dataclass(frozen=True)
class Gains:
    """What buckets add to the log probabilities of languages, beside that of an unseen bucket.

    The languages that have bucket b, and their gains, are at ``starts[b]`` to ``starts[b + 1]``.
    """

    starts: np.ndarray
    langs: np.ndarray
    gains: np.ndarray
    unseen: float
    size: int

    @staticmethod
    def of(lang: np.ndarray, bucket: np.ndarray, n: np.ndarray, buckets: int, size: int) -> Gains:
        """From counts of (language, bucket); the cost of an unseen bucket does not depend on them."""
        order = np.lexsort((lang, bucket))
        lang, bucket, n = lang[order], bucket[order], n[order]
        share = n / np.bincount(lang, n, size)[lang]
        unseen = np.log(UNSEEN / buckets)
        gains = np.log((1 - UNSEEN) * share + UNSEEN / buckets) - unseen
        starts = np.searchsorted(bucket, np.arange(buckets + 1))
        return Gains(starts, lang.astype(np.int32), gains.astype(np.float32), unseen, size)

    def totals(self, found: np.ndarray) -> np.ndarray:
        """The sum of the log probabilities of the buckets found, for each language."""
        buckets, counts = np.unique(found, return_counts=True)
        begin = self.starts[buckets]
        sizes = self.starts[buckets + 1] - begin
        ends = np.cumsum(sizes)
        places = np.repeat(begin - (ends - sizes), sizes) + np.arange(sizes.sum())
        gains = self.gains[places] * np.repeat(counts, sizes)
        return np.bincount(self.langs[places], gains, self.size) + len(found) * self.unseen


@dataclass(frozen=True)
class TextModel:
    """Gains of trigram buckets by language, and the bars that mean log probabilities must reach.

    There are 2^-``shift`` times ``BUCKETS`` buckets: a trigram's bucket is its number without as
    many bits.
    """

    languages: tuple[str, ...]
    gains: Gains | None = None
    bars: np.ndarray | None = None
    temper: float = TEMPERS[0]
    shift: int = 0


def trigrams(text: str) -> np.ndarray:
    """Buckets of all byte trigrams of the text in lower case, its ends marked by spaces.

    Runs of ASCII digits and punctuation count as a space, so they are evidence for no language.
    """
    data = (" " + text.lower() + " ").encode()
    letters = np.frombuffer(data.translate(_FOLD), np.uint8).astype(np.uint32)
    letters = letters[~((letters == 32) & (np.concatenate([[0], letters[:-1]]) == 32))]
    if len(letters) < 3:
        return np.empty(0, np.int64)
    mixed = letters[:-2] * 0x9E3779B1 + letters[1:-1] * 0x85EBCA77 + letters[2:] * 0xC2B2AE3D
    return (mixed.astype(np.uint32) * np.uint32(0x27D4EB2F) >> np.uint32(16)).astype(np.int64)


_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def primary_tag(label: Column) -> Column:
    """What a label says before ``-`` or ``_``, in lower case; null for none and for ``und``."""
    tag = F.lower(F.trim(F.regexp_extract(label, r"^[^-_]*", 0)))
    return F.when((tag != "") & (tag != UNKNOWN), tag)


def shift_for(languages: int) -> int:
    """The bits that bucket numbers lose, so that a model of so many languages has ``CELLS``."""
    shift = 0
    while BUCKETS >> shift > MIN_BUCKETS and (BUCKETS >> shift) * languages > CELLS:
        shift += 1
    return shift


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> TextModel:
    """The text model of ``labelled`` (doc_id, text, lang); rows without a language are left out.

    What comes to the driver is bounded: a count per language, two per bucket and language, and a
    few quantiles per language.
    """
    tagged = labelled.select("doc_id", text_or_empty().alias("text"), primary_tag("lang").alias("tag"))
    tagged = tagged.where("tag IS NOT NULL")
    counts = {row["tag"]: row["count"] for row in tagged.groupBy("tag").count().collect()}
    languages = tuple(sorted(counts))
    size = len(languages)
    if not size:
        return TextModel(())
    shift = shift_for(size)
    buckets = BUCKETS >> shift
    known = labelled.sparkSession.createDataFrame(
        [(tag, k, min(1.0, sample_rows / counts[tag])) for k, tag in enumerate(languages)],
        "tag string, lang int, share double",
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 20)) / float(1 << 20)
    # Equal texts are in one half, so that no half holds copies of the other's.
    half = F.pmod(F.xxhash64("text", F.lit("language half")), F.lit(2)).cast("int")
    sample = tagged.join(F.broadcast(known), "tag").where(draw < F.col("share"))
    sample = sample.select("lang", "text", half.alias("half"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [trigrams(text) >> shift for text in part["text"].to_pylist()]
                kind = part["lang"].to_numpy().astype(np.int64) * 2 + part["half"].to_numpy()
                kinds = np.repeat(kind, [len(f) for f in found])
                cells, n = np.unique(
                    kinds * buckets + np.concatenate([np.empty(0, np.int64), *found]),
                    return_counts=True,
                )
                kinds, bucket = np.divmod(cells, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kinds % 2, pa.int32()),
                        pa.array(kinds // 2, pa.int32()),
                        pa.array(bucket, pa.int32()),
                        pa.array(n, pa.int64()),
                    ],
                    ["half", "lang", "bucket", "n"],
                )

    found = sample.mapInArrow(count, "half int, lang int, bucket int, n long")
    cells = found.groupBy("half", "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    half, lang, bucket, n = (cells[c].to_numpy() for c in ("half", "lang", "bucket", "n"))
    # The model that judges a half is made of the other.
    halves = [
        Gains.of(lang[half != k], bucket[half != k], n[half != k], buckets, size) for k in (0, 1)
    ]
    cell, place = np.unique(lang.astype(np.int64) * buckets + bucket, return_inverse=True)
    gains = Gains.of(cell // buckets, cell % buckets, np.bincount(place, n), buckets, size)
    bars, temper = _calibrated(_judged(sample, halves, shift), buckets, size)
    return TextModel(languages, gains, bars, temper, shift)


def _judged(sample: DataFrame, halves: list[Gains], shift: int) -> DataFrame:
    """Of every held-out text of the sample (lang, text, half): its language, the mean it has there,
    the best other language (null for none) and the mean there, and the loss under each temper.
    """
    sent = sample.sparkSession.sparkContext.broadcast(halves)
    tempers = np.array(TEMPERS)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                columns = (part[name].to_pylist() for name in ("half", "lang", "text"))
                for half, k, text in zip(*columns):
                    found = trigrams(text) >> shift
                    if not len(found):
                        continue
                    totals = sent.value[half].totals(found)
                    # Minus the log of the posterior of the label.
                    weights = np.exp(np.multiply.outer(tempers, totals - totals.max()))
                    loss = np.log(weights.sum(axis=1)) - tempers * (totals[k] - totals.max())
                    own, totals[k] = totals[k], -np.inf
                    other = int(totals.argmax())
                    foreign = totals[other] / len(found) if other != k else None
                    rows.append((k, own / len(found), None if other == k else other, foreign, loss))
                kinds = pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.list_(pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                    ["lang", "own", "other", "foreign", "loss"],
                )

    return sample.mapInArrow(
        judge, "lang int, own double, other int, foreign double, loss array<double>"
    )


def _calibrated(judged: DataFrame, buckets: int, size: int) -> tuple[np.ndarray, float]:
    """The bar of each language and the temper, from held-out texts.

    A bar lies between the low end of the language's own texts and the level that others reach in
    it. Without foreign texts, evenly spread trigrams stand for them. A language without held-out
    texts has the foreign level as its bar, and one that others read like keeps its own level.
    """
    judged = staged(judged, "held-out")

    def level(name: str, q: float) -> Column:
        return F.percentile_approx(name, q, 10_000)

    losses = [F.sum(F.col("loss")[k]).alias(f"loss{k}") for k in range(len(TEMPERS))]
    every = judged.agg(level("foreign", FOREIGN_LEVEL).alias("level"), *losses).first()
    of_all = -np.log(buckets) if every["level"] is None else every["level"]
    low, high = np.full(size, np.nan), np.full(size, of_all)
    for row in judged.groupBy("lang").agg(level("own", OWN_LEVEL).alias("level")).collect():
        low[row["lang"]] = row["level"]
    foreign = judged.where("other IS NOT NULL").groupBy("other")
    foreign = foreign.agg(level("foreign", FOREIGN_LEVEL).alias("level"), F.count("*").alias("n"))
    for row in foreign.where(F.col("n") >= FOREIGN_ROWS).collect():
        high[row["other"]] = row["level"]
    low = np.where(np.isnan(low), high, low)
    found = [every[f"loss{k}"] for k in range(len(TEMPERS))]
    temper = TEMPERS[0] if None in found else TEMPERS[int(np.argmin(found))]
    return np.minimum(low, low + BAR_PLACE * (high - low)), temper


def _with_candidates(
    rows: DataFrame, model: TextModel, keep: Sequence[str], reach: float
) -> DataFrame:
    """``keep`` of every row, ``candidates`` (lang, like), and ``guess``.

    The guess is the likeliest language whose bar the text reaches, null for none; only texts that
    have one have candidates. These are the languages whose tempered log likelihood, here given less
    that of the best, is within ``reach`` of it.
    """
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = pa.array(model.languages, pa.string())
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part["text"].to_pylist()
                guesses = [None] * len(texts)
                places, likes = [np.empty(0, np.int64)] * len(texts), [np.empty(0)] * len(texts)
                for row, text in enumerate(texts):
                    found = trigrams(text) >> model.shift
                    if not len(found):
                        continue
                    totals = model.gains.totals(found)
                    fits = totals / len(found) >= model.bars
                    if not fits.any():
                        continue
                    guesses[row] = model.languages[int(np.where(fits, totals, -np.inf).argmax())]
                    less = (totals - totals.max()) * model.temper
                    places[row] = np.flatnonzero(less >= -reach)
                    likes[row] = less[places[row]]
                ends = np.cumsum([0, *map(len, places)])
                pairs = pa.StructArray.from_arrays(
                    [names.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(likes))],
                    ["lang", "like"],
                )
                candidates = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays(
                    [part[name] for name in keep] + [pa.array(guesses, pa.string()), candidates],
                    [*keep, "guess", "candidates"],
                )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema]
    return rows.select(*keep, "text").mapInArrow(
        run, ", ".join([*kinds, "guess string", "candidates array<struct<lang: string, like: double>>"])
    )


def _joined(rows: DataFrame, votes: DataFrame, names: Sequence[str], column: str) -> DataFrame:
    """``rows`` with a column of ``votes``, joined by ``names``, in which nulls are equal; 0 for none."""
    right = votes.select(F.struct(*names).alias("_key"), column)
    # A struct of nulls is not null, so it joins.
    found = rows.withColumn("_key", F.struct(*names)).join(right, "_key", "left").drop("_key")
    return found.withColumn(column, F.coalesce(column, F.lit(0).cast("long")))


def _priors(pairs: DataFrame, finest: DataFrame, levels: Sequence[str], size: int) -> DataFrame:
    """``pairs`` (levels, lang) with the votes ``n`` at the finest level and the prior ``parent``
    above it, from the votes (levels, lang, count)."""
    votes = finest.groupBy("lang").agg(F.sum("count").alias("n"))
    total = finest.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    pairs = _joined(pairs, votes, ["lang"], "n")
    pairs = pairs.withColumn("parent", (F.col("n") + 1) / F.lit(float(total + size))).drop("n")
    for depth in range(1, len(levels) + 1):
        part = list(levels[:depth])
        votes = finest.groupBy(*part, "lang").agg(F.sum("count").alias("n"))
        pairs = _joined(pairs, votes, [*part, "lang"], "n")
        if depth == len(levels):
            return pairs
        sums = finest.groupBy(*part).agg(F.sum("count").alias("_count"))
        pairs = _joined(pairs, sums, part, "_count")
        prior = (F.col("n") + PRIOR_WEIGHT * F.col("parent")) / (F.col("_count") + PRIOR_WEIGHT)
        pairs = staged(pairs.withColumn("parent", prior).drop("n", "_count"), "priors")
    return pairs


def identify(rows: DataFrame, model: TextModel, levels: Sequence[str]) -> DataFrame:
    """Columns of ``rows`` but text, with lang, posterior, text_lang and accepted.

    ``rows`` has text (not null), declared, an id, and ``levels``, coarse to fine (such as suffix,
    domain, host), each a part of the one before. A null level or declaration is no evidence of its
    own: it is a group of its own among its siblings, and an undeclared row has no such factor.
    Rows whose text reaches no bar are rejected and have lang ``und``; the posterior of the others
    says how sure the verdict is. Repeated rows are judged alike; an empty table gives no rows.
    """
    size = len(model.languages)
    keep = [name for name in rows.columns if name != "text"]
    if not size:
        return rows.select(
            *keep,
            F.lit(UNKNOWN).alias("lang"),
            F.lit(0.0).alias("posterior"),
            F.lit(None).cast("string").alias("text_lang"),
            F.lit(False).alias("accepted"),
        )
    n = rows.count()
    # The most that declarations and priors can differ by between two languages.
    reach = MARGIN + np.log(3 * n + 2) + np.log((n + PRIOR_WEIGHT) * (n + size) / PRIOR_WEIGHT)
    reach += (len(levels) - 1) * np.log((n + PRIOR_WEIGHT) / PRIOR_WEIGHT)
    read = staged(_with_candidates(rows, model, keep, float(reach)), "likelihoods")
    candidates = F.explode("candidates.lang").alias("lang")

    # What is declared, for the languages that texts read like.
    guessed = read.where("guess IS NOT NULL").withColumnRenamed("guess", "lang")
    votes = guessed.where("declared IS NOT NULL").groupBy("declared", "lang").count()
    votes = staged(votes, "declared")
    kinds = read.where("declared IS NOT NULL").select("declared").distinct().count()
    totals = votes.groupBy("lang").agg(F.sum("count").alias("total"))
    pairs = read.where("declared IS NOT NULL").select("declared", candidates).distinct()
    pairs = _joined(_joined(pairs, votes, ["declared", "lang"], "count"), totals, ["lang"], "total")
    share = (F.col("count") + SMOOTHING) / (F.col("total") + SMOOTHING * (kinds + 1))
    said = pairs.select(
        F.struct("declared", "lang").alias("_said"), F.log(share).alias("_said_log")
    )

    finest = staged(guessed.groupBy(*levels, "lang").count(), "votes")
    pairs = staged(read.select(*levels, candidates).distinct(), "pairs")
    priors = _priors(pairs, finest, levels, size)

    host = [*levels, "lang"]
    right = priors.select(F.struct(*host).alias("_host"), "n", "parent")
    read = read.withColumn("_id", F.monotonically_increasing_id())
    each = read.withColumn("_candidate", F.explode_outer("candidates")).select(
        "_id",
        F.struct(*keep, "guess").alias("_row"),
        F.struct(*levels, F.col("_candidate.lang").alias("lang")).alias("_host"),
        F.struct("declared", F.col("_candidate.lang").alias("lang")).alias("_said"),
        F.col("_candidate.like").alias("like"),
    )
    lang = F.col("_host.lang")
    own = (F.col("_row.guess") == lang).cast("long")
    prior = F.log(F.col("n") - own + PRIOR_WEIGHT * F.col("parent"))
    evidence = F.col("like") + F.coalesce("_said_log", F.lit(0.0)) + prior
    # Likelihoods are less the best one's, so that no exponential leaves the range of doubles.
    judged = (
        each.join(right, "_host", "left")
        .join(said, "_said", "left")
        .select("_id", "_row", evidence.alias("_evidence"), lang.alias("_lang"))
        .groupBy("_id")
        .agg(
            F.first("_row").alias("_row"),
            F.min(F.struct(-F.col("_evidence"), "_lang")).alias("_best"),
            (F.max(F.exp("_evidence")) / F.sum(F.exp("_evidence"))).alias("_posterior"),
        )
    )
    readable = F.col("_row.guess").isNotNull()
    return judged.select(
        *[F.col(f"_row.{name}").alias(name) for name in keep],
        F.when(readable, F.col("_best._lang")).otherwise(UNKNOWN).alias("lang"),
        F.when(readable, F.col("_posterior")).otherwise(0.0).alias("posterior"),
        F.col("_row.guess").alias("text_lang"),
        readable.alias("accepted"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents as rows to identify: the source is the host, ``lang`` what is declared."""
    return docs.select(
        "doc_id", text_or_empty().alias("text"), F.col("lang").alias("declared"), "source"
    )


def identify_documents(docs: DataFrame, model: TextModel | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, declared, source, lang, posterior, text_lang, accepted.

    Null texts count as empty and are rejected. Extra columns are ignored.
    """
    return identify(document_evidence(docs), model or train(docs), ["source"])


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages as rows to identify: declared is the primary tag of ``<html lang>``.

    The suffix is the last label of the host, the domain its last two. Texts are the html without
    scripts, styles, comments, tags and entities.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    tag = F.lower(
        F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", 1)
    )
    text = F.regexp_replace(
        html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>|&#?\w+;", " "
    )
    host = F.regexp_replace(host_of(F.col("url")), r":\d*$", "")
    return pages.select(
        "page_id",
        text.alias("text"),
        F.when(tag != "", tag).alias("declared"),
        F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"),
        F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1).alias("domain"),
        host.alias("host"),
    )


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """One row per row of ``pages``: page_id, declared, suffix, domain, host and the verdict.

    Null html counts as empty and is rejected; pages without an address share one host, the empty
    one. Repeated rows are judged alike, extra columns are ignored, an empty table gives no rows.
    """
    return identify(page_evidence(pages), model, ["suffix", "domain", "host"])
