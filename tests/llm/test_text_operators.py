import collections
import hashlib
import math
import random
import zlib

import pytest

import corpus_pipeline
from sluice.llm import fingerprints, language_id, lm_scoring, mixing
from tests.llm.conftest import make_docs, words


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 10 == 0


def expected_base(rows):
    count = collections.Counter()
    for doc_id, text, *_ in rows:
        if not is_held_out(doc_id):
            count.update(tokens(text))
    n, v = sum(count.values()), len(count)
    found = []
    for doc_id, text, *_ in rows:
        own = tokens(text)
        base = sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        known = sum(count[t] > 0 for t in own)
        found.append((doc_id, is_held_out(doc_id), len(own), known, n, pytest.approx(base)))
    return sorted(found, key=lambda r: str(r[:5]))


def scored(docs, **settings):
    rows = lm_scoring.held_out_scores(docs, **settings).collect()
    return sorted(
        (
            (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
            for r in rows
        ),
        key=lambda r: str(r[:5]),
    )


def test_base_scores(docs, doc_rows, odd_docs, odd_rows):
    assert [r[:6] for r in scored(docs)] == expected_base(doc_rows)
    assert [r[:6] for r in scored(odd_docs)] == expected_base(odd_rows)


def test_both_ways_agree(docs, monkeypatch):
    """Many segments; broadcast, and lookups that travel."""
    monkeypatch.setattr(lm_scoring, "SEGMENT_BYTES", 1 << 16)
    monkeypatch.setattr(lm_scoring, "BATCH_BYTES", 1 << 17)
    sent, travelled = scored(docs), scored(docs, broadcast_bytes=0)
    assert [r[:5] for r in sent] == [r[:5] for r in travelled]
    assert [r[5:] for r in sent] == [pytest.approx(r[5:]) for r in travelled]


def test_rows_follow_the_distinct_keys(spark, monkeypatch):
    """Many segments and few keys: no rows of empty segments are sent, in either way."""
    monkeypatch.setattr(lm_scoring, "SEGMENT_BYTES", 8)
    monkeypatch.setattr(lm_scoring, "HELD_KEYS", 6)
    rows = [(k, "a b c " * 200, "", "") for k in range(60)]
    docs = make_docs(spark, rows)
    model = lm_scoring.train(docs)
    assert model.first().segments > 5000 and model.count() <= 9  # 4 words and 5 pairs
    assert model.agg({"tokens": "sum"}).first()[0] == 60 * 601
    travelled = lm_scoring.score(docs, model, broadcast_bytes=0)
    sent = lm_scoring.score(docs, model)
    assert {tuple(r) for r in travelled.collect()} == {tuple(r) for r in sent.collect()}


def test_scores_beat_the_base_on_held_out_text(docs):
    held = [r for r in scored(docs) if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held) + 0.2 * sum(r[2] for r in held)


def test_score_of_a_pair_model(spark):
    """Against the formula with exact quantised counts; a false positive can only raise a score."""
    texts = ["a b a b a b c", "a b", "c a", "b b a c"] * 3
    rows = [(k, t, "", "") for k, t in enumerate(texts)]
    train = [tokens(t) for k, t, *_ in rows if not is_held_out(k)]
    one, two = collections.Counter(), collections.Counter()
    for own in train:
        one.update(own)
        two.update(zip(["start", *own], own))
    n, v = sum(one.values()), len(one)
    exact = 0
    for row in scored(make_docs(spark, rows)):
        own = tokens(texts[row[0]])
        total = 0.0
        for before, word in zip(["start", *own], own):
            p1 = (one[word] + 0.1) / (n + 0.1 * (v + 1))
            context = len(train) if before == "start" else one[before]
            pair = two[before, word]
            seen = 2 ** int(math.log2(pair)) if pair else 0
            total += math.log10((seen + 10 * p1) / (context + 10))
        assert row[6] >= total - 1e-9
        exact += row[6] == pytest.approx(total)
    assert exact >= len(rows) // 2


def test_filter_has_no_false_negatives():
    import numpy as np

    pairs = np.sort(np.random.default_rng(5).integers(0, 1 << 63, 5000).astype(np.uint64))
    counts = np.arange(5000) % 37 + 1
    segment = lm_scoring.Segment(
        *lm_scoring.Segment.build(pairs, np.ones(5000, int), pairs, counts)
    )
    want = np.floor(np.log2(counts)).astype(int) + 1
    found = segment.levels(pairs)
    assert (found >= want).all() and (found > want).mean() < 0.03
    other = segment.levels(pairs + np.uint64(1))
    assert (other > 0).mean() < 0.03


def test_scores_of_empty_tables(no_docs, spark):
    assert lm_scoring.held_out_scores(no_docs).count() == 0
    only_held_out = make_docs(spark, [(None, "a b", "", "")])
    row = lm_scoring.held_out_scores(only_held_out).first()
    assert (row.train_tokens, row.n_known, row.held_out) == (0, 0, True)


def expected_edits(rows):
    rows = sorted(rows)
    found = {}
    for k, (doc_id, text, *_) in enumerate(rows):
        text, other = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        found[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest())
    return found


def test_edited_texts(docs, doc_rows):
    found = {r.doc_id: r for r in fingerprints.edit_report(docs).collect()}
    assert {i: (r.n_chars, r.edited_sha256) for i, r in found.items()} == expected_edits(doc_rows)
    by_text = collections.defaultdict(set)
    for doc_id, text in doc_rows:
        by_text[text].add(found[doc_id].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len(set.union(*by_text.values())) == len(by_text)
    near = [r.near_edited for r in found.values()]
    far = [r.near_next for r in found.values()]
    assert all(0 <= x <= 1 for x in near + far)
    assert sum(near) / len(near) > sum(far) / len(far) + 0.3


def test_edited_texts_over_block_borders(docs, doc_rows, spark):
    from pyspark.sql import functions as F

    pairs = fingerprints.with_next(docs, [F.col("text")], block_docs=7).collect()
    ids = [i for i, _ in doc_rows]
    after = dict(zip(ids, ids[1:] + ids[:1]))
    assert {r.here.doc_id: r.next.doc_id for r in pairs} == after
    assert len(pairs) == len(ids)


@pytest.mark.parametrize("block_docs", [1, 3, 1000])
def test_next_rows_in_any_blocks(spark, block_docs):
    """Negative, repeated and missing ids; blocks of one id, of some, and one block."""
    from pyspark.sql import functions as F

    draw = random.Random(block_docs)
    ids = sorted(draw.sample(range(-500, 500), 120))
    rows = [(i, f"t{i}", "", "") for i in ids] + [(None, "a", "", ""), (None, "b", "", "")]
    draw.shuffle(rows)
    pairs = fingerprints.with_next(make_docs(spark, rows), [F.col("text")], block_docs).collect()
    found = {p.here.text: p.next.text for p in pairs}
    assert len(found) == len(rows)
    assert [found[f"t{a}"] for a in ids[:-1]] == [f"t{b}" for b in ids[1:]]
    assert found[f"t{ids[-1]}"] in "ab" and f"t{ids[0]}" in (found["a"], found["b"])
    twice = make_docs(spark, [(k // 2, f"{k}", "", "") for k in range(20)])
    pairs = fingerprints.with_next(twice, [F.col("text")], block_docs).collect()
    assert len(pairs) == 20
    assert all(p.next.doc_id - p.here.doc_id in (0, 1, -9) for p in pairs)


def test_many_blocks_are_planned_at_once(spark):
    """The number of expressions does not grow with that of blocks."""
    import time

    from pyspark.sql import functions as F

    docs = spark.range(300_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    begin = time.time()
    pairs = fingerprints.with_next(docs, [F.col("text")], block_docs=2)
    pairs._jdf.queryExecution().optimizedPlan()
    assert time.time() - begin < 10
    assert pairs.where("next.doc_id <> (here.doc_id + 1) % 300000").count() == 0
    assert pairs.count() == 300_000


def test_lanes_of_many_equal_lines(spark):
    """Sums of signs do not leave their range; every hash has a seed of its own."""
    from pyspark.sql import functions as F

    rows = [(1, "x\n" * 40_000 + "y", "x\n" * 39_999 + "z")]
    row = (
        spark.createDataFrame(rows, "id int, a string, b string")
        .select(fingerprints.lanes(F.col("a")).alias("a"), fingerprints.lanes(F.col("b")).alias("b"))
        .select("a", fingerprints.likeness(F.col("a"), F.col("b")).alias("near"))
        .first()
    )
    assert set(map(abs, row.a.sign)) <= {39_999, 40_001} and row.near > 0.99
    eq = row.a.eq
    assert len(set(eq)) == 8


def test_edited_odd_rows(odd_docs, no_docs, spark):
    assert fingerprints.edit_report(odd_docs).count() == odd_docs.count()
    assert fingerprints.edit_report(no_docs).count() == 0
    alone = fingerprints.edit_report(make_docs(spark, [(1, "ab", "", "")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"aa").hexdigest()
    without = make_docs(spark, [(None, "ab", "", ""), (None, None, "", "")])
    assert fingerprints.edit_report(without).count() == 2


def test_multiset_hash(spark):
    from pyspark.sql import functions as F

    a, b = "One two.\nThree four.\nOne two.", "One two. Three four.\n\nOne two."
    rows = [(1, a, b, "Three four.", "One two.\rOne two.", "Three four.\nOne two.")]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string, d string, e string")
    vectors = df.select(*[fingerprints.lanes(F.col(c)).alias(c) for c in "abcde"])
    a, b, c, d, e = (F.col(x) for x in "abcde")
    row = vectors.select(
        (a == b).alias("order"),
        (fingerprints.combine(c, d) == a).alias("insert"),
        (fingerprints.combine(a, c, -1) == d).alias("delete"),
        (a == e).alias("times"),
        fingerprints.likeness(a, b).alias("same"),
        fingerprints.likeness(c, d).alias("other"),
    ).first()
    assert (row.order, row.insert, row.delete, row.times) == (True, True, True, False)
    assert row.same == 1.0 and row.other < 0.4


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, top=2.0):
    """Targets by handing out what is over, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    targets, full, left = {}, set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        level = {s: left * weight[s] / total for s in open_}
        over = {s for s in open_ if level[s] > top * sizes[s]}
        if not over:
            return targets | level
        full |= over
        targets |= {s: top * sizes[s] for s in over}
        left -= sum(targets[s] for s in over)


def test_targets_and_copies(docs, odd_docs, odd_rows, no_docs):
    for df, is_odd in ((docs, False), (odd_docs, True)):
        rows = mixing.mix(df).collect()
        again = mixing.mix(df.repartition(3)).collect()
        key = lambda r: str(tuple(r))
        assert sorted(rows, key=key) == sorted(again, key=key)
        sizes = collections.Counter()
        for r in rows:
            sizes[r.source] += r.size
        targets = expected_targets(sizes)
        assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
        for r in rows:
            assert r.source_size == sizes[r.source]
            assert r.target == pytest.approx(targets[r.source])
            assert r.taken in (r.size * math.floor(r.rate), r.size * math.ceil(r.rate))
            assert r.taken <= 2 * r.size
        emitted = mixing.emit(df)
        assert emitted.columns == df.columns
        assert emitted.count() == sum(r.copies for r in rows)
    assert mixing.mix(no_docs).count() == 0 and mixing.emit(no_docs).count() == 0


def test_taken_words_come_near_the_target(spark):
    rows = [(k, words(k, 20), "", f"s{k % 7 % 3}") for k in range(3000)]
    found = mixing.mix(make_docs(spark, rows)).collect()
    taken = collections.Counter()
    for r in found:
        taken[r.source] += r.taken
    for r in found:
        assert abs(taken[r.source] - r.target) < 0.1 * r.target


def test_documents_languages(docs, odd_docs, no_docs):
    rows = language_id.identify_documents(docs).collect()
    assert all(r.accepted and r.lang == r.declared for r in rows)
    model = language_id.train(docs)
    assert model.temper in language_id.TEMPERS
    odd = {r.doc_id: r for r in language_id.identify_documents(odd_docs, model).collect()}
    assert not any(odd[i].accepted for i in (4, 5, 6, 13))
    assert odd[5].lang == "und" and odd[5].posterior == 0.0
    assert language_id.identify_documents(no_docs).count() == 0
    assert language_id.identify_documents(no_docs, model).count() == 0


def test_every_label_is_a_language(spark, docs):
    """100 labels, most with few rows, and forms of one tag; none is left out or stands twice."""
    rows = []
    for k in range(100):
        letters = "".join(chr(0x4E00 + 40 * k + i) for i in range(40))
        draw = random.Random(k)
        for copy in range(1 if k % 3 else 3):
            text = "".join(draw.choices(letters, k=300))
            rows.append((100 * k + copy, text, f"l{k}", "s"))
    rows += [(20_000 + k, words(k, 80), tag, "s") for k, tag in enumerate(["en", "en-US", "EN", " en_gb"] * 3)]
    rows += [(30_000, words(1, 80), "und", "s"), (30_001, words(1, 80), "", "s")]
    corpus = make_docs(spark, rows)
    model = language_id.train(corpus)
    assert model.languages == tuple(sorted([f"l{k}" for k in range(100)] + ["en"]))
    found = {r.doc_id: r for r in language_id.identify_documents(corpus, model).collect()}
    assert all(found[i].accepted and found[i].lang == lang for i, _, lang, _ in rows[: -14])
    assert all(found[20_000 + k].lang == "en" for k in range(12))


FOREIGN = [
    "Questa mattina sono andato al mercato per comprare il pane, il formaggio e le mele che "
    "piacciono tanto ai miei figli.",
    "Vanochtend ging ik naar de markt om brood en kaas te kopen, omdat mijn kinderen daar heel erg "
    "van houden.",
    "Esta manha fui ao mercado para comprar pao, queijo e as macas de que os meus filhos gostam "
    "muito.",
    "Dzis rano poszedlem na targ kupic chleb i ser, poniewaz moje dzieci bardzo je lubia.",
]


def expected_accepted(labelled, texts):
    """Whether texts pass, by (text, lang) rows whose half is given, in plain Python."""
    counts = collections.defaultdict(lambda: [collections.Counter(), collections.Counter()])
    for half, text, lang in labelled:
        counts[lang][half].update(language_id.trigrams(text).tolist())
    languages = sorted(counts)

    def means(text, halves):
        found, out = language_id.trigrams(text).tolist(), {}
        for lang in languages:
            count = sum((counts[lang][h] for h in halves), collections.Counter())
            n = max(1, sum(count.values()))
            p = [math.log(0.8 * count[t] / n + 0.2 / 65536) for t in found]
            out[lang] = sum(p) / len(p)
        return out

    own, foreign, cache = collections.defaultdict(list), collections.defaultdict(list), {}
    for half, text, lang in labelled:
        if not len(language_id.trigrams(text)):
            continue
        if (half, text) not in cache:
            cache[half, text] = means(text, [1 - half])
        by = cache[half, text]
        own[lang].append(by[lang])
        best = max((x for x in languages if x != lang), key=by.get)
        foreign[best].append(by[best])

    def level(values, q):
        return sorted(values)[max(0, math.ceil(q * len(values)) - 1)]

    every, bars = [x for xs in foreign.values() for x in xs], {}
    for lang in languages:
        high = level(foreign[lang] if len(foreign[lang]) >= 20 else every, 0.95)
        low = level(own[lang], 0.01)
        bars[lang] = min(low, low + 0.75 * (high - low))
    return [any(m >= bars[x] for x, m in means(text, [0, 1]).items()) for text in texts]


@pytest.mark.parametrize("share", [4, 1])
def test_foreign_texts_are_rejected(spark, docs, sf_dir, share):
    """At two sizes of the table: foreign texts go, clean ones stay, and plain Python agrees."""
    from pyspark.sql import functions as F

    labelled = docs.where(f"doc_id % {share} = 0")
    half = F.pmod(F.xxhash64("text", F.lit("language half")), F.lit(2))
    rows = [tuple(r) for r in labelled.select(half, "text", "lang").collect()]
    clean = [r.text[:400] for r in docs.where("doc_id % 10 = 1").collect()]
    planted = FOREIGN + clean
    assert expected_accepted(rows, planted) == [False] * 4 + [True] * len(clean)
    extra = make_docs(spark, [(10_000 + k, t, None, "x") for k, t in enumerate(planted)])
    both = labelled.unionByName(extra.select(labelled.columns))
    kept = corpus_pipeline.language_id(spark, both, sf_dir).where("doc_id >= 10000")
    assert {r.doc_id - 10_000 for r in kept.collect()} == set(range(4, len(planted)))


def test_many_languages_share_buckets(spark, docs, monkeypatch):
    monkeypatch.setattr(language_id, "CELLS", language_id.BUCKETS)
    model = language_id.train(docs)
    assert len(model.gains.starts) == (language_id.BUCKETS >> 2) + 1 and model.shift == 2
    rows = language_id.identify_documents(docs, model).collect()
    assert sum(r.accepted and r.lang == r.declared for r in rows) >= 0.98 * len(rows)


def test_held_out_accuracy(spark, docs):
    """Trained on even ids, judged on short pieces of odd ids that declare nothing."""
    from pyspark.sql import functions as F

    model = language_id.train(docs.where("doc_id % 2 = 0"))
    short = docs.where("doc_id % 2 = 1").select(
        "doc_id",
        F.substring("text", 1, 80).alias("text"),
        F.col("lang").alias("truth"),
        F.lit(None).cast("string").alias("declared"),
        "source",
    )
    rows = language_id.identify(short, model, ["source"]).collect()
    assert sum(r.lang == r.truth for r in rows) >= 0.95 * len(rows)


def test_evidence_decides_where_texts_do_not(spark, docs):
    model = language_id.train(docs)
    page = "<html lang={}><script>var x = '<p>';</script><!-- the and --><p>{}</p></html>"
    rows = [(k, f"http://a.host.fr/{k}", page.format("fr", "le la les une que dans pour")) for k in range(30)]
    rows += [(50, "http://a.host.fr/x", page.format("fr", "at")), (51, None, None)]
    rows += [(52, "http://b.host.fr/x", page.format("FR-ca", "at")), (53, "http://c.de/", "at")]
    english = page.format("en", "the of and to in that is was thing with")
    rows += [(100 + k, f"http://x.com/{k}", english) for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in language_id.identify_pages(pages, model).collect()}
    assert found[50].lang == found[52].lang == "fr"
    assert found[50].posterior > found[53].posterior or found[53].lang != "fr"
    assert (found[0].suffix, found[0].domain, found[0].host) == ("fr", "host.fr", "a.host.fr")
    assert found[51].lang == "und" and found[51].host == ""


def fused(rows, model, levels):
    """Verdicts on (text, declared, levels ..) in plain Python, but for the likelihood of the text."""
    likes, guesses = [], []
    for text, *_ in rows:
        found = language_id.trigrams(text) >> model.shift
        totals = model.gains.totals(found).tolist() if len(found) else [0.0] * len(model.languages)
        fits = [
            (total, lang)
            for total, lang, bar in zip(totals, model.languages, model.bars)
            if len(found) and total / len(found) >= bar
        ]
        likes.append({x: t * model.temper for t, x in zip(totals, model.languages)})
        guesses.append(max(fits, key=lambda f: f[0])[1] if fits else None)
    voters = [(g, *r[1:]) for g, r in zip(guesses, rows) if g is not None]
    kinds = len({r[1] for r in rows if r[1] is not None})
    size, found = len(model.languages), []
    for like, guess, (_, declared, *place) in zip(likes, guesses, rows):
        if guess is None:
            found.append(("und", 0.0))
            continue
        evidence = {}
        for lang in model.languages:
            prior = (sum(v[0] == lang for v in voters) + 1) / (len(voters) + size)
            for depth in range(1, levels):
                group = [v[0] for v in voters if list(v[2 : 2 + depth]) == place[:depth]]
                prior = (group.count(lang) + 10 * prior) / (len(group) + 10)
            own = [v[0] for v in voters if list(v[2:]) == place].count(lang) - (guess == lang)
            evidence[lang] = like[lang] + math.log(own + 10 * prior)
            if declared is not None:
                said = [v[0] for v in voters if v[1] is not None]
                both = sum(v[0] == lang and v[1] == declared for v in voters)
                evidence[lang] += math.log((both + 0.5) / (said.count(lang) + 0.5 * (kinds + 1)))
        top = max(evidence.values())
        weights = {x: math.exp(e - top) for x, e in evidence.items()}
        best = min(x for x in weights if weights[x] == 1.0)
        found.append((best, 1 / sum(weights.values())))
    return found


def test_posterior_against_plain_python(spark, docs):
    """Short pieces of text, so that declarations and hosts decide."""
    model = language_id.train(docs)
    draw = random.Random(11)
    rows = []
    for k, row in enumerate(docs.limit(150).collect()):
        begin = draw.randrange(max(1, len(row.text) - 12))
        text = row.text[begin : begin + draw.choice([3, 6, 12, 60])]
        declared = draw.choice([None, row.lang, row.lang, "en", "xx"])
        suffix = draw.choice([row.lang, "com", None])
        domain = f"{draw.choice('ab')}.{suffix}" if suffix else None
        rows.append((k, text, declared, suffix, domain, f"{draw.choice('xy')}.{domain}"))
    names = "id int, text string, declared string, suffix string, domain string, host string"
    levels = ["suffix", "domain", "host"]
    found = language_id.identify(spark.createDataFrame(rows, names), model, levels).collect()
    verdicts = {r.id: (r.lang, r.posterior) for r in found}
    expected = fused([r[1:] for r in rows], model, len(levels))
    assert len(verdicts) == len(rows)
    for k, (lang, posterior) in enumerate(expected):
        assert verdicts[k][0] == lang, k
        assert verdicts[k][1] == pytest.approx(posterior, abs=1e-5), k
    assert len({round(p, 3) for _, p in expected}) > 30


def test_pages_with_odd_rows(spark, docs):
    """Null addresses and html, repeated rows, empty pages, clashing names; an empty table."""
    model = language_id.train(docs)
    text = docs.where("lang = 'es'").first().text
    rows = [
        (1, None, f"<html lang=es><p>{text}</p>"),
        (2, "http://a.es/", None),
        (3, "no address", ""),
        (4, None, None),
        (5, "http://a.es/x", f"<p>{text}</p>"),
        (5, "http://a.es/x", f"<p>{text}</p>"),
        (None, "http://a.es/y", f"<p>{text}</p>" * 200),
        (6, "http://b.es/", "<html lang='1'>12 % 34"),
    ]
    names = "page_id long, url string, html string, lang string, guess string, candidates int, n int"
    pages = spark.createDataFrame([(*r, "x", "x", 1, 1) for r in rows], names)
    found = language_id.identify_pages(pages, model).collect()
    verdicts = sorted((str(r.page_id), r.lang, r.accepted, r.host) for r in found)
    assert verdicts == sorted(
        [
            ("1", "es", True, ""),
            ("2", "und", False, "a.es"),
            ("3", "und", False, ""),
            ("4", "und", False, ""),
            ("5", "es", True, "a.es"),
            ("5", "es", True, "a.es"),
            ("None", "es", True, "a.es"),
            ("6", "und", False, "b.es"),
        ]
    )
    empty = language_id.identify_pages(pages.limit(0), model)
    assert empty.count() == 0 and empty.columns == language_id.identify_pages(pages, model).columns
