import hashlib
import math

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sluice.llm.catalog import ORACLES, QUERIES
from tests.llm.conftest import changed, make_docs, words
from tests.llm.test_dedup import expected_near
from tests.llm.test_text_operators import expected_targets
from tests.side_by_side import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    problem, _, rows = compare(
        spark, connect(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir
    )
    assert problem is None
    assert rows > 0


def by_hand(rows, accepted):
    """The pipeline on (doc_id, text, lang, source) in plain Python."""
    rows = [r for r in rows if accepted(r)]
    last = {}
    for row in rows:
        if row[1] not in last or row[0] > last[row[1]][0]:
            last[row[1]] = row
    rows = list(last.values())
    near = expected_near(rows, corpus_pipeline.NEAR_SIMILARITY)
    kept = {r[0] for r in near if r[3]}
    rows = [r for r in rows if r[0] in kept]
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].encode().split())
    targets = expected_targets(sizes)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = []
    for doc_id, text, _, source in rows:
        rate = targets[source] / sizes[source] if sizes[source] else 0.0
        draw = int(hashlib.md5(f"mix:{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        copies = math.floor(rate) + (draw < rate - math.floor(rate))
        ids = library.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        row = (doc_id, len(ids), digest, hashlib.sha256(text.encode()).hexdigest())
        found += [row] * copies
    return sorted(found)


def test_run(spark, sf_dir, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    found = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert found == by_hand(rows, lambda r: True)


def test_stages_on_odd_rows(spark, sf_dir, docs, odd_rows, no_docs):
    clean = [tuple(r) for r in docs.limit(40).select("doc_id", "text", "lang", "source").collect()]
    clean = [(r[0] + 1000, *r[1:]) for r in clean]
    odd = make_docs(spark, [*odd_rows, *clean])
    kept = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = corpus_pipeline.staged(stage(spark, before, sf_dir), f"test-{name}")
        assert kept.columns == odd.columns, name
        if name == "language_id":
            left = {r.doc_id for r in kept.select("doc_id").collect()}
            assert {r[0] for r in clean} <= left and not {4, 5, 6, 13} & left
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert last.count() == kept.count() > 0
    empty = no_docs
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0


def test_near_dedup_of_rows_that_share_an_id(spark, sf_dir):
    """A text stays when another text of the same id is a copy; rows without id are judged too."""
    base, other, third = words(71, 200), words(72, 200), words(73, 200)
    rows = [
        (1, base, "en", "a"),
        (7, changed(base, 1, 2), "en", "a"),
        (7, other, "en", "b"),
        (None, changed(other, 2, 2), "en", "b"),
        (None, third, "en", "b"),
    ]
    kept = corpus_pipeline.near_dedup(spark, make_docs(spark, rows), sf_dir)
    found = [r.text for r in kept.collect()]
    assert third in found and len(found) == 3
    assert sum(t in found for t in (rows[0][1], rows[1][1])) == 1
    assert sum(t in found for t in (rows[2][1], rows[3][1])) == 1
