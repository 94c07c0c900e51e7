import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    return bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize(
    "text",
    [
        "",
        " ",
        "\n",
        "  two  spaces \n\n and\ttabs ",
        "don't I'LL we'd 's'",
        "a<|endoftext|>b <|endoftext|>",
        "\x1c\x1d \x85\xa0 x​　y",
        "naïve café é ﬁ 中文字符 😀😀 ١٢٣",
        "x" * 199 + "y",
        "ab" * 400 + "c" * 333,
        "é" * 150 + "e" * 150,
    ],
)
def test_same_as_the_library(model, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert model.encode(text) == expected
    assert model.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_every_code_point(model, library):
    texts = [
        "".join(f"a{chr(c)} {chr(c)}1" for c in range(begin, begin + 64))
        for begin in range(0, 0x30000, 64)
        if not 0xD800 <= begin < 0xE000
    ]
    expected = library.encode_batch(texts, add_special_tokens=False)
    assert [model.encode(t) for t in texts] == [e.ids for e in expected]


def test_heap_and_scan_agree(model, monkeypatch):
    word = "thethethe" * 20 + "zzq" * 30
    scanned = model.merge_word(word.encode()[:200])
    monkeypatch.setattr(bpe, "LONG_WORD", 0)
    assert model.merge_word(word.encode()[:200]) == scanned


def test_broken_bytes_decode_like_the_library(model, library):
    for ids in ([0, 128, 200], [160, 161, 250, 10], [50256, 188, 255, 255], list(range(120, 256))):
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)


def expected_row(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    decoded = library.decode(ids, skip_special_tokens=False)
    return doc_id, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest()


def order(rows):
    return sorted(rows, key=str)


def test_odd_rows(odd_docs, odd_rows, library):
    found = [tuple(r) for r in bpe.round_trip(odd_docs, PATH).collect()]
    assert order(found) == order(expected_row(library, r[0], r[1]) for r in odd_rows)


def test_whole_table(docs, doc_rows, library):
    found = [tuple(r) for r in bpe.round_trip(docs, PATH).collect()]
    assert order(found) == order(expected_row(library, *r) for r in doc_rows)


def test_empty_table(no_docs):
    assert bpe.round_trip(no_docs, PATH).count() == 0
