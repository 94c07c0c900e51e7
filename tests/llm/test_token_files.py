import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import token_files
from sluice.llm.common import shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_direct_access():
    draw = np.random.default_rng(1)
    tokens = (draw.integers(0, 1 << 31, 5000) >> draw.integers(0, 31, 5000)).astype(np.uint32)
    sizes = [0, 1, 1499, 0, 3500]
    image = token_files.build_file(3, 7, [5, None, -2, 9, 10], sizes, tokens)
    file = token_files.TokenFile(image + b"\n")
    assert (file.block, file.number, file.n_tokens) == (3, 7, 5000)
    assert file.doc_ids == [5, None, -2, 9, 10]
    assert [file.token(i) for i in range(0, 5000, 7)] == tokens[::7].tolist()
    for begin, end in [(0, 0), (0, 5000), (511, 513), (1024, 1024), (7, 4999), (4999, 5000)]:
        assert file.tokens(begin, end).tolist() == tokens[begin:end].tolist()
    assert [len(file.document(k)) for k in range(5)] == sizes
    with pytest.raises(IndexError):
        file.token(5000)


def test_file_without_tokens():
    file = token_files.TokenFile(token_files.build_file(0, 0, [1], [0], np.empty(0, np.uint32)))
    assert file.document(0).tolist() == []


def test_pieces(library):
    texts = [
        "don't stop,it's\u00a0they've\u3000'sure 12,5 \x1c a\x1fb\x85c 'S 'll'll x'd",
        "'t're've'm'll'd'x '1 a'1 \u2028Straße ÉCOLE e\u0301cole, naïve-ish ﬁn",
        "\x1d\x1e \t\n\x0b\x0c\r", "", "ΣΑΣ σας", "日本語、テスト123 привет-мир!", "İstanbul K",
        "[UNK] </w> <s> a</w>b",
    ]
    coder = token_files.Coder(PATH)
    for _ in range(2):
        found = [np.frombuffer(ids, coder.width).tolist() for ids in coder.encode_all(texts)]
        assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]


def expected(library, rows):
    start, found = 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        found.append((doc_id, start, len(ids), crc))
        start += len(ids)
    return found


def test_whole_table(docs, doc_rows, library):
    found = token_files.token_file_round_trip(docs, PATH).collect()
    assert sorted(map(tuple, found)) == expected(library, doc_rows)


def test_many_small_files(spark, docs, doc_rows, library):
    path = shared_path(spark, "test-tokens")
    token_files.write_token_files(docs, path, PATH, file_tokens=500)
    assert spark.read.format("binaryFile").load(path).count() > 50
    found = token_files.token_offsets(spark, path).collect()
    assert sorted(map(tuple, found)) == expected(library, doc_rows)


def test_odd_rows(odd_docs, odd_rows, library):
    found = token_files.token_file_round_trip(odd_docs, PATH).collect()
    rows = sorted(((r[0], r[1]) for r in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0))
    want = expected(library, rows)
    # Rows without id come first, in any order; all of them hold the same tokens together.
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    found = sorted(map(tuple, found), key=key)
    assert [r for r in found if r[0] is not None] == [r for r in want if r[0] is not None]
    assert sorted(r[2:] for r in found if r[0] is None) == sorted(
        r[2:] for r in want if r[0] is None
    )


def test_empty_table(no_docs):
    assert token_files.token_file_round_trip(no_docs, PATH).count() == 0
