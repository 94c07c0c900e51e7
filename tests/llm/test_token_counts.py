import json

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def count(text):
    model = bpe.vocabulary(PATH)
    merged = token_counts.MergedCounts(model)
    return token_counts.count_text(model, token_counts.whole_tokens(PATH), merged, text)


def test_whole_tokens_are_one_token_each(library):
    """The proof agrees with the library on every string of the vocabulary, both ways."""
    whole = token_counts.whole_tokens(PATH)
    letters = bpe.byte_letters()
    special = {t.content for t in library.get_added_tokens_decoder().values()}
    assert special <= whole and len(whole) <= library.get_vocab_size()
    model = bpe.vocabulary(PATH)
    n = 0
    for token in library.get_vocab(with_added_tokens=False):
        data = bytes(letters[c] for c in token)
        try:
            text = data.decode()
        except UnicodeDecodeError:
            continue
        if model.split(text) == [text]:  # can be a pre-token
            n += 1
            assert (text in whole) == (library_count(library, text) == 1), text
    assert n > 40_000


def test_vocabulary_strings_that_split_are_merged(tmp_path):
    """A vocabulary string that its own merges do not lead to is no whole token."""
    with open(PATH, encoding="utf-8") as file:
        data = json.load(file)
    word = max((m for m in data["model"]["merges"] if "".join(m).isascii()), key=len)
    lost = "".join(word) if isinstance(word, list) else word.replace(" ", "")
    merged = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
    data["model"]["merges"] = [m for m in merged if "".join(m) != lost]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(data), encoding="utf-8")
    letters = bpe.byte_letters()
    text = bytes(letters[c] for c in lost).decode()
    assert text in token_counts.whole_tokens(PATH)
    assert text not in token_counts.whole_tokens(str(other))


@pytest.mark.parametrize(
    "text",
    [
        "",
        " ",
        "  two  spaces \n\n and\ttabs ",
        "don't I'LL we'd 's'",
        "a<|endoftext|>b <|endoftext|><|endoftext|>",
        "\x1c\x1d \x85\xa0 x\u200b\u3000y",
        "na\u00efve caf\u00e9 \ufb01 \u4e2d\u6587\u5b57\u7b26 \U0001f600\U0001f600 \u0661\u0662",
        "x" * 199 + "y",
        "ab" * 4000 + "c" * 333,
    ],
)
def test_same_as_the_library(library, text):
    assert count(text) == library_count(library, text)


def test_every_code_point(library):
    texts = [
        "".join(f"a{chr(c)} {chr(c)}1" for c in range(begin, begin + 64))
        for begin in range(0, 0x20000, 64)
        if not 0xD800 <= begin < 0xE000
    ]
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [count(t) for t in texts] == expected


def test_parts_of_long_texts(library, monkeypatch):
    text = " a  b\n\n c\u3000\u3000d \x1c e<|endoftext|> f  <|endoftext|>\tg  " * 40
    for size in range(1, 60, 7):
        parts = list(token_counts.text_parts(text, size))
        assert "".join(parts) == text and len(parts) > 1
        assert sum(map(count, parts)) == library_count(library, text)
    assert list(token_counts.text_parts("x" * 100, 10)) == ["x" * 100]


def test_memory_is_bounded(monkeypatch):
    merged = token_counts.MergedCounts(bpe.vocabulary(PATH))
    monkeypatch.setattr(token_counts, "MEMORY", 1000)
    counts = [merged[f"zqx{k}"] for k in range(50)]
    assert len(merged) < 10 and counts == [merged[f"zqx{k}"] for k in range(50)]


def expected_row(library, doc_id, text):
    n = library_count(library, text or "")
    return doc_id, len((text or "").encode()), n, n > 1024


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_odd_rows(odd_docs, odd_rows, library):
    found = token_counts.token_counts(odd_docs, PATH).collect()
    assert order(found) == order(expected_row(library, r[0], r[1]) for r in odd_rows)
    assert any(r.over_limit for r in found) and not all(r.over_limit for r in found)


def test_whole_table(docs, doc_rows, library):
    found = token_counts.token_counts(docs, PATH).collect()
    assert order(found) == order(expected_row(library, *r) for r in doc_rows)


def test_empty_table(no_docs):
    assert token_counts.token_counts(no_docs, PATH).count() == 0


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="normalizer"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
