import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from sozmill.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return bpe.codec(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_pieces_of_any_length(coder, library):
    draw = random.Random(1)
    for n in (1, 2, 3, 7, 8, 9, 16, 17, 33, 100, 1000, 20000):
        for _ in range(20 if n < 1000 else 2):
            text = "".join(draw.choice("abehrtnosié日😀ß") for _ in range(n))
            assert bpe.encode_piece(text.encode(), coder.ranks) == library._encode_single_piece(text)


def test_texts(coder, library):
    draw = random.Random(2)
    for n in (0, 1, 5, 50, 500, 5000):
        text = "".join(draw.choice("ab ehrtno\n\t!?$1 2日😀'sßthe  <|endoftext|>") for _ in range(n))
        ids = [i for part in coder.encode(text) for i in part.tolist()]
        assert ids == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_cache_turns_over(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 50)
    small = bpe.Codec(bpe.load_ranks(PATH), P.PATTERN)
    text = " ".join(f"word{i % 300}x{i % 7}" for i in range(3000))
    for _ in range(2):
        assert [i for part in small.encode(text) for i in part.tolist()] == library.encode_ordinary(text)


def test_long_text_in_parts(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "LIST_CHARS", 100)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 7)
    text = "Some words, and more of them; 12 345 numbers too. " * 40
    assert [i for part in coder.encode(text) for i in part.tolist()] == library.encode_ordinary(text)


def check(rows, library):
    for row in rows:
        ids = library.encode_ordinary(row.given or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.given or "").encode()).hexdigest()


def test_documents(documents, odd, library):
    for docs in (documents, odd, odd.limit(0)):
        docs = docs.select("doc_id", "text", docs.text.alias("given"), docs.doc_id.alias("n_tokens"))
        rows = bpe.round_trip(docs, PATH, P.PATTERN).collect()
        assert len(rows) == docs.count()
        check(rows, library)


def test_ids_and_back(odd):
    coded = bpe.encode(odd.select("doc_id", "text", odd.text.alias("given")), PATH, P.PATTERN)
    for row in bpe.decode(coded, PATH, P.PATTERN).collect():
        assert bytes(row.decoded) == (row.given or "").encode()
