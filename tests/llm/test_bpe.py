import hashlib
import random
from itertools import chain

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sangam.llm import bpe

PIECES = [
    "a", "b", " ", "  ", "\n", "'s", "'re", "'", "don't", "é", "中文", "😀", "1", "23", "\t", "\u0085", "\xa0", "\x1c",
    "<|endoftext|>", "<|endo", "the", " token", "ization", "AAAA", "​", "́", "ǅ", "²", "½", "œ", "\x00", "_", "\r\n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.vocabulary(bpe.public_vocabulary())


def ids_of(v, text):
    return list(chain.from_iterable(bpe.encode(v, text)))


@pytest.mark.parametrize("slice_chars, long_piece", [(1 << 16, 4096), (1, 4096), (5, 4096), (40, 20)])
def test_equals_library(library, vocabulary, monkeypatch, slice_chars, long_piece):
    monkeypatch.setattr(bpe, "SLICE_CHARS", slice_chars)
    monkeypatch.setattr(bpe, "LONG_PIECE", long_piece)
    rng = random.Random(slice_chars)
    for _ in range(600):
        text = "".join(rng.choice(PIECES) * rng.choice([1, 1, 1, 2, 30]) for _ in range(rng.randrange(0, 20)))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(vocabulary, text) == want, text
        decoder = bpe.Decoder(vocabulary)
        assert decoder.feed(want) + decoder.finish() == text


def test_fits_is_what_merging_gives(vocabulary):
    rng = random.Random(4)
    tokens = sorted(vocabulary.ids.values())
    for _ in range(2000):
        left, right = rng.choice(tokens), rng.choice(tokens)
        merged = vocabulary.merged(vocabulary.bytes[left] + vocabulary.bytes[right])
        assert vocabulary.fits(left, right) == (merged == [left, right])


def test_memory_of_a_long_piece_is_bounded(vocabulary):
    piece, rng, held = bpe.Piece(vocabulary), random.Random(1), 0
    out, text = [], "".join(rng.choice("abcdefghij") for _ in range(20_000)).encode()
    for at in range(0, len(text), 500):
        out += piece.push(text[at : at + 500])
        held = max(held, len(piece.data))
    assert held < 1000
    assert out + piece.finish() == bpe.Piece(vocabulary).finish(text)


def test_broken_bytes_decode_as_the_library_does(library, vocabulary):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(0, 8))]
        decoder = bpe.Decoder(vocabulary)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_rows(spark, library):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, "é" * 70_000)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, bpe.bpe_digests(docs).collect()), key=str)
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), sha, hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    encoded = bpe.bpe_encode(docs)
    assert sorted(r.text or "" for r in bpe.bpe_decode(encoded).collect()) == sorted(t or "" for _, t in rows)
    assert bpe.bpe_digests(docs.limit(0)).collect() == []
