"""Counts against the library on whole texts."""

import random

import public_tokenizers
import pytest
from llm_cases import no_documents, odd_documents, odd_rows

from tripworks.llm import tokens
from tripworks.llm.frames import prepare

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.load(PATH)


def odd_texts():
    rng = random.Random(8)
    parts = ["a", "b", " ", "  ", "\n", "'s", "<|endoftext|>", "<|", "é", "1", "!", "\xa0", "​", " the", "\U0001f600", "\r\n", "\x1c", "\x85", "　", "longerword"]
    fixed = ["", " ", "  a", "a  b", "a \n b", "x<|endoftext|> y", "a" * 3000, "1 2 3 " * 200, "é" * 2000, " " * 2000 + "x", "<|endoftext|>" * 200, "x" + "\n" * 999]
    return fixed + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 1500))) for _ in range(120)]


def whole(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False))


def test_pieces_are_counted_as_the_whole(tokenizer, monkeypatch):
    counter = tokens.Counter(tokenizer)
    texts = odd_texts()
    assert counter.count(texts) == [whole(tokenizer, t) for t in texts]
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    assert counter.count(texts[:30]) == [whole(tokenizer, t) for t in texts[:30]]


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (200, 16), (300, 100), (1000, 1)])
def test_spliced_chunks_are_counted_as_the_whole(tokenizer, chunk, overlap):
    for text in odd_texts():
        if len(text) > chunk:
            assert tokens.spliced(tokenizer, text, chunk, overlap) == whole(tokenizer, text), text[:80]


def test_long_pieces_at_the_real_sizes_come_to_an_end(tokenizer):
    words = " word" * 40_000
    text = "a" * 140_000 + words[: 196_608 - 140_000] + "=" * 100_000 + " end"
    counter = tokens.Counter(tokenizer)
    assert counter.count([text]) == [len(tokenizer.encode(text, add_special_tokens=False))]


def test_what_is_remembered_is_short_and_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    counter = tokens.Counter(tokenizer)
    texts = [" ".join(f"w{i}x{k}" for k in range(7)) + " " + "漢" * 60_000 for i in range(40)] + [" ".join(f"v{k}" for k in range(200))]
    want = [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    assert [n for t in texts for n in counter.count([t])] == want
    assert max(map(len, counter.known)) <= tokens.SHORT and len(counter.known) <= 250


def test_pieces_concatenate():
    for text in odd_texts():
        assert "".join(tokens.pieces(text)) == text


def test_odd_documents(spark, tokenizer):
    prepare(spark)
    found = tokens.token_counts(odd_documents(spark), lambda: PATH).collect()
    expected = sorted((str(r[0]), len((r[1] or "").encode()), whole(tokenizer, r[1] or "")) for r in odd_rows())
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in found) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in found)
    assert tokens.token_counts(no_documents(spark), lambda: PATH).count() == 0
