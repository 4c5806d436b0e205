import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import CLASHES
from sitelens.llm import bpe_codec, token_count

ALPHABET = "ab zé\n\t▁<s>/|endoftx 你好🙂\u0085 'llre0123  ﬁ\x1f\x00ƒΩ"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe_codec.default_path())


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.Codec(bpe_codec.default_path())


@pytest.fixture(scope="module")
def counter():
    return token_count.Counter(token_count.default_path())


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=token_count.default_path())


def odd(n, length, seed=1):
    rng = random.Random(seed)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(length))) for _ in range(n)]
    return out + ["<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|>", "x" * 9000, "ab" * 6000, " " * 3000,
                  "word " * 4000, "\n" * 50 + "é " * 3000, "<s> </s> <unk> <0x41>"]


def test_chunked_encoding_equals_the_library(codec, tokenizer):
    for text in odd(40, 9000) + odd(300, 60, 2):
        assert codec.encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    text = odd(1, 9000, 11)[0] + " passage " + " ".join(f"w{i}" for i in range(4000))
    before = codec.reused
    for head in ("", "a different head before the shared passage "):
        assert codec.encode((head + text).encode()).tolist() == tokenizer.encode(head + text, add_special_tokens=False).ids
    assert codec.reused > before        # the second text found chunks of the first


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=120))
def test_any_unicode(codec, tokenizer, counter, pieces, parts):
    text = " ".join(parts).encode("utf-8", "ignore").decode()
    assert codec.encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert counter.count(text) == len(pieces.encode(text))


def test_cuts_depend_on_content_only():
    """A shared passage gets the same inner cuts wherever it stands."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(6000)]
    passage = " ".join(words).encode()
    one, two = b"head " + passage, b"another much longer head " * 40 + passage
    a = {len(one) - c for c in bpe_codec.cuts(one) if c > 100}
    b = {len(two) - c for c in bpe_codec.cuts(two) if len(two) - c < len(passage) - 100}
    assert a == b and len(a) > 5


def test_store_is_bounded(tokenizer):
    small = bpe_codec.Codec(bpe_codec.default_path(), store_bytes=20_000)
    for text in odd(30, 9000, 5):
        assert small.encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert small.stored <= 20_000


def test_encode_documents(docs, odd_texts, tokenizer):
    rows = [*enumerate(odd_texts), (None, "null id"), (3, "same text here")]
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in bpe_codec.encode_documents(docs(rows, CLASHES)).collect()}
    want = set()
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want.add((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        assert back == (text or "")
    assert got == want
    full = bpe_codec.encode_documents(docs(["round trip <|endoftext|>"]), with_ids=True).first()
    assert full["decoded"] == "round trip <|endoftext|>" and 50256 in full["ids"]
    assert bpe_codec.encode_documents(docs([])).count() == 0


def test_heap_merging_equals_the_library(counter, pieces):
    for text in odd(20, 6000, 7) + odd(400, 60, 8):
        assert counter.count(text) == len(pieces.encode(text))


def test_count_tokens(docs, odd_texts, pieces):
    rows = [*enumerate(odd_texts), (None, "null id"), (3, "same text here")]
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"])
                  for r in token_count.count_tokens(docs(rows, CLASHES)).collect()), key=repr)
    want = [(d, len((t or "").encode()), len(pieces.encode(t or ""))) for d, t in rows]
    assert got == sorted(((*w, w[2] > 4096) for w in want), key=repr)
    assert any(r[3] for r in got)
    assert token_count.count_tokens(docs([])).count() == 0


def test_memo_is_bounded(monkeypatch, pieces):
    monkeypatch.setattr(token_count, "MEMO_UNITS", 10)
    counter = token_count.Counter(token_count.default_path())
    text = " ".join(f"word{i}" for i in range(200))
    assert counter.count(text) == len(pieces.encode(text))
    assert len(counter.unit) <= 10 and len(counter.part) <= 10
