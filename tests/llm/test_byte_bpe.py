import base64
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tabloom.llm import byte_bpe
from tabloom.llm.byte_bpe import codec, encode_decode, read_ranks, sentencepiece_model

RANKS = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
TEXTS = [
    "", " ", "a  b", "a \n b ", "é  ü\n\n z", "日本語 テスト 🎉🎉", "<|endoftext|> x", "a" * 4000, "x\t y", "\x1c a \x85 b",
    "don't can't 123 4567 !!!??", "ºª a", "The quick brown fox jumps over the lazy dog. " * 30, "\x00\x01 \x02",
]


@pytest.fixture(scope="module")
def both():
    own = codec(sentencepiece_model(RANKS), public_tokenizers.PATTERN)
    other = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    return own, other


def test_ids_equal_tiktoken_and_round_trip(both):
    own, other = both
    for text, ids in zip(TEXTS, own.encode_batch(TEXTS), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_forgetting_changes_nothing(both, monkeypatch):
    own, _ = both
    want = own.encode_batch(TEXTS)
    monkeypatch.setattr(byte_bpe, "MOST_KNOWN", 0)
    assert [own.encode_batch([t])[0] for t in TEXTS] == want


def test_vocabulary_file_is_read_whole():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        assert {base64.b64decode(x.split()[0]) for x in lines} == set(RANKS)


def test_awkward_table(spark, awkward, no_documents, both):
    rows = encode_decode(awkward).collect()
    texts = [r["text"] or "" for r in awkward.collect()]
    want = sorted((len(both[1].encode_ordinary(t)), sha256(t.encode()).hexdigest()) for t in texts)
    assert sorted((r["n_tokens"], r["decoded_sha256"]) for r in rows) == want
    assert encode_decode(no_documents).count() == 0
