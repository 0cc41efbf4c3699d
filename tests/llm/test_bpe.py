import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from placemat.llm import bpe, tokens
from placemat.llm.queries import QUERIES


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def test_query_equals_the_library(spark, small, texts, words):
    for r in QUERIES["op3_word_bpe"].build(spark, small).collect():
        ids = words.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = words.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_documents(spark, odd, none, words):
    more = ["ΑΣΣ Σ İI", "é ́x", "x\x1cy q\x85r​", "don't I'll ½ ² ﬁ Å ẞ", "<|startoftext|>a<|endoftext|> b"]
    frame = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    want = sorted(words.encode(r.text or "", add_special_tokens=False).ids for r in frame.collect())
    got = bpe.decode_documents(bpe.encode_documents(frame)).collect()
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in got) == want
    for r in got:
        assert r.decoded == words.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False)
    assert bpe.encode_documents(none).count() == 0


def test_byte_level_ids_for_every_character():
    """The two libraries agree on each code point, in the middle of words, alone and after spaces."""
    slow = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    fast = tokens.ByteLevelEncoder(tokens.vocabulary_text(tokens.VOCABULARY))
    points = [c for c in [*range(0x3000), *range(0x3000, 0x110000, 37)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}x {chr(c)}  1{chr(c)}" for c in points]
    want = [np.array(e.ids, "<u4").tobytes() for e in slow.encode_batch_fast(texts, add_special_tokens=False)]
    assert fast.encode(texts) == want


@pytest.mark.parametrize("text", [" " * 2_000_000, "x" + "\n" * 9000 + "y", "a" * 30000, "<|endoftext|> x<|endoftext|>", "", "'s 'LL it's"])
def test_byte_level_extremes(text):
    slow = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    fast = tokens.ByteLevelEncoder(tokens.vocabulary_text(tokens.VOCABULARY))
    assert np.frombuffer(fast.encode([text])[0], "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids
