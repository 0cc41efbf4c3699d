import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from placemat.llm import token_files
from placemat.llm.queries import QUERIES
from placemat.llm.tokens import END_ID, VOCABULARY


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [END_ID], "<u4")


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [1, 7, 8, 1000, token_files.BLOCK])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    assert np.array_equal(token_files.unpack_block(token_files.pack_block(ids, bits)), ids)


def test_query(spark, small, texts, library):
    got = {r.doc_id: r for r in QUERIES["op8_token_files"].build(spark, small).collect()}
    start = 0
    for doc in sorted(texts):
        ids = ids_of(library, texts[doc])
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("bits", [False, True])
def test_odd_documents_and_documents_over_many_blocks(spark, odd, library, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(token_files, "BLOCK", 512)
    path = str(tmp_path / f"tokens{bits}")
    token_files.write_tokens(odd, path, bits=bits)
    parts = token_files.read_tokens(spark, path).collect()
    whole = {}
    for r in sorted(parts, key=lambda r: r.offset):
        whole[r.start] = whole.get(r.start, b"") + r.ids
    assert sorted(whole.values()) == sorted(ids_of(library, r.text).tobytes() for r in odd.collect())
    assert sorted(whole) == np.cumsum([0, *[len(whole[s]) // 4 for s in sorted(whole)]])[:-1].tolist()
    digests = token_files.token_digests(token_files.read_tokens(spark, path)).collect()
    assert {r.start: r.ids_crc32 for r in digests} == {s: zlib.crc32(b) for s, b in whole.items()}


def test_empty_table(spark, none, tmp_path):
    token_files.write_tokens(none, str(tmp_path / "none"))
    assert token_files.token_digests(token_files.read_tokens(spark, str(tmp_path / "none"))).count() == 0
