import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from placemat.llm import alignment
from placemat.llm.queries import QUERIES


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_of():
    """Byte of each character of a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def groups_of(libraries, text):
    """Groups of ids by walking both lists of ends."""
    a, b = libraries
    want = (" " + (text or "")).encode()
    if not text:
        return []
    byte = byte_of()
    first, second = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in first]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode() for i in second for p in [b.id_to_piece(i)]]
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return []
    groups, own, i, j, at, bt = [], ([], []), 0, 0, 0, 0
    while i < len(first) or j < len(second):
        if at <= bt and i < len(first):
            own[0].append(first[i])
            at, i = at + len(bytes_a[i]), i + 1
        else:
            own[1].append(second[j])
            bt, j = bt + len(bytes_b[j]), j + 1
        if at == bt:
            groups.append(own)
            own = ([], [])
    return groups


def brute(libraries, rows):
    groups = [groups_of(libraries, text) for _, text in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    weight = Counter(p for own in links for p in set(own))
    best = {}
    for (x, _), n in weight.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (doc, _), g, own in zip(rows, groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append(
            (doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own),
             sum(weight[p] == best[p[0]] for p in own), sum(weight[p] for p in own),
             hashlib.sha256(text.encode()).hexdigest() if g else "")
        )
    return sorted(out, key=repr)


def got(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_query_equals_brute_force(spark, small, texts, libraries):
    found = QUERIES["op11_token_alignment"].build(spark, small)
    assert got(found) == brute(libraries, list(texts.items()))


STRANGE = [
    "a \u2581 b", "\u2581", " ", "   ", "\n\n\n", "<s> </s> <unk> <|endoftext|>", "\x00\x01", "e\u0301 \ufb01 \uff21", "\u200b\ufeff x",
    "naïve 日本語 🙂👩‍👩‍👧", "0123456789" * 30, "x" * 4000, "  two  spaces  ", "\t\tif x:\n\t\t\treturn", "\r\n\r\n", "<0x0A>",
]


@pytest.mark.parametrize("run_bytes", [1, 8 << 20])
def test_odd_documents(spark, odd, libraries, monkeypatch, run_bytes):
    """Nulls, empty and long texts, repeated rows, texts that have no common bytes; many runs or one."""
    monkeypatch.setattr(alignment, "RUN_BYTES", run_bytes)
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(STRANGE)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionAll(more)
    assert got(alignment.weigh_links(docs)) == brute(libraries, [tuple(r) for r in docs.collect()])


def test_groups_and_pairs(spark, libraries):
    rows = [(1, "Hello tokenization, hello alignments"), (2, None)]
    found = {r.doc_id: r for r in alignment.align(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    groups = groups_of(libraries, rows[0][1])
    assert found[1].groups == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    pairs = np.frombuffer(found[1].pairs, "<i8")
    want = Counter((x << 32) | y for a, b in groups for x in a for y in b)
    assert dict(zip(pairs.tolist(), np.frombuffer(found[1].counts, "<i4").tolist())) == want
    assert found[2].groups == "" and found[2].pairs == b""


def test_empty_table(none):
    assert got(alignment.weigh_links(none)) == []


@given(st.lists(st.tuples(st.sets(st.integers(1, 60), max_size=60), st.sets(st.integers(1, 60), max_size=60)), min_size=1, max_size=5))
def test_cuts_are_all_common_ends(docs):
    """Ends of several documents in a row, each 61 bytes long."""
    a = [sorted(x | {61}) for x, _ in docs]
    b = [sorted(y | {61}) for _, y in docs]
    ends_a = np.array([61 * k + e for k, x in enumerate(a) for e in x])
    ends_b = np.array([61 * k + e for k, x in enumerate(b) for e in x])
    stops = np.cumsum([len(x) for x in a])
    cuts = alignment.shared_cuts(ends_a, ends_b, stops - [len(x) for x in a], stops - 1)
    assert ends_a[cuts].tolist() == sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
