import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from placemat.llm import suffix_dedup
from placemat.llm.queries import QUERIES


def brute(rows, width):
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(t[i : i + width] for _, t in texts for i in range(len(t) - width + 1))
    out = []
    for doc, t in texts:
        gone = bytearray(len(t))
        upto = 0
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                begin = max(i, upto)
                gone[begin : i + width] = b"\1" * (i + width - begin)
                upto = i + width
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((doc, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_query_equals_brute_force(spark, small, texts):
    found = got(QUERIES["op12_suffix_dedup"].build(spark, small))
    assert found == brute(list(texts.items()), suffix_dedup.WIDTH)
    assert any(0 < r[2] < r[1] for r in found)


def test_odd_documents(spark, odd, none):
    """Nulls, empty texts, texts that repeat within themselves, repeated rows, other columns."""
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(suffix_dedup.remove_repeats(odd)) == brute(rows, suffix_dedup.WIDTH)
    assert got(suffix_dedup.remove_repeats(none)) == []


def passages(n, seed, around):
    """Documents that share a passage with edits, ends cut off, or other bytes right before and after it."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefgé ") for _ in range(k))
    passage, rows = word(1500), []
    for i in range(n):
        own = passage
        if i % 5 == 1:
            cut = rng.randrange(len(own))
            own = own[:cut] + "#" + own[cut + 1 :]
        if i % 5 == 2:
            own = own[rng.randrange(500) :]
        if i % 5 == 3:
            own = own[: rng.randrange(400, 1500)]
        rows.append((i, word(rng.randrange(around)) + own + word(rng.randrange(around))))
    return rows


@pytest.mark.parametrize("crew", [1, 3, 256])
def test_crowded_anchors_are_split(spark, monkeypatch, crew):
    """Hundreds of documents share a passage that begins and ends differently in each."""
    rows = passages(150, 1, 600) + [(1000 + i, "ab" * 400 + str(i)) for i in range(8)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(suffix_dedup, "CREW", crew)
        found = suffix_dedup.remove_repeats(frame(spark, rows))
    assert got(found) == brute(rows, suffix_dedup.WIDTH)


def test_anchors_shared_by_chance_reach_no_suffix_array(spark, monkeypatch):
    """Texts that share sentences, but no 400 bytes in a row, are told apart by hashes alone."""
    rng = random.Random(3)
    line = lambda k: "".join(rng.choice("abcdefg ") for _ in range(k))
    shared = [line(150) for _ in range(4)]
    rows = [(i, "".join(line(200) + s for s in shared * 3)) for i in range(30)]
    asked, whole = [], suffix_dedup.piece_repeats

    def counted(pieces, *more):
        asked.append(pieces.count())
        return whole(pieces, *more)

    monkeypatch.setattr(suffix_dedup, "piece_repeats", counted)
    assert got(suffix_dedup.remove_repeats(frame(spark, rows))) == brute(rows, suffix_dedup.WIDTH)
    assert asked == [0]


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 997)
    rows = passages(40, 2, 5000)
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]
    first, windows, _, _ = suffix_dedup.segments(np.concatenate(data), np.cumsum([len(d) for d in data]))
    starts = np.concatenate([np.arange(a, a + n) for a, n in zip(first, windows, strict=True)])
    ends = np.cumsum([len(d) for d in data])
    want = [np.arange(e - len(d), e - suffix_dedup.WIDTH + 1) for d, e in zip(data, ends, strict=True)]
    assert np.array_equal(np.sort(starts), np.concatenate(want))


@given(st.lists(st.text("ab", min_size=1, max_size=40), min_size=1, max_size=6), st.integers(1, 5))
def test_maximal_repeats(pieces, least):
    """Every group has all occurrences, cannot be grown on either side, and none is missing."""
    pieces = [p.encode() for p in pieces]
    suffix, common, piece, before = suffix_dedup.suffix_array(pieces, np.array([*map(len, pieces)]))
    begins = np.cumsum([0, *map(len, pieces)])
    text_at = lambda i: pieces[piece[i]][suffix[i] - begins[piece[i]] :]
    for i in range(1, len(suffix)):
        a, b = text_at(i - 1), text_at(i)
        assert a <= b
        shared = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common[i] == shared
    found = {}
    for length, a, b in suffix_dedup.maximal_repeats(common, before, least):
        places = sorted((int(piece[i]), int(suffix[i] - begins[piece[i]])) for i in range(a, b + 1))
        assert text_at(a)[:length] not in found
        found[text_at(a)[:length]] = places
    want = {}
    for k, p in enumerate(pieces):
        for i in range(len(p)):
            for j in range(i + least, len(p) + 1):
                want.setdefault(p[i:j], []).append((k, i))
    maximal = {}
    for s, places in want.items():
        left = {pieces[k][i - 1] if i else (k, "start") for k, i in places}
        right = {pieces[k][i + len(s)] if i + len(s) < len(pieces[k]) else (k, "end") for k, i in places}
        starts = any(i == 0 for _, i in places)
        if len(places) > 1 and (len(left) > 1 or starts) and (len(right) > 1):
            maximal[s] = sorted(places)
    assert found == maximal
