import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from placemat.llm import packing
from placemat.llm.queries import QUERIES
from placemat.llm.tokens import END_ID, VOCABULARY


def fewest(lengths, capacity):
    """Least number of sequences, by search."""

    @lru_cache(None)
    def go(left):
        if not left:
            return 0
        first, rest = left[-1], left[:-1]
        best = len(left)

        def fill(room, items, chosen):
            nonlocal best
            options = sorted({x for x in items if x <= room}, reverse=True)
            if not options:
                best = min(best, 1 + go(tuple(items)))
                return
            for x in options:
                if chosen and x > chosen[-1]:
                    continue
                i = items.index(x)
                fill(room - x, items[:i] + items[i + 1 :], [*chosen, x])
                best = min(best, 1 + go(tuple(items))) if not chosen else best

        fill(capacity - first, list(rest), [])
        return best

    return go(tuple(sorted(lengths)))


def histogram(lengths):
    return {s: lengths.count(s) for s in set(lengths)}


@pytest.mark.parametrize("seed", range(40))
def test_reduction_loses_nothing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 30])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    counts = [lengths.count(s) for s in range(capacity + 1)]
    fixed = packing.reduce(counts, capacity)
    left = [s for s, n in enumerate(counts) for _ in range(n)]
    taken = [s for g in fixed for s in g.lengths for _ in range(g.count)]
    assert sorted(left + taken) == sorted(lengths) and all(sum(g.lengths) <= capacity for g in fixed)
    assert sum(g.count for g in fixed) + fewest(left, capacity) == fewest(lengths, capacity)


@pytest.mark.parametrize("seed", range(10))
def test_solution_holds_every_piece_once(seed):
    rng = random.Random(seed)
    lengths = [min(1024, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(20000)]
    groups = packing.solve(histogram(lengths))
    assert all(sum(g.lengths) <= 1024 for g in groups)
    assert sorted(s for g in groups for s in g.lengths for _ in range(g.count)) == sorted(lengths)
    places = packing.Places(groups)
    seen = set()
    for s, n in histogram(lengths).items():
        sequence, offset = places.find(np.full(n, s), np.arange(n))
        seen |= {(a, b + k) for a, b in zip(sequence.tolist(), offset.tolist()) for k in (0, s - 1)}
    assert places.sequences <= 1.01 * max(sum(lengths) / 1024, sum(x > 512 for x in lengths)) + 1
    assert len(seen) >= len(lengths)


def check(rows, texts):
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    sequences, total = {}, 0
    got = sorted((r.doc_id is None, r.doc_id, r.start, r.length, r.crc) for r in rows)
    want = []
    for doc, text in texts:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [END_ID], "<u4")
        total += len(ids)
        cuts = sorted({0, *range(len(ids), 0, -1024), len(ids)})
        for a, b in zip(cuts, cuts[1:]):
            want.append((doc is None, doc, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert got == sorted(want)
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        ends = np.cumsum([0, *[n for _, n in held]]).tolist()
        assert [o for o, _ in held] == ends[:-1] and ends[-1] <= 1024
    return len(sequences), total


def test_query(spark, small, texts):
    rows = QUERIES["op10_best_fit_packing"].build(spark, small).withColumnRenamed("ids_crc32", "crc").collect()
    count, total = check(rows, texts.items())
    assert count <= 1.03 * total / 1024 + 1


def test_odd_documents(odd, none):
    rows = packing.pack_documents(odd).selectExpr("*", "crc32(ids) AS crc").collect()
    check(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack_documents(none).count() == 0
