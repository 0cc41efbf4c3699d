import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from placemat.llm import components, simhash
from placemat.llm.queries import QUERIES


def slow_simhash(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(edges, nodes):
    """Smallest node reachable from each, by plain search."""
    near = {n: set() for n in nodes}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        stack = [n]
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = n
                stack += near[x]
    return out


def brute(fps):
    """Component by document, for fingerprints by document."""
    ids = sorted(fps)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 3]
    return reach(edges, ids)


def test_query(spark, small, texts):
    got = {r.doc_id: r for r in QUERIES["op9_simhash"].build(spark, small).collect()}
    fps = {d: slow_simhash(t) for d, t in texts.items()}
    assert {d: int(r.fingerprint, 16) for d, r in got.items()} == fps
    assert {d: r.component_id for d, r in got.items()} == brute(fps)


@pytest.mark.parametrize("cell", [4096, 7])
@pytest.mark.parametrize("levels", [1, 4])
def test_all_links_are_found(spark, monkeypatch, cell, levels):
    """Clusters, chains and lone points; with small cells a crowded shard is split."""
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(3)
    points = set()
    for _ in range(12):
        p = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 30])):
            points.add(p)
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << bit
    points = sorted(points | {0, 1, 7, 2**64 - 1, 2**63})
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), levels).collect()
    for r in links:
        assert (r.a ^ r.b) != 0
    got = reach([(r.a, r.b) for r in links], signed)
    pairs = [(signed[i], signed[j]) for i, a in enumerate(points) for j in range(i) if (a ^ points[j]).bit_count() <= 3]
    assert got == reach(pairs, signed)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)] + [(7, 7)]
    found = components.smallest_reachable(spark.createDataFrame(edges, "a long, b long"))
    want = {n: s for n, s in reach(edges, {x for e in edges for x in e}).items() if n != s}
    assert {r.node: r.smallest for r in found.collect()} == want


def test_odd_documents(odd, none):
    rows = simhash.near_groups(odd).collect()
    assert len(rows) == odd.count()
    blank = {r.doc_id for r in rows if r.fp == 0}
    assert {0, 1, 2, None} <= blank and {r.component_id for r in rows if r.fp == 0} == {0}
    assert simhash.near_groups(none).count() == 0


def test_native_hash_is_the_same(spark):
    found = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first().h
    assert found % 2**64 == xxhash.xxh64_intdigest(b"a b c", seed=42)
