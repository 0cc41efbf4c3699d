import random

import corpus_pipeline
import pytest

from placemat.llm import shingles, simhash


def runs(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    """Smallest id that pairs of Jaccard similarity 0.8 or more reach, by comparing all."""
    sets, label = {d: runs(t) for d, t in texts.items()}, {d: d for d in texts}
    ids = sorted(texts)
    pairs = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    while any(label[a] != label[b] for a, b in pairs):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


def edited(seed):
    """Texts, copies with some words changed anywhere, chains of them and words in other orders."""
    rng, texts = random.Random(seed), []
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    for _ in range(25):
        text = rng.choices(words, k=rng.choice([3, 8, 40, 120, 400]))
        for _ in range(rng.choice([1, 2, 8])):
            texts.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 40))):
                text[rng.randrange(len(text))] = rng.choice(words)
    return dict(enumerate([*texts, None, "", " ", "One", "one"]))


@pytest.mark.parametrize("cell", [shingles.CELL_BYTES, 3000])
def test_stage_drops_what_is_similar(spark, monkeypatch, cell):
    """Equal to brute force; with small cells a large group is split."""
    monkeypatch.setattr(shingles, "CELL_BYTES", cell)
    texts = edited(5)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute(texts)
    assert {r.doc_id: r.component_id for r in shingles.similar_groups(docs).collect()} == want
    assert len({*want.values()}) < len(texts) - 20
    left = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left) == sorted({*want.values()})


def test_fingerprints_find_candidates(spark):
    """The trees alone, without MinHash, join just the sets whose fingerprints differ by three bits or fewer."""
    texts, rng = edited(6), random.Random(6)
    for _ in range(8):
        long = rng.choices(texts[0].split() + [f"w{i}" for i in range(500)], k=3000)
        for last in ("x", "y", "z"):
            texts[len(texts)] = " ".join([*long, last])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    distinct = shingles.signatures(docs).dropDuplicates(["node"])
    sets = [shingles.shingle_set((t or "").encode()) for t in texts.values()]
    fps = {shingles.node_of(s): simhash.majority(s) for s in sets if len(s)}
    want = {frozenset((a, b)) for a in fps for b in fps if a != b and (fps[a] ^ fps[b]).bit_count() <= 3}
    edges = [(r.a, r.b) for r in shingles.fingerprint_edges(distinct).collect()]
    assert want and edges

    def components(pairs):
        label = {n: n for n in fps}
        while any(label[a] != label[b] for a, b in pairs):
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert components(edges) == components([tuple(p) for p in want])


def test_odd_documents(odd, none):
    got = shingles.similar_groups(odd).collect()
    assert len(got) == odd.count() and {0, 1, 2} <= {r.doc_id for r in got if r.component_id == 0}
    assert shingles.similar_groups(none).count() == 0
