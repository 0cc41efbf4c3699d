import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from placemat.llm import kneser_ney as kn
from placemat.llm.queries import QUERIES


class Slow:
    """The model from its definition, over tuples of bytes."""

    def __init__(self, texts):
        level = Counter()
        for t in texts:
            data = bytes(kn.ORDER - 1) + t
            level.update(tuple(data[i : i + kn.ORDER]) for i in range(len(t)))
        self.counts, self.off, self.total, self.mass = {}, {}, {}, {}
        for order in range(kn.ORDER, 0, -1):
            if order < kn.ORDER:
                level = Counter(g[1:] for g in level)
            n = Counter(level.values())
            off = {}
            for k in (1, 2, 3):
                y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
                usable = n[k] and n[1] + 2 * n[2]
                off[k] = min(max(k - (k + 1) * y * n[k + 1] / n[k] if usable else k / 2, 0), k)
            total, mass = defaultdict(int), defaultdict(float)
            for g, c in level.items():
                total[g[:-1]] += c
                mass[g[:-1]] += off[min(c, 3)]
            self.counts[order], self.off[order], self.total[order], self.mass[order] = dict(level), off, total, mass

    def p(self, gram):
        order = len(gram)
        if not order:
            return 1 / 256
        lower = self.p(gram[1:])
        total = self.total[order].get(gram[:-1])
        if not total:
            return lower
        c = self.counts[order].get(gram, 0)
        share = (c - self.off[order][min(c, 3)]) / total if c else 0
        return share + self.mass[order][gram[:-1]] / total * lower

    def log_p(self, text):
        data = bytes(kn.ORDER - 1) + text
        return sum(math.log(self.p(tuple(data[i : i + kn.ORDER]))) for i in range(len(text)))


@pytest.mark.parametrize("texts", [[b"", b"a", b"", b"abc"], [b"", b""], [b"x" * 9]])
def test_grams(texts):
    grams, sizes = kn.grams_of(texts)
    want = [int.from_bytes((bytes(kn.ORDER - 1) + t)[i : i + kn.ORDER], "big") for t in texts for i in range(len(t))]
    assert grams.tolist() == want and sizes.tolist() == [len(t) for t in texts]


def test_against_definition(spark):
    rng = random.Random(2)
    words = ["the", "quick", "brown", "fox", "ñandú", "and", "then", "some"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30))), "en") for i in range(60)]
    rows += [(100, "QX!! 99 zz", "en"), (101, "", "en"), (102, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(40)], "doc_id long")
    counted = {r.doc_id for r in trusted.where(~kn.held_back(trusted["doc_id"])).collect()}
    slow = Slow([t.encode() for i, t, _ in rows if i in counted])
    got = {r.doc_id: r for r in kn.classify(docs, trusted).collect()}
    for i, text, _ in rows:
        data = (text or "").encode()
        assert got[i].n_bytes == len(data)
        assert got[i].log_p == pytest.approx(slow.log_p(data), rel=1e-5, abs=1e-5)
    # Probabilities of all bytes after a context add up to one.
    for context in ((0, 0, 0), tuple(b"the"), tuple(b"zzz"), tuple(b" fo")):
        assert sum(slow.p((*context, w)) for w in range(256)) == pytest.approx(1)
    assert not got[100].kept and got[101].kept and got[102].kept
    assert np.mean([got[i].kept for i in range(60)]) > 0.95


def test_keeps_good_documents_and_drops_junk(spark):
    sf = "/root/testdata/sf0.01"
    judged = QUERIES["op7_quality_perplexity"].build(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    share = {r.quality: r.kept for r in judged.join(labels, "doc_id").groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "kept").collect()}
    kept = {r.quality: r["count"] for r in judged.join(labels, "doc_id").where("kept").groupBy("quality").count().collect()}
    assert kept[1] / share[1] > 0.98 and kept.get(0, 0) / share[0] < 0.3


def test_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 0), (8, 1, None), (9, 0, 0), (11, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    trusted = kn.trusted_ids(labels)
    assert kn.classify(odd, trusted).count() == odd.count()
    assert kn.classify(none, trusted).count() == 0
    untaught = kn.classify(odd, trusted.where("false"))
    assert untaught.where("kept and threshold is null").count() == odd.count()
