import base64
import math
import random

import numpy as np
from pyspark.sql import functions as F

from placemat.llm import langid
from placemat.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op5_language_id"].build(spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").where("lang is not null")
    scored = found.join(truth, "doc_id").where("held_out").agg(
        F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
        F.min("score").alias("lo"), F.max("score").alias("hi"),
    ).first()
    assert scored.n > 250 and scored.right > 0.97 and 0 <= scored.lo <= scored.hi <= 1


def test_whole_text_counts():
    rng = np.random.default_rng(1)
    model = langid.train(["aeiou " * 40, "xyzqw " * 40] * 20, ["v", "c"] * 20)
    v, c = "aeiou " * 400, "xyzqw " * 100
    scores = langid.document_scores(model, [v, c, c + v, v + c, c * 9 + v[:50]])[:, :-1]
    assert [model.langs[k] for k in scores.argmax(axis=1)] == ["v", "c", "v", "v", "c"]
    # A long text is the mean of its windows.
    data = "".join(rng.choice(list("aexq "), 5 * langid.LENGTH))
    parts = [data[i : i + langid.LENGTH] for i in range(0, len(data), langid.LENGTH)]
    assert np.allclose(langid.document_scores(model, [data])[0], langid.document_scores(model, parts).mean(axis=0))


def test_odd_documents(spark, odd, none):
    found = langid.predict(odd, langid.fit(odd))
    rows = found.collect()
    assert len(rows) == odd.count()
    for r in rows:
        readable = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not readable) and 0 <= r.score <= 1
    kept = langid.keep_known(odd, langid.fit(odd))
    assert kept.columns == odd.columns
    assert all(any(c.isalpha() for c in r.text or "") for r in kept.collect())
    assert langid.fit(none) is None and langid.predict(none, None).count() == 0
    unlearnt = langid.predict(odd, None).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in unlearnt] == [("und", 0.0)]


def slow_probabilities(model, text):
    """Mean over the windows of a text of the softmax of the largest filter responses, byte by byte."""
    data, windows = text.lower().encode(), []
    for at in range(0, len(data), langid.LENGTH):
        window = data[at : at + langid.LENGTH].ljust(langid.LENGTH, b"\0")
        widest, pooled, f = max(langid.WIDTHS), [], 0
        for width, count in langid.WIDTHS.items():
            for _ in range(count):
                best = max(
                    sum(
                        float(model.embed[window[place + w], e] * model.filters[w * langid.EMBED + e, f])
                        for w in range(width)
                        for e in range(langid.EMBED)
                    )
                    for place in range(langid.LENGTH - widest + 1)
                )
                pooled.append(max(best + float(model.bias[f]), 0))
                f += 1
        logits = [sum(p * float(model.out[f, k]) for f, p in enumerate(pooled)) + float(b) for k, b in enumerate(model.out_bias)]
        most = max(logits)
        shares = [math.exp(x - most) for x in logits]
        windows.append([x / sum(shares) for x in shares])
    return [sum(w[k] for w in windows) / len(windows) for k in range(len(model.langs) + 1)]


def test_network_against_plain_loops():
    model = langid.train(["aeiou " * 40, "xyzqw " * 40] * 10, ["v", "c"] * 10)
    texts = ["aeiou xyzqw", "Ünïcode aei " * 30, "q"]
    found = langid.document_scores(model, texts)
    assert np.allclose(found, [slow_probabilities(model, t) for t in texts], atol=1e-4)


def test_gradient_step_lowers_the_loss(monkeypatch):
    texts, labels = ["aeiou " * 40, "xyzqw " * 40] * 10, ["v", "c"] * 10
    losses = []
    for steps in (1, 40, 400):
        monkeypatch.setattr(langid, "STEPS", steps)
        model = langid.train(texts, labels)
        right = [model.langs.index(v) for v in labels]
        losses.append(-np.log(langid.document_scores(model, texts)[np.arange(len(texts)), right]).mean())
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.05


def test_rejects_text_in_no_language(spark):
    """Noise goes, text in a script that was not learnt goes, documents of the given tables stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rng = random.Random(3)

    def kept(texts):
        frame = spark.createDataFrame([(t,) for t in texts], "text string")
        return langid.keep_known(frame, model).count() / len(texts)

    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [" ".join("".join(rng.choices(letters, k=rng.randint(2, 10))) for _ in range(rng.randint(5, 80))) for _ in range(300)]
    assert kept(words) < 0.02
    assert kept([base64.b64encode(rng.randbytes(rng.randint(30, 400))).decode() for _ in range(300)]) < 0.02
    assert kept([rng.randbytes(rng.randint(30, 400)).hex() for _ in range(300)]) < 0.02
    # Fixed value: sentences of languages and scripts that the labels do not have.
    foreign = [
        "Все люди рождаются свободными и равными в своём достоинстве и правах.",
        "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心。",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
    ]
    assert kept(foreign) == 0
    readable = docs.filter(F.col("text").rlike(r"\p{L}"))
    assert langid.keep_known(readable, model).count() > 0.99 * readable.count()
    # A text in two of the languages is in a language.
    pairs = [r.text for r in docs.filter("lang in ('en', 'fr') and length(text) between 600 and 3000").orderBy("doc_id").limit(40).collect()]
    assert kept([a + "\n" + b for a, b in zip(pairs[::2], pairs[1::2], strict=True)]) == 1
