"""Language identification by a byte convolutional network.

Bytes of the lower-cased text are embedded; filters of several widths slide over a window of fixed length; each
keeps its largest response; a softmax layer reads them. The network is trained in numpy on the driver, on a sample
of at most SAMPLE documents per language, of which at most SNIPPET code points from the middle are used. It is then
applied to all windows of the whole text, in batches, and a document's score is the mean over its windows.

Beside the languages the network learns one class of text in none of them, from noise that is made of the sample
itself and at random (``_noise``), so that a text can be rejected. Rejection goes by the share of that class alone, so a
text in two of the languages is none of them's for certain and yet accepted. The limit of each language is set by documents of the
sample that were not trained on.

A text that is null or has no letter is ``und`` with score 0. With nothing to learn from, every text is. Rows
without a key are never learnt from. Repeated rows get equal results; an empty table an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from placemat.llm.blocks import release
from placemat.llm.tokens import slices

UNKNOWN = "und"
SAMPLE = 400
SNIPPET = 2000
#: Documents a batch of windows may hold, as windows.
WINDOWS_AT_ONCE = 256
LENGTH = 256
EMBED = 8
WIDTHS = {2: 12, 3: 12, 4: 12}
STEPS = 700
BATCH = 64
CROPS = 6
RATE = 4e-3
#: Noise windows per training document, and the one document of so many that is kept from training to set limits.
NOISE_CROPS = 2
CHECKED = 5
#: Limits are this share of the least probability, of all languages together, of such a document, within these bounds.
LIMIT_SHARE = 0.8
LIMIT_BOUNDS = (0.2, 0.5)


class Model(NamedTuple):
    langs: list[str]
    embed: np.ndarray  # byte x EMBED
    filters: np.ndarray  # widest * EMBED x filters
    bias: np.ndarray
    out: np.ndarray  # filters x (languages, then the class of other text)
    out_bias: np.ndarray
    limits: np.ndarray  # per language, the least probability of all languages together


def held_out(key: Column) -> Column:
    """Documents never learnt from: crc32 of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def as_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)


def _mask() -> np.ndarray:
    """1 where a filter has a weight: filters narrower than the widest see its first bytes only."""
    widest = max(WIDTHS)
    seen = [np.arange(widest * EMBED) < w * EMBED for w, n in WIDTHS.items() for _ in range(n)]
    return np.array(seen, np.float32).T


def _patches(embedded: np.ndarray) -> np.ndarray:
    """windows x positions x (widest * EMBED)."""
    n, length, _ = embedded.shape
    flat = np.ascontiguousarray(embedded).reshape(n, length * EMBED)
    wide = max(WIDTHS) * EMBED
    return np.lib.stride_tricks.sliding_window_view(flat, wide, axis=1)[:, ::EMBED]


def _responses(model: Model, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    patches = np.ascontiguousarray(_patches(model.embed[windows]))
    n, places, wide = patches.shape
    return patches, (patches.reshape(-1, wide) @ model.filters).reshape(n, places, -1)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def window_scores(model: Model, windows: np.ndarray) -> np.ndarray:
    """Probability of each language and, last, of other text, per window of LENGTH bytes."""
    _, responses = _responses(model, windows)
    pooled = np.maximum(responses.max(axis=1) + model.bias, 0)
    return _softmax(pooled @ model.out + model.out_bias)


def _crops(text: str, rng: np.random.Generator) -> np.ndarray:
    """Windows at random places, some short, so that short texts are learnt as well."""
    data = as_bytes(text)
    rows = np.zeros((CROPS, LENGTH), np.uint8)
    for row in rows:
        length = int(min(len(data), LENGTH if rng.random() < 0.6 else rng.integers(8, LENGTH)))
        at = int(rng.integers(0, len(data) - length + 1))
        row[:length] = data[at : at + length]
    return rows


def _noise(text: str, rng: np.random.Generator) -> str:
    """Text in no language: the code points of ``text`` in another order, or letters drawn alike from a small or a
    large alphabet, or from a stretch of the code points of any script, in one run or in words."""
    kind, n = int(rng.integers(0, 4)), LENGTH
    if kind == 0:
        return "".join(rng.permutation(list(text[: 4 * n])))
    if kind == 1:
        letters = [c for c in set(text.lower()) if c.isalpha()] or ["x"]
    elif kind == 2:
        letters = list("abcdefghijklmnopqrstuvwxyz0123456789+/=_-")
    else:
        start = int(rng.integers(0x250, 0xD700))
        letters = [chr(c) for c in range(start, start + int(rng.integers(20, 200)))]
    drawn = rng.choice(letters, n)
    if rng.random() < 0.6:
        drawn[rng.random(n) < 1 / rng.integers(3, 12)] = " "
    return "".join(drawn)


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Fit by Adam on softmax loss; one document of CHECKED per language sets its limit, where it has so many."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    seen_so_far: dict[str, int] = {}
    checks: list[int] = []
    for i, label in enumerate(labels):
        seen_so_far[label] = seen_so_far.get(label, 0) + 1
        if seen_so_far[label] % CHECKED == 0:
            checks.append(i)
    learnt = sorted(set(range(len(texts))) - set(checks))
    model = _fitted([texts[i] for i in learnt], [langs.index(labels[i]) for i in learnt], langs, rng)
    lowest, highest = LIMIT_BOUNDS
    limits = np.full(len(langs), lowest)
    if checks:
        own = np.array([langs.index(labels[i]) for i in checks])
        scores = 1 - document_scores(model, [texts[i] for i in checks])[:, -1]
        for k in range(len(langs)):
            if (own == k).any():
                limits[k] = np.clip(LIMIT_SHARE * scores[own == k].min(), lowest, highest)
    return model._replace(limits=limits)


def _fitted(texts: list[str], labels: list[int], langs: list[str], rng: np.random.Generator) -> Model:
    mask = _mask()
    classes = len(langs) + 1
    wide, count = mask.shape
    model = Model(
        langs,
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        (rng.normal(0, wide**-0.5, mask.shape) * mask).astype(np.float32),
        np.zeros(count, np.float32),
        rng.normal(0, count**-0.5, (count, classes)).astype(np.float32),
        np.zeros(classes, np.float32),
        np.zeros(len(langs)),
    )
    noise = [_crops(_noise(t, rng), rng)[:1] for t in texts for _ in range(NOISE_CROPS)]
    x = np.concatenate([*[_crops(t, rng) for t in texts], *noise])
    y = np.concatenate([np.repeat(labels, CROPS), np.full(len(noise), classes - 1)])
    params = list(model[1:-1])
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(x), BATCH)
        windows = x[pick]
        patches, responses = _responses(model, windows)
        best = responses.argmax(axis=1)  # window x filter
        rows = np.arange(BATCH)[:, None]
        pooled = responses[rows, best, np.arange(count)[None, :]] + model.bias
        active = np.maximum(pooled, 0)
        error = _softmax(active @ model.out + model.out_bias)
        error[np.arange(BATCH), y[pick]] -= 1
        error /= BATCH
        back = (error @ model.out.T) * (pooled > 0)
        chosen = patches[rows, best]  # window x filter x wide
        to_filters = np.einsum("bf,bfw->wf", back, chosen) * mask
        to_bytes = (back[:, :, None] * model.filters.T[None]).reshape(BATCH, count, -1, EMBED)
        seen = windows[rows[:, :, None], best[:, :, None] + np.arange(max(WIDTHS))]
        to_embed = np.zeros_like(model.embed)
        np.add.at(to_embed, seen.reshape(-1), to_bytes.reshape(-1, EMBED))
        grads = [to_embed, to_filters, back.sum(0), active.T @ error, error.sum(0)]
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def training_rows(docs: DataFrame, key: str, text: str, lang: str, sample: int = SAMPLE) -> DataFrame:
    """``lang, snippet`` of the sample: per language the documents whose key has the smallest hashes."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.filter(F.col(text).rlike(r"\p{L}"))
    start = F.greatest(F.lit(1), F.floor((F.length(text) - SNIPPET) / 2).cast("int"))
    cut = known.select(
        F.col(lang).alias("lang"),
        F.xxhash64(key).alias("h"),
        F.substring(F.col(text), start, F.lit(SNIPPET)).alias("snippet"),
    )
    order = Window.partitionBy("lang").orderBy("h", "snippet")
    ranked = cut.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample)
    return ranked.select("lang", "rank", "snippet")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model | None:
    """A model of the languages the sample has, or None. At most ``sample`` snippets per language are collected."""
    rows = sorted(training_rows(docs, key, text, lang, sample).collect())
    return train([r["snippet"] for r in rows], [r["lang"] for r in rows]) if rows else None


def document_scores(model: Model, texts: list[str]) -> np.ndarray:
    """Mean probabilities of ``window_scores`` over the windows of each text; texts are not empty."""
    total = np.zeros((len(texts), len(model.langs) + 1))
    counts = np.zeros(len(texts))
    held, owners, size = [], [], 0

    def apply() -> None:
        nonlocal held, owners, size
        windows, owner = np.concatenate(held), np.concatenate(owners)
        for at in range(0, len(windows), WINDOWS_AT_ONCE):
            np.add.at(total, owner[at : at + WINDOWS_AT_ONCE], window_scores(model, windows[at : at + WINDOWS_AT_ONCE]))
        held, owners, size = [], [], 0

    for i, text in enumerate(texts):
        data = as_bytes(text)
        n = -(-len(data) // LENGTH)
        windows = np.zeros(n * LENGTH, np.uint8)
        windows[: len(data)] = data
        held.append(windows.reshape(n, LENGTH))
        owners.append(np.full(n, i))
        counts[i] = n
        size += n
        if size >= 8 * WINDOWS_AT_ONCE:
            apply()
    if held:
        apply()
    return total / np.maximum(counts, 1)[:, None]


def _with_scores(docs: DataFrame, model: Model | None, text: str) -> DataFrame:
    """``docs`` with ``__language``: the likeliest language, its score, and whether the text is in a language at all, by
    the limit of the likeliest. Only the text goes to Python, in small slices."""
    if model is None:
        unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("known"))
        return docs.withColumn("__language", unknown)

    @F.arrow_udf("lang string, score double, known boolean")
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            langs, scores, knowns = [], [], []
            for few in slices(pa.RecordBatch.from_arrays([batch], ["text"]), "text"):
                texts = few.column("text").to_pylist()
                some = [i for i, t in enumerate(texts) if t]
                found = document_scores(model, [texts[i] for i in some])
                found, other = found[:, :-1], found[:, -1].tolist()
                lang, score, known = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
                best, top = found.argmax(axis=1).tolist(), found.max(axis=1, initial=0.0).tolist()
                for i, k, p, rest in zip(some, best, top, other, strict=True):
                    lang[i], score[i], known[i] = model.langs[k], min(p, 1.0), bool(1 - rest >= model.limits[k])
                langs += lang
                scores += score
                knowns += known
            columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(knowns, pa.bool_())]
            yield pa.StructArray.from_arrays(columns, ["lang", "score", "known"])
            del batch
            release()

    readable = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn("__language", classify(F.when(readable, F.col(text))))


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    found = _with_scores(docs, model, text)
    return found.withColumns({"lang_pred": F.col("__language.lang"), "score": F.col("__language.score")}).drop("__language")


def keep_known(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents that are in one of the languages, or in several; columns as they came."""
    return _with_scores(docs, model, text).filter(F.col("__language.known")).select(*docs.columns)
