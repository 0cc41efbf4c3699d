"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over bytes, of order ORDER: a text's n-grams are its bytes with ORDER - 1 zero bytes before the first.
Trusted documents are counted in blocks, and the counts of each n-gram meet in its bucket. Lower orders
count continuations. Every order has its three discounts, of the numbers of n-grams seen once to four times.

To score, a block asks once for each distinct n-gram it holds. All asked n-grams of the corpus are joined, order by
order, to the count tables, and the probabilities go back to the blocks that asked. An n-gram has at most 256
continuations, so no join key is hot.

A fifth of the trusted documents is kept out of the counts and sets the thresholds: per language, SLACK times the QUANTILE
of their perplexities. So that a few words decide nothing, a text counts as PRIOR bytes longer, at its language's
mean. A language with fewer than LEAST_DOCS such documents, or null, takes the threshold of all. Without trusted
text every document is kept, with null perplexity and threshold; so is an empty or null text of no language's mean.

Repeated rows are scored each. Documents without a key are scored but never trusted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.llm.blocks import block_number, blocks_of, packed_blocks, release, squeeze, unpack_rows, unsqueeze
from placemat.llm.core import shuffle_partitions
from placemat.scratch import stage

ORDER = 4
QUANTILE = 0.99
SLACK = 1.25
PRIOR = 100
LEAST_DOCS = 30
HELD_BACK = 5  # one trusted document of so many sets thresholds
GRAM = np.dtype("<u4")


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of all texts in a row, as numbers of ORDER bytes, and the number of each text's."""
    pad = bytes(ORDER - 1)
    data = np.frombuffer(pad.join([b"", *texts]), np.uint8).astype(GRAM)
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return np.empty(0, GRAM), sizes
    grams = np.zeros(len(data) - ORDER + 1, GRAM)
    for k in range(ORDER):
        grams = (grams << 8) | data[k : k + len(grams)]
    # A text's n-grams end at its own bytes; those that end in the zeros before it fall away.
    own = np.repeat(np.arange(len(texts)), sizes)
    return grams[np.arange(len(own)) + (ORDER - 1) * own], sizes


def bucket_of(gram, buckets: int):
    """Of numpy arrays; ``bucket_column`` is the same for columns."""
    return (gram ^ (gram >> 15)) % buckets


def bucket_column(gram: Column, buckets: int) -> Column:
    return F.pmod(gram.bitwiseXOR(F.shiftright(gram, 15)), F.lit(buckets)).cast("int")


def _by_bucket(block: int, grams: np.ndarray, extra: list[np.ndarray], buckets: int) -> list[tuple[int, int, bytes]]:
    """Rows ``block, bucket, payload`` of sorted distinct n-grams and columns beside them."""
    bucket = bucket_of(grams, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
    rows = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            some = order[a:b]
            steps = np.diff(grams[some].astype(np.int64), prepend=0).astype(GRAM)
            rows.append((block, int(bucket[some[0]]), squeeze(b"".join(x.astype(GRAM).tobytes() for x in (steps, *(e[some] for e in extra))))))
    return rows


def _unpacked(payload: bytes, columns: int) -> list[np.ndarray]:
    """The n-grams of a payload, then its other columns."""
    rows = np.frombuffer(unsqueeze(payload), GRAM).reshape(columns, -1)
    return [np.cumsum(rows[0], dtype=np.int64), *rows[1:]]


def _lists(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("block", "bucket", "payload"), columns, kinds, strict=True)})


def held_back(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(HELD_BACK)) == 0


def count_grams(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``gram, n`` over the documents (``doc_id, text``) whose key ``trusted`` has and that are not held back."""
    buckets = blocks_of(docs)

    def count(own: pa.Table, ids: pa.Table) -> pa.Table:
        release()
        rows = unpack_rows(own.column("payload"))
        if rows is None or not ids.num_rows:
            return _lists([])
        known = set(ids.column("doc_id").to_pylist())
        pairs = zip(rows.column("doc_id").to_pylist(), rows.column("text").cast(pa.binary()), strict=True)
        texts = [t.as_py() or b"" for i, t in pairs if i in known]
        grams, n = np.unique(grams_of(texts)[0], return_counts=True)
        return _lists(_by_bucket(int(ids.column("block")[0].as_py()), grams, [n], buckets))

    def total(group: pa.Table) -> pa.Table:
        release()
        parts = [_unpacked(p, 2) for p in group.column("payload").to_pylist()]
        grams, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        return pa.table({"gram": grams, "n": n})

    ids = trusted.filter(F.col("doc_id").isNotNull() & ~held_back(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id")
    ).distinct()
    ids = ids.withColumn("block", block_number(docs, F.col("doc_id")))
    blocks = packed_blocks(docs.select("doc_id", "text"), "doc_id")
    lists = blocks.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(
        count, "block int, bucket int, payload binary"
    )
    return lists.groupBy("bucket").applyInArrow(total, "gram long, n long")


def _discount(n: Column, k: int) -> Column:
    """Discount of n-grams seen k times (3: or more), from the numbers ``n1`` to ``n4`` of n-grams seen so often."""
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    value = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
    usable = (F.col(f"n{k}") > 0) & (F.col("n1") + 2 * F.col("n2") > 0)
    # Counts of counts of small texts may have gaps; half of the count is then taken off.
    return F.least(F.greatest(F.coalesce(F.when(usable, value), F.lit(k / 2)), F.lit(0.0)), F.lit(float(k)))


class Model:
    """Per order: ``gram, alpha`` (discounted share of its context) and ``context, gamma`` (weight of the next order)."""

    def __init__(self, alphas: dict[int, DataFrame], gammas: dict[int, DataFrame]):
        self.alphas, self.gammas = alphas, gammas


def build(counts: DataFrame) -> Model:
    """The model of written counts ``gram, n``. Per order, four counts of counts reach the driver."""
    alphas, gammas, level = {}, {}, counts
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            cut = F.col("gram").bitwiseAND(F.lit((1 << (8 * order)) - 1))
            level = stage(level.groupBy(cut.alias("gram")).agg(F.count("*").alias("n")), "continuations")
        seen = level.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in range(1, 5)])
        found = seen.na.fill(0).select(*[_discount(F.col("n"), k).alias(f"d{k}") for k in (1, 2, 3)]).first()
        off = F.when(F.col("n") == 1, found["d1"]).when(F.col("n") == 2, found["d2"]).otherwise(found["d3"])
        terms = level.select("gram", F.shiftright("gram", 8).alias("context"), "n", off.alias("off"))
        sums = terms.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("gamma"))
        gammas[order] = sums.select("context", "gamma")
        alphas[order] = terms.join(sums, "context").select("gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("alpha"))
    return Model(alphas, gammas)


def probabilities(model: Model, asked: DataFrame) -> DataFrame:
    """``gram, p`` for distinct asked n-grams ``gram``: each order's share plus its weight times the next order."""
    levels = {ORDER: asked.select("gram")}
    for order in range(ORDER - 1, 0, -1):
        cut = F.col("gram").bitwiseAND(F.lit((1 << (8 * order)) - 1))
        levels[order] = levels[order + 1].select(cut.alias("gram")).distinct()
    below = None
    for order in range(1, ORDER + 1):
        rows = levels[order].withColumn("context", F.shiftright("gram", 8))
        rows = rows.join(model.alphas[order], "gram", "left").join(model.gammas[order], "context", "left")
        alpha, gamma = F.coalesce("alpha", F.lit(0.0)), F.coalesce("gamma", F.lit(1.0))
        if below is None:
            rows = rows.withColumn("p", alpha + gamma / 256)
        else:
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << (8 * (order - 1))) - 1)))
            lower = below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            rows = rows.join(lower, "suffix").withColumn("p", alpha + gamma * F.col("lower"))
        below = rows.select("gram", "p")
    return below


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``n_bytes`` and ``log_p`` (sum of natural logarithms)."""
    buckets, parts = blocks_of(docs), shuffle_partitions(docs.sparkSession)
    blocks = packed_blocks(docs, "doc_id")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("block").to_numpy()
            for block in np.unique(own):
                mine = batch.filter(pa.array(own == block))
                rows = unpack_rows(pa.chunked_array([mine.column("payload")]))
                texts = [t.as_py() or b"" for t in rows.column("text").cast(pa.binary())]
                grams = np.unique(grams_of(texts)[0])
                yield from _lists(_by_bucket(int(block), grams, [], buckets)).to_batches()
            release()

    def distinct(group: pa.Table) -> pa.Table:
        release()
        parts = [_unpacked(p, 1)[0] for p in group.column("payload").to_pylist()]
        return pa.table({"gram": np.unique(np.concatenate(parts))})

    def answer(lists: pa.Table, found: pa.Table) -> pa.Table:
        release()
        order = np.argsort(found.column("gram").to_numpy())
        grams = found.column("gram").to_numpy()[order]
        logs = np.log(found.column("p").to_numpy()[order]).astype(np.float32)
        out = [
            squeeze(logs[np.searchsorted(grams, _unpacked(p, 1)[0])].tobytes())
            for p in lists.column("payload").to_pylist()
        ]
        return pa.table({"block": lists.column("block"), "grams": lists.column("payload"), "logs": pa.array(out, pa.binary())})

    def add_up(own: pa.Table, lists: pa.Table) -> pa.Table:
        release()
        rows = unpack_rows(own.column("payload"))
        texts = [t.as_py() or b"" for t in rows.column("text").cast(pa.binary())]
        known = [_unpacked(p, 1)[0] for p in lists.column("grams").to_pylist()]
        logs = [np.frombuffer(unsqueeze(p), np.float32) for p in lists.column("logs").to_pylist()]
        grams, sizes = grams_of(texts)
        sums = np.zeros(len(texts))
        if len(grams):
            table = np.concatenate(known)
            order = np.argsort(table)
            value = np.concatenate(logs)[order].astype(np.float64)
            found = value[np.searchsorted(table[order], grams)]
            full = np.flatnonzero(sizes)
            sums[full] = np.add.reduceat(found, (np.cumsum(sizes) - sizes)[full])
        kept = rows.drop_columns(["text"])
        return kept.append_column("n_bytes", pa.array(sizes)).append_column("log_p", pa.array(sums))

    asks = blocks.mapInArrow(ask, "block int, bucket int, payload binary").repartition(parts, "bucket")
    asked = asks.groupBy("bucket").applyInArrow(distinct, "gram long")
    found = probabilities(model, asked).withColumn("bucket", bucket_column(F.col("gram"), buckets))
    answers = asks.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(
        answer, "block int, grams binary, logs binary"
    )
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text"]
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        add_up, ", ".join([*kept, "n_bytes long", "log_p double"])
    )


def judge(scored: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """``scored`` (``doc_id, lang, n_bytes, log_p``) with ``perplexity``, ``threshold`` and ``kept``."""
    ids = trusted.filter(F.col("doc_id").isNotNull() & held_back(F.col("doc_id"))).select("doc_id").distinct()
    known = scored.join(ids, "doc_id", "left_semi")
    # Every document counts for its language and for all languages.
    groups = known.withColumn("group", F.explode(F.array(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")), F.lit("*"))))
    means = groups.groupBy("group").agg((F.sum("log_p") / F.sum("n_bytes")).alias("mean"), F.count("*").alias("docs"))
    means = means.filter((F.col("group") == "*") | (F.col("docs") >= LEAST_DOCS)).drop("docs")

    def perplexity(mean: Column) -> Column:
        return F.exp(-(F.col("log_p") + PRIOR * mean) / (F.col("n_bytes") + PRIOR))

    limits = groups.join(means, "group").groupBy("group", "mean").agg(
        (F.percentile_approx(perplexity(F.col("mean")), quantile, 10000) * slack).alias("threshold")
    )
    limits = stage(limits, "thresholds")
    every = limits.filter(F.col("group") == "*").first()
    own = limits.filter(F.col("group") != "*").select(
        F.substring("group", 2, 1 << 20).alias("lang"), F.col("mean").alias("own_mean"), F.col("threshold").alias("own")
    )
    mean = F.coalesce("own_mean", F.lit(every["mean"] if every else None).cast("double"))
    limit = F.coalesce("own", F.lit(every["threshold"] if every else None).cast("double"))
    judged = scored.join(own, "lang", "left").withColumns({"perplexity": perplexity(mean), "threshold": limit})
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return judged.withColumn("kept", kept).drop("own_mean", "own")


def classify(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, lang, n_bytes, log_p, perplexity, threshold, kept`` of every document.

    ``trusted`` has the keys (``doc_id``) of trusted documents. Counts and scores are written once.
    """
    read = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    counts = stage(count_grams(read, trusted), "grams")
    scored = stage(score(read, build(counts)), "scores")
    return judge(scored, trusted)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Keys of documents labelled good and not toxic."""
    return labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id")
