"""Alignment of two tokenizers' tokens by the bytes they cover.

Both tokenizers split the same bytes, so a byte offset where tokens of both end cuts the document into groups, and the
tokens of a group are linked. Cuts are found by divide and conquer: an interval of tokens looks for a common end
near its middle, by bisection of the other side's ends, and is halved there; an interval without one is a group.
All intervals of a slice of documents are worked on together, each with bounds of its own.

A link's weight is the number of documents that hold its pair of ids linked. Documents are read in runs of a few MB; a run
is written as one compressed payload and one row per distinct pair, with the number of its documents that hold it. These
rows are summed by pair, ranked within the first id, joined back to the runs that ask, and
meet their payload there. So texts are read once and never moved, and a pair that all documents hold travels once per run.

A null or empty text has no tokens, nor has one whose tokens do not spell a space and the text: its numbers are zero
and its groups empty. Repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemat.llm.blocks import pack_rows, release, unpack_rows
from placemat.llm.core import shuffle_partitions
from placemat.llm.tokens import ByteLevelEncoder, slices, vocabulary_text
from placemat.scratch import fresh_path

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
RUN_BYTES = 8 << 20
SPACE = "\u2581"


def vocabulary_bytes(name: str) -> bytes:
    """The vocabulary file, read on the driver and sent to the tasks (below 2 MB)."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


class ByteLevelSide:
    """Ids by a byte-level vocabulary, special tokens' strings as plain text; ``pieces`` are the bytes of every id."""

    def __init__(self, vocabulary: str):
        encoder = ByteLevelEncoder(vocabulary)
        self.ordinary: tiktoken.Encoding = encoder.ordinary
        self.library = encoder.tokenizer
        self.library.encode_special_tokens = True
        known = {i: b for b, i in self.ordinary._mergeable_ranks.items()}
        self.pieces = [known.get(i, b"") for i in range(max(known, default=-1) + 1)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> np.ndarray:
        try:
            return self.ordinary.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:  # a run of white space too long for its splitter
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)


class PieceSide:
    """Ids by a piece vocabulary, which puts the space before the text itself."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@cache
def _sides(vocabulary: str, model: bytes) -> tuple[ByteLevelSide, PieceSide]:
    """One pair of tokenizers for all runs of a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteLevelSide(vocabulary), PieceSide(model)


def shared_cuts(a: np.ndarray, b: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Indices into ``a``, ascending, of the tokens of the first side that end where one of the second side ends.

    ``a`` and ``b`` are ascending ends of all documents in a row. Interval i holds the tokens ``firsts[i]`` to
    ``lasts[i]`` (inclusive) of ``a``, and its last end is known to be shared. An interval bisects ``b`` for the
    end in its middle; if it is not there it tries the next ends on either side, ever further, until all are tried.
    A common end splits the interval in two, both of which end in a shared cut again.
    """
    found = [lasts]
    low, high = firsts, lasts  # open question: is one of low..high-1 shared?
    while True:
        open_ = low < high
        low, high = low[open_], high[open_]
        if not len(low):
            return np.sort(np.concatenate(found))
        middle = (low + high - 1) // 2
        cut = np.full(len(low), -1)
        waiting = np.arange(len(low))
        step = 0
        while len(waiting):
            for side in (middle[waiting] - step, middle[waiting] + step) if step else (middle[waiting],):
                inside = (side >= low[waiting]) & (side < high[waiting]) & (cut[waiting] < 0)
                who, ends = waiting[inside], a[side[inside]]
                at = np.searchsorted(b, ends)
                hit = b[at] == ends
                cut[who[hit]] = side[inside][hit]
            step += 1
            reach = (middle[waiting] - step >= low[waiting]) | (middle[waiting] + step < high[waiting])
            waiting = waiting[(cut[waiting] < 0) & reach]
        split = cut >= 0
        found.append(cut[split])
        low, high = np.concatenate([low[split], cut[split] + 1]), np.concatenate([cut[split], high[split]])


class Slice:
    """Tokens of both sides of some documents, their groups and links; arrays run over all documents in a row."""

    def __init__(self, texts: list[str | None], left: ByteLevelSide, right: PieceSide):
        spaced = [" " + t if t else "" for t in texts]
        ids_a = left.encode(spaced)
        ids_b = right.encode([t or "" for t in texts])
        none = np.zeros(0, np.int64)
        for k, text in enumerate(spaced):
            want = text.encode()
            if not want or any(
                b"".join(map(side.pieces.__getitem__, ids.tolist())) != want
                for side, ids in ((left, ids_a[k]), (right, ids_b[k]))
            ):
                ids_a[k] = ids_b[k] = none
        self.n_docs = len(texts)
        self.a, self.b = np.concatenate([none, *ids_a]), np.concatenate([none, *ids_b])
        self.n_a, self.n_b = np.array([*map(len, ids_a)], np.int64), np.array([*map(len, ids_b)], np.int64)
        # Documents follow each other without gaps, so one ascending array of ends serves them all.
        ends_a, ends_b = (
            np.cumsum(np.array([*map(len, side.pieces)], np.int64)[ids]) for side, ids in ((left, self.a), (right, self.b))
        )
        stops = np.cumsum(self.n_a)
        filled = self.n_a > 0
        cuts = shared_cuts(ends_a, ends_b, (stops - self.n_a)[filled], stops[filled] - 1)
        self.a_stop = cuts + 1
        self.b_stop = np.searchsorted(ends_b, ends_a[cuts]) + 1
        self.a_start = np.concatenate([none, [0] * bool(len(cuts)), self.a_stop[:-1]]).astype(np.int64)
        self.b_start = np.concatenate([none, [0] * bool(len(cuts)), self.b_stop[:-1]]).astype(np.int64)
        self.doc = np.searchsorted(stops, cuts, side="right")  # of each group

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and pair of ids (first side in the upper 32 bits) of every linked pair of tokens."""
        wide, high = self.b_stop - self.b_start, self.a_stop - self.a_start
        size = wide * high
        group = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
        a = self.a[self.a_start[group] + place // wide[group]]
        b = self.b[self.b_start[group] + place % wide[group]]
        return self.doc[group], (a << 32) | b

    def group_texts(self, names_a: list[str], names_b: list[str]) -> list[str]:
        """Groups of each document: ids of both sides with the signs that follow them."""
        a_group = np.repeat(np.arange(len(self.a_stop)), self.a_stop - self.a_start)
        b_group = np.repeat(np.arange(len(self.b_stop)), self.b_stop - self.b_start)
        a_last, b_last = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        a_last[self.a_stop - 1], b_last[self.b_stop - 1] = True, True
        row = np.empty(len(self.a) + len(self.b), np.int64)
        row[np.arange(len(self.a)) + self.b_start[a_group]] = self.a + a_last * (len(names_a) // 2)
        row[np.arange(len(self.b)) + self.a_stop[b_group]] = self.b + b_last * (len(names_b) // 2) + len(names_a)
        names, out, at = names_a + names_b, [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append("".join(map(names.__getitem__, row[at : at + n].tolist()))[:-1])
            at += n
        return out


def _names(n: int, last: str) -> list[str]:
    return [f"{i}," for i in range(n)] + [f"{i}{last}" for i in range(n)]


def document_pairs(docs: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of each document with the number of their links, ordered by document and pair."""
    order = np.lexsort((pairs, docs))
    docs, pairs = docs[order], pairs[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(docs) != 0) | (np.diff(pairs) != 0)])[: len(docs)])
    return docs[first], pairs[first], np.diff(np.append(first, len(docs)))


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, counts binary"
ROWS = "kind string, run long, pair long, docs long, payload binary"


def _aligned_slices(batches: Iterator[pa.RecordBatch], vocabulary: str, model: bytes) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Numbers, group texts and distinct pairs of each document, slice by slice, with the pairs of all of them."""
    left, right = _sides(vocabulary, model)
    names_a, names_b = _names(len(left.pieces), "|"), _names(len(right.pieces), ";")
    for batch in batches:
        for few in slices(batch, "text"):
            own = Slice(few.column("text").to_pylist(), left, right)
            link_doc, link_pair = own.links()
            doc, pair, count = document_pairs(link_doc, link_pair)
            cuts = np.searchsorted(doc, np.arange(own.n_docs + 1)).tolist()
            ranges = list(zip(cuts, cuts[1:], strict=False))
            table = pa.table(
                {
                    "doc_id": few.column("doc_id"),
                    "n_a": own.n_a,
                    "n_b": own.n_b,
                    "n_groups": np.bincount(own.doc, minlength=own.n_docs),
                    "n_links": np.bincount(link_doc, minlength=own.n_docs),
                    "groups": own.group_texts(names_a, names_b),
                    "pairs": pa.array([pair[i:j].tobytes() for i, j in ranges], pa.binary()),
                    "counts": pa.array([count[i:j].astype("<i4").tobytes() for i, j in ranges], pa.binary()),
                }
            )
            yield table, pair


def _read(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def align(
    docs: DataFrame, vocabulary: str | None = None, model: bytes | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, counts`` of each document.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``; ``pairs`` (64-bit) and ``counts`` (32-bit) hold the distinct pairs of linked ids,
    the first id in the upper half, and the number of their links.
    """
    vocabulary, model = vocabulary or vocabulary_text(BYTE_LEVEL), model or vocabulary_bytes(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in _aligned_slices(batches, vocabulary, model):
            yield from table.to_batches()

    return _read(docs, key, text).mapInArrow(run, ALIGNED)


def weigh_links(
    docs: DataFrame, vocabulary: str | None = None, model: bytes | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each document.

    ``count_sum`` adds up the weights of a document's links; ``n_best`` counts the links whose weight is the highest of
    their first id.
    """
    vocabulary, model = vocabulary or vocabulary_text(BYTE_LEVEL), model or vocabulary_bytes(PIECES)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        pairs: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            number = int.from_bytes(os.urandom(8), "little", signed=True)
            pair, n = np.unique(np.concatenate(pairs), return_counts=True)
            made = pa.table({"kind": ["run"], "run": [number], "payload": [pack_rows(pa.concat_tables(held))]})
            asked = pa.table({"kind": ["pair"] * len(pair), "run": np.full(len(pair), number), "pair": pair, "docs": n})
            schema = pa.schema([("kind", pa.string()), ("run", pa.int64()), ("pair", pa.int64()), ("docs", pa.int64()), ("payload", pa.binary())])
            for t in (made, asked):
                columns = [t.column(f.name) if f.name in t.column_names else pa.nulls(t.num_rows, f.type) for f in schema]
                yield from pa.table(columns, schema=schema).to_batches(1 << 16)
            held.clear(), pairs.clear()

        for table, pair in _aligned_slices(batches, vocabulary, model):
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in table.column("groups").to_pylist()]
            size += pc.sum(pc.binary_length(table.column("groups"))).as_py() or 0
            held.append(table.drop_columns(["groups"]).append_column("groups_sha256", pa.array(digests, pa.string())))
            pairs.append(pair)
            if size > RUN_BYTES:
                yield from flush()
                size = 0
        if held:
            yield from flush()
        release()

    spark = docs.sparkSession
    path = fresh_path(spark, "aligned")
    _read(docs, key, text).mapInArrow(write, ROWS).write.partitionBy("kind").parquet(path)
    asked = spark.read.schema(ROWS).parquet(path).filter("kind = 'pair'").select("run", "pair", "docs")
    runs = spark.read.schema(ROWS).parquet(path).filter("kind = 'run'").select("run", "payload")
    weights = asked.groupBy("pair").agg(F.sum("docs").alias("weight")).withColumn("first", F.shiftright("pair", 32))
    highest = weights.groupBy("first").agg(F.max("weight").alias("highest"))
    ranked = weights.join(highest, "first").select("pair", "weight", (F.col("weight") == F.col("highest")).alias("best"))
    answers = asked.join(ranked, "pair").select("run", "pair", "weight", "best")

    def add_up(own: pa.Table, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("pair").to_numpy())
        known = table.column("pair").to_numpy()[order]
        weight, best = table.column("weight").to_numpy()[order], table.column("best").to_numpy()[order]
        rows = unpack_rows(own.column("payload"))
        n_best, total = [], []
        for pairs, counts in zip(rows.column("pairs").to_pylist(), rows.column("counts").to_pylist(), strict=True):
            at, count = np.searchsorted(known, np.frombuffer(pairs, "<i8")), np.frombuffer(counts, "<i4").astype(np.int64)
            n_best.append(int(count[best[at]].sum()))
            total.append(int((count * weight[at]).sum()))
        release()
        made = rows.drop_columns(["pairs", "counts"])
        return made.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64())).select(
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        )

    parts = shuffle_partitions(spark)
    return (
        runs.repartition(parts, "run")
        .groupBy("run")
        .cogroup(answers.repartition(parts, "run").groupBy("run"))
        .applyInArrow(
            add_up,
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
        )
    )
