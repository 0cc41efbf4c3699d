"""Best-fit packing of documents into sequences, after a Martello-Toth reduction.

Lengths are at most CAPACITY, so the instance is a histogram of at most CAPACITY counts, whatever the number
of documents: Spark counts it, the driver solves it, and each piece finds its place by the number it has among
the pieces of its length. The reduction fixes sequences that no other choice can beat (see ``reduce``); what is
left goes best-fit decreasing.

A null text is empty and has the end id alone. A text of more than CAPACITY ids is cut from its end into full
pieces, so that the first piece takes the rest. Repeated rows are packed as often as they occur. An empty table
gives no pieces.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemat.llm.tokens import END_ID, ID, VOCABULARY, ByteLevelEncoder, slices, vocabulary_text
from placemat.scratch import stage

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length int, packed binary, part int, nth long"


class Group(NamedTuple):
    """``count`` sequences that hold pieces of these lengths."""

    lengths: tuple[int, ...]
    count: int


def _largest(counts: list[int], most: int) -> int:
    """Largest length up to ``most`` that is there, else 0."""
    return next((s for s in range(most, 0, -1) if counts[s]), 0)


def _smallest(counts: list[int], how_many: int) -> list[int]:
    """The smallest lengths there, each as often as it occurs."""
    found: list[int] = []
    for s, n in enumerate(counts):
        found += [s] * min(n, how_many - len(found))
        if len(found) == how_many:
            break
    return found


def _best_pair(counts: list[int], room: int) -> tuple[int, int] | None:
    """Lengths a >= b such that every pair x >= y in ``room`` has x <= a and y <= b, and any single x <= a."""
    a = _largest(counts, room)
    if not a:
        return None
    counts[a] -= 1
    b = _largest(counts, min(room - a, a))
    counts[a] += 1
    if not b:
        return None
    for y in range(b + 1, room // 2 + 1):
        if counts[y]:
            counts[y] -= 1
            partner = next((x for x in range(y, room - y + 1) if counts[x]), 0)
            counts[y] += 1
            if partner:
                return None
    return a, b


def reduce(counts: list[int], capacity: int) -> list[Group]:
    """Take dominating sequences out of ``counts`` (by length) and return them.

    For the largest length s, a set dominates when every other feasible set with s can trade its pieces for
    those of this one. That is so for s alone if nothing fits beside it; for s and one that fills the sequence;
    for s and the largest that fits, if no two fit; and for s and the pair of ``_best_pair``, if no three fit.
    """
    fixed = []
    for s in range(capacity, 0, -1):
        while counts[s]:
            counts[s] -= 1
            room = capacity - s
            small = _smallest(counts, 3)
            fill = _largest(counts, room)
            if not fill:
                mates: tuple[int, ...] = ()
            elif fill == room or sum(small[:2]) > room or len(small) < 2:
                mates = (fill,)
            elif (sum(small) > room or len(small) < 3) and (pair := _best_pair(counts, room)):
                mates = pair
            else:
                counts[s] += 1
                break
            counts[s] += 1
            need: dict[int, int] = defaultdict(int)
            for x in (s, *mates):
                need[x] += 1
            # As many at once as there are: taking pieces away adds no rival, so the choice holds.
            times = min(counts[x] // n for x, n in need.items())
            for x, n in need.items():
                counts[x] -= n * times
            fixed.append(Group((s, *mates), times))
    return fixed


def best_fit(counts: list[int], capacity: int) -> list[Group]:
    """Best-fit decreasing over the histogram: equal sequences stay together as one group."""
    rooms: list[list[Group]] = [[] for _ in range(capacity + 1)]
    for s in range(capacity, 0, -1):
        left = counts[s]
        while left:
            room = next((r for r in range(s, capacity + 1) if rooms[r]), None)
            if room is None:
                rooms[capacity].append(Group((), left))
                continue
            group = rooms[room].pop()
            each = min(room // s, left)
            times = min(group.count, left // each)
            rooms[room - each * s].append(Group(group.lengths + (s,) * each, times))
            if times < group.count:
                rooms[room].append(Group(group.lengths, group.count - times))
            left -= each * times
    return [g for held in rooms for g in held if g.lengths]


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    counts = [histogram.get(s, 0) for s in range(capacity + 1)]
    return reduce(counts, capacity) + best_fit(counts, capacity)


class Places:
    """Where the n-th piece of a length goes: sequence and offset, by binary search over runs of equal places."""

    def __init__(self, groups: list[Group]):
        runs: dict[int, list[list[int]]] = defaultdict(lambda: [[], [], []])
        taken: dict[int, int] = defaultdict(int)
        sequence = 0
        for g in groups:
            offset = 0
            for s in g.lengths:
                firsts, shifts, offsets = runs[s]
                firsts.append(taken[s])
                shifts.append(sequence - taken[s])
                offsets.append(offset)
                taken[s] += g.count
                offset += s
            sequence += g.count
        self.runs = {s: tuple(np.array(x, np.int64) for x in r) for s, r in runs.items()}
        self.sequences = sequence

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for s in np.unique(length):
            own = length == s
            firsts, shifts, offsets = self.runs[int(s)]
            run = np.searchsorted(firsts, number[own], side="right") - 1
            sequence[own] = number[own] + shifts[run]
            offset[own] = offsets[run]
        return sequence, offset


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of n ids, and n: full pieces at the end, the rest first."""
    return sorted({0, *range(n, 0, -capacity), n})


def by_planes(ids: bytes) -> bytes:
    """The ids' lowest bytes, then their second ones, and so on; most of the higher ones are zero."""
    return np.frombuffer(ids, np.uint8).reshape(-1, ID.itemsize).T.tobytes()


def from_planes(data: bytes) -> bytes:
    return np.frombuffer(data, np.uint8).reshape(ID.itemsize, -1).T.tobytes()


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, key: str, text: str) -> DataFrame:
    """Pieces with their ids, compressed; ``nth`` numbers those of one length in the task ``part`` that made them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = ByteLevelEncoder(vocabulary), zstandard.ZstdCompressor(level=3)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = np.array([END_ID], ID).tobytes()
        for batch in batches:
            for few in slices(batch, "text"):
                out: list[list] = [[] for _ in range(7)]
                texts = [t or "" for t in few.column("text").to_pylist()]
                for doc, ids in zip(few.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    ids += end
                    cuts = cut_points(len(ids) // 4, capacity)
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        packed = packer.compress(by_planes(ids[4 * a : 4 * b]))
                        row = (doc, k, a, b - a, packed, part, seen[b - a])
                        seen[b - a] += 1
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "packed", "part", "nth"],
                )

    read = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(cut, PIECES)


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids, sequence_id, offset``.

    The pieces are written once, so that their numbers within a length hold for every later use. Numbers across
    tasks come from one count per task and length. At most ``capacity`` counts reach the driver.
    """
    vocabulary = vocabulary or vocabulary_text(VOCABULARY)
    pieces = stage(token_pieces(docs, vocabulary, capacity, key, text), "pieces")
    made = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(solve(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = made.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for b in batches:
            numbers = b.column("number").to_numpy()
            sequence, offset = places.find(b.column("length").to_numpy(), numbers)
            ids = [from_planes(reader.decompress(p)) for p in b.column("packed").to_pylist()]
            kept = ["doc_id", "piece", "start", "length"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in kept], pa.array(ids, pa.binary()), pa.array(sequence), pa.array(offset)],
                [*kept, "ids", "sequence_id", "offset"],
            )

    numbered = pieces.join(firsts, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "packed", (F.col("first") + F.col("nth")).alias("number")
    )
    return numbered.mapInArrow(
        settle, "doc_id long, piece int, start long, length int, ids binary, sequence_id long, offset long"
    )
