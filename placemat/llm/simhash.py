"""SimHash near-duplicates: exact pairs of fingerprints by vantage-point trees, then components.

A fingerprint has a bit where more than half of the 64-bit hashes of the text's shingles have it. Two
fingerprints within 3 bits are within 1 bit in their upper or in their lower 32 bits, so there is one tree for
each half, searched within radius 1. A tree has one vantage point per level and a branch for each distance from
it; the leaf, the row of distances, is the shard. By the triangle inequality a neighbour's distance from a vantage
point differs by at most 1, and since one bit makes every distance odd or even, a neighbour's distances
are all the same or all differ by exactly 1. Only those branches are searched: a fingerprint is a member of its
own shard and a visitor of the neighbouring ones, of which one half is enough because the other end of a pair
looks the other way. Whole fingerprints are compared within a shard, so pairs are exact.

Equal fingerprints are one node. A text without words, or null, has fingerprint zero, linked like any other.
Repeated rows share a node. Null keys never name a component; one of null keys alone is null. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.llm.components import smallest_reachable
from placemat.scratch import stage

SHINGLE = 3
SEED = 42
RADIUS = 3
HALF_BITS = 32
LOW = (1 << HALF_BITS) - 1
#: Members a task compares at once; a shard with more is split into cells.
CELL = 4096
HASHES_AT_ONCE = 1 << 16


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of UTF-8 text, as an unsigned integer."""
    words = (text or b"").lower().split()  # of bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)))
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    return majority(np.fromiter(map(digest, shingles), np.dtype("<u8"), len(shingles)))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are those set in more than half of 64-bit hashes; 0 of none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        some = hashes[at : at + HASHES_AT_ONCE].astype("<u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint's bits as a signed bigint."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            values = np.array([simhash(t.as_py()) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"]
            )

    read_columns = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read_columns.mapInArrow(read, "doc_id long, fp long")


def vantage_points(levels: int) -> list[int]:
    """Rows of the 32 x 32 Hadamard matrix: each pair is 16 bits apart, so that distances tell different things."""
    rows = sorted(range(1, HALF_BITS), key=lambda r: (r.bit_count(), r))
    return [sum(1 << i for i in range(HALF_BITS) if (r & i).bit_count() % 2) for r in rows[:levels]]


def tree_levels(fingerprints: int) -> int:
    """Levels that leave some tens of members in a shard. Pairs found do not depend on it."""
    return min(max(3, math.ceil(math.log(max(fingerprints, 1) / 64, 8))), 12)


def _routes(fp: Column, levels: int) -> Column:
    """Array of ``tree, leaf, member``: the own shard, and those of neighbours further from the first point."""
    places = []
    for tree in (0, 1):
        half = F.shiftright(fp, HALF_BITS * tree).bitwiseAND(F.lit(LOW))
        leaf = F.lit(0).cast("bigint")
        for point in vantage_points(levels):
            # Distances are 0 to 32; one more leaves room for -1 of a neighbouring branch.
            leaf = leaf * 35 + F.bit_count(half.bitwiseXOR(F.lit(point))) + 1
        turns = [0]
        for level in range(levels):
            turns = [t * 35 + s for t in turns for s in ((1,) if level == 0 else (1, -1))]
        for step in (0, *turns):
            places.append(
                F.struct(F.lit(tree).alias("tree"), (leaf + step).alias("leaf"), F.lit(step == 0).alias("member"))
            )
    return F.array(*places)


def _cells(routed: DataFrame) -> DataFrame:
    """Rows with their ``cell``: a shard of more than CELL members is split by a hash of the fingerprint.

    A member of cell i also visits the cells after it, and a visitor visits all, so every pair still meets once.
    """
    large = (
        routed.filter("member").groupBy("tree", "leaf").agg(F.count("*").alias("n")).filter(F.col("n") > CELL)
    ).select("tree", "leaf", F.ceil(F.col("n") / CELL).cast("int").alias("cells"))
    sized = routed.join(large, ["tree", "leaf"], "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    own = F.when(F.col("member"), F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int")).otherwise(F.lit(0))
    spread = sized.withColumn("own", own).withColumn(
        "cell", F.explode(F.sequence(F.col("own"), F.col("cells") - 1))
    )
    return spread.select(
        "tree", "leaf", "cell", "fp", (F.col("member") & (F.col("cell") == F.col("own"))).alias("member")
    )


def _star(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the first node of each component to its others, for edges between positions a and b."""
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[moved]], nodes[moved]


def _linked(fp: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of all pairs within RADIUS that have a member."""
    nodes, held = np.concatenate([fp[member], fp[~member]]), int(member.sum())
    members = nodes[:held]
    a_all: list[np.ndarray] = []
    b_all: list[np.ndarray] = []
    at_once = max(1, (1 << 21) // max(held, 1))
    for at in range(0, len(nodes), at_once):
        near = np.bitwise_count(nodes[at : at + at_once, None] ^ members[None, :]) <= RADIUS
        a, b = np.nonzero(near)
        a += at
        fresh = a > b
        if fresh.any():
            first, second = _star(np.arange(len(nodes)), a[fresh], b[fresh])
            a_all.append(first)
            b_all.append(second)
    if not a_all:
        return nodes[:0], nodes[:0]
    return _star(nodes, np.concatenate(a_all), np.concatenate(b_all))


def fingerprint_links(distinct: DataFrame, levels: int) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints that join all within RADIUS: a star per shard and group."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def groups(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            tree, leaf, cell, fp, member = rows
            new = (np.diff(tree) != 0) | (np.diff(leaf) != 0) | (np.diff(cell) != 0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(fp)]
            found = [
                _linked(fp[x:y].view(np.uint64), member[x:y])
                for x, y in zip(cuts, cuts[1:], strict=False)
                if y - x > 1
            ]
            pairs = [np.concatenate(p).view(np.int64) for p in zip(*found, strict=True)] if found else [[], []]
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in pairs], ["a", "b"])

        for batch in batches:
            rows = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "leaf", "cell", "fp", "member"))
            if held:
                rows = tuple(np.concatenate(x) for x in zip(held.pop(), rows, strict=True))
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])
            whole = int(np.argmax(last))  # the last group may go on in the next batch
            if whole:
                yield groups(tuple(x[:whole] for x in rows))
            held.append(tuple(x[whole:] for x in rows))
        if held:
            yield groups(held.pop())

    routed = distinct.select("fp", F.explode(_routes(F.col("fp"), levels)).alias("to")).select("fp", "to.*")
    shard = ["tree", "leaf", "cell"]
    sharded = _cells(routed).repartition(*shard).sortWithinPartitions(*shard)
    return sharded.select(*shard, "fp", "member").mapInArrow(search, "a long, b long")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: the smallest key that links of up to RADIUS bits reach.

    Fingerprints are written once. Links run between distinct fingerprints; copies join by equality.
    """
    found = stage(fingerprints(docs, key, text), "fingerprints")
    distinct = stage(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    links = fingerprint_links(distinct, tree_levels(distinct.count()))
    reached = smallest_reachable(links)
    placed = distinct.join(reached, distinct["fp"] == reached["node"], "left").select(
        "fp", "first", F.coalesce("smallest", "fp").alias("group")
    )
    named = placed.groupBy("group").agg(F.min("first").alias("component_id"))
    # A group is joined once per distinct fingerprint, before the copies come in.
    component = placed.join(named, "group").select("fp", "component_id")
    return found.join(component, "fp").select("doc_id", "fp", "component_id")


def hex_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
