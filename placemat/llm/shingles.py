"""Near copies by word shingles: all documents linked by a Jaccard similarity of 0.8 or more, then components.

A text is the set of its runs of five words (ASCII white space apart, A-Z as a-z); one of fewer words has one run, of
the words it has. Equal sets are one node. A set has a SimHash fingerprint, and the two vantage-point trees of
``simhash.py`` find all pairs of fingerprints within three bits. These are the closest candidates only, so MinHash adds
those down to the limit: nodes meet in a bucket where all ROWS minima of
one of BANDS bands are equal, which a pair of similarity 0.8 misses with probability (1 - 0.8**ROWS)**BANDS = 5e-7.
Candidates of both are only gathered into loose groups, so a bucket adds one edge per node, whatever its size. Inside a
loose group the sets themselves are compared: a search from node to node takes every neighbour there is out of
those not reached yet, so that links are exact and a large group of near copies costs little more than one pass.

Loose groups of more than CELL_BYTES are split into cells, and each pair of cells meets in a task of its own.
Texts without words, or null, have the empty set: they are copies of each other. Repeated rows share a node. Null keys
never name a component; one of null keys alone is null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemat.llm.blocks import release
from placemat.llm.components import smallest_reachable
from placemat.llm.simhash import fingerprint_links, majority, tree_levels
from placemat.scratch import stage

SHINGLE = 5
#: The least similarity of a link, as a fraction: integers leave nothing to rounding.
LEAST = (4, 5)
BANDS = 48
ROWS = 6
SEED = 42
#: Bytes of text in a cell; a task holds two.
CELL_BYTES = 16 << 20
HASHES_AT_ONCE = 1024

_rng = np.random.default_rng(SEED)
FACTORS = _rng.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
SHIFTS = _rng.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
BAND_SEEDS = _rng.integers(0, 1 << 64, BANDS, np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of words of UTF-8 text."""
    words = (text or b"").lower().split()  # of bytes: only A-Z, only ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    runs = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    if len(words) < shingle:
        runs = iter([b" ".join(words)])
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    return np.unique(np.fromiter(map(digest, runs), np.uint64))


def node_of(hashes: np.ndarray) -> int:
    """Name of a set, as a signed integer; 0 of the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), seed=SEED)).view(np.int64)) if len(hashes) else 0


def buckets(hashes: np.ndarray) -> np.ndarray:
    """One bucket per band, as signed integers; none of the empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        drawn = hashes[at : at + HASHES_AT_ONCE, None] * FACTORS
        drawn += SHIFTS
        np.minimum(least, drawn.min(axis=0), out=least)
    mixed = BAND_SEEDS.copy()
    for column in least.reshape(BANDS, ROWS).T:
        mixed = (mixed ^ column) * MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, node, fp, buckets`` of every row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            nodes = pa.array([node_of(s) for s in sets], pa.int64())
            fps = pa.array(np.array([majority(s) for s in sets], np.uint64).view(np.int64))
            found = [buckets(s) for s in sets]
            cuts = np.cumsum([0, *map(len, found)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([*found, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), nodes, fps, lists], ["doc_id", "node", "fp", "buckets"])
        release()

    read_columns = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read_columns.mapInArrow(read, "doc_id long, node long, fp long, buckets array<long>")


def fingerprint_edges(distinct: DataFrame) -> DataFrame:
    """Edges ``a, b`` between nodes that join all whose fingerprints are within three bits; not the empty set."""
    named = distinct.filter("node != 0").select("node", "fp")
    held = stage(named.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints")
    equal = named.join(held, "fp").filter("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    links = fingerprint_links(held.select("fp"), tree_levels(held.count()))
    first, second = (held.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_node")) for end in ("a", "b"))
    near = links.join(first, "a").join(second, "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    return equal.unionByName(near)


def loose_groups(distinct: DataFrame) -> DataFrame:
    """``node, group`` of nodes that share a bucket or nearly a fingerprint with another: components of those that do."""
    placed = distinct.select("node", F.explode("buckets").alias("bucket"))
    ends = placed.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z")
    edges = placed.join(ends, "bucket").select("a", F.col("node").alias("b"))
    reached = smallest_reachable(edges.unionByName(fingerprint_edges(distinct)))
    first = reached.select(F.col("smallest").alias("node"), F.col("smallest").alias("group")).distinct()
    return reached.select("node", F.col("smallest").alias("group")).unionByName(first)


def linked(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Star edges between the positions of sets, none empty, that join all of similarity LEAST or more."""
    part, whole = LEAST
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    own = np.split(codes, np.cumsum(sizes)[:-1])
    mark = np.zeros(codes.max() + 1, np.uint8)
    left, edges = np.arange(len(sets)), []
    while len(left) > 1:
        root, queue = int(left[0]), [int(left[0])]
        left, codes = left[1:], codes[sizes[left[0]] :]
        while queue and len(left):
            node = queue.pop()
            mark[own[node]] = 1
            starts = np.cumsum(sizes[left]) - sizes[left]
            common = np.add.reduceat(mark[codes], starts, dtype=np.int64)
            mark[own[node]] = 0
            near = whole * common >= part * (sizes[left] + sizes[node] - common)
            if near.any():
                queue += left[near].tolist()
                edges += [(root, x) for x in left[near].tolist()]
                codes = codes[np.repeat(~near, sizes[left])]
                left = left[~near]
    return edges


def shingle_links(docs: DataFrame, groups: DataFrame, text: str = "text") -> DataFrame:
    """Edges ``a, b`` between nodes of one loose group that join all of similarity LEAST or more."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            nodes = [node_of(shingle_set(t.as_py())) for t in texts.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), texts], ["node", "text"])

    def compare(rows: pa.Table) -> pa.Table:
        release()
        nodes = rows.column("node").to_numpy()
        edges = linked([shingle_set(t.as_py()) for t in rows.column("text").cast(pa.binary())])
        ends = zip(*[(nodes[x], nodes[y]) for x, y in edges], strict=True) if edges else ([], [])
        return pa.table([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    named = docs.select(F.col(text).alias("text")).mapInArrow(name, "node long, text string")
    met = named.join(groups, "node").groupBy("node", "group").agg(F.any_value("text").alias("text"))
    held = stage(met, "candidates")
    large = held.groupBy("group").agg(F.sum(F.octet_length("text")).alias("size")).filter(F.col("size") > CELL_BYTES)
    cells = large.select("group", F.ceil(F.col("size") / CELL_BYTES).cast("int").alias("cells"))
    sized = held.join(cells, "group", "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    spread = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    cell = ["group", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    return spread.select(*cell, "node", "text").groupBy("group", "low", "high").applyInArrow(compare, "a long, b long")


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, component_id``: the smallest key that links of similarity LEAST or more reach."""
    found = stage(signatures(docs, key, text), "shingles")
    distinct = stage(
        found.groupBy("node").agg(
            F.min("doc_id").alias("first"), F.any_value("fp").alias("fp"), F.any_value("buckets").alias("buckets")
        ),
        "distinct",
    )
    reached = smallest_reachable(shingle_links(docs, stage(loose_groups(distinct), "loose"), text))
    placed = distinct.join(reached, "node", "left").select("node", "first", F.coalesce("smallest", "node").alias("group"))
    named = placed.groupBy("group").agg(F.min("first").alias("component_id"))
    component = placed.join(named, "group").select("node", "component_id")
    return found.select("doc_id", "node").join(component, "node").select("doc_id", "component_id")
