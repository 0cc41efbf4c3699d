"""Token ids in files of compressed planes, written in order of the key and read back.

A folder holds three tables, written by Spark so that a lost task leaves nothing half done:

* ``kind=chunk``: ``shard, chunk, payload``; a payload is one block of BLOCK ids (the last of a shard has fewer).
* ``kind=index``: ``shard, chunk, at, n, bytes``, where in its shard a chunk begins, its ids and its size.
* ``kind=doc``: ``shard, at, n, doc_id``, the extent of each document.

Shards are ranges of the key in ascending order, so the ids of all shards in a row are those of all documents.
A payload is ``PLN1``, then as little-endian numbers the ids (u4), kind of planes (u1: 0 bytes, 1 bits), planes
(u1) and the size of each plane (u4), then the planes, each one zstandard frame: plane k holds byte (or bit) k
of every id of the block, lowest first.

A null text is empty and has the end id alone. Null keys come first. Rows of one key follow in order of their
text's hash. An empty table gives empty files.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placemat.llm.ranges import order_key, range_bounds, range_of
from placemat.llm.tokens import END_ID, ID, VOCABULARY, ByteLevelEncoder, slices, vocabulary_text

BLOCK = 1 << 16
MAGIC = b"PLN1"
HEAD = "<4sIBB"
LEVEL = 3
ROWS = "kind string, shard long, chunk long, at long, n long, bytes long, doc_id long, payload binary"


def pack_block(ids: np.ndarray, bits: bool = False) -> bytes:
    rows = ids.astype(ID).view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = rows.T
    packer = zstandard.ZstdCompressor(level=LEVEL)
    frames = [packer.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    sizes = struct.pack(f"<{len(frames)}I", *map(len, frames))
    return struct.pack(HEAD, MAGIC, len(ids), int(bits), len(frames)) + sizes + b"".join(frames)


def unpack_block(payload: bytes) -> np.ndarray:
    magic, n, bits, count = struct.unpack_from(HEAD, payload)
    if magic != MAGIC:
        raise ValueError("not a block of planes")
    sizes = struct.unpack_from(f"<{count}I", payload, struct.calcsize(HEAD))
    at, planes, reader = struct.calcsize(HEAD) + 4 * count, [], zstandard.ZstdDecompressor()
    for size in sizes:
        planes.append(np.frombuffer(reader.decompress(payload[at : at + size]), np.uint8))
        at += size
    rows = np.stack(planes)
    if bits:
        rows = np.unpackbits(rows, axis=1, bitorder="little")[:, :n]
        rows = np.packbits(rows.T, axis=1, bitorder="little")
    else:
        rows = rows.T
    return np.ascontiguousarray(rows).view(ID).reshape(-1)


class _Rows:
    """Rows of the three tables, collected column by column."""

    names = ("kind", "shard", "chunk", "at", "n", "bytes", "doc_id", "payload")
    kinds = (pa.string(), *[pa.int64()] * 6, pa.binary())

    def __init__(self):
        self.columns: list[list] = [[] for _ in self.names]
        self.size = 0

    def add(self, **values) -> None:
        for column, name in zip(self.columns, self.names, strict=True):
            column.append(values.get(name))
        self.size += len(values.get("payload") or b"")

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(c, k) for c, k in zip(self.columns, self.kinds, strict=True)]
        self.__init__()
        return pa.RecordBatch.from_arrays(arrays, list(self.names))


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    bits: bool = False,
) -> None:
    """Encode every text, append the end id, and write the three tables to ``path``.

    Texts are shuffled once, to ranges of the key; a task reads its ranges in order and holds one block.
    """
    vocabulary = vocabulary or vocabulary_text(VOCABULARY)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteLevelEncoder(vocabulary)
        end = np.array([END_ID], ID).tobytes()
        rows, shard, chunk, at = _Rows(), None, 0, 0
        held = bytearray()

        def flush(size: int) -> None:
            nonlocal chunk
            ids = np.frombuffer(bytes(held[: 4 * size]), ID)
            del held[: 4 * size]
            payload = pack_block(ids, bits)
            rows.add(kind="chunk", shard=shard, chunk=chunk, payload=payload)
            rows.add(
                kind="index", shard=shard, chunk=chunk, at=chunk * BLOCK, n=size, bytes=len(payload)
            )
            chunk += 1

        for batch in batches:
            for few in slices(batch, "text"):
                texts = [t or "" for t in few.column("text").to_pylist()]
                shards, docs_ = few.column("shard").to_pylist(), few.column("doc_id").to_pylist()
                for own, doc, ids in zip(shards, docs_, encoder.encode(texts), strict=True):
                    if own != shard:
                        if held:
                            flush(len(held) // 4)
                        shard, chunk, at = own, 0, 0
                    ids += end
                    rows.add(kind="doc", shard=shard, at=at, n=len(ids) // 4, doc_id=doc)
                    at += len(ids) // 4
                    held += ids
                    while len(held) >= 4 * BLOCK:
                        flush(BLOCK)
                yield rows.batch()
        if held:
            flush(len(held) // 4)
            yield rows.batch()

    bounds = range_bounds(docs, key)
    read = docs.select(order_key(key).alias("k"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ranged = read.withColumn("shard", range_of(F.col("k"), bounds).cast("long"))
    ordered = ranged.repartition("shard").sortWithinPartitions("shard", "k", F.xxhash64("text"))
    made = ordered.select("shard", "doc_id", "text").mapInArrow(encode, ROWS)
    made.write.partitionBy("kind").parquet(path)


def _table(spark: SparkSession, path: str, kind: str, columns: list[str]) -> DataFrame:
    rows = spark.read.schema(ROWS).parquet(path)
    return rows.filter(F.col("kind") == kind).select(*columns)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document and chunk it lies in: ``doc_id, start, n_tokens, offset, ids``.

    ``start`` counts the ids of all documents before, ``offset`` those of the document before this part. Chunks
    meet their extents by shard and chunk; a chunk has at most BLOCK extents. Only the sizes of the shards
    are summed in one place.
    """
    docs = _table(spark, path, "doc", ["shard", "at", "n", "doc_id"])
    chunks = _table(spark, path, "chunk", ["shard", "chunk", "payload"])
    index = _table(spark, path, "index", ["shard", "n"])
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = index.groupBy("shard").agg(F.sum("n").alias("size"))
    firsts = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    first_chunk = F.floor(F.col("at") / BLOCK)
    last_chunk = F.floor((F.col("at") + F.col("n") - 1) / BLOCK)
    extents = (
        docs.withColumn("chunk", F.explode(F.sequence(first_chunk, last_chunk)))
        .groupBy("shard", "chunk")
        .agg(F.collect_list(F.struct("at", "n", "doc_id")).alias("extents"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                block = one.column("chunk")[0].as_py() * BLOCK
                ids = unpack_block(one.column("payload")[0].as_py())
                out: list[list] = [[] for _ in range(5)]
                for x in one.column("extents")[0].as_py():
                    a, b = max(x["at"], block), min(x["at"] + x["n"], block + BLOCK)
                    values = (x["doc_id"], one.column("first")[0].as_py() + x["at"], x["n"], a - x["at"],
                              ids[a - block : b - block].tobytes())
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                kinds = (*[pa.int64()] * 4, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                    ["doc_id", "start", "n_tokens", "offset", "ids"],
                )

    joined = chunks.join(extents, ["shard", "chunk"]).join(F.broadcast(firsts), "shard")
    return joined.select("chunk", "payload", "extents", "first").mapInArrow(
        cut, "doc_id long, start long, n_tokens long, offset long, ids binary"
    )


def token_digests(parts: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document; only parts of split documents move with ids."""
    whole = F.length("ids") == 4 * F.col("n_tokens")
    marked = parts.select(
        "doc_id",
        "start",
        "n_tokens",
        F.when(whole, F.crc32("ids")).alias("crc"),
        F.when(~whole, F.struct("offset", "ids")).alias("part"),
    )
    joined = F.unhex(F.array_join(F.transform(F.sort_array("parts"), lambda p: F.hex(p["ids"])), ""))
    return (
        marked.groupBy("doc_id", "start", "n_tokens")
        .agg(F.first("crc", ignorenulls=True).alias("crc"), F.collect_list("part").alias("parts"))
        .select("doc_id", "start", "n_tokens", F.coalesce("crc", F.crc32(joined)).alias("ids_crc32"))
    )
