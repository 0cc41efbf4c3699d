"""Blocks of documents that look things up in a large table.

A block is a hash class of documents, of bounded size because their number follows the shuffle partitions. It asks
once for each distinct thing its documents hold, in one row per bucket of the table, and gets one row
back. So a thing that a third of all documents hold is asked for once per block, and documents are shuffled once:
all steps that read the same frame of blocks share its exchange.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.llm.core import shuffle_partitions

BLOCKS_PER_PARTITION = 2


def blocks_of(docs: DataFrame) -> int:
    return BLOCKS_PER_PARTITION * shuffle_partitions(docs.sparkSession)


def block_number(docs: DataFrame, key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks_of(docs))).cast("int")


def release() -> None:
    """Give memory that finished groups have left back to the system: workers live on, and an executor has several."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


#: Rows a task holds before it packs them, in bytes of Arrow data.
PACK_BYTES = 16 << 20


def pack_rows(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpack_rows(payloads: pa.ChunkedArray) -> pa.Table | None:
    """All rows of a block, or None if it has none."""
    tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for p in payloads]
    return pa.concat_tables(tables) if tables else None


def packed_blocks(docs: DataFrame, key: str, distinct: str | None = None) -> DataFrame:
    """``block, payload``, shuffled by block: the rows of ``docs`` in compressed packs.

    Text takes about half the room in the shuffle that it takes row by row. With ``distinct``, a task sends one of the
    rows that are equal in that column, so that a row which a third of all rows repeat travels once per task.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            blocks = rows.column("block").to_numpy()
            order = np.argsort(blocks, kind="stable")
            sorted_blocks = blocks[order]
            cuts = [0, *(np.flatnonzero(np.diff(sorted_blocks)) + 1).tolist(), len(order)]
            rows = rows.drop_columns(["block"])
            own, data = [], []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    own.append(int(sorted_blocks[a]))
                    data.append(pack_rows(rows.take(pa.array(order[a:b])).combine_chunks()))
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(data, pa.binary())], ["block", "payload"])

        held, size = [], 0
        seen: set = set()
        for batch in batches:
            if distinct:
                values = batch.column(distinct).to_pylist()
                fresh = [i for i, v in enumerate(values) if v not in seen and not seen.add(v)]
                batch = batch.take(pa.array(fresh, pa.int64()))
            held.append(batch)
            size += batch.nbytes
            if size > PACK_BYTES:
                yield packs(held)
                held, size = [], 0
        if held:
            yield packs(held)
        held = []
        release()

    numbered = docs.withColumn("block", block_number(docs, F.col(key)))
    parts = shuffle_partitions(docs.sparkSession)
    return numbered.mapInArrow(pack, "block int, payload binary").repartition(parts, "block")
