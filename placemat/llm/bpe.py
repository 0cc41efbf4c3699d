"""BPE encoding and decoding over a table of distinct words.

Texts are cut at ASCII white space, which this kind of vocabulary drops and never joins across. Each block of
documents lists its distinct words by bucket (a hash of the word), in order; a bucket brings the lists of all blocks
together and encodes each distinct word once; the ids go back to the blocks and are put where the word stands. Decoding looks
every id up in the table of pieces, whose size is the vocabulary's, and joins the pieces by a space, as the tokenizer
does that has no decoder.

A null text is empty and has no ids; its decoded text is empty. Repeated rows are encoded each. An empty table
gives an empty result. A text without white space is one word, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemat.llm.blocks import blocks_of, packed_blocks, squeeze, unpack_rows, unsqueeze
from placemat.llm.tokens import ID, load_tokenizer, slices, vocabulary_text

VOCABULARY = "word_bpe_49k.json"
WORDS_AT_ONCE = 5000


def words_by_bucket(texts: list[bytes], buckets: int) -> dict[int, list[bytes]]:
    """Distinct words in order, by bucket."""
    distinct: set[bytes] = set()
    for text in texts:
        distinct.update(text.split())
    out: dict[int, list[bytes]] = {}
    for word in sorted(distinct):
        out.setdefault(xxhash.xxh64_intdigest(word) % buckets, []).append(word)
    return out


def _planes(values: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones, and so on, which compresses better."""
    return values.astype(ID).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(ID).reshape(-1)


def _texts(rows: pa.Table) -> list[bytes]:
    return [t.as_py() or b"" for t in rows.column("text").cast(pa.binary())]


def _word_lists(blocks: DataFrame, buckets: int) -> DataFrame:
    """``block, bucket, words``: the distinct words of a block in order, space-joined and compressed."""

    def read(own: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        lists = words_by_bucket(_texts(unpack_rows(own.column("payload"))), buckets)
        block = own.column("block")[0].as_py()
        return pa.table(
            {
                "block": pa.array([block] * len(lists), pa.int32()),
                "bucket": pa.array(list(lists), pa.int32()),
                "words": pa.array([squeeze(b" ".join(w)) for w in lists.values()], pa.binary()),
            }
        )

    return blocks.groupBy("block").applyInArrow(read, "block int, bucket int, words binary")


def _encoded_lists(lists: DataFrame, vocabulary: str) -> DataFrame:
    """``block, bucket, ids``: for each list the number of ids of every word, and all ids, compressed."""

    loaded: list = []  # one tokenizer for all buckets of a task

    def encode(group: pa.Table) -> pa.Table:
        if not loaded:
            loaded.append(load_tokenizer(vocabulary))
        tokenizer = loaded[0]
        asked = [unsqueeze(x).split() for x in group.column("words").to_pylist()]
        distinct = list(set().union(*asked))
        known: dict[bytes, list[int]] = {}
        for at in range(0, len(distinct), WORDS_AT_ONCE):
            some = distinct[at : at + WORDS_AT_ONCE]
            found = tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            known.update(zip(some, [e.ids for e in found], strict=True))
        answers = []
        for words in asked:
            ids = [known[w] for w in words]
            row = np.array([len(words), *map(len, ids), *chain.from_iterable(ids)], ID)
            answers.append(squeeze(_planes(row)))
        return pa.table(
            {"block": group.column("block"), "bucket": group.column("bucket"), "ids": pa.array(answers, pa.binary())}
        )

    return lists.groupBy("bucket").applyInArrow(encode, "block int, bucket int, ids binary")


def _table_of(lists: dict[int, list[bytes]], answers: pa.Table) -> dict[bytes, bytes]:
    """Ids by word, of all words of a block."""
    table: dict[bytes, bytes] = {}
    for bucket, ids in zip(answers.column("bucket").to_pylist(), answers.column("ids").to_pylist(), strict=True):
        row = _from_planes(unsqueeze(ids))
        n = int(row[0])
        ends = (4 * np.cumsum(row[1 : n + 1], dtype=np.int64)).tolist()
        data, at = row[n + 1 :].tobytes(), 0
        for word, end in zip(lists[bucket], ends, strict=True):
            table[word] = data[at:end]
            at = end
    return table


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, ids``: ids as little-endian unsigned 32-bit integers."""
    vocabulary = vocabulary or vocabulary_text(VOCABULARY)
    buckets = blocks_of(docs)
    read = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = packed_blocks(read, "doc_id")
    answers = _encoded_lists(_word_lists(blocks, buckets), vocabulary)

    def place(own: pa.Table, lists: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        rows = unpack_rows(own.column("payload"))
        texts = _texts(rows)
        table = _table_of(words_by_bucket(texts, buckets), lists)
        ids = [b"".join([table[w] for w in t.split()]) for t in texts]
        return pa.table({"doc_id": rows.column("doc_id"), "ids": pa.array(ids, pa.binary())})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(place, "doc_id long, ids binary")


def pieces_by_id(vocabulary: str) -> list[bytes | None]:
    """The piece of every id; None where the vocabulary has none."""
    tokenizer = load_tokenizer(vocabulary)
    found = {i: p.encode() for p, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    return [found.get(i) for i in range(max(found, default=-1) + 1)]


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with ``decoded``: the pieces of the ids, joined by a space."""
    vocabulary = vocabulary or vocabulary_text(VOCABULARY)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_by_id(vocabulary)
        for batch in batches:
            for few in slices(batch, "ids"):
                out = []
                for ids in few.column("ids"):
                    found = map(pieces.__getitem__, np.frombuffer(ids.as_py(), ID).tolist())
                    out.append(b" ".join(found).decode())
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), few.column("ids"), pa.array(out, pa.string())], ["doc_id", "ids", "decoded"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids binary, decoded string")
