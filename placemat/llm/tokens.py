"""Byte-level BPE ids of whole texts.

Ids are those of the tokenizers library for the same vocabulary file. Ordinary text is encoded by tiktoken with the
ranks of that file, which takes a third of the time and no table of words; the tests compare the two, also for
every code point. A text that holds the string of a special token, or millions of spaces in a row, goes to the
tokenizers library.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
ID = np.dtype("<u4")
BYTES_AT_ONCE = 2 << 20

# Fixed value: how a byte-level vocabulary splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_text(name: str) -> str:
    """The vocabulary file's text, read on the driver and sent to the tasks (below 2 MB)."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def load_tokenizer(vocabulary: str) -> Tokenizer:
    """Without truncation, padding or threads of its own: Spark gives each task one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_of_character() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevelEncoder:
    def __init__(self, vocabulary: str):
        self.tokenizer = load_tokenizer(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte = byte_of_character()
        pieces = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(byte[c] for c in p): i for p, i in pieces.items() if p not in self.special}
        self.ordinary = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [self._encode_one(text).tobytes() for text in texts]

    def _encode_one(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            try:
                return self.ordinary.encode_to_numpy(text, disallowed_special=()).astype(ID, copy=False)
            except ValueError:  # a run of white space too long for its splitter
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, ID)


def slices(batch: pa.RecordBatch, text: str) -> Iterable[pa.RecordBatch]:
    """The batch in runs of rows whose texts (or ids) add up to a few MB, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // BYTES_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
