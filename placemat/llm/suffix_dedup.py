"""Repeats of WIDTH bytes or more, found on an enhanced suffix array over the places where texts may repeat.

* A window is WIDTH bytes of a text. Its anchor is the least of its k-gram hashes (rightmost of equals), so equal windows
  have equal anchors. Consecutive windows of one anchor make a segment of fewer than two windows' bytes: a row of hashes
  for about every 185 bytes. Anchors whose segments are all equal need no more.
* Windows of one anchor are told apart by its place in them, in RANGE places at once, and by the bytes that all windows of
  such a range share: most anchors that texts share by chance, or beside an edit, end here, as hashes alone. Equal windows
  have the same range and share its bytes. What is left of a segment there is a piece, and is read from the texts.
* The pieces of one range and anchor form a shard. A suffix array over the windows of many shards, with its table of common
  prefixes, is scanned with a stack for the tree of common-prefix intervals. An interval whose suffixes are preceded by
  different bytes is a maximal repeat; it is put out with all its occurrences. The bytes they cover are the ones
  that any repeated window covers: growing a repeated window as long as all its occurrences agree ends in a maximal repeat.
  What covers a segment is one run: it has fewer than two windows' bytes, so any two repeats in it overlap.
* A shard with more than CREW distinct pieces is split again with ever smaller ranges, down to single windows. So a passage
  that a third of all texts holds is compared in pieces that no task holds together; equal pieces count as one throughout.

Texts equal as a whole are one text, held once by each task that reads them. Blocks of texts follow the shuffle
partitions. Matches never cross texts. Null is an empty text; rows that repeat are copies of each other, so they lose all
their bytes if they have WIDTH or more. An empty table gives an empty result. Only key and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.llm.blocks import PACK_BYTES, blocks_of, pack_rows, packed_blocks, release, unpack_rows
from placemat.llm.core import shuffle_partitions
from placemat.scratch import fresh_path, stage

WIDTH = 400
GRAM_BITS = 5
GRAM = 1 << GRAM_BITS
CREW = 256
PARTS = 4
RANGE = WIDTH // PARTS
CHUNK = 1 << 20
PLACE_BITS = 24
SORT_BYTES = 1 << 17
HEAD = 7  # bytes compared at once; the eighth says how many there are
DIVERSE = 256

_rng = np.random.default_rng(12)
BYTE_HASH = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
FACTORS = [np.uint64(x | 1) for x in _rng.integers(0, 1 << 63, GRAM_BITS + 1, dtype=np.uint64)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every place, by doubling."""
    h = BYTE_HASH[data]
    for k in range(GRAM_BITS):
        h = h[: -(1 << k)] * FACTORS[k] + h[1 << k :]
    h ^= h >> np.uint64(29)
    h *= FACTORS[GRAM_BITS]
    h ^= h >> np.uint64(32)
    return h


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    return np.minimum(keys[: len(keys) - (width - reach)], keys[width - reach :]) if width > reach else keys


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """``first, windows, lead, hash`` of each run of windows with one anchor, in texts that lie in a row in ``data``.

    ``lead`` is how far the anchor lies behind the first window's start.
    """
    found: list[tuple[np.ndarray, ...]] = []
    low = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, len(data) - WIDTH + 1, CHUNK):
        part = data[at : at + CHUNK + WIDTH - 1]
        h = gram_hashes(part)
        # The place, counted from the right, makes the rightmost of equal hashes the least.
        keys = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
        least = window_minima(keys, WIDTH - GRAM + 1)
        inside = np.ones(len(least), bool)
        for end in ends[np.searchsorted(ends, at, side="right") : np.searchsorted(ends, at + len(part))].tolist():
            inside[max(0, end - at - WIDTH + 1) : end - at] = False
        starts = np.flatnonzero(inside)
        if not len(starts):
            continue
        own = least[starts]
        first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (np.diff(starts) != 1)]))
        place = (low - (own[first] & low)).astype(np.int64)
        begin = starts[first]
        found.append((begin + at, np.diff(np.append(first, len(starts))), place - begin, h[place].view(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _content(data: bytes, lead: int) -> int:
    return xxhash.xxh3_64_intdigest(data, seed=lead) - (1 << 63)


def suffix_array(pieces: list[bytes], starts_per_piece: np.ndarray) -> tuple[np.ndarray, ...]:
    """``suffix, common, piece, before`` of the suffixes at the first places of each piece, in order.

    ``common[i]`` is the length of the prefix that suffix i shares with the one before it; ``before`` is the byte before
    a suffix, DIVERSE at the beginning of a piece. Ranks are tripled from HEAD bytes on, or doubled where three do not fit a
    key; the ranks of all lengths give the common prefixes.
    """
    sizes = np.array([*map(len, pieces)], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    left = ends[owner] - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(min(HEAD, n)):
        key[: n - k] |= np.where(left[: n - k] > k, data[k:], 0).astype(np.uint64) << np.uint64(56 - 8 * k)
    heads = key | np.minimum(left, HEAD).astype(np.uint64)
    ranks = [np.unique(heads, return_inverse=True)[1] + 1]
    length, longest = HEAD, int(sizes.max())
    times = 3 if (n + 1) ** 3 < 1 << 63 else 2
    while length < longest:
        joined = ranks[-1].copy()
        for ahead in range(length, length * times, length):
            joined *= n + 1
            joined[: max(0, n - ahead)] += np.where(left[: max(0, n - ahead)] > ahead, ranks[-1][ahead:], 0)
        ranks.append(np.unique(joined, return_inverse=True)[1] + 1)
        length *= times
    begin = ends - sizes
    places = np.repeat(begin - np.cumsum(starts_per_piece) + starts_per_piece, starts_per_piece) + np.arange(
        starts_per_piece.sum()
    )
    suffix = places[np.argsort(ranks[-1][places], kind="stable")]
    one, two = suffix[:-1], suffix[1:]
    common = np.zeros(len(one), np.int64)
    for k in [k for k in range(len(ranks) - 1, -1, -1) for _ in range(times - 1)]:
        a, b = one + common, two + common
        open_ = (common < left[one]) & (common < left[two])
        same = np.zeros(len(one), bool)
        same[open_] = ranks[k][a[open_]] == ranks[k][b[open_]]
        common[same] += np.minimum(HEAD * times**k, left[a[same]])
    a, b = one + common, two + common
    open_ = np.flatnonzero((common < left[one]) & (common < left[two]))
    a, b = a[open_], b[open_]
    differ = heads[a] ^ heads[b]
    tail = np.zeros(len(a), np.int64)
    for k in range(HEAD):
        tail += (differ >> np.uint64(56 - 8 * k)) == 0
    common[open_] += np.minimum(tail, np.minimum(left[a], left[b]))
    before = np.where(suffix > begin[owner[suffix]], data[suffix - 1].astype(np.int64), DIVERSE)
    return suffix, np.concatenate([np.zeros(min(1, len(suffix)), np.int64), common]), owner[suffix], before


def maximal_repeats(common: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """``length, first, last`` of each interval of the suffix array that is a maximal repeat of ``least`` bytes or more.

    The intervals of common prefixes nest as a tree. The scan keeps the open ones on a stack, each with the byte
    before its suffixes, or DIVERSE if there are several. Runs of suffixes all preceded by one byte hold no
    maximal repeat and are passed over.
    """
    begins = np.flatnonzero(common < least)
    if not len(begins):
        return
    stops = np.append(begins[1:], len(common))
    low, high = np.minimum.reduceat(before, begins), np.maximum.reduceat(before, begins)
    for i in np.flatnonzero((stops - begins > 1) & ((low != high) | (high == DIVERSE))).tolist():
        begin, stop = int(begins[i]), int(stops[i])
        if stop - begin == 2:
            yield int(common[begin + 1]), begin, begin + 1
            continue
        prefix, byte = common[begin:stop].tolist(), before[begin:stop].tolist()
        stack: list[list[int]] = []  # length, first, byte before
        for k in range(1, stop - begin + 1):
            now = prefix[k] if k < stop - begin else 0
            first, left = k - 1, byte[k - 1]
            while stack and stack[-1][0] > now:
                length, first, held = stack.pop()
                left = left if left == held else DIVERSE
                if left == DIVERSE:
                    yield length, begin + first, begin + k - 1
            if now:
                if stack and stack[-1][0] == now:
                    stack[-1][2] = left if left == stack[-1][2] else DIVERSE
                else:
                    stack.append([now, first, left])


def _indexed(own: pa.Table) -> pa.Table:
    """Rows of a block: its distinct texts in payloads, and the segments of each."""
    block = own.column("block")[0].as_py()
    seen: set[bytes] = set()
    made: list[pa.Table] = []

    def texts(held: list[pa.Table], number: int) -> pa.Table:
        rows = pa.concat_tables(held).combine_chunks()
        tid = (block << 32) + number + np.arange(rows.num_rows, dtype=np.int64)
        text = rows.column("text").cast(pa.large_binary()).combine_chunks()
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = (text.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[offsets[0] : offsets[-1]]
        begins, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        first, windows, lead, h = segments(np.frombuffer(raw, np.uint8), ends)
        text_of = np.searchsorted(begins, first, side="right") - 1
        stops = (first + windows + WIDTH - 1).tolist()
        c = [_content(raw[a:b], x) for a, b, x in zip(first.tolist(), stops, lead.tolist(), strict=True)]
        payload = pack_rows(pa.table({"tid": tid, "digest": rows.column("digest"), "text": text.cast(pa.binary())}))
        cells = {
            "block": pa.array([block], pa.int32()), "payload": pa.array([payload], pa.binary()), "tid": tid[text_of],
            "at": first - begins[text_of], "windows": windows, "lead": lead, "h": h, "c": np.array(c, np.int64),
        }
        one = _rows({"kind": ["text"], "block": cells["block"], "payload": cells["payload"]}, 1)
        cells = {k: pa.array(cells[k]) for k in ("tid", "at", "windows", "lead", "h", "c")}
        return pa.concat_tables([one, _rows(cells | {"kind": ["segment"] * len(c)}, len(c))])

    held, size, number = [], 0, 0
    for payload in own.column("payload").chunks:
        for one in payload:
            rows = unpack_rows([one])
            fresh = []
            for i, digest in enumerate(rows.column("digest").to_pylist()):
                if digest not in seen:
                    seen.add(digest)
                    fresh.append(i)
            held.append(rows.take(pa.array(fresh, pa.int64())))
            size += held[-1].nbytes
            if size > PACK_BYTES:
                made.append(texts(held, number))
                number, held, size = len(seen), [], 0
    if sum(t.num_rows for t in held):
        made.append(texts(held, number))
    release()
    return pa.concat_tables(made)


INDEX = pa.schema(
    [("kind", pa.string()), ("block", pa.int32()), ("payload", pa.binary())]
    + [(c, pa.int64()) for c in ("tid", "at", "windows", "lead", "h", "c")]
)
INDEX_ROWS = "kind string, block int, payload binary, tid long, at long, windows long, lead long, h long, c long"
PIECE = "h long, c long, n long, lead long, windows long, piece binary"
RANGE_ROWS = ["whole_h", "whole_c", "shift", "h", "c", "n", "tid", "at", "lead", "windows"]


def _rows(columns: dict, n: int) -> pa.Table:
    return pa.table([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in INDEX], schema=INDEX)


def _batches(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches(1 << 13)


def write_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` (key, digest), ``texts`` (block, payload) and ``segments`` of the distinct texts, as written tables."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"), F.unhex(F.sha2(body, 256)).alias("digest"))
    path = fresh_path(spark, "suffix-index")
    blocks = packed_blocks(read.select("digest", "text"), "digest", distinct="digest")
    blocks.groupBy("block").applyInArrow(_indexed, INDEX_ROWS).write.partitionBy("kind").parquet(path)

    def table(kind: str, *columns: str) -> DataFrame:
        return spark.read.schema(INDEX_ROWS).parquet(path).filter(F.col("kind") == kind).select(*columns)

    rows = stage(read.select("doc_id", "digest"), "suffix-rows")
    return rows, table("text", "block", "payload"), table("segment", "tid", "at", "windows", "lead", "h", "c")


def _wanted_pieces(own: pa.Table, wanted: pa.Table) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """The wanted rows of each payload of a block, and the bytes they stand for."""
    for payload in own.column("payload").chunks:
        for one in payload:
            rows = unpack_rows([one])
            tids = rows.column("tid").to_numpy()
            if not len(tids) or not wanted.num_rows:
                continue
            asked = wanted.column("tid").to_numpy()
            here = np.flatnonzero((asked >= tids[0]) & (asked <= tids[-1]))
            mine = wanted.take(pa.array(here[np.argsort(asked[here], kind="stable")]))
            texts = rows.column("text")
            held, body, pieces = None, b"", []
            places = zip(*(mine.column(c).to_pylist() for c in ("tid", "at", "windows")), strict=True)
            for tid, at, windows in places:
                if tid != held:
                    held, body = tid, texts[tid - int(tids[0])].as_py()
                pieces.append(body[at : at + windows + WIDTH - 1])
            yield mine, pieces


def _cut_pieces(own: pa.Table, wanted: pa.Table) -> pa.Table:
    """The bytes of the wanted pieces of a block."""
    names = ["h", "c", "n", "lead", "windows"]
    kinds = pa.schema([(x, pa.int64()) for x in names] + [("piece", pa.binary())])
    cut = [m.select(names).append_column("piece", pa.array(p, pa.binary())).cast(kinds) for m, p in _wanted_pieces(own, wanted)]
    release()
    return pa.concat_tables([kinds.empty_table(), *cut])


def _ranges(h: int, lead: int, windows: int, piece: bytes, width: int) -> Iterator[tuple[int, int, int]]:
    """``first, last, hash`` of the windows of a piece in each range of ``width`` places of the anchor.

    A window starting at s has its anchor at lead - s; ranges of that place are [low, low + width).
    """
    for low in range((lead - windows + 1) // width * width, lead + 1, width):
        shared = piece[lead - low : lead - low - width + 1 + WIDTH]
        own = xxhash.xxh3_64_intdigest(shared, seed=(h ^ (low * 1000003 + width)) & ((1 << 64) - 1)) - (1 << 63)
        yield max(0, lead - low - width + 1), min(windows - 1, lead - low), own


def _cut_ranges(own: pa.Table, wanted: pa.Table) -> pa.Table:
    """Hashes of the ranges of the wanted segments of a block, with their places, but not their bytes."""
    made = []
    for mine, pieces in _wanted_pieces(own, wanted):
        columns = (mine.column(x).to_pylist() for x in ("h", "c", "n", "tid", "at", "lead", "windows"))
        for h, c, n, tid, at, lead, windows, piece in zip(*columns, pieces, strict=True):
            for first, last, range_h in _ranges(h, lead, windows, piece, RANGE):
                content = _content(piece[first : last + WIDTH], lead - first)
                made.append((h, c, first, range_h, content, n, tid, at + first, lead - first, last - first + 1))
    release()
    columns = np.array(made, np.int64).reshape(-1, len(RANGE_ROWS)).T
    return pa.table([pa.array(np.ascontiguousarray(x)) for x in columns], names=RANGE_ROWS)


def _repeat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal repeats of whole shards, which come in order, a few MB at once."""
    kinds = pa.schema([("h", pa.int64()), ("length", pa.int64()), ("occurrences", pa.list_(pa.struct([("c", pa.int64()), ("at", pa.int64())])))])

    def repeats(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        pieces = rows.column("piece").to_pylist()
        h, c = rows.column("h").to_numpy(), rows.column("c").to_numpy()
        suffix, common, piece, before = suffix_array(pieces, rows.column("windows").to_numpy())
        begins = np.cumsum([0, *map(len, pieces)])[:-1]
        place, name = suffix - begins[piece], c[piece]
        found = np.array([*maximal_repeats(common, before, WIDTH)], np.int64).reshape(-1, 3)
        length, first, last = found.T
        cuts = np.concatenate([[0], np.cumsum(last - first + 1)])
        order = np.repeat(first - cuts[:-1], last - first + 1) + np.arange(cuts[-1])
        occurrences = pa.StructArray.from_arrays([pa.array(name[order]), pa.array(place[order])], ["c", "at"])
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), occurrences)
        return pa.RecordBatch.from_arrays([pa.array(h[piece[first]]), pa.array(length.copy()), lists], schema=kinds)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        h = batch.column("h").to_numpy()
        sizes = pc.binary_length(batch.column("piece")).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(h)) + 1).tolist(), batch.num_rows]
        begin = 0
        if held and batch.num_rows and held[-1].column("h")[-1].as_py() != h[0] and size > SORT_BYTES:
            yield repeats(held)
            held, size = [], 0
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a > begin and size > SORT_BYTES:
                yield repeats([*held, batch.slice(begin, a - begin)])
                held, size, begin = [], 0, a
            size += int(sizes[a:b].sum())
        if batch.num_rows > begin:
            held.append(batch.slice(begin))
    if held:
        yield repeats(held)


def _split_pieces(width: int):
    """Cut each piece where the anchor's place in the window passes a multiple of ``width``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "c", "lead", "windows", "piece"]
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for h, c, lead, windows, piece in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                for first, last, own in _ranges(h, lead, windows, piece, width):
                    part = piece[first : last + WIDTH]
                    content = _content(part, lead - first)
                    for column, value in zip(out, (h, c, first, own, content, lead - first, last - first + 1, part), strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(out, kinds, strict=True)],
                ["whole_h", "whole_c", "shift", "h", "c", "lead", "windows", "piece"],
            )

    return run


def _loose(rows: DataFrame, times: Column | None = None) -> DataFrame:
    """Anchors with several rows: ``h`` and whether all their contents are equal. ``times``: rows that a row stands for.

    It is written, so that a join with it shuffles both sides anew and adaptive execution can split a hot anchor.
    """
    n = F.count("*") if times is None else F.sum(times)
    found = rows.groupBy("h").agg(n.alias("n"), F.min("c").alias("a"), F.max("c").alias("b"))
    return stage(found.filter("n > 1").select("h", (F.col("a") == F.col("b")).alias("equal")), "anchors")


def _distinct(rows: DataFrame, n: Column) -> DataFrame:
    """``h, c, n`` and the first place of each content."""
    place = F.min(F.struct("tid", "at", "lead", "windows")).alias("first")
    return rows.groupBy("h", "c").agg(n.alias("n"), place).select("h", "c", "n", "first.*")


def _joined(spans: DataFrame) -> DataFrame:
    """One span per piece: repeats in fewer than two windows' bytes overlap. Written for the reason given in ``_loose``."""
    return stage(spans.groupBy("h", "c").agg(F.min("a").alias("a"), F.max("b").alias("b")), "spans")


def piece_repeats(pieces: DataFrame, width: int = RANGE) -> tuple[DataFrame, list[DataFrame]]:
    """``h, c, a, b``: bytes of each piece that repeats cover; and the maximal repeats found (``h, length, occurrences``).

    ``pieces`` is a written table of distinct ``h, c`` with ``n``, the number of places a piece stands at.
    """
    sizes = pieces.groupBy("h").agg(F.count("*").alias("crew"))
    most = sizes.agg(F.max("crew")).first()[0] or 0
    whole = pieces.filter("n > 1").select("h", "c", F.lit(0).cast("long").alias("a"), (F.col("windows") + WIDTH - 1).alias("b"))
    parts = shuffle_partitions(pieces.sparkSession)
    calm = pieces if most <= CREW else pieces.join(sizes.filter(F.col("crew") <= CREW), "h", "left_semi")
    ordered = calm.select("h", "c", "windows", "piece").repartition(parts, "h").sortWithinPartitions("h")
    groups = stage(
        ordered.mapInArrow(_repeat_rows, "h long, length long, occurrences array<struct<c: long, at: long>>"), "repeats"
    )
    spans = whole.unionAll(
        groups.select("h", "length", F.explode("occurrences").alias("o")).select(
            "h", "o.c", F.col("o.at").alias("a"), (F.col("o.at") + F.col("length")).alias("b")
        )
    )
    if most <= CREW:
        return spans, [groups]
    narrow = max(1, -(-width // PARTS))
    hot = pieces.join(sizes.filter(F.col("crew") > CREW), "h", "left_semi").select("h", "c", "lead", "windows", "piece")
    cut = stage(
        hot.mapInArrow(
            _split_pieces(narrow),
            "whole_h long, whole_c long, shift long, h long, c long, lead long, windows long, piece binary",
        ),
        "splits",
    )
    several = stage(cut.join(_loose(cut), "h"), "splits")  # written, so that adaptive execution can split a hot anchor
    distinct = several.groupBy("h", "c").agg(
        F.count("*").alias("n"), F.first("lead").alias("lead"), F.first("windows").alias("windows"), F.first("piece").alias("piece")
    )
    below, more = piece_repeats(stage(distinct, "pieces"), narrow)
    back = cut.select("h", "c", "whole_h", "whole_c", "shift").join(below, ["h", "c"])
    spans = spans.unionAll(
        back.select(
            F.col("whole_h").alias("h"), F.col("whole_c").alias("c"), (F.col("shift") + F.col("a")).alias("a"), (F.col("shift") + F.col("b")).alias("b")
        )
    )
    return spans, [groups, *more]


def _without(own: pa.Table, spans: pa.Table) -> pa.Table:
    """What is left of the texts of a block."""
    order = np.lexsort((spans.column("a").to_numpy(), spans.column("tid").to_numpy()))
    tid, a, b = (spans.column(x).to_numpy()[order] for x in ("tid", "a", "b"))
    out: list[list] = [[] for _ in range(5)]
    for payload in own.column("payload").chunks:
        for one in payload:
            rows = unpack_rows([one])
            tids = rows.column("tid").to_numpy()
            first, last = np.searchsorted(tid, tids), np.searchsorted(tid, tids, side="right")
            for k in range(rows.num_rows):
                body = rows.column("text")[k].as_py()
                kept, upto, runs = [], 0, 0
                for x, y in zip(a[first[k] : last[k]].tolist(), b[first[k] : last[k]].tolist(), strict=True):
                    if x > upto or not runs:
                        kept.append(body[upto:x])
                        runs += 1
                    upto = max(upto, y)
                rest = b"".join([*kept, body[upto:]])
                values = rows.column("digest")[k].as_py(), len(body), len(body) - len(rest), runs, hashlib.sha256(rest).hexdigest()
                for column, value in zip(out, values, strict=True):
                    column.append(value)
    release()
    kinds = [pa.binary(), *[pa.int64()] * 3, pa.string()]
    names = ["digest", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``: each row's text without the bytes of repeated windows."""
    rows, texts, found = write_index(docs, key, text)
    parts = shuffle_partitions(docs.sparkSession)

    def beside_texts(asked: DataFrame):
        asked = asked.withColumn("block", F.shiftright("tid", 32).cast("int"))
        by_block = texts.repartition(parts, "block").groupBy("block")
        return by_block.cogroup(asked.repartition(parts, "block").groupBy("block"))

    marked = stage(found.join(_loose(found), "h"), "segments")
    loose = marked.filter(~F.col("equal"))
    segments_ = _distinct(loose, F.count("*"))
    ranges = stage(beside_texts(segments_).applyInArrow(_cut_ranges, ", ".join(f"{x} long" for x in RANGE_ROWS)), "ranges")
    several = stage(ranges.join(_loose(ranges, F.col("n")), "h"), "ranges")
    open_ = several.filter(~F.col("equal"))
    spans, _ = piece_repeats(stage(beside_texts(_distinct(open_, F.sum("n"))).applyInArrow(_cut_pieces, PIECE), "pieces"))
    whole = F.col("whole_h").alias("h"), F.col("whole_c").alias("c")
    spans = several.filter("equal").select(
        *whole, F.col("shift").alias("a"), (F.col("shift") + F.col("windows") + WIDTH - 1).alias("b")
    ).unionAll(
        open_.join(_joined(spans), ["h", "c"]).select(
            *whole, (F.col("shift") + F.col("a")).alias("a"), (F.col("shift") + F.col("b")).alias("b")
        )
    )
    covered = (
        marked.filter("equal")
        .select("tid", F.col("at").alias("a"), (F.col("at") + F.col("windows") + WIDTH - 1).alias("b"))
        .unionAll(
            loose.select("tid", "at", "h", "c").join(_joined(spans), ["h", "c"]).select("tid", (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("b")).alias("b"))
        )
    )
    left = beside_texts(covered).applyInArrow(
        _without, "digest binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    copies = rows.groupBy("digest").agg(F.count("*").alias("copies"))
    judged = left.join(copies, "digest")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= WIDTH)
    judged = judged.select(
        "digest",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
    return rows.join(judged, "digest").drop("digest")
