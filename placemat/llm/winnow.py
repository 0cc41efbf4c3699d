"""Document fingerprints by winnowing, and the likeness of neighbouring documents.

A text is read as short pieces (``PIECE``): words are cut into pieces of at most four letters or digits, and any other sign, or
letter of another script, is a piece of its own, so text without spaces has pieces as well. Each run of K pieces has
a polynomial hash modulo PRIME, which is put together from the hashes of its parts: those of one and of two pieces are
extended at all places at once, so no run is read anew. Of every window of WINDOW successive runs the smallest hash is
chosen, the rightmost one where equal, and kept with its position. Two texts that share ``K + WINDOW - 1`` pieces in a row
therefore share a chosen hash, and its positions say where.

Shorter texts have shorter windows (``WINDOWS``), so that a text of a few words has more than one hash. What a shorter
window chooses includes what a longer one does, so texts of unlike length still compare. A text of fewer than K pieces has
one run, of those it has; a text without any, or null, has an empty fingerprint. Likeness is the share of common distinct
hashes (Jaccard); two empty fingerprints are alike (1.0). Repeated rows each get their own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemat.llm.ranges import bound_array, order_key, range_bounds, range_of

PIECE = r"[A-Za-z\u00AA-\u02FF]{1,4}|[0-9]{1,4}|[^\x20\x09-\x0D]"
K = 4
WINDOW = 16  # a power of two
#: Windows of texts with fewer runs than the first number.
WINDOWS = ((32, 1), (128, 4))
PRIME = (1 << 31) - 1
BASE = 1_000_003
MIX = 1_540_483_477  # spreads the hashes, so that the smallest is not that of the smallest letters
POSITION_BITS = 31
LAST_POSITION = (1 << POSITION_BITS) - 1


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values), F.lit(1)))


def _extended(values: Column, following: Column, places: int, by: int) -> Column:
    """Hashes of runs from those of their first ``by`` pieces and of the ``places`` pieces after these."""
    factor = F.lit(pow(BASE, places, PRIME)).cast("bigint")
    return F.zip_with(values, _shifted(following, by), lambda a, b: (a * factor + b) % F.lit(PRIME))


def _shifted_least(values: Column, by: int) -> Column:
    """Smaller of each value and the one ``by`` places later; past the end there is none."""
    return F.zip_with(values, _shifted(values, by), lambda a, b: F.least(a, b))


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the chosen runs in order, as ``hash * 2**31 + (2**31 - 1 - position)``.

    Packed like this, the least value of a window is the least hash, and of equal ones the rightmost.
    """
    before = df.columns

    def step(name: str, value: Column) -> Column:
        nonlocal df
        df = df.withColumn(f"__{out}_{name}", value)
        return F.col(f"__{out}_{name}")

    read = F.coalesce(F.col(text), F.lit(""))
    pieces = F.regexp_extract_all(read, F.lit(PIECE), F.lit(0))
    one = step("1", F.transform(pieces, lambda piece: F.xxhash64(piece).bitwiseAND(F.lit(PRIME))))
    two = step("2", _extended(one, one, 1, 1))
    full = _extended(two, two, 2, 2)
    short = F.array(F.aggregate(one, F.lit(0).cast("bigint"), lambda h, c: (h * BASE + c) % F.lit(PRIME)))
    runs = F.when(F.size(one) >= K, F.slice(full, F.lit(1), F.greatest(F.size(one) - (K - 1), F.lit(1))))
    runs = step("runs", runs.when(F.size(one) > 0, short).otherwise(F.array().cast("array<bigint>")))

    def packed(h: Column, at: Column) -> Column:
        return F.shiftleft(h * F.lit(MIX) % F.lit(PRIME), POSITION_BITS).bitwiseOR(F.lit(LAST_POSITION).cast("bigint") - at)

    least, reach = step("least1", F.transform(runs, packed)), 1
    levels = {1: least}
    while reach < WINDOW:
        least = step(f"least{2 * reach}", _shifted_least(least, reach))
        reach *= 2
        levels[reach] = least

    def chosen(window: int) -> Column:
        return F.array_distinct(F.slice(levels[window], F.lit(1), F.greatest(F.size(runs) - window + 1, F.lit(1))))

    value = chosen(WINDOW)
    for fewer, window in reversed(WINDOWS):
        value = F.when(F.size(runs) < fewer, chosen(window)).otherwise(value)
    return df.withColumn(out, value).select(*[c for c in before if c != out], out)


def hashes(chosen: Column) -> Column:
    return F.transform(chosen, lambda p: F.shiftrightunsigned(p, POSITION_BITS))


def positions(chosen: Column) -> Column:
    """Positions of the chosen runs, in pieces."""
    return F.transform(chosen, lambda p: F.lit(LAST_POSITION) - p.bitwiseAND(F.lit(LAST_POSITION)))


def fingerprint_text(chosen: Column) -> Column:
    return F.array_join(F.transform(hashes(chosen), lambda h: F.lower(F.hex(h))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Common hashes of two arrays of distinct hashes over all of them, 0 to 1."""

    def of(both: Column) -> Column:
        common = F.size(F.array_intersect(both["a"], both["b"]))
        return common / (F.size(both["a"]) + F.size(both["b"]) - common)

    pair = F.array(F.struct(a.alias("a"), b.alias("b")))
    return F.element_at(
        F.transform(pair, lambda p: F.when(F.size(p["a"]) + F.size(p["b"]) == 0, 1.0).otherwise(of(p))), 1
    )


def with_next(df: DataFrame, key: str, carried: dict[str, str], tie: Column) -> DataFrame:
    """Each row with columns of the next row by descending ``key``; the first row follows the last.

    ``carried`` maps a column to the name its next value gets. Rows go by one shuffle to ranges of the key,
    cut at values the key has; the row at a cut is also sent, as a guest, to the range that ends before it,
    so that no second pass is needed. Null keys come last. Rows of one key share a range, ordered by ``tie``.
    """
    bounds = range_bounds(df, key)
    last = F.lit(len(bounds) - 1)
    keyed = df.withColumn("__key", order_key(key)).withColumn("__tie", tie)
    keyed = keyed.withColumn("__own", range_of(F.col("__key"), bounds))
    at_cut = F.col("__key") == F.element_at(bound_array(bounds), F.col("__own") + 1)

    def place(bucket: Column, guest: bool) -> Column:
        return F.struct(bucket.alias("bucket"), F.lit(guest).alias("guest"))

    guest = place(F.when(F.col("__own") == last, F.lit(0)).otherwise(F.col("__own") + 1), True)
    own = place(F.col("__own"), False)
    placed = keyed.withColumn(
        "__place", F.explode(F.when(at_cut, F.array(own, guest)).otherwise(F.array(own)))
    )
    window = Window.partitionBy(F.col("__place.bucket")).orderBy(
        F.col("__place.guest"), F.col("__key").desc(), F.col("__tie")
    )
    seen = placed.select("*", *[F.lead(c).over(window).alias(name) for c, name in carried.items()])
    return seen.filter(~F.col("__place.guest")).drop("__key", "__tie", "__own", "__place")


def edited_text(text: Column, following: Column) -> Column:
    """``text`` whose last third (rounded down, code points) is replaced by the start of ``following``."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third)
    )


def neighbour_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, text, ``edited`` text, fingerprints ``own``, ``other`` (of the edited text) and the likenesses."""
    read = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    printed = fingerprint(read, "text", "own")
    paired = with_next(printed, key, {"text": "next_text", "own": "next_own"}, F.xxhash64("text"))
    edited = paired.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    both = fingerprint(edited, "edited", "other")

    def distinct(chosen: str) -> Column:
        return F.array_distinct(hashes(F.col(chosen)))

    return both.select(
        key,
        "text",
        "edited",
        "own",
        "other",
        likeness(distinct("own"), distinct("other")).alias("near_edited"),
        likeness(distinct("own"), distinct("next_own")).alias("near_next"),
    )
