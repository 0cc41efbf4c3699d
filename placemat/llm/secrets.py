"""Secret scans: named patterns, and windows of high Shannon entropy in runs of key-like characters.

Everything is a Column expression over one text, so a scan moves no rows and long texts never meet.

Spans are structs ``start, rank, end, kind`` with code point positions, end exclusive, in order of start,
then of rank. Base kinds keep every leftmost, non-overlapping match that is long enough. The entropy kinds
slide a window over each run of 20 or more characters of ``[A-Za-z0-9+/_=-]`` that looks drawn: letters and digits
mixed, or letters of both cases that are not words strung together. Runs shorter than the wide window have a window
of their own, with the threshold in the same proportion. Small letters alone tell words and keys not apart and
are left. Moving by one character lowers one count and raises another; the sum of ``n*log2(n)`` follows, held
in whole units of 2**-20 bit so that no error gathers. A span reaches from the first window at or above the
threshold of its class to the end of the last one. Runs that match an allow-list pattern add nothing.

Null or empty text has no spans. Repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"

# A segment of a path: words or short numbers, parted by signs or capitals.
_PIECE = r"(?:[a-z]+|[A-Z]+|[a-z]*(?:[A-Z][a-z]{2,})+)[0-9]{0,4}"
_WORDS = rf"(?:{_PIECE}|[0-9]{{1,4}})(?:[_=-]+(?:{_PIECE}|[0-9]{{1,4}}))*"
# Words of two letters within such names.
SHORT_WORDS = "An|As|At|By|Do|If|In|Is|It|My|No|Of|On|Or|To|Up|We"
#: Words strung together, told by their capitals.
CAMEL = rf"^[a-z]*(?:[A-Z]*(?:{SHORT_WORDS}|[A-Z][a-z]{{2,}}))*[A-Z]*$"

ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUID
    r"(?i)example|sample|dummy|placeholder|changeme|redacted",
    r"(?i)0123456789|1234567890|abcdefghij",
    rf"^/?(?:{_WORDS}/)+(?:{_WORDS})?$",  # file path of plain words
)


class CharClass(NamedTuple):
    kind: str
    alphabet: str
    window: int
    threshold: float  # bits per character


SHORTEST = 20
_WIDE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CLASSES = (
    CharClass("entropy_hex", "0123456789abcdef", 20, 3.0),
    CharClass("entropy_base64", _WIDE, 24, 3.9),
    CharClass("entropy_base64", _WIDE, SHORTEST, 3.9 * math.log2(SHORTEST) / math.log2(24)),
    CharClass("entropy_base64", _WIDE, SHORTEST, 3.5),  # one case and digits, which are fewer symbols
)
BASE_KINDS = ("assign", "access", "hex")
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
UNIT = 1 << 20
BLOCK = 256


def weights(window: int) -> list[int]:
    """``n*log2(n)`` for n up to the window's length, in units of 2**-20."""
    return [0] + [round(n * math.log2(n) * UNIT) for n in range(1, window + 1)]


def limit(window: int, threshold: float) -> int:
    """The largest sum of weights at which a window's entropy still reaches the threshold."""
    return math.floor((math.log2(window) - threshold) * window * UNIT)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def running_sums(values: Column) -> Column:
    """Sums of the first 1, 2, ... values: within blocks, and once per block before it."""

    def block(b: Column) -> Column:
        own = F.slice(values, b * BLOCK + 1, F.lit(BLOCK))
        before = F.array(_sum(F.slice(values, F.lit(1), b * BLOCK)))
        return F.flatten(
            F.transform(
                before,
                lambda p: F.transform(own, lambda _, i: p + _sum(F.slice(own, F.lit(1), i + 1))),
            )
        )

    last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
    return F.when(
        F.size(values) > 0, F.flatten(F.transform(F.sequence(F.lit(0), last), block))
    ).otherwise(F.array().cast("array<int>"))


def _found(df: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Columns ``name`` (matched strings) and ``name_end`` (their ends in the text)."""
    df = df.withColumn(name, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    # What lies between the matches, found by the same search, tells where they are.
    steps = F.when(
        F.size(name) > 0,
        F.zip_with(
            name, F.split(F.col(text), pattern, -1), lambda hit, gap: F.length(hit) + F.length(gap)
        ),
    ).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(f"{name}_step", F.slice(steps, F.lit(1), F.size(name)))
    return df.withColumn(f"{name}_end", running_sums(F.col(f"{name}_step")))


def _span(start: Column, rank: int, end: Column, kind: str) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        F.lit(rank).alias("rank"),
        end.cast("int").alias("end"),
        F.lit(kind).alias("kind"),
    )


def _base(name: str, rank: int, kind: str, least: int, size_of) -> Column:
    spans = F.zip_with(
        name,
        f"{name}_end",
        lambda hit, end: F.when(size_of(hit) >= least, _span(end - F.length(hit), rank, end, kind)),
    )
    return F.filter(spans, lambda s: s.isNotNull())


def _step(counts: Column, total: Column, code: Column, by: int, weight: Column) -> tuple[Column, Column]:
    """Counts and sum of weights after one character comes in (by = 1) or goes out (by = -1)."""
    had = F.element_at(counts, code)
    moved = F.transform(counts, lambda n, k: F.when(k + 1 == code, n + by).otherwise(n))
    return moved, total + F.element_at(weight, had + by + 1) - F.element_at(weight, had + 1)


def hot_windows(run: Column, spec: CharClass) -> Column:
    """Struct ``first, last``: ends of the first and last window at or above the threshold, 0 if none."""
    weight = F.array(*[F.lit(w).cast("bigint") for w in weights(spec.window)])
    most = limit(spec.window, spec.threshold)
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(spec.alphabet), c))

    def slide(codes: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), len(spec.alphabet)).alias("counts"),
            F.lit(0).cast("bigint").alias("total"),
            F.lit(0).alias("at"),
            F.lit(0).alias("first"),
            F.lit(0).alias("last"),
        )

        def move(state: Column, code: Column) -> Column:
            at = state["at"] + 1
            gone = F.when(at > spec.window, F.element_at(codes, F.greatest(at - spec.window, F.lit(1))))
            less = F.transform(
                state["counts"], lambda n, k: F.when(gone.isNotNull() & (k + 1 == gone), n - 1).otherwise(n)
            )
            left = state["total"] + F.when(
                gone.isNotNull(),
                F.element_at(weight, F.element_at(state["counts"], gone))
                - F.element_at(weight, F.element_at(state["counts"], gone) + 1),
            ).otherwise(F.lit(0).cast("bigint"))
            step = F.struct(less.alias("counts"), left.alias("total"))

            def enter(s: Column) -> Column:
                counts, total = _step(s["counts"], s["total"], code, 1, weight)
                hot = (at >= spec.window) & (total <= most)
                return F.struct(
                    counts.alias("counts"),
                    total.alias("total"),
                    at.alias("at"),
                    F.when(hot & (state["first"] == 0), at).otherwise(state["first"]).alias("first"),
                    F.when(hot, at).otherwise(state["last"]).alias("last"),
                )

            return F.element_at(F.transform(F.array(step), enter), 1)

        return F.aggregate(codes, start, move, lambda s: F.struct(s["first"], s["last"]))

    return F.element_at(F.transform(F.array(codes), slide), 1)


HEX_RUN = r"^(?:[0-9a-f]+|[0-9A-F]+)$"
#: What makes a run look drawn, by the class it is judged in.
MIXED = r"^(?=.*[0-9])(?=.*[A-Za-z])"
BOTH_CASES = r"^(?=.*[a-z])(?=.*[A-Z])"
#: One case alone: letters and digits without signs that change places at least three times.
ALTERNATING = r"^(?=(?:[a-z0-9]+|[A-Z0-9]+)$)(?:.*[0-9][A-Za-z]){3}"


def _class_of(run: Column) -> Column:
    """Number of the run's class: hex digits of one case alone, one case with digits, else the wide or the short window."""
    return F.when(run.rlike(HEX_RUN), 0).when(run.rlike(ALTERNATING), 3).when(F.length(run) >= CLASSES[1].window, 1).otherwise(2)


def _drawn(run: Column, cls: Column) -> Column:
    letters = run.rlike("^[A-Za-z]+$") & run.rlike(BOTH_CASES) & ~run.rlike(CAMEL)
    mixed = run.rlike(MIXED)
    return (mixed & ((cls != 2) | run.rlike(BOTH_CASES))) | letters


def secret_spans(
    docs: DataFrame, text: str = "text", allowed: tuple[str, ...] = ALLOWED, out: str = "secrets"
) -> DataFrame:
    """``docs`` with array columns ``<out>_base`` (pattern spans) and ``<out>`` (all spans).

    Columns of these names are replaced; no other column changes.
    """
    kept = docs.columns
    t, a, c, h, r = (f"__{out}_{x}" for x in ("text", "assign", "access", "hex", "run"))
    df = docs.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    df = _found(df, t, a, ASSIGN)
    df = _found(df, t, c, ACCESS)
    # A run of hex digits is a match whatever its length, so only the long ones need be found.
    df = _found(df, t, h, r"(?<![0-9a-f])[0-9a-f]{32,}")
    df = _found(df, t, r, RUN)
    base = F.concat(
        _base(a, 0, "assign", 8, lambda hit: F.length(F.regexp_extract(hit, "^(?:" + ASSIGN + ")$", 2))),
        _base(c, 1, "access", 16, F.length),
        _base(h, 2, "hex", 32, F.length),
    )

    def entropy_span(run: Column, end: Column) -> Column:
        cls = _class_of(run)
        fair = _drawn(run, cls)
        for pattern in allowed:
            fair = fair & ~run.rlike(pattern)
        start = end - F.length(run)

        def spans(spec: CharClass, rank: int) -> Column:
            hot = F.transform(
                F.array(hot_windows(F.lower(run) if spec is CLASSES[0] else run, spec)),
                lambda w: F.when(
                    w["last"] > 0, _span(start + w["first"] - spec.window, rank, start + w["last"], spec.kind)
                ),
            )
            return F.element_at(hot, 1)

        judged = F.when(cls == 0, spans(CLASSES[0], 3))
        for n in (1, 2, 3):
            judged = judged.when(cls == n, spans(CLASSES[n], 4))
        return F.when(fair, judged)

    added = F.filter(F.zip_with(r, f"{r}_end", entropy_span), lambda s: s.isNotNull())
    df = df.withColumn(f"{out}_base", F.sort_array(base.cast(SPAN)))
    df = df.withColumn(out, F.sort_array(F.concat(F.col(f"{out}_base"), added.cast(SPAN))))
    return df.select(*[x for x in kept if x not in (out, f"{out}_base")], f"{out}_base", out)


def span_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
