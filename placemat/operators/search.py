"""Search by regular expression through an index of the trigrams of a column.

``write_index`` stores one row per trigram and key, sorted by both, so a trigram's keys lie in few row groups and a filter on it
skips the rest, and beside it how many keys each trigram has. ``search_indexed`` takes the trigrams that every match of
a pattern must contain, reads the postings of the rarest, keeps the keys that all of them have, and applies the
pattern to these rows alone. A pattern without such a trigram, or whose rarest one is in too many rows
to save anything, is searched by an honest scan. Rows are always those of the plain search.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemat.operators.filters import search_name

SIZE = 3
#: How many of a pattern's trigrams are looked up, the rarest first.
LOOKED_UP = 3
#: A scan is as good when the rarest trigram is in more than this share of the rows.
MAX_SHARE = 0.2
#: Postings that a task sorts or groups at once, whatever their number.
PART_POSTINGS = 1 << 20

# Characters beyond ASCII that equal an ASCII letter when case is ignored, and those letters.
FOLDED, LETTERS = "\u017f\u212a\u0130\u0131", "skii"


def folded(text: Column) -> Column:
    return F.lower(F.translate(text, FOLDED, LETTERS))


def trigrams(text: Column) -> Column:
    """Distinct trigrams of ASCII characters, case aside; null has none."""
    last = F.length(text) - SIZE + 1
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    found = F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(SIZE))))
    return F.filter(found, lambda g: g.rlike(r"\A\p{ASCII}*\z"))


def required_trigrams(pattern: str) -> set[str]:
    """Trigrams that stand in everything the pattern matches, case aside; only what is plainly literal counts."""
    if "|" in pattern or "(?" in pattern or "\\Q" in pattern:
        return set()
    runs, i, depth = [""], 0, 0

    def skip_class(at: int) -> int:
        """The place behind a class in brackets that begins at ``at``, with those inside it."""
        level = 0
        while at < len(pattern):
            if pattern[at] == "\\":
                at += 1
            else:
                level += {"[": 1, "]": -1}.get(pattern[at], 0)
            at += 1
            if not level:
                break
        return at

    while i < len(pattern):
        c, literal = pattern[i], None
        if c == "[":
            i = skip_class(i)
        elif c == "\\" and i + 1 < len(pattern):
            literal = None if pattern[i + 1].isalnum() else pattern[i + 1]
            i += 2
            if literal is None:  # what follows an escape letter may belong to it
                while i < len(pattern) and (pattern[i].isalnum() or pattern[i] in "{}<>"):
                    i += 1
        else:
            depth += {"(": 1, ")": -1}.get(c, 0)
            literal = None if c in "().^$*+?{}" else c
            i += 1
        quantified = pattern[i : i + 1] if pattern[i : i + 1] in ("*", "+", "?", "{") else ""
        if literal is None or depth:
            runs.append("")
        elif quantified:
            # Once at least for '+'; how often else is not looked into. What follows is not next to it for sure.
            runs[-1] += literal if quantified == "+" else ""
            runs.append("")
        else:
            runs[-1] += literal
        if quantified == "{":
            i = (pattern.find("}", i) + 1) or len(pattern)
    plain = [r.lower() for r in runs if r.isascii()]
    parts = plain + [p.lower() for r in runs if not r.isascii() for p in "".join(c if c.isascii() else "\0" for c in r).split("\0")]
    return {p[k : k + SIZE] for p in parts for k in range(len(p) - SIZE + 1)}


class NameIndex(NamedTuple):
    """Where an index lies, and what it was made of."""

    path: str
    key: str
    rows: int


def write_index(df: DataFrame, path: str, key: str = "row_key", name: str = "name") -> NameIndex:
    """Index the column ``name`` of rows with a unique ``key``. A trigram that all rows have fills several files."""
    # A text has no more trigrams than letters, so the parts are bounded before any posting is made.
    rows, letters = df.agg(F.count("*"), F.sum(F.length(name).cast("bigint"))).first()
    postings = df.select(F.explode(trigrams(folded(F.col(name)))).alias("gram"), F.col(key).alias("key"))
    postings.repartitionByRange(_parts(letters or 0), "gram", "key").sortWithinPartitions("gram", "key").write.parquet(f"{path}/postings")
    stored = df.sparkSession.read.parquet(f"{path}/postings")
    stored.groupBy("gram").agg(F.count("*").alias("keys")).write.parquet(f"{path}/counts")
    return NameIndex(path, key, rows)


def _parts(postings: int) -> int:
    return max(1, -(-postings // PART_POSTINGS))


def candidates(spark: SparkSession, index: NameIndex, pattern: str, max_share: float = MAX_SHARE) -> DataFrame | None:
    """Keys that may match, or None where a scan is as good. At most a row per trigram of the pattern is collected."""
    wanted = required_trigrams(pattern)
    if not wanted:
        return None
    counts = spark.read.parquet(f"{index.path}/counts").where(F.col("gram").isin(sorted(wanted)))
    known = {r["gram"]: r["keys"] for r in counts.collect()}
    rarest = sorted(wanted, key=lambda g: (known.get(g, 0), g))[:LOOKED_UP]
    if known.get(rarest[0], 0) > max_share * index.rows:
        return None
    # Common ones would cost more than they rule out.
    chosen = [g for g in rarest if known.get(g, 0) <= max_share * index.rows]
    postings = spark.read.parquet(f"{index.path}/postings").where(F.col("gram").isin(chosen))
    if len(chosen) == 1:  # a key stands once with each trigram
        return postings.select("key")
    # Dealt by key first: postings lie by trigram, so a count before that would hold every key and save nothing.
    dealt = postings.repartition(_parts(sum(known.get(g, 0) for g in chosen)), "key")
    return dealt.groupBy("key").agg(F.count("*").alias("grams")).where(F.col("grams") == len(chosen)).select("key")


def search_indexed(df: DataFrame, index: NameIndex, pattern: str = "", max_share: float = MAX_SHARE) -> DataFrame:
    """``search_name(df, pattern)`` for the rows the index was made of."""
    keys = candidates(df.sparkSession, index, pattern, max_share)
    some = df if keys is None else df.join(keys, df[index.key] == keys["key"], "left_semi")
    return search_name(some, pattern)
