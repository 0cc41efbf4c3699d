"""Quality rules by host: rule failures counted per host, rates shrunk by an empirical beta prior.

``count_rules`` is row by row. Rows are then reduced to their counts and written once; hosts are summed from
that table, each rate is drawn towards the mean of all hosts, and the verdict is joined back to the rows.

Null or empty texts have no words and fail the word rule. A null host is a host of its own. Repeated rows
count as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.scratch import stage

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
NO_SYMBOL = r"[^#*$%&|<>]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 50
MAX_DUP_LINE_PERCENT = 50
#: A host goes when the shrunk share of its documents that fail a rule is above this.
MAX_RATE = 0.5
#: Bounds of the prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1e6


def _covered(starts: Column) -> Column:
    """Words in the windows of three words that begin at ``starts`` (ascending), each word once."""
    state = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("total"))
    return F.aggregate(
        starts,
        state,
        lambda s, at: F.struct(
            (at + 3).alias("upto"), (s["total"] + at + 3 - F.greatest(at, s["upto"])).alias("total")
        ),
        lambda s: s["total"],
    )


def count_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts in COUNTS as long columns; columns of these names are replaced.

    Windows of three words are compared by 64-bit hash.
    """
    kept = [c for c in docs.columns if c not in COUNTS]
    df = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("__words", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)))
    df = df.withColumn("__lines", F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(WORD)))
    df = df.withColumn(
        "__windows",
        F.when(
            F.size("__words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("__words") - 3),
                lambda i: F.xxhash64(*[F.get(F.col("__words"), i + k) for k in range(3)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # Only a text with an equal pair of windows needs them in order of hash.
    df = df.withColumn(
        "__sorted",
        F.when(
            F.size(F.array_distinct("__windows")) < F.size("__windows"),
            F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twice = F.filter(
        "__sorted",
        lambda x, k: (x["h"] == F.get(F.col("__sorted"), k - 1)["h"])
        | (x["h"] == F.get(F.col("__sorted"), k + 1)["h"]),
    )
    df = df.withColumn("__twice", F.sort_array(F.transform(twice, lambda x: x["i"])))
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.regexp_replace("__text", SPACE, "")),
        "n_symbols": F.length(F.regexp_replace("__text", NO_SYMBOL, "")),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(_covered(F.col("__twice")), F.lit(0)),
    }
    return df.select(*kept, *[v.cast("long").alias(k) for k, v in counts.items()])


def rules() -> dict[str, Column]:
    """Rules by name, true where a document fails; the first two are the base rules."""
    n = F.col("n_words")
    return {
        "few_words": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    }


def host_rates(counted: DataFrame, host: str) -> DataFrame:
    """Host, its documents, and per rule the shrunk failure rate ``rate_<rule>``.

    The prior of a rule has the mean of all documents, and the weight at which the spread of the hosts'
    rates, less what chance alone gives, equals the beta distribution's. One row of sums reaches the driver.
    """
    named = rules()
    hosts = counted.groupBy(host).agg(
        F.count("*").alias("docs"), *[F.sum(v.cast("long")).alias(f"fail_{k}") for k, v in named.items()]
    )
    docs = F.sum("docs")
    sums = [docs.alias("docs"), F.count("*").alias("hosts")]
    for k in named:
        sums += [
            F.sum(f"fail_{k}").alias(f"f_{k}"),
            F.sum(F.col(f"fail_{k}") * F.col(f"fail_{k}") / F.col("docs")).alias(f"ff_{k}"),
        ]
    total = hosts.agg(*sums).first()
    rates = []
    for k in named:
        n, mean, weight = total["docs"] or 0, 0.0, LEAST_WEIGHT
        if n:
            mean = total[f"f_{k}"] / n
            chance = mean * (1 - mean)
            spread = total[f"ff_{k}"] / n - mean * mean - chance * total["hosts"] / n
            weight = MOST_WEIGHT if spread <= 0 else min(max(chance / spread - 1, LEAST_WEIGHT), MOST_WEIGHT)
        rates.append(((F.col(f"fail_{k}") + mean * weight) / (F.col("docs") + weight)).alias(f"rate_{k}"))
    return hosts.select(host, "docs", *rates)


def host_verdicts(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` without its text, with the counts, ``base_failed``, ``host_rejected`` and ``kept``.

    The counts are written once to the shared folder; hosts are joined to rows with nulls as equals.
    """
    added = (*COUNTS, "base_failed", "host_rejected", "kept", text)
    columns = [c for c in docs.columns if c not in added]
    counted = stage(count_rules(docs, text).select(*columns, *COUNTS), "hosts")
    rates = host_rates(counted, host)
    bad = F.lit(False)
    for k in rules():
        bad = bad | (F.col(f"rate_{k}") > MAX_RATE)
    verdict = rates.select(F.col(host).alias("__host"), bad.alias("host_rejected"))
    base = rules()
    joined = counted.join(verdict, counted[host].eqNullSafe(verdict["__host"])).drop("__host")
    return joined.withColumn("base_failed", base["few_words"] | base["repeats"]).withColumn(
        "kept", ~F.col("base_failed") & ~F.col("host_rejected")
    )


# The same in DuckDB's SQL, for the columns the query returns.
SQL = rf"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
    FROM documents
), three AS (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), twice AS (
    SELECT doc_id, i FROM three QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), counted AS (
    SELECT doc_id, source, len(w) AS n_words,
           len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM words LEFT JOIN repeated USING (doc_id)
), failed AS (
    SELECT *, n_words < {MIN_WORDS} AS few_words,
           100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS repeats,
           100 * n_symbols > {MAX_SYMBOL_PERCENT} * word_chars AS symbols,
           100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines AS dup_lines
    FROM counted
), rule_rows AS (
    UNPIVOT (SELECT source, few_words::INT AS few_words, repeats::INT AS repeats, symbols::INT AS symbols,
                    dup_lines::INT AS dup_lines FROM failed)
    ON few_words, repeats, symbols, dup_lines INTO NAME rule VALUE fail
), hosts AS (
    SELECT source, rule, count(*) AS docs, sum(fail)::DOUBLE AS f FROM rule_rows GROUP BY ALL
), moments AS (
    SELECT rule, sum(f) / sum(docs) AS mean, count(*) / sum(docs) AS per_doc,
           sum(f * f / docs) / sum(docs) AS square
    FROM hosts GROUP BY rule
), priors AS (
    SELECT rule, mean, CASE WHEN spread <= 0 THEN {MOST_WEIGHT}
        ELSE least(greatest(mean * (1 - mean) / spread - 1, {LEAST_WEIGHT}), {MOST_WEIGHT}) END AS weight
    FROM (SELECT *, square - mean * mean - mean * (1 - mean) * per_doc AS spread FROM moments)
), bad AS (
    SELECT source, bool_or((f + mean * weight) / (docs + weight) > {MAX_RATE}) AS host_rejected
    FROM hosts JOIN priors USING (rule) GROUP BY source
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       few_words OR repeats AS base_failed, NOT (few_words OR repeats) AND NOT host_rejected AS kept
FROM failed JOIN bad ON failed.source IS NOT DISTINCT FROM bad.source
"""
