"""Merkle manifest of a dataset: a tree of fan-out 16 per group of rows, and one over the groups' roots.

A row is a leaf: the SHA-256 of its columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
Leaves ascend by key within their group. They are cut into aligned blocks of BLOCK nodes, which are whole subtrees,
and a block keeps each of its levels as one string of hex digests. So a parent is the hash of a substring
of fixed width, and the siblings of a node are the substrings on both sides of it in its run. The roots of the
blocks are the nodes of the next floor, until each tree is one block; the trees' roots then are the nodes of a last tree.

Nothing meets in one task but the nodes of a block. Texts are read once, where they are hashed; from there on a row is its
digest. Rows are numbered by a range layout (``range_parts``), so a group may hold any share of them. The driver gets
one number per floor and the root.

A null key comes first in its group, a null group is a group of its own and comes before all others. Rows of one
key are ordered by their digest, so repeated rows have equal leaves side by side. A single leaf is its group's root, a
single group's root the root. An empty table gives an empty result. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemat.operators.ranking import PART, POSITION, range_parts
from placemat.scratch import stage

FANOUT = 16
FLOOR_LEVELS = 2
BLOCK = FANOUT**FLOOR_LEVELS
DIGEST = 64  # hex digits of a SHA-256
RUN = FANOUT * DIGEST
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(framed, values)), 256)


def numbered(nodes: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``pos``, from 0 in each group. ``order`` begins with a column that orders the groups.

    A group's rows may lie in many parts. What is joined back has one row per part and group in it.
    """
    laid = range_parts(nodes.withColumn("_tie", F.monotonically_increasing_id()), [*order, "_tie"]).drop("_tie")
    earlier = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        laid.groupBy(PART, group)
        .agg(F.min(POSITION).alias("_first"), F.count("*").alias("_rows"))
        .select(PART, group, (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    return laid.join(shifts, [PART, group]).withColumn("pos", F.col(POSITION) + F.col("_shift")).drop(PART, POSITION, "_shift")


def _parents(level: Column) -> Column:
    runs = F.ceil(F.length(level) / RUN).cast("int")
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256)
        ),
        "",
    )


def floor_blocks(nodes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``tree, block, members, level_0.., root`` from ``tree, pos, digest``: one row per BLOCK nodes of a tree.

    A level above the first exists while more than one node remains of the tree: in all blocks but the first one always,
    as theirs is not the only block.
    """
    member = F.struct((F.col("pos") % BLOCK).cast("int").alias("at"), "digest", *keep)
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    found = nodes.groupBy("tree", block).agg(F.sort_array(F.collect_list(member)).alias("members"))
    found = found.withColumn("level_0", F.array_join(F.transform("members", lambda m: m["digest"]), ""))
    for h in range(FLOOR_LEVELS):
        level = F.col(f"level_{h}")
        many = (F.col("block") > 0) | (F.length(level) > DIGEST)
        found = found.withColumn(f"level_{h + 1}", F.when(many, _parents(level)))
    levels = [F.col(f"level_{h}") for h in range(FLOOR_LEVELS, -1, -1)]
    return stage(found.withColumn("root", F.coalesce(*levels)), "merkle")


def own_path(at: Column) -> Column:
    """What stands left and right of a member in its run, at each level of its block."""
    segments = []
    for h in range(FLOOR_LEVELS):
        index = F.floor(at / FANOUT**h).cast("int")
        run = F.substring(F.col(f"level_{h}"), F.floor(index / FANOUT).cast("int") * RUN + 1, F.lit(RUN))
        place = (index % FANOUT) * DIGEST
        left, right = F.substring(run, F.lit(1), place), F.substring(run, place + DIGEST + 1, F.lit(RUN))
        segments.append(F.when(F.col(f"level_{h + 1}").isNotNull(), F.struct(left.alias("left"), right.alias("right"))))
    return F.filter(F.array(*segments), lambda s: s.isNotNull())


def raise_floors(nodes: DataFrame, keep: Sequence[str] = ()) -> list[DataFrame]:
    """The floors of all trees, from the leaves up to where every tree is one block."""
    floors = [floor_blocks(nodes, keep)]
    while (floors[-1].agg(F.max("block").alias("last")).first()["last"] or 0) > 0:
        floors.append(floor_blocks(floors[-1].select("tree", F.col("block").alias("pos"), F.col("root").alias("digest"))))
    return floors


def descend(floors: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest floor's members, each with ``path``: its siblings from its own run up to the top.

    ``above`` has ``tree, path`` and whatever else belongs to a tree: the path from its root on.
    """
    extra = [c for c in above.columns if c not in ("tree", "path")]
    paths = above.withColumn("block", F.lit(0).cast("bigint"))
    for k, floor in reversed(list(enumerate(floors))):
        below = floor.join(paths, ["tree", "block"]).select(
            "tree", *extra, "block", "path", *[f"level_{h}" for h in range(FLOOR_LEVELS + 1)], F.explode("members").alias("m")
        )
        path = F.concat(own_path(F.col("m")["at"]), "path").alias("path")
        if k:
            number = (F.col("block") * BLOCK + F.col("m")["at"]).alias("block")
            paths = below.select("tree", *extra, number, path)
        else:
            paths = below.select("tree", *extra, F.col("m"), path)
    return paths


def fold(leaf: Column, path: Column) -> Column:
    return F.aggregate(path, leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def manifest(
    docs: DataFrame,
    changed: Column | None = None,
    key: str = "doc_id",
    group: str = "source",
    columns: Sequence[str] = COLUMNS,
    text: str = "text",
) -> DataFrame:
    """``key, leaf, subroot, root, path, offered``: each row's leaf, its roots and its inclusion proof.

    ``path`` is the proof, an array of ``left, right`` hex strings from the leaf's run to the root. ``changed`` is a
    text that is offered in place of the row's own, or null; ``offered`` is the leaf of the row with it.
    """
    changed = F.lit(None).cast("string") if changed is None else changed
    values = [F.col(c) for c in columns]
    swapped = [changed if c == text else F.col(c) for c in columns]
    leaves = stage(
        docs.select(
            F.col(key).alias("id"),
            F.col(group).cast("string").alias("group"),
            framed(F.col(group)).alias("tree"),
            leaf_digest(values).alias("digest"),
            F.when(changed.isNotNull(), leaf_digest(swapped)).alias("changed"),
        ),
        "leaves",
    )
    floors = raise_floors(numbered(leaves, "tree", ["group", "id", "digest"]), ["id", "changed"])
    name = F.when(F.col("tree") != "-", F.expr("substring(tree, instr(tree, ':') + 1)")).alias("group")
    roots = floors[-1].select(F.lit("").alias("tree"), F.col("tree").alias("member"), name, F.col("root").alias("digest"))
    tops = raise_floors(numbered(roots, "tree", ["group"]), ["member"])
    found = tops[-1].select("root").first()
    empty = F.array().cast("array<struct<left: string, right: string>>")
    top = descend(tops, tops[-1].select("tree", empty.alias("path")))
    trees = top.select(F.col("m")["member"].alias("tree"), F.col("m")["digest"].alias("subroot"), "path")
    return descend(floors, trees).select(
        F.col("m")["id"].alias(key),
        F.col("m")["digest"].alias("leaf"),
        "subroot",
        F.lit(found["root"] if found else None).cast("string").alias("root"),
        "path",
        F.coalesce(F.col("m")["changed"], F.col("m")["digest"]).alias("offered"),
    )


# The letters that the tampered text has in lower case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered(key: Column, text: Column, every: int = 5) -> Column:
    """The text in lower case where ``every`` divides the key's checksum, else null."""
    return F.when(F.crc32(key.cast("string").cast("binary")) % every == 0, F.translate(text, UPPER, LOWER))


def verify(proofs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Recompute the root from the offered leaf and the original siblings, and say whether it is the same."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = proofs.select(
        key,
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        fold(F.col("offered"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


SQL = """
WITH RECURSIVE
bits(b, k, v) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL
    SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8
),
crc(id, i, v) AS (
    SELECT DISTINCT doc_id::varchar, 0, 4294967295::bigint FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT c.id, c.i + 1, xor(c.v // 256, t.v)
    FROM crc c JOIN bits t ON t.k = 8 AND t.b = xor(c.v % 256, ascii(substr(c.id, c.i + 1, 1))::bigint)
    WHERE c.i < length(c.id)
),
picked AS (
    SELECT id FROM crc WHERE i = length(id) AND xor(v, 4294967295) % 5 = 0
),
offered AS (
    SELECT d.*, CASE WHEN p.id IS NULL THEN d.text
        ELSE translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS other
    FROM documents d LEFT JOIN picked p ON p.id = d.doc_id::varchar
),
framed AS (
    SELECT doc_id, source, coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar, '-')
        || coalesce(strlen(source)::varchar || ':' || source, '-')
        || coalesce(strlen(lang)::varchar || ':' || lang, '-')
        || coalesce(strlen(n_chars::varchar)::varchar || ':' || n_chars::varchar, '-') AS head,
        coalesce(strlen(text)::varchar || ':' || text, '-') AS body,
        coalesce(strlen(other)::varchar || ':' || other, '-') AS offer
    FROM offered
),
leaves AS (
    SELECT doc_id, source, sha256(head || body) AS leaf, sha256(head || offer) AS offer FROM framed
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
),
nodes(source, h, pos, digest) AS (
    SELECT source, 0, pos, leaf FROM placed
    UNION ALL
    SELECT source, h + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM nodes) WHERE n > 1
    GROUP BY source, h, pos // 16
),
subroots AS (
    SELECT source, arg_max(digest, h) AS digest FROM nodes GROUP BY source
),
tops(h, pos, digest) AS (
    SELECT 0, row_number() OVER (ORDER BY source NULLS FIRST) - 1, digest FROM subroots
    UNION ALL
    SELECT h + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY h, pos // 16
),
flanks AS (
    SELECT source, h, pos, digest, count(*) OVER (PARTITION BY source, h) AS n,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM nodes WINDOW run AS (PARTITION BY source, h, pos // 16 ORDER BY pos)
),
top_flanks AS (
    SELECT h, pos, count(*) OVER (PARTITION BY h) AS n,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM tops WINDOW run AS (PARTITION BY h, pos // 16 ORDER BY pos)
),
climb(doc_id, source, leaf, h, pos, folded, proof, done) AS (
    SELECT doc_id, source, leaf, 0, pos, offer, '', false FROM placed
    UNION ALL
    SELECT c.doc_id, c.source, c.leaf, c.h + 1, c.pos // 16,
        CASE WHEN f.n > 1 THEN sha256(f.l || c.folded || f.r) ELSE c.folded END,
        CASE WHEN f.n > 1 THEN c.proof || f.l || f.r ELSE c.proof END, f.n = 1
    FROM climb c JOIN flanks f ON f.source IS NOT DISTINCT FROM c.source AND f.h = c.h AND f.pos = c.pos WHERE NOT c.done
),
places AS (
    SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM subroots
),
summit(doc_id, leaf, subroot, h, pos, folded, proof, done) AS (
    SELECT c.doc_id, c.leaf, p.digest, 0, p.pos, c.folded, c.proof, false
    FROM climb c JOIN places p ON p.source IS NOT DISTINCT FROM c.source WHERE c.done
    UNION ALL
    SELECT c.doc_id, c.leaf, c.subroot, c.h + 1, c.pos // 16,
        CASE WHEN f.n > 1 THEN sha256(f.l || c.folded || f.r) ELSE c.folded END,
        CASE WHEN f.n > 1 THEN c.proof || f.l || f.r ELSE c.proof END, f.n = 1
    FROM summit c JOIN top_flanks f ON f.h = c.h AND f.pos = c.pos WHERE NOT c.done
),
top AS (
    SELECT arg_max(digest, h) AS root FROM tops
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM summit, top WHERE done
"""
