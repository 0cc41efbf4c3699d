import hashlib
import zlib

import compare
import pytest

from placemat.llm import merkle
from placemat.llm.queries import QUERIES


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return digest("".join(framed(row[c] if c != "text" else text) for c in merkle.COLUMNS))


def tree(leaves):
    """Root and, for each leaf, what stands left and right of it at each level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, pos in enumerate(at):
            run = level[pos // 16 * 16 : pos // 16 * 16 + 16]
            paths[k].append(("".join(run[: pos % 16]), "".join(run[pos % 16 + 1 :])))
        level = [digest("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        at = [pos // 16 for pos in at]
    return level[0], paths


def brute(rows):
    """What the query returns, as a sorted list."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((leaf_of(r, r["text"]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[1]["doc_id"] is not None, x[1]["doc_id"] or 0, x[0]))
        own[name] = tree([leaf for leaf, _ in groups[name]])
    root, tops = tree([own[n][0] for n in names]) if names else (None, [])
    out = []
    for name, top in zip(names, tops, strict=True):
        for (leaf, r), path in zip(groups[name], own[name][1], strict=True):
            change = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]) if change else r["text"]
            folded = leaf_of(r, text)
            for left, right in path + top:
                folded = digest(left + folded + right)
            proof = digest("".join(a + b for a, b in path + top))
            out.append((r["doc_id"], leaf, own[name][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def run(docs):
    found = merkle.verify(merkle.manifest(docs, merkle.tampered(docs["doc_id"], docs["text"])))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_query_equals_sql(spark, small):
    found = QUERIES["op13_merkle_manifest"].build(spark, small)
    assert compare.differences(found, compare.connect(small), merkle.SQL) == []


def test_trees_of_all_shapes(spark):
    """Groups on both sides of each power of the fan-out, over more sources than a run holds; one spans many parts."""
    sizes = {f"s{i}": n for i, n in enumerate([1, 2, 15, 16, 17, 255, 256, 257, 4096, 4097, *[3] * 10])}
    sizes |= {None: 33, "": 5, "é": 1}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append({"doc_id": i * 7919 % 100003, "source": source, "lang": None, "n_chars": i, "text": f"Text {i} é"})
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert run(docs) == brute(rows)


@pytest.mark.parametrize("repeats", [1, 40])
def test_odd_documents(spark, odd, repeats):
    """Nulls, empty and long texts, rows that repeat (their leaves stand side by side) and columns of any name."""
    docs = odd
    for _ in range(repeats - 1):
        docs = docs.unionAll(odd)
    assert run(docs) == brute([r.asDict() for r in docs.collect()])


def test_only_tampered_rows_fail(spark, small):
    found = QUERIES["op13_merkle_manifest"].build(spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in found:
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in texts[r.doc_id] or "")
        assert r.verified == (not changed)


def test_empty_table(none):
    assert run(none) == []
