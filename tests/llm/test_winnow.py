import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from placemat.llm import winnow
from placemat.llm.queries import QUERIES


def run_hash(run):
    h = 0
    for piece in run:
        h = (h * winnow.BASE + (xxhash.xxh64_intdigest(piece.encode(), seed=42) & winnow.PRIME)) % winnow.PRIME
    return h * winnow.MIX % winnow.PRIME


def brute(text):
    """Chosen (hash, position) pairs, window by window, each run read from the text."""
    pieces = re.findall(winnow.PIECE, text or "")
    if not pieces:
        return []
    runs = [(run_hash(pieces[at : at + winnow.K]), at) for at in range(max(1, len(pieces) - winnow.K + 1))]
    window = next((w for fewer, w in winnow.WINDOWS if len(runs) < fewer), winnow.WINDOW)
    chosen = []
    for at in range(max(1, len(runs) - window + 1)):
        least = min(runs[at : at + window], key=lambda g: (g[0], -g[1]))
        if not chosen or least != chosen[-1]:
            chosen.append(least)
    return chosen


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_against_brute_force(spark, small, texts):
    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in QUERIES["op2_fingerprints"].build(spark, small).collect()}
    for place, doc in enumerate(order):
        text, following = texts[doc], texts[order[(place + 1) % len(order)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, other = brute(text), brute(edited)
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == " ".join(f"{h:x}" for h, _ in own)
        assert r.positions == " ".join(str(at) for _, at in own)
        assert r.edited_fingerprint == " ".join(f"{h:x}" for h, _ in other)
        assert abs(r.near_edited - likeness(own, other)) < 1e-12
        assert abs(r.near_next - likeness(own, brute(following))) < 1e-12


def test_positions_and_ties(spark):
    frame = spark.createDataFrame([("a b c " * 20,), ("p q r s t u v w x y z",), ("ab" * 700,), ("x" * 900,), ("é\U0001f600z" * 90,), ("日本" * 5,)], "text string")
    for r in winnow.fingerprint(frame, "text", "f").select("text", winnow.positions(F.col("f")).alias("p")).collect():
        assert r.p == [at for _, at in brute(r.text)]


def test_a_shared_passage_shares_a_hash(spark):
    """At any place in texts of any length, with and without spaces."""
    chinese = "".join(chr(0x4E00 + 7 * i) for i in range(winnow.K + winnow.WINDOW - 1))
    for shared in (chinese, "one or two words of a passage that both texts hold, of twenty pieces or so"):
        count = len(re.findall(winnow.PIECE, shared))
        assert count >= winnow.K + winnow.WINDOW - 1
        frame = spark.createDataFrame([(f"{'a b c d e ' * n}{shared}{' x y z' * (40 - n)}",) for n in (0, 3, 11, 25, 200)], "text string")
        rows = winnow.fingerprint(frame, "text", "f").select("text", winnow.hashes("f").alias("h"), winnow.positions("f").alias("p")).collect()
        within = []
        for r in rows:
            at = len(re.findall(winnow.PIECE, r.text[: r.text.index(shared)]))
            inside = range(at, at + count - winnow.K + 1)
            within.append({(h, p - at) for h, p in zip(r.h, r.p, strict=True) if p in inside})
        assert set.intersection(*within)


@pytest.mark.parametrize("letters", ["abcdefghij klmno", "日本語文書検索試験一二三四五六", "abcdefghijklmnop"])
def test_short_edited_texts_are_alike(spark, letters):
    """Two thirds of a text stay, so the likeness is above zero from 30 code points on, with or without spaces."""
    texts = ["".join(letters[(i * i + 3 * i * n + n) % len(letters)] for i in range(n)) for n in range(30, 140, 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r.near_edited > 0 for r in winnow.neighbour_likeness(docs).collect())


def test_odd_documents(spark, odd, none):
    rows = winnow.neighbour_likeness(odd).collect()
    assert len(rows) == odd.count()
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.own) == r.own and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert winnow.neighbour_likeness(none).count() == 0
    one = winnow.neighbour_likeness(spark.createDataFrame([(7, "a b c d")], "doc_id long, text string")).first()
    clash = spark.createDataFrame([("a b", 1, 2)], "text string, f long, own long")
    assert winnow.fingerprint(clash, "text", "f").columns == ["text", "own", "f"]
    assert one.edited == "a b ca " and one.near_next == 1.0
