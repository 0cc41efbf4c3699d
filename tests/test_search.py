import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placemat.operators import filters, search
from placemat.scratch import fresh_path

NAMES = [
    "Mario's Pizza", "PIZZA (house) 24h", "Pi\u0131zza", "Thai \u0130zmir", "\u212aebab \u017ftop", "caf\u00e9 Zo\u00eb", "a|b", "[x]", "", "ab", None,
    "pizzapizza", "Pizz", "izza", "Kebab stop", "tab\there", "C:\\dir", "1.5 stars", "new\nline pizza", "aaa", "xaaax",
]
PATTERNS = [
    "pizza", "PIZZA", "piz+a", "pizza?", "pizzas?", "piz{1,2}a", "(pizza)+", "(?i)pizza", "pizza|kebab", "p[iy]zza", "p[]a]zza",
    r"\(house\)", r"\d+h", r"1\.5", "kebab.stop", "kebab stop", "^pizza", "pizza$", "", "a", "ab", "caf\u00e9 zo", "zo\u00eb", "\u0131zz",
    r"\bpizza\b", "pizza{2}", "(pi)zza", r"C:\\dir", r"\x41aa", "aaa+", "aaa*", "a{3}", "[[a-c]x]aaa", "no such name", r"new\sline", "Thai izmir",
]


@pytest.fixture(scope="module")
def names(spark):
    rows = [(i, n) for i, n in enumerate(NAMES * 3)] + [(1000 + i, f"other place {i}") for i in range(200)]
    return spark.createDataFrame(rows, "row_key long, name string").repartition(3)


@pytest.fixture(scope="module")
def index(spark, names):
    return search.write_index(names, fresh_path(spark, "index"))


@pytest.mark.parametrize("pattern", PATTERNS)
def test_rows_are_those_of_the_scan(names, index, pattern):
    want = sorted(r.row_key for r in filters.search_name(names, pattern).collect())
    assert sorted(r.row_key for r in search.search_indexed(names, index, pattern).collect()) == want


def test_candidates(spark, names, index):
    """Few rows are looked at; where a pattern says nothing, or is common, all are."""
    assert search.candidates(spark, index, "pizza").count() == 4 * 3
    assert search.candidates(spark, index, "no such name").count() == 0
    assert search.candidates(spark, index, "place") is None and search.candidates(spark, index, "place", 1.0).count() == 200
    assert search.candidates(spark, index, "pi|za") is None
    plan = search.search_indexed(names, index, "pizza")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(gram" in plan and "Python" not in plan


def test_an_empty_table_and_a_common_trigram(spark, names):
    none = names.where(F.lit(False))
    assert search.search_indexed(none, search.write_index(none, fresh_path(spark, "none")), "pizza").count() == 0


PIECES = st.sampled_from(["a", "b", "ab", "abc", "cab", " ", ".", "a?", "b*", "c+", "a{0,1}", "b{2}", "[ab]", "(abc)", "(bc)?", r"\.", r"\w", "^", "$"])


@given(st.lists(PIECES, max_size=6).map("".join), st.text("abc .", max_size=12))
def test_every_match_has_the_required_trigrams(pattern, text):
    if re.search(pattern, text, re.IGNORECASE):
        assert all(g in text.lower() for g in search.required_trigrams(pattern))


def test_parts_of_the_index_and_of_a_search_are_bounded(spark, tmp_path, monkeypatch):
    """Parts grow with the rows, not with a setting; keys of one trigram are not grouped again."""
    monkeypatch.setattr(search, "PART_POSTINGS", 500)
    rows = spark.range(400).selectExpr("id AS row_key", "concat('place ', cast(id AS string), if(id % 9 = 0, ' qrst', '')) AS name")
    index = search.write_index(rows, str(tmp_path / "index"))
    assert index.rows == 400
    stored = spark.read.parquet(f"{index.path}/postings")
    parts = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(parts) >= 7 and max(parts) <= 1000
    one, several = search.candidates(spark, index, "qrs"), search.candidates(spark, index, "qrst")
    assert "Aggregate" not in one._jdf.queryExecution().optimizedPlan().toString()
    assert {r["key"] for r in one.collect()} == {r["key"] for r in several.collect()} == set(range(0, 400, 9))
    assert one.count() == several.count() == 45
