import compare

from placemat.llm import hosts
from placemat.llm.queries import QUERIES


def test_query_equals_sql(spark, small):
    found = QUERIES["op4_host_rules"].build(spark, small)
    assert compare.differences(found, compare.connect(small), hosts.SQL) == []


def test_counts(spark):
    text = "a b c a b c\n\n x \n x \nno # $$"
    r = hosts.count_rules(spark.createDataFrame([(text,)], "text string")).first()
    # The windows "a b c" occur twice; with both of them all six words are covered.
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (11, 13, 3, 1, 6)


def test_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, "bad", "short" if i % 10 else good) for i in range(200)]
    rows += [(1000 + i, f"host{i % 9}", good if i % 20 else "short") for i in range(900)]
    rows += [(5000, "tiny", "short"), (5001, None, good), (5002, None, good)]
    judged = {r.doc_id: r for r in hosts.host_verdicts(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert not any(judged[i].kept for i in range(200)) and judged[0].host_rejected and not judged[0].base_failed
    assert all(judged[1000 + i].kept == (i % 20 > 0) for i in range(900))
    # One failure of one document is drawn towards the mean of all hosts.
    assert not judged[5000].host_rejected and judged[5001].kept


def test_odd_documents(odd, none):
    judged = hosts.host_verdicts(odd)
    assert judged.count() == odd.count() and "text" not in judged.columns
    assert judged.where("n_words = 0 and kept").count() == 0
    assert hosts.host_verdicts(none).count() == 0
