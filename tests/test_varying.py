import json

import pytest

from placemat.operators import varying
from placemat.scratch import fresh_path


def landed(spark, lines):
    path = fresh_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return varying.read_varying_json(spark, path)


def flat(data, prefix=""):
    """The rules in plain Python, keys in alphabetical order."""
    out = {}
    for key in sorted(data, key=str.encode):
        name = f"{prefix}_{key}" if prefix else key
        if isinstance(data[key], dict):
            out |= flat(data[key], name)
        elif data[key] is not None:
            out[name] = json.dumps(data[key], sort_keys=True) if isinstance(data[key], list) else data[key]
    return out


RECORDS = [
    {"name": "A", "rating": 4.5, "location": {"city": "SF", "geo": {"lat": 1, "lng": -2.25}}},
    {"name": None, "rating": 4, "categories": ["Italian", "a, b: c", 'q"uo\\te', "é\U0001f600\n\t"], "open": True},
    {"a": {"b": {"c": {"d": "deep"}}}, "empty": {}, "none": [], "nested": [{"y": 1.5, "x": [None, {"k": "v:,"}]}]},
    {"a_b_c_e": "clash", "OBJECT<x": 1, "sp ace": "s", "do.t": "t", "back`tick": "u", "it's": "v", 'say"': "w", "": "nameless"},
    {"a_b_c_d": "later", "big": 1e300, "long": 2**62},
    {},
]


def test_every_key_is_kept(spark):
    lines = [json.dumps(r, ensure_ascii=False) for r in RECORDS]
    found = varying.flatten_varying(landed(spark, [*lines[:2], "{broken", "", *lines[2:]])).collect()
    assert [{k: v for k, v in r.asDict().items() if v is not None} for r in found] == [flat(r) for r in RECORDS]
    assert "empty" not in found[0] and "name" in found[0] and found[2]["a_b_c_d"] == "deep"


def test_a_key_of_several_kinds_is_text(spark):
    lines = ['{"v": 1}', '{"v": {"x": "y"}}', '{"v": [1, 2]}', '{"v": "s"}', "7", "null", "[1]"]
    found = [r.v for r in varying.flatten_varying(landed(spark, lines)).collect()]
    assert found == ["1", '{"x":"y"}', "[1,2]", "s", None, None, None]


def test_paths_of_one_name(spark):
    """Of two paths with one name a record has what it has; numbers and text together are text."""
    lines = ['{"a": {"b": 1}}', '{"a_b": "x"}', '{"a": {"b": 2}, "a_b": "y"}']
    assert [r.a_b for r in varying.flatten_varying(landed(spark, lines)).collect()] == ["1", "x", "y"]


def test_a_kept_schema_saves_the_first_pass(spark):
    first = landed(spark, ['{"a": 1, "b": {"c": "x"}}'])
    schema = varying.varying_schema(first)
    later = varying.flatten_varying(landed(spark, ['{"b": {"c": "y"}, "new": 1}']), schema=schema)
    assert later.columns == ["a", "b_c"] and tuple(later.first()) == (None, "y")


def test_responses_without_records(spark):
    lines = ['{"businesses": [{"id": "1"}, null, {"k": 2}]}', '{"businesses": []}', '{"businesses": null}', '{"error": 1}']
    found = varying.flatten_varying(varying.explode_records(landed(spark, lines), "businesses"))
    assert [tuple(r) for r in found.select("id", "k").collect()] == [("1", None), (None, 2)]


def test_limits(spark):
    records = landed(spark, ['{"a": 1, "b": 2, "c": 3}'])
    with pytest.raises(ValueError, match="more than 2"):
        varying.flatten_varying(records, max_columns=2)
    with pytest.raises(ValueError, match="both kinds"):
        varying.flatten_varying(landed(spark, [json.dumps({"'\"": 1})]))
    assert varying.flatten_varying(landed(spark, ["{}"])).columns == []
