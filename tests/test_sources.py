"""JSON Lines, JSON arrays, the rewrite job and mapping files."""

from __future__ import annotations

import os
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from staylake.errors import BadMapping
from staylake.operators.rejects import split_rejects
from staylake.sources.json_arrays import array_records, normalise_json, plain_number, read_json_array, rewrite_json_arrays
from staylake.sources.json_lines import parse_json_lines, read_json_lines
from staylake.sources.mappings import load_mapping, mapping_from_dict, write_mapping

GOOD = '{"id":1,"label":"k-a","status":"F","accommodations":{"reservation":9001},"currencies":{"booker":"EUR"}}'


def _write_text(path: str, name: str, text: str) -> str:
    """Write a small text file by hand (the scratch path is a local ``file:`` URI in tests)."""
    local = path.removeprefix("file:")
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, name), "w", encoding="utf-8") as f:
        f.write(text)
    return f"{path}/{name}"


def test_json_line_edge_rows(spark):
    lines = [
        GOOD,
        "{bad",
        '"str"',
        "[1]",
        '{"id":2,"accommodations":[1,2]}',
        '{"id":3,"label":77}',
        '{"id":4,"accommodations":null}',
        "",
        "   ",
        '[{"id":5},{"id":6}]',
    ]
    parsed = parse_json_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    good, bad = split_rejects(parsed)
    good_ids = sorted(r["id"] for r in good.collect())
    assert good_ids == ["1", "3", "4", "5", "6"]
    labels = {r["id"]: r["label"] for r in good.collect()}
    assert labels["3"] == "77"
    assert good.where("id = '1'").first()["accommodations"]["reservation"] == "9001"
    rejects = {r["raw"]: r["id"] for r in bad.collect()}
    # "[1]" is an array line: exploded first, its element "1" is then rejected.
    assert rejects == {"{bad": None, '"str"': None, "1": None, '{"id":2,"accommodations":[1,2]}': "2"}
    assert parsed.count() == good.count() + bad.count()


def test_truncated_record_keeps_leading_id(spark):
    parsed = parse_json_lines(spark.createDataFrame([(GOOD[:-2],)], "value string"))
    _, bad = split_rejects(parsed)
    assert [(r["id"], r["reason"]) for r in bad.collect()] == [("1", "malformed_json")]


def test_read_json_lines_from_files(spark, scratch):
    _write_text(scratch, "a.jsonl", GOOD + "\n\n" + GOOD.replace('"id":1', '"id":7') + "\n")
    df = read_json_lines(spark, scratch)
    assert sorted(r["id"] for r in df.collect()) == ["1", "7"]


def test_json_array_layouts(spark, scratch):
    recs = [GOOD.replace('"id":1', f'"id":{i}') for i in range(5)]
    _write_text(scratch + "/whole", "a.json", "[\n  " + ",\n  ".join(recs) + "\n]\n")
    _write_text(scratch + "/whole", "b.json", '[{"id": 10}, {"id": 11, "label": "d-m"}]')
    whole = read_json_array(spark, scratch + "/whole", layout="whole")
    assert sorted(int(r["id"]) for r in whole.collect()) == [0, 1, 2, 3, 4, 10, 11]
    _write_text(scratch + "/lines", "a.json", "[\n" + ",\n".join(recs) + "\n]\n")
    lines = read_json_array(spark, scratch + "/lines", layout="lines")
    assert sorted(int(r["id"]) for r in lines.collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        read_json_array(spark, scratch, layout="other")


def test_rewrite_normalises_numbers(spark, scratch):
    _write_text(scratch + "/src", "a.json", '[{"id": 1, "x": 10.0, "y": 2.50}, {"id": 2, "x": 3}]')
    n = rewrite_json_arrays(spark, scratch + "/src", scratch + "/dst")
    assert n == 2
    texts = sorted(r["value"] for r in spark.read.text(scratch + "/dst").collect())
    assert texts[0] == '{"id":1,"x":10,"y":2.5}'
    assert texts[1] == '{"id":2,"x":3}'


def test_mapping_file_roundtrip_and_errors(spark, scratch):
    m = mapping_from_dict(spark, {"NL": "EUROPE", "JP": "ASIA", "N": None})
    write_mapping(m, scratch + "/m.json")
    back = {r["key"]: r["value"] for r in load_mapping(spark, scratch + "/m.json").collect()}
    assert back == {"NL": "EUROPE", "JP": "ASIA", "N": None}
    with pytest.raises(BadMapping):
        load_mapping(spark, scratch + "/missing.json")
    bad = _write_text(scratch + "/bad", "x.json", "[1, 2]")
    with pytest.raises(BadMapping):
        load_mapping(spark, bad)
    bad2 = _write_text(scratch + "/bad2", "x.json", "{not json")
    with pytest.raises(BadMapping):
        load_mapping(spark, bad2)


def test_mapping_numbers_keep_json_text(spark, scratch):
    p = _write_text(scratch, "m.json", '{"a": 1, "b": "x"}')
    got = {r["key"]: r["value"] for r in load_mapping(spark, p).collect()}
    assert got == {"a": "1", "b": "x"}


def test_reject_decision_does_not_depend_on_projection(spark):
    """A record that fails anywhere is rejected even when only other fields are read."""
    drifted = '{"id":9,"label":"k-a","accommodations":[1,2]}'
    parsed = parse_json_lines(spark.createDataFrame([(GOOD,), (drifted,)], "value string"))
    good, bad = split_rejects(parsed)
    assert [r["label"] for r in good.select("label").collect()] == ["k-a"]
    assert [r["id"] for r in bad.select("id").collect()] == ["9"]
    assert good.select("label").count() == 1


def _loaded(spark, lines, layout=None):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = split_rejects(parse_json_lines(df))
    return sorted(r["id"] for r in good.collect()), sorted(r["raw"] for r in bad.collect())


def test_text_after_a_record_is_rejected(spark):
    lines = ['{"id":1}', '{"id":2} {"id":3}', '{"id":4}garbage', ' {"id":5} ', '[{"id":6},{"id":7}]', '[{"id":8}] x']
    good, bad = _loaded(spark, lines)
    assert good == ["1", "5", "6", "7"]
    assert bad == ['[{"id":8}] x', '{"id":2} {"id":3}', '{"id":4}garbage']


def test_blank_lines_and_nulls_are_no_bookings(spark):
    good, bad = _loaded(spark, ["\t", "  ", "", "null", '[null, {"id":1}]', '{"id":2}'])
    assert (good, bad) == (["1", "2"], ["null", "null"])


def test_long_numbers_keep_their_text(spark):
    lines = ['{"id":12345678901234567.25}', '{"id":123456789012345678901234567890}']
    df = parse_json_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    good, bad = split_rejects(df)
    assert sorted(r["value"] for r in good.collect()) == sorted(lines)
    assert "123456789012345678901234567890" in {r["id"] for r in good.collect()}
    assert bad.count() == 0


def test_array_lines_with_several_records(spark, scratch):
    _write_text(scratch, "a.json", '[{"id":1},\n{"id":2},{"id":3},\n\t\n{"id":4},null,\n{"id":5\n{"id":6}]\n')
    good, bad = split_rejects(read_json_array(spark, scratch, layout="lines"))
    assert sorted(r["id"] for r in good.collect()) == ["1", "2", "3", "4", "6"]
    assert sorted(r["raw"] for r in bad.collect()) == ["null", '{"id":5']


def test_null_element_of_a_whole_array_is_rejected(spark, scratch):
    _write_text(scratch, "a.json", '[{"id":1}, null]')
    good, bad = split_rejects(read_json_array(spark, scratch, layout="whole"))
    assert [r["id"] for r in good.collect()] == ["1"]
    assert [r["raw"] for r in bad.collect()] == ["null"]


def test_rewrite_keeps_long_numbers(spark, scratch):
    _write_text(scratch + "/src", "a.json", '[{"id":12345678901234567890.0,"x":2.50,"y":12345678901234567.25},null]')
    assert rewrite_json_arrays(spark, scratch + "/src", scratch + "/dst") == 2
    texts = sorted(r["value"] for r in spark.read.text(scratch + "/dst").collect())
    assert texts == ["null", '{"id":12345678901234567890,"x":2.5,"y":12345678901234567.25}']


def test_nested_values_where_text_belongs_are_rejected(spark):
    lines = ['{"id":1,"label":{"a":1}}', '{"id":2,"label":"{not nested}"}', '{"id":3,"status":["x"]}', '{"id":4,"label":5}',
             '{"id":5,"booker":{"address":{"country":{"c":1}}}}', '{"id":6,"label":null}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = split_rejects(parse_json_lines(df))
    assert sorted(r["id"] for r in good.collect()) == ["2", "4", "6"]
    assert sorted((r["id"], r["reason"]) for r in bad.collect()) == [("1", "label_not_text"), ("3", "status_not_text"), ("5", "country_not_text")]


def test_broken_element_is_one_reject_and_texts_stay(spark, scratch):
    recs = ['{"id":12345678901234567.25}', '{"id":2,"label":"a],[{\\"b"}', '{"id":3,"label":', '{"id":4}', '{"id":5\n,"x":1', '{"id":6}}', '{"id":7,\n"label":"k-a"}', "null"]
    _write_text(scratch + "/src", "a.json", " [\n" + ",\n".join(recs) + "\n]\n")
    _write_text(scratch + "/src", "b.json", "[ ]")
    good, bad = split_rejects(read_json_array(spark, scratch + "/src", layout="whole"))
    assert sorted(r["value"] for r in good.collect()) == sorted([recs[0], recs[1], recs[3], recs[6]])
    assert sorted(r["raw"] for r in bad.collect()) == sorted([recs[2], recs[4], recs[5], "null"])
    assert rewrite_json_arrays(spark, scratch + "/src", scratch + "/dst") == len(recs)
    texts = [r["value"] for r in spark.read.text(scratch + "/dst").collect()]
    assert len(texts) == len(recs) and '{"id":12345678901234567.25}' in texts


def _texts(spark, scratch, text, name="a.json", **conf):
    _write_text(scratch + "/src", name, text)
    good, bad = split_rejects(read_json_array(spark, scratch + "/src", layout="whole"))
    return sorted(r["value"] for r in good.collect()), sorted(r["raw"] for r in bad.collect())


def test_nothing_after_a_record_is_lost(spark, scratch):
    """What follows a record on its line makes a reject that holds it, in lines and in arrays of lines."""
    lines = ['{"id":"1"}],[{"id":"2"}', '{"id":"3"}]garbage', '[{"id":"5"}]] {"id":"6"}', '{"id":"7"},{"id":"8"}', '{"id":"9"},"x":1']
    good, bad = _loaded(spark, lines)
    assert good == [] and bad == sorted(lines)
    _write_text(scratch, "a.json", '[{"id":"1"}],[{"id":"2"}]\n{"id":"8"}],[{"id":"9"}\n{"id":5},null\n')
    good, bad = split_rejects(read_json_array(spark, scratch, layout="lines"))
    assert [r["id"] for r in good.collect()] == ["5"]
    assert sorted(r["raw"] for r in bad.collect()) == ["null", '{"id":"1"}],[{"id":"2"}', '{"id":"8"}],[{"id":"9"}']


def test_ids_of_several_records_on_a_line_keep_their_text(spark, scratch):
    long = "98765432109876543.25"
    df = spark.createDataFrame([(f'[{{"id":{long}}}, {{"id": 1e5}}]',)], "value string")
    assert sorted(r["value"] for r in split_rejects(parse_json_lines(df))[0].collect()) == ['{"id": 1e5}', f'{{"id":{long}}}']
    _write_text(scratch, "a.json", f'[{{"id":{long}}},{{"id":{long}}}]\n')
    for layout in ("lines", "whole"):
        assert [r["value"] for r in split_rejects(read_json_array(spark, scratch, layout=layout))[0].collect()] == [f'{{"id":{long}}}'] * 2


def test_broken_elements_cost_one_element_each(spark, scratch):
    recs = ['{"id":"1","x":[{"id":"7"}]}', '{"id":"2","label":"abc}', '{"id":"3"}', '{"id":"4","label":', '{"id":"5"]}', '{"id":"6"}']
    for k, comma in enumerate((",", ",\n", " , ")):
        got = _texts(spark, f"{scratch}/{k}", "[" + comma.join(recs) + "]")
        assert got == (sorted([recs[0], recs[2], recs[5]]), sorted([recs[1], recs[3], recs[4]])), comma
    assert _texts(spark, scratch + "/cut", "[" + ",".join(recs[:1] * 3)) == (recs[:1] * 3, [])  # the array is not closed
    assert _texts(spark, scratch + "/none", " [\n] ") == ([], [])
    assert _texts(spark, scratch + "/one", ' [ {"id":1} ] ') == (['{"id":1}'], [])
    assert _texts(spark, scratch + "/mixed", '[{"id":1},{"label":"k-a"}, {"id":2} ,\n{"id":3},5]') == (
        ['{"id":1}', '{"id":2}', '{"id":3}', '{"label":"k-a"}'],
        ["5"],
    )


def test_arrays_inside_records_with_the_same_separator(spark, scratch):
    """`},{"id":` inside a record does not cut it, beside broken records too."""
    deep = '{"id":%d,"x":[{"id":1},{"id":2,"y":[3]},{"id":"]}"}],"z":"},{\\"id\\":"}'
    recs = [deep % k for k in range(40)]
    recs[5] = '{"id":5,"x":[{"a":1}'
    recs[20] = '{"id":20,"label":"abc}'
    recs[30] = '{"id":30}'
    good, bad = _texts(spark, scratch, "[" + ",".join(recs) + "]")
    assert good == sorted(r for k, r in enumerate(recs) if k not in (5, 20)) and bad == sorted([recs[5], recs[20]])


def test_array_files_split_anywhere(spark, scratch):
    """Small splits cut separators at every byte; each element is read once, by many tasks."""
    recs = [f'{{"id":{k},"x":{{"y":{{"z":"{"é" * (k % 7)}"}}}}}}' for k in range(400)]
    for k, sep in enumerate((",", ",\n  ")):
        _write_text(f"{scratch}/{k}", "a.json", "[" + sep.join(recs) + "\n]\n")
        for size in (61, 100, 1009):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            try:
                df = read_json_array(spark, f"{scratch}/{k}", layout="whole")
                got = sorted((r["value"] for r in df.collect()), key=lambda t: int(t[6 : t.index(",")]))
                assert got == recs
                assert df.rdd.getNumPartitions() > 8
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")


def _as_int_or_decimal(token):
    d = Decimal(token)
    return str(int(d)) if d == d.to_integral_value() else format(d.normalize(), "f")


def test_numbers_are_rewritten_on_their_digits(spark):
    tokens = ["10.0", "2.50", "20", "-0", "-0.0", "0.10", "1e20", "1E+2", "2.50e1", "1.5e400", "-1.5e-3", "1e-7", "12345678901234567.25",
              "1" * 45, "0." + "0" * 50 + "10", "-" + "9" * 30 + ".00", "123.456e2", "123.456e5", "0e0", "0.0e-9"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    with localcontext() as c:
        c.prec = 1000
        want = {t: _as_int_or_decimal(t) for t in tokens}
    assert {r["t"]: r["n"] for r in df.select("t", plain_number(F.col("t")).alias("n")).collect()} == want
    text = '{ "a b" : 1.0 ,"2.50":"2.50 \\" 3.0", "n":[1.50, 2e1,true,null, -0.0 ], "e": 1e99999 }'
    bad = '{"a":1.0,\n"b"'
    got = [r[0] for r in spark.createDataFrame([(text,), (bad,)], "t string").select(normalise_json(F.col("t"))).collect()]
    assert got == ['{"a b":1,"2.50":"2.50 \\" 3.0","n":[1.5,20,true,null,0],"e":1e99999}', '{"a":1.0, "b"']
    plain = ['{"a": 10.0,"b":2.50 , "c":"1.50 ","d":[0.0,0.1050,100,7.000],"e":12.0}', "3.10", "5.0", '"5.0"', "[ ]"]
    want = ['{"a":10,"b":2.5,"c":"1.50 ","d":[0,0.105,100,7],"e":12}', "3.1", "5", '"5.0"', "[]"]
    rows = spark.createDataFrame(list(enumerate(plain)), "k int, t string").select("k", normalise_json(F.col("t")))
    assert [r[1] for r in sorted(rows.collect())] == want
    long = '{"a":"' + "x" * 300_000 + '","n":2.50}'
    assert spark.createDataFrame([(long,)], "t string").select(normalise_json(F.col("t"))).first()[0] == long.replace("2.50", "2.5")


def test_last_value_of_a_repeated_key_counts(spark, scratch):
    p = _write_text(scratch, "m.json", '{"a": 1, "b": "x", "a": 2, "c": "y", "c": null}')
    assert {r["key"]: r["value"] for r in load_mapping(spark, p).collect()} == {"a": "2", "b": "x", "c": None}
    df = spark.createDataFrame([('{"id":1,"label":"a","id":2}',)], "value string")
    assert [r["id"] for r in parse_json_lines(df).collect()] == ["2"]


def test_numbers_are_cut_into_parts_once(spark, scratch):
    """Every step of the rewrite of a number is worked out once: its expression names few regexes, and lines are stripped once."""
    df = spark.createDataFrame([("[1.5e1]",)], "value string")
    plan = df.select(normalise_json(F.col("value")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") + plan.count("regexp_replace(") < 20
    df.union(spark.createDataFrame([("[",), (" ] ",), ("",), ("{\"a\":-0.0,\"b\":1.20e1},",)], "value string")).write.text(scratch)
    got = array_records(spark, scratch, "lines")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(value") == 1
    assert sorted(r[0] for r in got.collect()) == ["1.5e1", '{"a":-0.0,"b":1.20e1}']
    assert rewrite_json_arrays(spark, scratch, scratch + "_out", layout="lines") == 2
    assert sorted(r[0] for r in spark.read.text(scratch + "_out").collect()) == ["15", '{"a":0,"b":12}']
