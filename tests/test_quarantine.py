"""Malformed logs and tables: what is lost is listed; nested attributes, lists and defaults."""

import gzip

import pytest

from eventloom.sources import delimited, xes
from eventloom.spec import LogSpec

HEAD = '<?xml version="1.0"?>\n<log>\n'


def trace(name, *events, more=""):
    return f'<trace><string key="concept:name" value="{name}"/>{more}' + "".join(f'<event><int key="n" value="{e}"/></event>' for e in events) + "</trace>\n"


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


SPEC = LogSpec(xes_case_attributes={"concept:name": "string"}, xes_event_attributes={"n": "int"})


def rejects_of(df):
    return sorted((r["reason"], r["trace"], r["event"], r["attribute"]) for r in df.collect())


def test_a_cut_trace_is_listed_and_costs_no_other_event(spark, tmp_path):
    cut = '<trace><string key="concept:name" value="b"/><event><int key="n" value="9"/></ev'
    path = write(tmp_path / "cut.xes", HEAD + trace("a", 1, 2) + cut + trace("c", 3) + "</log>")
    with pytest.raises(ValueError, match="1 of 3 traces"):
        xes.read_log(spark, path, SPEC)
    log, rejects = xes.read_log_checked(spark, path, SPEC, most_rejected=0.5)
    assert sorted((r["case:concept:name"], r["n"]) for r in log.collect()) == [("a", 1), ("a", 2), ("c", 3)]
    (row,) = rejects.collect()
    assert (row["reason"], row["trace"], row["block_start"]) == ("no end of the trace", "b", 0)
    assert row["file"].endswith("cut.xes") and row["text"].startswith("<trace><string")


def test_broken_xml_and_a_missing_end(spark, tmp_path):
    broken = '<trace><string key="concept:name" value="b"/><event><int key="n" value="9"></event></trace>\n'
    path = write(tmp_path / "broken.xes", HEAD + trace("a", 1) + broken + trace("c", 3) + '<trace><string key="concept:name" value="d"/><event><int key="n"')
    parsed = xes.parse_traces(spark, path)
    assert rejects_of(xes.rejected_traces(spark, path, parsed)) == [("no end of the log", None, None, None), ("not well formed", "b", None, None), ("not well formed", "d", None, None)]
    assert xes.read_xes(spark, path, {"concept:name": "string"}, {"n": "int"}).count() == 2


def test_cells_that_are_not_of_their_type(spark, tmp_path):
    path = write(tmp_path / "cells.xes", HEAD + trace("a", 1, "x7", more='<date key="d" value="soon"/>') + trace("b", "", 4) + "</log>")
    spec = SPEC.with_(xes_case_attributes={"concept:name": "string", "d": "date"})
    log, rejects = xes.read_log_checked(spark, path, spec)
    assert rejects_of(rejects) == [("not of type bigint", "a", 1, "n"), ("not of type bigint", "b", 0, "n"), ("not of type timestamp", "a", None, "d")]
    assert sorted((r["case:concept:name"], r["seq"], r["n"]) for r in log.collect()) == [("a", 0, 1), ("a", 1, None), ("b", 0, None), ("b", 1, 4)]


def test_a_whole_log_has_no_rejects(spark, tmp_path):
    path = str(tmp_path / "whole.xes.gz")
    with gzip.open(path, "wt") as f:
        f.write(HEAD + "".join(trace(f"t{i}", *range(i % 3)) for i in range(50)) + "</log>\n")
    log, rejects = xes.read_log_checked(spark, path, SPEC)
    assert rejects.count() == 0 and log.count() == sum(i % 3 for i in range(50))
    empty = write(tmp_path / "empty.xes", HEAD + "</log>")
    log, rejects = xes.read_log_checked(spark, empty, SPEC)
    assert rejects.count() == 0 and log.count() == 0


NESTED = HEAD + """
<global scope="trace"><string key="concept:name" value="unnamed"/><string key="region" value="EU"/></global>
<global scope="event"><string key="org:resource" value="nobody"/><int key="n" value="0"/></global>
<classifier name="x" keys="concept:name"/>
<trace>
  <string key="concept:name" value="a"><string key="source" value="book"/><int key="page" value="7"/></string>
  <list key="tags"><values><string key="t" value="red"/><string key="t" value="blue"/><int key="t" value="3"/></values></list>
  <event><int key="n" value="5"><string key="unit" value="kg"/></int><string key="org:resource" value="ann"><string key="role" value="clerk"/></string></event>
  <event><string key="with/slash" value="kept"/><list key="old"><string key="x" value="1"/></list></event>
</trace>
<trace>
  <string key="region" value="US"/>
  <event/>
</trace>
</log>
"""


def test_nested_attributes_lists_and_defaults(spark, tmp_path):
    path = write(tmp_path / "nested.xes", NESTED)
    case = {"concept:name": "string", "concept:name/source": "string", "concept:name/page": "int", "tags": "list", "region": "string"}
    event = {"n": "int", "n/unit": "string", "org:resource": "string", "org:resource/role": "string", "with/slash": "string", "old": "list"}
    rows = sorted(tuple(r) for r in xes.read_xes(spark, path, case, event).collect())
    assert rows == [
        ("a", "book", 7, '["red","blue","3"]', "EU", 0, None, "nobody", None, "kept", '["1"]', 1),
        ("a", "book", 7, '["red","blue","3"]', "EU", 5, "kg", "ann", "clerk", None, None, 0),
        ("unnamed", None, None, None, "US", 0, None, "nobody", None, None, None, 0),
    ]
    types = xes.attribute_types(spark, path)
    assert types[0] == {"concept:name": ["string"], "concept:name/page": ["int"], "concept:name/source": ["string"], "region": ["string"], "tags": ["list"]}
    assert types[1] == {"n": ["int"], "n/unit": ["string"], "old": ["list"], "org:resource": ["string"], "org:resource/role": ["string"], "with/slash": ["string"]}
    # all that the log has
    log = xes.read_log(spark, path, LogSpec())
    assert set(log.columns) == {f"case:{n}" for n in case} | set(event) | {"seq"}


def test_defaults_are_those_of_the_file(spark, tmp_path):
    write(tmp_path / "one.xes", NESTED)
    write(tmp_path / "two.xes", HEAD + trace("z", 1) + "</log>")
    rows = xes.read_xes(spark, str(tmp_path), {"concept:name": "string", "region": "string"}, {"n": "int"}).collect()
    assert sorted((r["case:concept:name"], r["case:region"] or "") for r in rows) == [("a", "EU"), ("a", "EU"), ("unnamed", "US"), ("z", "")]


def test_tables_with_broken_lines(spark, tmp_path):
    path = write(tmp_path / "t.csv", "state;x;n;ts\n0;a;1.5;2024-01-01\n1;b\n2;c;oops;2024-01-01\n3;d;NA;later\n4;e;2;2024-01-02;6\n")
    schema = "state long, x string, n double, ts timestamp"
    with pytest.raises(ValueError, match="2 of 5 lines"):
        delimited.read_delimited_checked(spark, path, schema)
    table, rejects = delimited.read_delimited_checked(spark, path, schema, most_rejected=0.5)
    assert [(r["state"], r["n"], r["ts"] is None) for r in table.orderBy("state").collect()] == [(0, 1.5, False), (2, None, False), (3, None, True)]
    found = sorted((r["reason"], r["attribute"] or "", r["text"]) for r in rejects.collect())
    assert found == [("not as many cells as the header", "", "1;b"), ("not as many cells as the header", "", "4;e;2;2024-01-02;6"), ("not of type double", "n", "oops"), ("not of type timestamp", "ts", "later")]
    with pytest.raises(ValueError, match="absent"):
        delimited.read_delimited_checked(spark, path, "state long, absent int")
