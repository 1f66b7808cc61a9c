"""Readers and writers, and whole runs from a log file to a policy."""

import gzip
from pathlib import Path

import pytest

from eventloom import __main__ as cli
from eventloom.operators import encode
from eventloom.plans.pipeline import Run, run_all
from eventloom.plans.preprocess import label_outcomes, preprocess
from eventloom.presets import PRESETS
from eventloom.sources import delimited, xes
from eventloom.staging import clear_staged, stage, staged_dir

# (case, amount, [(activity, minute, resource, expense)])
FINES = [
    ("A1", 35.0, [("Create Fine", 0, "r1", None), ("Send Fine", 60, None, 13.5), ("Payment", 90, None, None)]),
    ("A2", 36.0, [("Create Fine", 5, "r1", None), ("Payment", 50, None, None)]),
    ("A3", 80.0, [("Create Fine", 7, "r2", None), ("Send Fine", 70, None, 13.5), ("Add penalty", 99, None, None),
                  ("Send for Credit Collection", 99, None, None)]),
    ("A4", 80.0, [("Create Fine", 8, "r2", None), ("Send Fine", 71, None, 13.5)]),
    ("A5", 35.0, [("Create Fine", 9, "r1", None), ("Send Fine", 60, None, 13.5), ("Payment", 95, None, None)]),
]


def write_xes(path):
    lines = ['<?xml version="1.0" encoding="UTF-8"?>', '<log xes.version="1.0">', '<string key="name" value="fines"/>']
    for case, amount, events in FINES:
        lines.append(f'<trace><string key="concept:name" value="{case}"/><boolean key="paid" value="true"/>')
        for i, (activity, minute, resource, expense) in enumerate(events):
            lines.append("<event>")
            lines.append(f'<string key="concept:name" value="{activity}"/>')
            lines.append(f'<date key="time:timestamp" value="2024-01-01T{1 + minute // 60:02d}:{minute % 60:02d}:00.000+01:00"/>')
            if resource:
                lines.append(f'<string key="org:resource" value="{resource}"/>')
            if i == 0:
                lines.append(f'<float key="amount" value="{amount}"/>')
                lines.append('<int key="article" value="157"/><string key="vehicleClass" value="A"/><int key="points" value="0"/>')
            if expense is not None:
                # the same attribute with two types
                lines.append(f'<{"float" if case != "A5" else "int"} key="expense" value="{expense if case != "A5" else 13}"/>')
            lines.append("</event>")
        lines.append("</trace>")
    lines.append("</log>")
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines))


@pytest.fixture(scope="module")
def fines(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("logs") / "fines.xes.gz")
    write_xes(path)
    return path


def test_xes(spark, fines):
    log = xes.read_xes(
        spark, fines, {"concept:name": "string", "paid": "boolean"},
        {"concept:name": "string", "time:timestamp": "date", "amount": "float", "article": "int", "expense": ("float", "int")},
    )
    assert log.dtypes == [
        ("case:concept:name", "string"), ("case:paid", "boolean"), ("concept:name", "string"), ("time:timestamp", "timestamp"),
        ("amount", "double"), ("article", "bigint"), ("expense", "double"), ("seq", "bigint"),
    ]
    rows = {(r["case:concept:name"], r["seq"]): r for r in log.collect()}
    assert len(rows) == sum(len(e) for _, _, e in FINES)
    assert rows["A3", 3]["concept:name"] == "Send for Credit Collection"
    assert rows["A1", 0]["amount"] == 35.0 and rows["A1", 1]["amount"] is None
    assert rows["A5", 1]["expense"] == 13.0 and rows["A1", 1]["expense"] == 13.5
    assert rows["A2", 0]["case:paid"] is True and rows["A2", 0]["article"] == 157
    with pytest.raises(ValueError, match="unknown type"):
        xes.read_xes(spark, fines, {}, {"x": "text"})


def test_xes_attribute_types(spark, fines):
    case, event = xes.attribute_types(spark, fines)
    assert case == {"concept:name": ["string"], "paid": ["boolean"]}
    assert event["expense"] == ["float", "int"] and event["time:timestamp"] == ["date"]
    assert xes.widest(["int", "float"]) == "float" and xes.widest(["int", "date"]) == "string"


def test_delimited_round_trip(spark, tmp_path):
    df = spark.sql(
        "SELECT * FROM VALUES ('a b', 1L, 1.5D, true, timestamp'2024-01-01 00:00:00.5'), (null, null, null, null, null) "
        "AS t(s, n, d, b, ts)"
    )
    path = str(tmp_path / "out")
    delimited.write_delimited(df, path)
    back = delimited.read_delimited(spark, path, df.schema)
    assert back.dtypes == df.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_missing_spellings(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("state;x;n\n0;NA;1.5\n1;NaN;null\n2;missing;oops\n3;;\n")
    table = delimited.read_delimited(spark, path, "state long, x string, n double, absent int")
    assert table.dtypes == [("state", "bigint"), ("x", "string"), ("n", "double"), ("absent", "int")]
    rows = table.orderBy("state").collect()
    assert [tuple(r) for r in rows] == [(0, None, 1.5, None), (1, None, None, None), (2, "missing", None, None), (3, None, None, None)]
    everything = delimited.read_all_text(spark, path)
    assert everything.where("x IS NULL").count() == 3
    numbered = delimited.number_rows(everything)
    assert [r["state"] for r in numbered.orderBy("seq").collect()] == ["0", "1", "2", "3"]


def test_preprocess_fines(spark, fines):
    spec = PRESETS["rtf"]
    log = preprocess(xes.read_log(spark, fines, spec), spec)
    absent = {"lastSent", "notificationType", "dismissal"}
    assert set(log.columns) == {*spec.configured, "execution_time_minutes"} - absent
    rows = {(r["Case ID"], r["seq"]): r for r in log.collect()}
    # A4 has neither a payment nor a collection
    assert {k[0] for k in rows} == {"A1", "A2", "A3", "A5"}
    last = rows["A3", 3]
    assert last["timesincecasestart"] == 92.0 and last["remaining_time_minutes"] == 0.0
    assert last["execution_time_minutes"] == 92.0 and rows["A1", 0]["execution_time_minutes"] == 90.0
    # filled forward, then 0 and missing; fewer than ten events of a kind become other
    assert rows["A1", 2]["amount"] == 35.0 and rows["A1", 0]["expense"] == 0.0
    assert rows["A1", 2]["article"] == "157"
    assert rows["A1", 2]["Resource"] == "other"
    assert rows["A2", 1]["Activity"] == "Payment"


def test_preprocess_loans_counts_open_cases(spark):
    rows = [("c1", "A", 0, 0, None), ("c1", "B", 30, 1, "x"), ("c2", "A", 10, 0, "y"), ("c2", "C", 20, 1, None), ("c3", "A", 15, 0, None)]
    raw = spark.createDataFrame(
        [(c, a, f"2024-01-01 00:{m:02d}:00", s, r, "COMPLETE") for c, a, m, s, r in rows],
        "`case:concept:name` string, `concept:name` string, `time:timestamp` string, seq long, `org:resource` string, "
        "`lifecycle:transition` string",
    )
    spec = PRESETS["bpi12"].with_(rare_threshold=2)
    got = {(r["case:concept:name"], r["seq"]): r for r in preprocess(raw, spec).collect()}
    assert [got[k]["open_cases"] for k in (("c1", 0), ("c2", 0), ("c3", 0), ("c2", 1), ("c1", 1))] == [1, 2, 2, 1, 0]
    assert got["c2", 1]["org:resource"] == "y" and got["c1", 0]["org:resource"] == "missing"
    assert got["c1", 1]["concept:name"] == "other" and got["c1", 0]["concept:name"] == "A"


@pytest.mark.parametrize("preset", ["sepsis", "intDecl", "permit"])
def test_other_presets(spark, preset):
    spec = PRESETS[preset]
    raw = spark.createDataFrame(
        [("c1", "Release A", "2024-01-01T00:00:00Z", 0, "UNKNOWN", True, "12"), ("c1", "Other", "bad", 1, None, None, "x"),
         (None, "Release B", "2024-01-02T00:00:00Z", 0, "kim", False, None)],
        "`case:concept:name` string, `concept:name` string, `time:timestamp` string, seq long, `org:role` string, "
        "`case:Overspent` boolean, `case:RequestedAmount` string",
    )
    rows = {r["Case ID"]: r for r in preprocess(raw, spec.with_(rare_threshold=1)).collect()}
    assert set(rows) == {"c1", "missing_caseid"}
    assert rows["c1"]["event_nr"] == 1
    if preset != "sepsis":
        assert rows["c1"]["Role"] == "missing" and rows["missing_caseid"]["Role"] == "kim"
        assert rows["c1"]["RequestedAmount"] == 12.0 and rows["missing_caseid"]["RequestedAmount"] == 0.0
    if preset == "permit":
        assert rows["c1"]["Overspent"] == "True" and rows["missing_caseid"]["Overspent"] == "False"


def test_run_all_and_skipping(spark, fines, tmp_path):
    out = str(tmp_path / "run")
    argv = ["--preset", "rtf", "--log", fines, "--out", out, "--abstraction", "contextual", "--horizon", "6"]
    cli.main(argv, spark)
    run = Run(spark, PRESETS["rtf"], out)
    assert {r["last_action_name"] for r in run.read("mdp/states_described").collect()} == {
        "start", "archive_application", "Create Fine", "Send Fine", "Payment", "Add penalty", "Send for Credit Collection",
    }
    assert run.read("mdp/transitions").columns == ["state", "action_index", "action", "next_state", "probability"]
    clauses = run.read("encoding/clauses")
    assert clauses.count() == run.read("mdp/transitions").count()
    policy = run.read("policy")
    start = run.read("encoding/initial_state").first()["state"]
    best = policy.where(f"state = {start} AND step = 6").first()
    assert best["action"] == "Create Fine" and best["value"] == pytest.approx(10.0)
    assert encode.check_ids(run.read("mdp/states_discretized")).first()["contiguous"]

    # earlier tables are reused, so the log is not needed
    again = run_all(
        spark, PRESETS["rtf"], out, skip=["preprocess", "discovery", "discretize", "encoding"], horizon=1
    )
    assert {r["step"] for r in again.collect()} == {1}
    with pytest.raises(ValueError, match="raw log"):
        run_all(spark, PRESETS["rtf"], out)
    with pytest.raises(ValueError, match="unknown stages"):
        run_all(spark, PRESETS["rtf"], out, skip=["planning"])


def test_outcome_labels_of_a_preset(spark, fines):
    spec = PRESETS["rtf"].with_(rare_threshold=1)
    log = preprocess(xes.read_log(spark, fines, spec), spec)
    found = {r["Case ID"]: r["label"] for r in label_outcomes(log, spec).collect()}
    assert found["A3"] == "deviant" and found["A1"] == "regular"
    assert label_outcomes(log, spec, cut=True).count() == log.count() - 1
    with pytest.raises(ValueError, match="label_activity"):
        label_outcomes(log, PRESETS["sepsis"])


def test_staged_tables_are_cleared(spark):
    stage(spark.range(3), "numbers")
    folder = Path(staged_dir(spark).removeprefix("file:"))
    assert list(folder.glob("numbers-*/*.parquet"))
    clear_staged(spark)
    assert not folder.exists()


def test_run_with_clusters(spark, fines, tmp_path):
    table = run_all(
        spark, PRESETS["rtf"], str(tmp_path / "run"), xes.read_log(spark, fines, PRESETS["rtf"]), kind="partial_k_means", k=2,
        initial=0, horizon=2,
    )
    assert table.count() > 0


def test_xes_is_split_between_traces(spark, tmp_path):
    path = str(tmp_path / "many.xes")
    traces = [
        f'<trace>\n<id key="identity:id" value="u{i}"/><string key="concept:name" value="c{i}"/>' + "".join(f'<event><int key="n" value="{j}"/></event>' for j in range(i % 7)) + "</trace>"
        for i in range(3000)
    ]
    with open(path, "w", encoding="utf-8") as f:
        f.write('<?xml version="1.0"?>\n<log>\n<global scope="trace"><string key="concept:name" value=""/></global>\n' + "\n".join(traces) + "\n</log>\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        wanted = None
        # borders fall into all places of the closing tag
        for size in ("128m", "20000", "20003", "20007"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            log = xes.read_xes(spark, path, {"concept:name": "string", "identity:id": "id"}, {"n": "int"})
            rows = sorted(tuple(r) for r in log.collect())
            assert log.rdd.getNumPartitions() == 1 if size == "128m" else log.rdd.getNumPartitions() > 3
            wanted = wanted or rows
            assert rows == wanted
        assert len(rows) == sum(i % 7 for i in range(3000))
        assert rows[0][1] == "u" + rows[0][0][1:]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
