"""Support sets as bitmaps, and formats of timestamps by evidence."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventloom.functions.time import infer_formats, known_shapes
from eventloom.operators import encode


def unpacked(df, *names):
    rows = df.select(*names, encode.bitmap_states(F.col("bits"), F.col("bucket")).alias("states")).collect()
    found = {}
    for r in rows:
        found.setdefault(tuple(r[n] for n in names), []).extend(r["states"])
    return {k: sorted(v) for k, v in found.items()}


def test_bitmaps_of_states(spark):
    draw = random.Random(2)
    sets = {n: sorted(draw.sample(range(100_000), size)) for n, size in (("p", 5000), ("q", 20), ("r", 1))}
    sets["edge"] = [0, 7, 8, 32_767, 32_768, 65_535, 65_536]
    sets["all"] = list(range(40_000))
    pairs = spark.createDataFrame([(n, s) for n, states in sets.items() for s in states], "pvar string, state long")
    bitmaps = encode.support_bitmaps(pairs.unionByName(pairs.limit(50)))
    assert unpacked(bitmaps, "pvar") == {(n,): s for n, s in sets.items()}
    counts = bitmaps.groupBy("pvar").agg(F.sum(F.bitmap_count("bits")).alias("n")).collect()
    assert {r["pvar"]: r["n"] for r in counts} == {n: len(s) for n, s in sets.items()}
    some = bitmaps.where("pvar IN ('p', 'all')")
    assert unpacked(encode.in_all(some))[()] == sorted(set(sets["p"]) & set(sets["all"]))
    assert unpacked(encode.in_any(some))[()] == sorted(set(sets["p"]) | set(sets["all"]))
    # by group: names of one letter, and the others
    grouped = bitmaps.withColumn("short", F.length("pvar") == 1)
    assert unpacked(encode.in_all(grouped, group=["short"]), "short").get((True,), []) == sorted(set(sets["p"]) & set(sets["q"]) & set(sets["r"]))
    actions = encode.support_bitmaps(pairs.where("pvar IN ('all', 'edge')").withColumnRenamed("pvar", "action"), "action")
    met = {(r["action"], r["pvar"]): r["n"] for r in encode.shared_states(actions, bitmaps, "action", "pvar").collect()}
    want = {(a, p): len(set(sets[a]) & set(sets[p])) for a in ("all", "edge") for p in sets}
    assert met == {k: n for k, n in want.items() if n}
    assert encode.support_bitmaps(pairs.limit(0)).count() == 0


def parsed(spark, texts, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, t string").withColumn("shape", F.lit("x"))
    formats = infer_formats(frame, "t", **options)
    return formats, [r["t"] for r in formats.apply(frame).orderBy("id").collect()]


def test_formats_of_one_column(spark):
    at = dt.datetime
    texts = {
        "2024-03-05 07:08:09": at(2024, 3, 5, 7, 8, 9),
        "2024-03-05T07:08:09.123456789Z": at(2024, 3, 5, 7, 8, 9, 123456),
        "2024-03-05T07:08:09.5+02:00": at(2024, 3, 5, 5, 8, 9, 500000),
        "2024-3-5 7:08 UTC": at(2024, 3, 5, 7, 8),
        "2024/03/05 07:08": at(2024, 3, 5, 7, 8),
        "2024-03-05": at(2024, 3, 5),
        "20240305": at(2024, 3, 5),
        "5 March 2024 07:08:09": at(2024, 3, 5, 7, 8, 9),
        "05-Mar-2024": at(2024, 3, 5),
        "Mar 5, 2024 7:08 pm": at(2024, 3, 5, 19, 8),
        "Tuesday, 5 Mar 2024 07:08:09 +0100": at(2024, 3, 5, 6, 8, 9),
        # the day is first, as the next one shows
        "05.03.2024 07:08": at(2024, 3, 5, 7, 8),
        "31.03.2024 07:08": at(2024, 3, 31, 7, 8),
        # the month is first
        "3/5/2024 7:08:09 AM": at(2024, 3, 5, 7, 8, 9),
        "3/31/2024 7:08:09 AM": at(2024, 3, 31, 7, 8, 9),
        # no evidence: by default the month is first
        "03-05-2024": at(2024, 3, 5),
        # each order has evidence: the default, where it fits
        "1/2/2024": at(2024, 1, 2),
        "1/13/2024": at(2024, 1, 13),
        "13/1/2024": at(2024, 1, 13),
        " 2024-03-05 07:08:09 ": at(2024, 3, 5, 7, 8, 9),
        "no date": None,
        "": None,
        "2024-13-45": None,
        "99": None,
    }
    formats, got = parsed(spark, [*texts, None])
    got = [None if x is None else x.astimezone(dt.UTC).replace(tzinfo=None) if x.tzinfo else x for x in got]
    assert dict(zip(texts, got, strict=False)) == texts and got[-1] is None
    report = {r["shape"]: (r["n"], r["pattern"]) for r in formats.shapes.collect()}
    assert report["n.n.y n:n"] == (2, "d.M.yyyy H:mm") and report["n/n/y n:n:n p"] == (2, "M/d/yyyy h:mm:ss a")
    assert report["no date"] == (1, None) and report["D"] == (1, "yyyyMMdd")
    assert parsed(spark, ["03-05-2024"], day_first=True)[1] == [dt.datetime(2024, 5, 3)]
    assert parsed(spark, [None, None])[1] == [None, None]
    assert parsed(spark, [])[1] == []
    assert len(known_shapes()) > 200
