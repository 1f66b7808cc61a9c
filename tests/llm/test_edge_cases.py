"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from eventloom.llm import interleave, langid, licences, minhash, onebit, packing, quality, toxicity, urlfilter, winnow

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(30_000))
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 4),
    (4, "one two", "en", "a", 7),
    (5, LONG, "en", "b", len(LONG)),
    (6, LONG, "de", None, len(LONG)),
    (7, "the cat sat on the mat and then it went away", "en", "a", 44),
    (7, "the cat sat on the mat and then it went away", "en", "a", 44),
    (None, "the cat sat on the mat and then it went away", "en", "a", 44),
    (8, "1234 5678 !!", "en", "a", 12),
]
LABELS = [(4, 1, 0), (5, 1, 0), (7, 0, 1), (8, 0, 1), (None, 1, 1), (2, None, None), (4, 1, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    # columns whose names the operators use themselves
    frame = spark.createDataFrame(ROWS, DOCS)
    for name in ("score", "predicted", "statistics", "words", "key", "bands", "ids", "start", "rank", "fraction", "file_id"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_near_duplicates(docs):
    result = minhash.near_duplicates(docs)
    assert result.count() == len(ROWS)
    rows = by_id(result, "n_shingles", "component_id", "kept")
    assert rows[1] == (0, 1, True) and rows[2] == (0, 2, True) and rows[3] == (0, 3, True)
    assert rows[4] == (1, 4, True)
    assert rows[5] == (29_996, 5, True) and rows[6] == (29_996, 5, False)
    assert rows[7] == (7, 7, True) and rows[None] == (7, None, True)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(10, "Sat on the MAT and then it went away, far"), (11, "ONE two"), (12, None), (13, ""), (14, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (14, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15")], "item_id long, text string")
    items = items.withColumn("words", F.lit(1))
    result = winnow.contamination(docs, items)
    rows = by_id(result, "n_words", "n_hit", "item_ids")
    assert result.count() == len(ROWS)
    assert rows[1] == rows[2] == rows[3] == (0, 0, [])
    assert rows[4] == (2, 2, ["11"])
    assert rows[5] == (30_000, 11, ["14"]) == rows[6]
    assert rows[7] == (11, 0, [])
    assert winnow.contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert winnow.contamination(docs.limit(0), items).count() == 0


def test_shards(docs):
    result = interleave.interleaved_shards(docs, n_shards=3)
    rows = result.collect()
    assert len(rows) == len(ROWS)
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s, n in enumerate([4, 3, 3]) for i in range(n)]
    assert {r.doc_id: r["size"] for r in rows}[1] == 16
    assert interleave.interleaved_shards(docs.limit(0)).count() == 0


def test_quality(docs, labels):
    rows = quality.score_quality(docs, labels)
    assert rows.count() == len(ROWS)
    scores = by_id(rows, "score")
    assert all(0 <= s[0] <= 1 for s in scores.values())
    assert scores[1] == scores[2] and scores[5] == scores[6] and scores[7] == scores[None]
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).count() == 0


def test_toxicity(docs, labels):
    rows = toxicity.score_toxicity(docs, labels)
    assert rows.count() == len(ROWS)
    scores = by_id(rows, "score")
    assert all(0 <= s[0] <= 1 for s in scores.values())
    assert scores[1] == scores[2] and scores[5] == scores[6] and scores[7] == scores[None]
    assert {r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_language(docs):
    rows = langid.identify_languages(docs)
    assert rows.count() == len(ROWS)
    told = by_id(rows, "lang_pred", "score")
    assert told[1] == told[2] == told[3] == told[8] == ("und", 0.0)
    assert told[4][0] != "und" and told[5] == told[6] and told[7] == told[None]
    assert {r.lang_pred for r in langid.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify_languages(docs.limit(0)).count() == 0


def test_packing(docs):
    rows = packing.pack_documents(docs, window=64).collect()
    total = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 > 0
        total.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert total[1] == total[2] == [(0, 1, 1)]
    assert sum(n for _, n, _ in total[5]) == total[5][0][2]
    assert set(total) == {r[0] for r in ROWS}
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_neighbours(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]), (7, [0.0, 1.0]), (100, [1.0, 0.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vector", F.lit(1)).withColumn("code", F.lit(1))
    index, coder = onebit.build_index(vectors)
    found = onebit.nearest(index.where("vec_id % 100 = 0"), index, coder, k=10).collect()
    shown = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in found)
    assert shown == [(0, 1, 1, 0.0), (0, 2, 100, 0.0), (0, 3, 7, 1.414214), (100, 1, 0, 0.0), (100, 2, 1, 0.0), (100, 3, 7, 1.414214)]
    index, coder = onebit.build_index(vectors.limit(0))
    assert onebit.nearest(index, index, coder).count() == 0


def test_urls(spark):
    urls = [None, "", "no host", "HTTP://A.Example.NET/en/x?q=1", "http://example.net/", "http://net", "http://x.org/fr/", "http://y.org/de/#/fr/", "http://badnet/x", "x://h:80?a=b&c=d", "http://" + "a" * 20_000]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, urls[3])], "page_id long, url string").withColumn("host", F.lit("x")).withColumn("label", F.lit("x"))
    rules = {"net/": "block", "example.net/en/": "allow", "org/fr/": "allow"}
    result = urlfilter.judge_urls(pages, rules)
    assert result.count() == len(urls) + 1
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in result.collect()}
    assert [rows[i][:3] for i in (0, 1, 2)] == [("", "", None)] * 3
    assert rows[3] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert rows[4] == ("example.net", "/", "net/", "block")
    assert rows[5][:3] == ("net", "", None)
    assert rows[6] == ("x.org", "/fr/", "org/fr/", "allow")
    assert rows[7][:3] == ("y.org", "/de/", None)
    assert rows[8][:3] == ("badnet", "/x", None)
    assert rows[9][:3] == ("h:80", "", None)
    assert {r[3] for r in rows.values()} <= {"block", "allow"}
    assert {r.verdict for r in urlfilter.judge_urls(pages, {}).collect()} == {"allow"}
    assert urlfilter.judge_urls(pages.limit(0), rules).count() == 0


def test_licences(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/b/c/x.py", "text"),
        (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\n" + "word " * 5000),
        (4, "d/z.py", None),
        (5, None, "All rights reserved."),
        (6, "top.txt", ""),
        (7, "a/b/COPYING.txt", "no licence here"),
        (2, "a/b/c/x.py", "text"),
        (8, "ab/x.py", "text"),
    ]
    files = spark.createDataFrame(rows, "file_id long, path string, text string").withColumn("license", F.lit("x")).withColumn("folder", F.lit("x"))
    result = licences.scan_licences(files)
    assert result.count() == len(rows)
    got = {r.file_id: (r.license, r.origin, r.licensed_folder) for r in result.collect()}
    assert got == {1: ("MIT", "own", None), 2: ("MIT", "folder", "a"), 3: ("Apache-2.0", "own", None), 4: (None, None, None), 5: ("proprietary", "own", None), 6: (None, None, None), 7: ("MIT", "folder", "a"), 8: (None, None, None)}
    assert licences.scan_licences(files.limit(0)).count() == 0


def test_licence_candidates_lose_nothing(spark):
    # no word of the hand-made list; cosines 0.924, 0.899 and 0.879
    rows = [(1, "x/1", "CC BY-NC 4.0"), (2, "x/2", "text\nCC BY 4.0\ntext"), (3, "x/3", "Released under MIT."), (4, "x/4", "mit der und die"), (5, "x/5", "4 cc")]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r.file_id: (r.license, r.similarity) for r in licences.scan_licences(files).collect()}
    assert {i: name for i, (name, _) in got.items()} == {1: "CC-BY-NC-4.0", 2: "CC-BY-4.0", 3: "MIT", 4: None, 5: None}
    assert [round(got[i][1], 3) for i in (1, 2, 3)] == [0.924, 0.899, 0.879]


@pytest.mark.parametrize("least", [0.3, 0.75, 0.95])
def test_licence_candidates_against_all_subsets(least):
    terms, _ = licences.template_terms()
    vectors = {}
    for word, name, weight, _ in terms:
        vectors.setdefault(name, {})[word] = weight
    candidates = licences.candidate_words(list(vectors.values()), least)
    for vector in vectors.values():
        # the most similar passage with given words has the template's weights
        words = sorted(vector)[:12]
        rest = set(vector) - set(words)
        for bits in range(1 << len(words)):
            held = rest | {w for i, w in enumerate(words) if bits >> i & 1}
            if sum(vector[w] ** 2 for w in held) ** 0.5 >= least:
                assert any(all(held & s for s in sets) for sets in candidates)


LICENCE_TEXTS = [
    ("MIT", "MIT License\n\nCopyright (c) 2020 A. Person\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software ..."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MIT", "# SPDX-License-Identifier: MIT\nimport os\n"),
    ("Apache-2.0", "// SPDX-License-Identifier: Apache-2.0\npackage a;\n"),
    ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS"),
    ("Apache-2.0", '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n'),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE"),
    ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n"),
    ("GPL-2.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n"),
    ("GPL-3.0", " * it under the terms of the GNU General Public License as published by"),
    ("GPL-2.0", "/* This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation; either version 2 of the License, or\n * (at your option) any later version. */\n"),
    ("GPL-3.0", "# SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "# SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007\n"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n"),
    ("BSD-2-Clause", "BSD 2-Clause License\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n"),
    ("MPL-2.0", "Mozilla Public License Version 2.0\n==================================\n"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"),
    # no statement of a licence
    *((None, text) for text in ("mit", "MIT der Zeit\nmit\n", "License", "under the License", "GPL", "artistic", "Version 2.0", "public license", "1", "free software", "SPDX-License-Identifier: Other-2.0", "SPDX-License-Identifier: Other-1.0")),
]


def test_usual_licence_files_and_headers(spark):
    rows = [(i, f"{i}/x", text) for i, (_, text) in enumerate(LICENCE_TEXTS)]
    found = {r.file_id: r.license for r in licences.scan_licences(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert [(found[i], text) for i, (_, text) in enumerate(LICENCE_TEXTS)] == LICENCE_TEXTS


def test_licence_wordings():
    vectors = licences.wording_vectors(licences.TEMPLATES, licences.WORDINGS)
    assert max(x for _, weights, _ in vectors for x in weights.values()) < licences.LEAST
    # each wording is most similar to one of its own licence
    for name, weights, _ in vectors:
        alike = sorted((-round(sum(x * other.get(w, 0.0) for w, x in weights.items()), 6), label) for label, other, _ in vectors)
        assert alike[0][1] == name


def test_decontamination_of_ids_with_a_long_and_a_short_text(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    long = " ".join(f"w{i}" for i in range(1000)) + " " + passage
    docs = spark.createDataFrame([(1, long), (1, "only three words"), (2, passage), (3, passage)], "doc_id long, text string")
    items = spark.createDataFrame([(10, passage), (11, long), (11, "two words")], "item_id long, text string")
    # the alignment at word 1000 lies beyond the short text; passages count for the id
    found = {(r.doc_id, r.item_id, r.shift): r.hits for r in winnow.shared_passages(docs, items).collect()}
    assert found[1, 10, 1000] == found[1, 11, 0][1000:] == list(range(1000, 1012))
    assert found[2, 10, 0] == found[3, 11, -1000] == list(range(12))
