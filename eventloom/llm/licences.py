"""Licence scans: TF-IDF cosine of headers to templates, then inheritance by folder.

Lines, blocks (lines up to a blank one) and whole texts are compared with
templates: words are weighted by their inverse frequency over the templates, and
a passage has the licence of the most similar template, if the cosine is high
enough. Vectors are sparse rows (passage, word, count); the only broadcast is the
templates' words, a constant of the library or the caller.

Passages that cannot be similar enough are left out beforehand. Without the words
of a set, the cosine to a template is at most the norm of the template's other
weights (Cauchy-Schwarz). A set that brings this norm below the least cosine is
one that each similar passage meets, so nothing is lost.

A file in a folder named as a licence file states the licence of the folder. A
file without a licence of its own takes it from the nearest folder above it: the
distinct folders are joined with their ancestors, and the files with the folders.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.staging import stage

# fixed values: usual statements of public licences
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
)


def _gnu(licence: str, name: str, version: str, work: str = "program") -> list[tuple[str, str]]:
    """Statement with the version, short header, first paragraph and whole text of the usual header."""
    terms = f"it under the terms of the {name} as published by the Free Software Foundation"
    first = f"This {work} is free software: you can redistribute it and/or modify {terms}, either version {version} of the License, or (at your option) any later version."
    rest = (
        f" This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        f"PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this {work}. If not, see <http://www.gnu.org/licenses/>."
    )
    # without a version, the line on the terms is that of version 3
    only = f"version {version} only" if version == "2" else f"version {version}"
    return [(licence, t) for t in (f"{name} version {version}", f"{name} v{version}", f"{terms}, {only}", first, first + rest)]


def _creative_commons() -> list[tuple[str, str]]:
    """Titles and statements of the six attribution licences."""
    texts = []
    for marks in ("", "NC", "SA", "ND", "NC SA", "NC ND"):
        names = {"NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
        title = "-".join(["Attribution", *(names[m] for m in marks.split())])
        for version, ported in (("4.0", "International"), ("3.0", "Unported")):
            short = "-".join(["BY", *marks.split()])
            licence = f"CC-{short}-{version}"
            texts += [(licence, f"Creative Commons {title} {version} {ported}"), (licence, f"This work is licensed under a Creative Commons {title} {version} {ported} License.")]
            texts.append((licence, f"Licensed under CC {short} {version}."))
    return texts


#: Further wordings, weighted like the statements above: titles, source headers, bodies of licence texts and
#: SPDX lines. No single word of one reaches LEAST. Near relatives are there so that they do not pass for another licence.
WORDINGS = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy'),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("GPL-3.0", "GNU General Public License"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL-3.0", "GNU Lesser General Public License"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.0", "GNU Library General Public License"),
    ("LGPL-2.0", "GNU Library General Public License Version 2, June 1991"),
    ("AGPL-3.0", "GNU Affero General Public License"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", 'Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.'),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("proprietary", "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited."),
    *_gnu("GPL-3.0", "GNU General Public License", "3"),
    *_gnu("GPL-2.0", "GNU General Public License", "2"),
    *_gnu("LGPL-3.0", "GNU Lesser General Public License", "3", "library"),
    *_gnu("LGPL-2.1", "GNU Lesser General Public License", "2.1", "library"),
    *_gnu("LGPL-2.0", "GNU Library General Public License", "2", "library"),
    *_gnu("AGPL-3.0", "GNU Affero General Public License", "3"),
    *_creative_commons(),
)
SPDX_IDS = (
    "Apache-2.0", "MIT", "MIT-0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "LGPL-2.0", "AGPL-3.0", "BSD-3-Clause", "BSD-2-Clause", "BSD-4-Clause", "0BSD",
    "ISC", "Zlib", "BSL-1.0", "Unlicense", "WTFPL", "MPL-2.0", "EPL-2.0", "EPL-1.0", "EUPL-1.2", "CDDL-1.0", "Artistic-2.0", "CC0-1.0", "PostgreSQL", "MS-PL",
    *(f"CC-{marks}-{version}" for marks in ("BY", "BY-NC", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND") for version in ("4.0", "3.0")),
)
# where the version's words are usual, the first word of the id counts twice; else the line of an unknown licence would be similar
for _id in SPDX_IDS:
    _again = " " + _id.split("-")[0] if re.search("^(Apache|CC)|-1[.]", _id) else ""
    WORDINGS += tuple((_id, f"SPDX-License-Identifier: {_id}{kind}{_again}") for kind in (("", "-only", "-or-later") if "GPL" in _id else ("",)))
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice)(\.[^/]*)?$"
LEAST = 0.75
#: Frequent in texts without a licence, so they pick passages only if other words do not suffice; without effect on results.
FREQUENT = frozenset(
    "a all an and any are as at be but by can do even for from have if in is it its may mit more nd no nor not of on one only or other out see should so some such "
    "that the then there this to under use was were will with you your 0 1 2 3 4".split()
)


def _tokens(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def template_terms(templates=TEMPLATES) -> tuple[list[tuple[str, str, float, float]], float]:
    """Rows (word, licence, weight / norm, idf) and the idf of a word in no template."""
    bags = [(name, Counter(_tokens(text))) for name, text in templates]
    df = Counter(w for _, bag in bags for w in bag)
    idf = {w: math.log((1 + len(bags)) / (1 + n)) + 1 for w, n in df.items()}
    rows = []
    for name, bag in bags:
        norm = math.sqrt(sum((c * idf[w]) ** 2 for w, c in bag.items()))
        rows += [(w, name, c * idf[w] / norm, idf[w]) for w, c in sorted(bag.items())]
    return rows, math.log(1 + len(bags)) + 1


def candidate_words(vectors: list[dict[str, float]], least: float) -> list[tuple[frozenset[str], ...]]:
    """Word sets, of which a passage of cosine ``least`` to any vector meets all those of one entry.

    Where the words that are not frequent do not suffice for a vector, several sets
    of frequent ones do so together with them: a passage without the former meets each.
    """
    # similarities are rounded to six decimals
    need = 1 - max(least - 1e-6, 0.0) ** 2 + 1e-9
    alone, entries = set(), set()
    for vector in vectors:
        squares = {w: x * x for w, x in vector.items()}
        covered = 0.0
        for w in sorted(squares.keys() - FREQUENT, key=lambda w: (-squares[w], -len(w), w)):
            if covered <= need:
                alone.add(w)
                covered += squares[w]
        if covered <= need:
            usual = sorted(squares.keys() & FREQUENT, key=lambda w: (-squares[w], w))
            sets: set[frozenset[str]] = set()
            # all minimal sets of up to four words
            for n in range(1, 5):
                for part in map(frozenset, combinations(usual, n) if len(usual) <= 12 else ()):
                    if covered + sum(squares[v] for v in part) > need and not any(o <= part for o in sets):
                        sets.add(part)
            if not sets:
                some: list[str] = []
                for w in usual:
                    some.append(w)
                    if covered + sum(squares[v] for v in some) > need:
                        sets.add(frozenset(some))
                        some = []
            # a passage without any word of the vector has no cosine
            entries.add(tuple(sorted(sets or {frozenset(usual)}, key=lambda s: (-min(map(len, s), default=0), sorted(s)))))
    return ([(frozenset(alone),)] if alone else []) + sorted((e for e in entries if all(e)), key=lambda e: [sorted(s) for s in e])


def _any_of(words: frozenset[str]) -> str:
    """A pattern of the words, branched by their first letters."""
    by_first: dict[str, list[str]] = {}
    for w in sorted(words):
        by_first.setdefault(w[0], []).append(w[1:])
    return "(?i)(^|[^a-z0-9])(" + "|".join(f"{first}({'|'.join(rest)})" for first, rest in by_first.items()) + ")([^a-z0-9]|$)"


def may_state(text: Column, candidates: list[tuple[frozenset[str], ...]]) -> Column:
    """True for the texts that meet all word sets of an entry."""
    held = F.lit(False)
    for sets in candidates:
        met = F.lit(True)
        for words in sets:
            met = met & text.rlike(_any_of(words))
        held = held | met
    return held


def wording_vectors(templates, wordings) -> list[tuple[str, dict[str, float], dict[str, float]]]:
    """(licence, word to weight / norm, word to idf) of the templates and further wordings; the templates alone fix the idf."""
    terms, unknown = template_terms(templates)
    idf = {word: i for word, _, _, i in terms}
    rows = []
    for name, text in (*templates, *wordings):
        weights = {w: n * idf.get(w, unknown) for w, n in Counter(_tokens(text)).items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        rows.append((name, {w: weights[w] / norm for w in sorted(weights)}, {w: idf.get(w, unknown) for w in weights}))
    return rows


def words_of(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, "[^a-z0-9]+"), "")


def own_licences(files: DataFrame, templates=TEMPLATES, least: float = LEAST, wordings=None) -> DataFrame:
    """``file_id``, ``license``, ``similarity`` of the files with a licence statement; staged.

    The most similar passage counts, then the first licence by name. A licence may
    have several templates and further ``wordings`` (those of the library if the
    templates are); the words are weighted by their frequency over ``templates``.
    """
    spark = files.sparkSession
    if wordings is None:
        wordings = WORDINGS if templates is TEMPLATES else ()
    unknown = template_terms(templates)[1]
    vectors = wording_vectors(templates, wordings)
    candidates = candidate_words([weights for _, weights, _ in vectors], least)
    text = F.col("text")
    told = files.where(F.col("file_id").isNotNull() & text.isNotNull() & may_state(text, candidates)).select("file_id", "text")
    passages = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n[ \t\r]*\n"), F.array(text)))
    parts = told.select("file_id", F.posexplode(passages).alias("part", "passage")).where(may_state(F.col("passage"), candidates))
    bags = parts.select("file_id", "part", F.explode(words_of(F.col("passage"))).alias("word")).groupBy("file_id", "part", "word").agg(F.count(F.lit(1)).alias("n"))
    terms = [(w, n, name, x, idf[w]) for n, (name, weights, idf) in enumerate(vectors) for w, x in weights.items()]
    weights = spark.createDataFrame(terms, "word string, template int, license string, weight double, idf double")
    idf = weights.groupBy("word").agg(F.first("idf").alias("idf"), F.collect_list(F.struct("template", "license", "weight")).alias("of"))
    # templates are a constant, so their words are too
    weighed = stage(bags.join(F.broadcast(idf), "word", "left").select("file_id", "part", "of", (F.col("n") * F.coalesce("idf", F.lit(unknown))).alias("x")), "passage-words")
    norms = weighed.groupBy("file_id", "part").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = weighed.select("file_id", "part", "x", F.explode("of").alias("t")).groupBy("file_id", "part", "t.template", "t.license").agg(F.sum(F.col("x") * F.col("t.weight")).alias("dot"))
    alike = dots.join(norms, ["file_id", "part"]).select("file_id", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("similarity")).where(F.col("similarity") >= least)
    best = alike.groupBy("file_id").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "license")).alias("best"))
    return stage(best.select("file_id", "best.license", (-F.col("best.minus")).alias("similarity")), "own-licences")


def folder_of(path: Column) -> Column:
    """The path without its last part; empty for a file at the top."""
    return F.regexp_replace(F.regexp_extract(path, r"^(.*/)?[^/]*$", 1), "/$", "")


def scan_licences(files: DataFrame, templates=TEMPLATES, least: float = LEAST, wordings=None) -> DataFrame:
    """One row per file: its licence and where that comes from.

    ``files`` has ``file_id``, ``path`` (parts divided by ``/``) and ``text``;
    other columns are not read. Columns: ``file_id``, ``path``, ``license`` (null
    if there is none), ``similarity`` (of an own one), ``origin`` (``own``,
    ``folder`` or null), ``licensed_folder``. A null or empty text has no
    licence of its own; a null path is in no folder. Where a folder has several
    licence files the most similar counts, then the first licence by name.
    Ids are unique; repeated rows give repeated results.
    """
    own = own_licences(files, templates, least, wordings)
    # written once: a path may be a long expression over the text, and places are read three times
    places = stage(files.select("file_id", "path"), "file-paths").select("file_id", "path", folder_of(F.col("path")).alias("folder"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    stated = places.where(F.col("name").rlike(LICENCE_FILE)).join(own, "file_id")
    stated = stated.groupBy("folder").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "license")).alias("best"))
    stated = stage(stated.select(F.col("folder").alias("above"), F.col("best.license").alias("from_folder")), "licensed-folders")
    folders = places.where("folder is not null").select("folder").distinct()
    parts = F.split("folder", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    steps = folders.select("folder", F.explode(ups).alias("up")).select("folder", "up.depth", "up.above").distinct()
    nearest = steps.join(stated, "above").groupBy("folder").agg(F.max(F.struct("depth", "above", "from_folder")).alias("up"))
    nearest = stage(nearest.select("folder", F.col("up.above").alias("licensed_folder"), "up.from_folder"), "inherited")
    joined = places.select("file_id", "path", "folder").join(own, "file_id", "left").join(nearest, "folder", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("from_folder").isNotNull(), "folder")
    return joined.select("file_id", "path", F.coalesce("license", "from_folder").alias("license"), "similarity", origin.alias("origin"), F.when(F.col("license").isNull(), F.col("licensed_folder")).alias("licensed_folder"))
