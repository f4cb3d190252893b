import math
import random
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import licences as L

MIT, CC, GPL = "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3."
SCHEMA = "doc_id long, path string, text string, licence string, directory int"


def cosine(idf, words, template):
    a, b = Counter(words), Counter(L.words_of(template))
    x, y = ({w: n * idf(w) for w, n in c.items()} for c in (a, b))
    norm = lambda v: math.sqrt(sum(i * i for i in v.values()))
    return sum(x[w] * y[w] for w in x.keys() & y.keys()) / (norm(x) * norm(y)) if x else 0.0


def same(words, name, template):
    """Whether a window has the template's deciding words, and for a tag all words of the name."""
    tag = set(L.words_of(name)) if template.startswith("SPDX") else set()
    return L.DECIDING & set(words) == L.DECIDING & set(L.words_of(template)) and tag <= set(words)


def plain_scan(idf, text, templates):
    """licence -> best cosine of every window of a notice's length, and the best cosine of the whole text."""
    every = [*templates, *((n, f"SPDX-License-Identifier: {n}") for n in sorted({n for n, _ in templates}))]
    words = L.words_of(text)
    windows, whole = [], 0.0
    for name, template in every:
        m = min(len(L.words_of(template)), len(words))
        for i in range(len(words) - m + 1 if words else 0):
            if same(words[i : i + m], name, template) and (c := round(cosine(idf, words[i : i + m], template), 6)) >= L.COSINE:
                windows.append((-c, name, i, i + m))
        whole = max(whole, cosine(idf, words, template) if same(words, name, template) else 0.0)
    found, taken = {}, []
    for c, name, i, j in sorted(windows):  # of overlapping licences the best one stays
        if all(name == other or j <= a or b <= i for other, a, b in taken):
            taken.append((name, i, j))
            found[name] = max(found.get(name, 0.0), -c)
    return found, whole


def run(spark, rows):
    return {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, SCHEMA), F.col("path")).collect()}


def row(i, path, text):
    return (i, path, text, "x", 1)


def test_headers_files_and_inheritance(spark):
    filler = "\n".join(f"line {i} of plain words that say nothing" for i in range(30))
    rows = [
        row(1, "a/LICENSE", MIT), row(2, "a/x/code", f"{filler}\n{GPL}\n{filler}"), row(3, "a/x/y/z/plain", filler), row(4, "b/plain", filler), row(5, "a/x/y/NOTICE", CC),
        row(6, "a/x/y/z/deep", None), row(7, "top", filler), row(8, "ab/plain", filler), row(9, None, filler), row(10, "c/two", f"{MIT}\n{filler}\n{CC}"),
        row(11, "a/x/y/z/deep", ""), row(11, "a/x/y/z/deep", ""), row(12, None, MIT), row(13, "d/LICENSE", "licensed under the apache\nlicense version 2.0"), row(14, "d/e", "x"),
    ]
    got = run(spark, rows)
    assert (got[1].licence, got[1].basis) == ("MIT", "file")
    assert (got[2].licence, got[2].basis, got[2].from_dir) == ("GPL-3.0", "header", None)
    assert (got[3].licence, got[3].basis, got[3].from_dir) == ("CC-BY-NC-4.0", "inherited", "a/x/y")
    assert got[6].from_dir == got[11].from_dir == "a/x/y" and got[6].basis == "inherited"
    assert all((got[i].licence, got[i].basis) == (None, "none") for i in (4, 7, 8, 9))
    assert got[10].licences == "CC-BY-NC-4.0,MIT" and got[10].licence == "CC-BY-NC-4.0" and got[12].basis == "file"
    assert got[13].licence == "Apache-2.0" and got[14].from_dir == "d"
    assert L.scan(spark.createDataFrame([], SCHEMA), F.col("path")).count() == 0


def test_top_directory_declares_for_all(spark):
    got = run(spark, [row(1, "LICENSE", MIT), row(2, "a/b/c", "plain"), row(3, "/abs", "plain")])
    assert got[2].from_dir == "" and got[3].licence == "MIT"


def test_whole_scan_equals_brute_force(spark):
    """Counts of all words over all texts, every window against every notice, without anchors, slots or bounds."""
    rnd = random.Random(3)
    common = ["the", "under", "this", "is", "of", "to", "in", "and", "a", "version", "license"]
    parts = [t for _, t in L.TEMPLATES] + ["the under this is of", "license", "Copyright 2020 Someone", "", "x y z", "SPDX-License-Identifier: MIT", "the license the version 3"]
    rows = []
    for i in range(60):
        lines = [" ".join(rnd.choice(common) if rnd.random() < 0.6 else f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(12))) for _ in range(rnd.randrange(6))]
        for _ in range(rnd.randrange(3)):
            words = rnd.choice(parts).split()
            for _ in range(rnd.randrange(3)):
                words.insert(rnd.randrange(len(words) + 1), f"w{rnd.randrange(300)}")
            lines.insert(rnd.randrange(len(lines) + 1), (" " if rnd.random() < 0.5 else "\n// ").join(words))
        rows.append(row(i, f"d/{i}", "\n".join(lines)))
    texts = {r[0]: r[2] for r in rows}
    df = Counter(w for t in texts.values() for w in set(L.words_of(t)))
    idf = lambda w: math.log((1 + len(rows)) / (1 + df[w])) + 1
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, SCHEMA), F.col("path"), full=[]).collect()}
    assert sum(r.basis != "none" for r in got.values()) > 20
    for i, text in texts.items():
        found, whole = plain_scan(idf, text, L.TEMPLATES)
        sure = {n for n, c in found.items() if c > L.COSINE + 1e-5}
        assert sure <= set(filter(None, got[i].licences.split(","))) <= set(found), text
        if sure:
            assert abs(got[i].score - (whole if whole >= L.COSINE else max(found.values()))) < 1e-5
        assert (got[i].basis == "file") == (whole >= L.COSINE)


def test_line_breaks_do_not_matter(spark):
    """A notice on one line, over nine and one word a line scores alike, wherever it stands."""
    filler = "\n".join(f"line {i} of plain words that say nothing" for i in range(30))
    notice = next(t for n, t in L.TEMPLATES if n == "GPL-3.0" and len(t) > 150)
    words = notice.split()
    step = -(-len(words) // 9)
    shapes = [notice, "\n * ".join(" ".join(words[i : i + step]) for i in range(0, len(words), step)), "\n# ".join(words)]
    got = run(spark, [row(i, f"d{i}/x", f"{filler}\n/* {s} */\n{filler}") for i, s in enumerate(shapes)])
    assert {(r.licence, r.basis, r.score) for r in got.values()} == {("GPL-3.0", "header", 1.0)}


def test_a_very_long_text(spark):
    got = run(spark, [row(1, "a/x", "plain words here " * 100_000 + GPL), row(2, "a/y", "license " * 100_000)])
    assert (got[1].licence, got[1].basis) == ("GPL-3.0", "header") and got[2].basis == "none"


def test_a_hot_directory(spark):
    rows = [row(i, f"hot/{i}" if i % 3 else f"d{i}/x", "plain") for i in range(1, 900)] + [row(0, "hot/LICENSE", MIT)]
    got = run(spark, rows)
    assert all(got[i].basis == ("inherited" if i % 3 else "none") for i in range(1, 900))


def test_full_licence_texts_declare(spark):
    """Licence files as they are shipped, with a copyright line, or cut or re-wrapped, declare; kin are told apart and prose isn't a licence."""
    texts = dict(L.full_texts())
    filler = "\n".join(f"line {i} of plain words that say nothing" for i in range(30))
    rows = []
    for i, (name, text) in enumerate(sorted(texts.items())):
        shipped = (f"Copyright 2021 Somebody\n\n{text}", " ".join(text.split()), text[: len(text) * 9 // 10])[i % 3]
        rows += [row(2 * i, f"{name}/LICENSE", shipped), row(2 * i + 1, f"{name}/a/b/code", filler)]
    prose = " ".join("the owner of the house and the work of the day is in this and that place to which you may go or not under any other sky".split() * 60)
    rows += [row(900, "p/essay", prose), row(901, "p/x", filler), row(902, "q/code", f"{filler}\n" * 20 + texts["MIT"])]
    got = run(spark, rows)
    for i, name in enumerate(sorted(texts)):
        assert (got[2 * i].licence, got[2 * i].basis) == (name, "file"), name
        assert name in got[2 * i].licences.split(",")
        assert (got[2 * i + 1].licence, got[2 * i + 1].basis, got[2 * i + 1].from_dir) == (name, "inherited", name)
    assert got[900].basis == got[901].basis == "none" and got[902].basis == "header"


#: Headers of files as they are usually written, and their licences; None: no licence that has a notice.
HEADERS = [
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-1.1", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"), ("MIT", "SPDX-License-Identifier: MIT"), (None, "SPDX-License-Identifier: Zlib"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (None, "This work is licensed under a Creative Commons Attribution 2.0 Generic License."), (None, "Licensed under the Apache License, Version 1.1."), (None, "Licensed under CC BY-NC-SA 2.0."),
]


def test_kin_and_versions_are_told_apart(spark):
    """As headers within files and as texts of their own; a version without a notice has no name."""
    filler = "\n".join(f"line {i} of plain words that say nothing" for i in range(30))
    rows = [row(i, f"d{i}/x", f"{filler}\n// {text}\n{filler}") for i, (_, text) in enumerate(HEADERS)] + [row(1000 + i, f"e{i}/x", text) for i, (_, text) in enumerate(HEADERS)]
    got = run(spark, rows)
    assert {i: got[i].licences for i in range(len(HEADERS))} == {i: name or "" for i, (name, _) in enumerate(HEADERS)}
    assert {i: got[1000 + i].licence for i in range(len(HEADERS))} == {i: name for i, (name, _) in enumerate(HEADERS)}


def test_full_texts_name_no_others(spark):
    """Header lists of whole licence texts hold no foreign names, and a relative that isn't at hand isn't taken for one that is."""
    texts = dict(L.full_texts())
    affero = texts["GPL-3.0"].replace("GNU General Public License", "GNU Affero General Public License").replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")
    unfree = texts["CC-BY-4.0"].replace("Attribution 4.0", "Attribution-NonCommercial 4.0") + " NonCommercial purposes only." * 8
    rows = [row(i, f"{n}/LICENSE", t) for i, (n, t) in enumerate(texts.items())] + [row(900, "a/COPYING", affero), row(901, "a/x", "plain"), row(902, "b/COPYING", unfree)]
    got = run(spark, rows)
    assert {n: got[i].licences for i, n in enumerate(texts)} == {n: n for n in texts}
    assert got[900].licence == "AGPL-3.0" and got[901].licence == "AGPL-3.0" and got[902].licence != "CC-BY-4.0"
