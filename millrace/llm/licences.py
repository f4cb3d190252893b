"""Licence scan: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Words are weighted by inverse document frequency over all documents. A text's headers are its
windows of as many words as a notice has, wherever lines break; each notice is compared with all of
them, and with the text as a whole. A header or text at ``COSINE`` or above carries the notice's
licence, if it has the words that tell kin apart (versions, lesser, affero, noncommercial and the like) as the notice has
them and no others; of headers that overlap only the best licence's count. A text that matches as a whole is a licence file and declares its licence for its directory.
Whole texts are also compared with full licence texts (folder ``licence_texts``); the better match counts, if such words are
about as many. Names that a licence's own text brings up are no headers of its file. A text that is like a full one but for
such words is a relative's that isn't at hand: it declares by the notice that it holds. Files with no
header of their own take the licence of the nearest directory above them that declares one, found by
joining the paths of directories, never of files, with the declaring paths.

The templates' words are counted exactly. All other words are counted in ``SLOTS`` hashed slots, in
documents that hold any word of the slot, so what is collected has a fixed size; a word that shares
its slot weighs less than it would alone, and never less than a word that every document holds.

Of each notice the heaviest words are its anchors, so many that what is left can't reach the cosine
(by the Cauchy-Schwarz bound); windows without an anchor are passed over without loss. By the same
bound a text is compared with no template if too little of its weight is in templates' words, or if
it lacks too much of the template's.

Null and odd cases: a null or empty text has no header; a null path is a file in no directory,
which inherits nothing; a text shorter than a notice is one window; several licences in a text are all
listed, the best match first, ties to the name that sorts first; several declaring files in a directory
likewise; texts of any length are read whole; repeated rows are each answered; an empty table gives
an empty result; other columns, of any name, are ignored.
"""

from __future__ import annotations

import math
import pkgutil
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import joined_by_share, utf8, written

#: Licences of one family by name, title, and the versions that have notices of their own.
GNU = (
    ("GPL", "GNU General Public License", ("1", "2", "3")),
    ("LGPL", "GNU Library General Public License", ("2",)),
    ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
    ("AGPL", "GNU Affero General Public License", ("3",)),
)
#: The parts of Creative Commons licences as they are written out, and the combinations there are.
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = (("3.0", "Unported"), ("4.0", "International"))
#: Other licence names and notices that declare them.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("ISC", "Licensed under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Words that tell kin apart. A notice and what is named after it have the same of them.
DECIDING = frozenset("1 2 3 4 affero agpl by cc0 gpl lesser lgpl nc nd noderivatives noderivs noncommercial sa sharealike".split())


def notices() -> list[tuple[str, str]]:
    """Names and notices: those of families by their patterns, and the others."""
    out = list(NOTICES)
    for short, title, versions in GNU:
        for v in versions:
            name = f"{short}-{v if '.' in v else v + '.0'}"
            out += [
                (name, f"This work is licensed under the {title}, version {v}."),
                (name, f"modify it under the terms of the {title} as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version."),
                (name, f"modify it under the terms of the {title} version {v} as published by the Free Software Foundation."),
            ]
    for kind in CC_KINDS:
        for v, place in CC_VERSIONS:
            long = "-".join(CC_PARTS[p] for p in kind.split("-"))
            out += [(f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}."), (f"CC-{kind}-{v}", f"This work is licensed under a Creative Commons {long} {v} {place} License.")]
    return sorted(out)


TEMPLATES = notices()
#: Licences whose full text is a file template. Those without a notice above are there to be told from their kin.
FULL = (
    "Apache-2.0", "Artistic-1.0-Perl", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0",
    "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "NCSA", "Unlicense",
)
#: Words whose number tells a full text from its kin's that isn't at hand.
FULL_DECIDING = ("affero", "lesser", "library", "noncommercial", "noderivatives", "sharealike")
COSINE = 0.75
FAR = 1 << 20
#: Hashed slots for the document frequencies of words that no template has.
SLOTS = 1 << 18
#: Slots in one row while counts are added up.
STRIP = 1 << 10
WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def full_texts() -> list[tuple[str, str]]:
    """Names and texts of the file templates."""
    return [(name, pkgutil.get_data(__package__, f"licence_texts/{name}.txt").decode("utf-8")) for name in FULL]


def of_kin(words: Counter, template: Counter) -> bool:
    """Whether a whole text has about as many of the words that tell kin apart as a full licence text."""
    return all(words[w] <= 2 * template[w] + 2 and template[w] <= 2 * words[w] + 2 for w in FULL_DECIDING)


def slot_of(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % SLOTS


class Matcher:
    """Templates as unit vectors under the corpus's word weights."""

    def __init__(self, templates: Sequence[tuple[str, str]], frequency: dict[str, int], slots: np.ndarray, documents: int, tags: bool = True):
        spdx = [(name, f"SPDX-License-Identifier: {name}") for name in sorted({n for n, _ in templates})] if tags else []
        counted = [(name, words_of(text)) for name, text in [*templates, *spdx]]
        self.full = {} if tags else {name: Counter(words) for name, words in counted}
        self.decide = [] if not tags else [DECIDING & set(words) for _, words in counted]
        # of a tag, every word of the name decides
        self.tag = [frozenset() for _ in templates] + [frozenset(words_of(name)) for name, _ in spdx]
        self.idf = {w: math.log((1 + documents) / (1 + frequency.get(w, 0))) + 1 for _, words in counted for w in words}
        self.other = np.log((1 + documents) / (1 + slots.astype(np.float64))) + 1
        self.by_word: dict[str, list[tuple[int, float]]] = {}
        self.names, self.lengths, self.units = [], [], []
        self.brings: dict[str, set[str]] = {}
        self.anchors: dict[str, list[int]] = {}
        for i, (name, words) in enumerate(counted):
            v = {w: n * self.idf[w] for w, n in Counter(words).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            self.names.append(name)
            self.lengths.append(len(words))
            self.units.append({w: x / norm for w, x in v.items()})
            left = 1.0
            for w in sorted(v, key=lambda w: (-v[w], w)):
                self.by_word.setdefault(w, []).append((i, v[w] / norm))
                if math.sqrt(max(left, 0.0)) >= COSINE - 1e-9:
                    self.anchors.setdefault(w, []).append(i)
                left -= (v[w] / norm) ** 2

    def weight(self, word: str) -> float:
        known = self.idf.get(word)
        return float(self.other[slot_of(word)]) if known is None else known

    def best(self, words: Counter, kin: bool = False) -> tuple[float, str] | None:
        """The best template's cosine and licence for a text as a whole, if it reaches the threshold; with ``kin``, whatever
        the words that tell kin apart say."""
        known = sorted(words.keys() & self.by_word.keys())
        inside = sum((words[w] * self.idf[w]) ** 2 for w in known)
        least = inside + sum(n * n for n in words.values()) - sum(words[w] ** 2 for w in known)  # no word weighs less than 1
        if not known or inside < (COSINE**2 - 1e-9) * least:
            return None
        norm2 = inside + sum((n * self.weight(w)) ** 2 for w, n in sorted(words.items()) if w not in self.by_word)
        if inside < (COSINE**2 - 1e-9) * norm2:
            return None
        norm = math.sqrt(norm2)
        dots: dict[int, float] = {}
        for w in known:
            for i, x in self.by_word[w]:
                dots[i] = dots.get(i, 0.0) + x * words[w] * self.idf[w]
        found = [(-round(d / norm, 6), self.names[i]) for i, d in dots.items() if d / norm >= COSINE and (kin or self._same(i, words))]
        return (-min(found)[0], min(found)[1]) if found else None

    def _same(self, i: int, words: Counter | set | dict) -> bool:
        """Whether the words that tell kin apart are those of template i."""
        if self.full:
            return of_kin(words, self.full[self.names[i]])
        return {w for w in DECIDING if w in words} == self.decide[i] and all(w in words for w in self.tag[i])

    def _windows(self, i: int, words: list[str], weights: list[float], at: list[int]) -> Iterator[tuple[float, str, int, int]]:
        """Windows of template i's length that hold a position in ``at`` and reach the threshold: negated cosine, licence, start, end."""
        unit, m, decide, tag = self.units[i], min(self.lengths[i], len(words)), self.decide[i], self.tag[i]
        ranges: list[list[int]] = []  # of starts
        for p in at:
            lo, hi = max(0, p - m + 1), min(p, len(words) - m)
            if ranges and lo <= ranges[-1][1] + 1:
                ranges[-1][1] = max(ranges[-1][1], hi)
            else:
                ranges.append([lo, hi])
        for lo, hi in ranges:
            count: dict[str, int] = {}
            dot = norm2 = 0.0
            held = 0  # deciding words of the window that the template has, and those that it hasn't count far below
            for p in range(lo, hi + m):
                w, x = words[p], weights[p]
                n = count.get(w, 0)
                count[w] = n + 1
                if not n and w in DECIDING:
                    held += 1 if w in decide else -FAR
                norm2 += (2 * n + 1) * x * x
                dot += x * unit.get(w, 0.0)
                if p >= lo + m:
                    w, x = words[p - m], weights[p - m]
                    n = count[w] - 1
                    count[w] = n
                    if not n and w in DECIDING:
                        held -= 1 if w in decide else -FAR
                    norm2 -= (2 * n + 1) * x * x
                    dot -= x * unit.get(w, 0.0)
                if p >= lo + m - 1 and held == len(decide) and (score := round(min(1.0, dot / math.sqrt(norm2)), 6)) >= COSINE and all(count.get(x) for x in tag):
                    yield -score, self.names[i], p - m + 1, p + 1

    def relative(self, words: Counter) -> bool:
        """Whether a text is like a full licence text but for the words that tell kin apart."""
        return self.best(words, kin=True) is not None

    def scan(self, text: str) -> tuple[list[tuple[float, str]], tuple[float, str] | None]:
        """(licences of headers, best first; licence of the whole text)."""
        words = words_of(text)
        there = set(words)
        if self.anchors.keys().isdisjoint(there):
            return [], None
        # a template can only match if the text holds enough of its weight
        able = {i for w in there & self.anchors.keys() for i in self.anchors[w]}
        able = {i for i in able if self.decide[i] <= there and self.tag[i] <= there and sum(x * x for w, x in self.units[i].items() if w in there) >= COSINE**2 - 1e-9}
        best: dict[str, float] = {}
        if able:
            at: dict[int, list[int]] = {i: [] for i in sorted(able)}
            for p, w in enumerate(words):
                for i in self.anchors.get(w, ()):
                    if i in able:
                        at[i].append(p)
            weights = [self.weight(w) for w in words]
            owner = np.full(len(words), -1)
            order = {n: k for k, n in enumerate(sorted(set(self.names)))}
            for score, name, start, end in sorted(w for i, positions in at.items() for w in self._windows(i, words, weights, positions)):
                held = owner[start:end]
                if ((held < 0) | (held == order[name])).all():
                    owner[start:end] = order[name]
                    best[name] = max(best.get(name, 0.0), -score)
        return sorted(((s, n) for n, s in best.items()), key=lambda x: (-x[0], x[1])), self.best(Counter(words))


def _frequency(batches: Iterator[pa.RecordBatch], vocabulary: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """word, n of the vocabulary (the empty word: documents), and strips of the slots' counts."""
    total: Counter = Counter()
    slots = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for raw in batch["raw"]:
            words = set(words_of(raw.as_py().decode("utf-8", "replace")))
            total.update(vocabulary & words)
            total[""] += 1
            slots[list({slot_of(w) for w in words - vocabulary})] += 1
    if not total:
        return
    strips = slots.reshape(-1, STRIP)
    used = np.flatnonzero(strips.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array([*total, *[None] * len(used)], pa.string()), pa.array([*total.values(), *used.tolist()], pa.int64()),
         pa.array([*[None] * len(total), *(strips[i].tobytes() for i in used)], pa.binary())], names=["word", "n", "strip"])


def _added(strips: pa.Table) -> pa.Table:
    """The sum of one strip's counts."""
    sums = np.sum([np.frombuffer(x.as_py(), np.int64) for x in strips["strip"]], axis=0)
    return pa.table({"i": strips["i"][:1], "strip": pa.array([sums.tobytes()], pa.binary())})


def matchers_for(texts: DataFrame, templates: Sequence[tuple[str, str]], files: Sequence[tuple[str, str]]) -> tuple[Matcher, Matcher]:
    """Of notices and of full texts. The vocabulary and the number of slots bound what is collected."""
    vocabulary = frozenset(w for _, t in [*templates, *files] for w in words_of(t)) | frozenset(w for n, _ in templates for w in words_of(f"SPDX-License-Identifier: {n}"))
    counts = written(texts.select("raw").mapInArrow(lambda it: _frequency(it, vocabulary), "word string, n long, strip binary"), "licence-counts")
    seen = {r["word"]: r["n"] for r in counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    documents = seen.pop("", 0)
    slots = np.zeros((SLOTS // STRIP, STRIP), np.int64)
    strips = counts.where("strip is not null").select(F.col("n").alias("i"), "strip").groupBy("i").applyInArrow(_added, "i long, strip binary")
    for r in strips.toLocalIterator():
        slots[r["i"]] = np.frombuffer(r["strip"], np.int64)
    headers, whole = Matcher(templates, seen, slots.reshape(-1), documents), Matcher(files, seen, slots.reshape(-1), documents, tags=False)
    whole.brings = {name: {n for _, n in headers.scan(text)[0]} - {name} for name, text in files}
    return headers, whole


def _scan(batches: Iterator[pa.RecordBatch], matcher: Matcher, files: Matcher) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, scores, whole, whole_scores = [], [], [], []
        for raw in batch["raw"]:
            text = raw.as_py().decode("utf-8", "replace")
            found, file = matcher.scan(text)
            if full := files.best(words := Counter(words_of(text))):
                file = min(full, file or full, key=lambda x: (-x[0], x[1]))
                # names that the licence's own text brings up, as that of its kin, are no headers
                best = {n: s for s, n in reversed(found) if n not in files.brings.get(full[1], ())}
                best[full[1]] = max(full[0], best.get(full[1], 0.0))
                found = sorted(((s, n) for n, s in best.items()), key=lambda x: (-x[0], x[1]))
            elif file is None and found and files.relative(words):
                file = found[0]  # the text of a licence that isn't at hand, by the notice that it holds itself
            names.append([n for _, n in found])
            scores.append(found[0][0] if found else None)
            whole.append(file[1] if file else None)
            whole_scores.append(file[0] if file else None)
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["path"], pa.array(names, pa.list_(pa.string())), pa.array(scores, pa.float64()), pa.array(whole, pa.string()), pa.array(whole_scores, pa.float64())],
            names=["id", "path", "found", "score", "whole", "whole_score"],
        )


def parent(path: Column) -> Column:
    """The directory of a path; the top directory is the empty string."""
    return F.when(path.isNotNull(), F.regexp_replace(path, "/?[^/]*$", ""))


def ancestors(directory: Column) -> Column:
    """The directory and all above it, the top one included."""
    parts = F.split(directory, "/")
    every = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), every))


def inherited(directories: DataFrame, declared: DataFrame) -> DataFrame:
    """directory, files, from_dir, from_licence: the nearest declaring directory at or above each."""
    up = directories.select("directory", F.explode(ancestors(F.col("directory"))).alias("above"))
    hits = up.join(declared, F.col("above") == F.col("from_dir"))
    nearest = hits.groupBy(F.col("directory").alias("near")).agg(F.max(F.struct(F.length("from_dir").alias("depth"), "from_dir", "from_licence")).alias("best"))
    return directories.join(nearest, F.col("directory") == F.col("near")).select("directory", "files", "best.from_dir", "best.from_licence")


def scan(files: DataFrame, path: Column, templates: Sequence[tuple[str, str]] = TEMPLATES, full: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, path, licence, basis (header, file, inherited or none), score, licences, from_dir."""
    texts = files.select(F.col("doc_id").alias("id"), path.alias("path"), utf8("text").alias("raw"))
    shared = texts.sparkSession.sparkContext.broadcast(matchers_for(texts, templates, full_texts() if full is None else full))
    id_type = texts.schema["id"].dataType.simpleString()
    kind = f"id {id_type}, path string, found array<string>, score double, whole string, whole_score double"
    rows = written(texts.mapInArrow(lambda it: _scan(it, *shared.value), kind).withColumn("directory", parent(F.col("path"))), "licences")
    declared = rows.where(F.col("whole").isNotNull() & F.col("directory").isNotNull()).groupBy(F.col("directory").alias("from_dir")).agg(
        F.min(F.struct((-F.col("whole_score")).alias("s"), F.col("whole").alias("l"))).alias("m")
    )
    declared = declared.select("from_dir", F.col("m.l").alias("from_licence"))
    directories = rows.where(F.col("directory").isNotNull()).groupBy("directory").agg(F.count(F.lit(1)).alias("files"))
    given = written(inherited(directories, declared), "licence-dirs")
    out = joined_by_share(rows, F.col("directory"), given, "directory", "files", rows.count())
    own = F.when(F.col("whole").isNotNull(), F.col("whole")).otherwise(F.col("found")[0])
    has = F.size("found") > 0
    return out.select(
        F.col("id").alias("doc_id"),
        "path",
        F.coalesce(F.when(has | F.col("whole").isNotNull(), own), F.col("from_licence")).alias("licence"),
        F.when(F.col("whole").isNotNull(), F.lit("file")).when(has, F.lit("header")).when(F.col("from_licence").isNotNull(), F.lit("inherited")).otherwise(F.lit("none")).alias("basis"),
        F.coalesce("whole_score", "score").alias("score"),
        F.array_join("found", ",").alias("licences"),
        F.when(~has & F.col("whole").isNull(), F.col("from_dir")).alias("from_dir"),
    )
