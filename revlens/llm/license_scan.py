"""License scan: sparse TF-IDF cosine of headers and licence files to templates, then directory inheritance.

Header candidates are the lines of a text that hold a cue word, their sentences that hold one, and the runs of such
lines (up to ``RUN_GAP`` other lines between two of them). A candidate's words are weighted by their count and inverse
document frequency and compared by cosine with the weighted templates; the best candidate at or above ``HEADER`` names
the licence. So that words around a notice don't hide it, each template is also compared with every window of its own
length that holds a cue word, across line breaks; a window counts at or above ``SPAN``. A text
is a licence file if it matches a template as a whole at or above ``WHOLE`` or the full text of a licence at or above
``FULL``, or if its file name says so and a candidate matches; it covers its directory. A file without a header of its own inherits from the nearest ancestor
directory that a licence file covers: the distinct directories are joined by path with the covered ones among their
ancestors, and the deepest one wins. Its answer goes to the files by a join on the directory. A directory with a large
share of the files is hot: there are at most ``HOT_SHARE`` such directories at any size, and their answers are broadcast.

Document frequencies are counted over all texts, for the words of the templates and full texts only (a bounded
vocabulary); other words of a candidate weigh as much as the rarest template word.

Defined results: a null or empty text has no header and may inherit; a null path has no directory; two licence files
of one directory: the better score, then the smaller licence name, counts; repeated rows and null ids are rows like
any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import column, stored, text_batches
from revlens.llm.licence_texts import TEXTS

HEADER = 0.6
SPAN = 0.7  # more than "under the license" of a short template has; there are many windows
BLOCK_WORDS = 4096
WHOLE = 0.8
FULL = 0.9  # long prose shares many common words with a long licence
RUN_GAP = 2
HOT_SHARE, HOT_FILES = 200, 1000  # a hot directory has more than one file in 200, and more than 1000
SPREAD = 4096  # parts for files that ask for nothing in the join on directories

# Short notices of common licences, as their public texts recommend them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. Public domain, CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)
# AGPL-3.0 is GPL-3.0 under its own name but for a paragraph; without it, its full text would pass as GPL-3.0.
FULL_TEXTS = (
    *TEXTS,
    *(("AGPL-3.0", re.sub(r"(GNU )(General)", r"\1Affero \2", text, flags=re.IGNORECASE)) for name, text in TEXTS if name == "GPL-3.0"),
)
CUES = re.compile(r"licen[cs]|copyright|spdx|public domain|creative commons|cc0|permission|redistribut|free software", re.IGNORECASE)
LICENCE_NAME = re.compile(r"(?:^|/)(?:licen[cs]e|copying|unlicense|notice)(?:[.-][^/]*)?$", re.IGNORECASE)
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
SENTENCE = re.compile(r"(?<=[.!?;])\s+")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def candidates(text: str) -> Iterator[str]:
    """The cue lines of a text, their cue sentences, and the runs of lines from one cue line to another close by."""
    if not CUES.search(text):
        return
    lines = text.split("\n")
    at = [k for k, line in enumerate(lines) if CUES.search(line)]
    start = 0
    for k, here in enumerate(at):
        yield lines[here]
        yield from (part for part in SENTENCE.split(lines[here]) if len(part) < len(lines[here]) and CUES.search(part))
        if k + 1 == len(at) or at[k + 1] - here > RUN_GAP + 1:
            if k > start:
                yield "\n".join(lines[at[start] : here + 1])
            start = k + 1


class Matcher:
    """Cosine of TF-IDF vectors to the templates, by an inverted index over their words."""

    def __init__(self, templates, frequency: dict[str, int], total: int):
        bags = [Counter(words(t)) for _, t in templates]
        vocabulary = set().union(*bags) if bags else set()
        self.names = [name for name, _ in templates]
        self.weight = {w: math.log((1 + total) / (1 + frequency.get(w, 0))) + 1 for w in vocabulary}
        self.other = max(self.weight.values(), default=1.0)
        self.index: dict[str, list[tuple[int, float]]] = {}
        for k, bag in enumerate(bags):
            norm = math.sqrt(sum((n * self.weight[w]) ** 2 for w, n in bag.items()))
            for w, n in bag.items():
                self.index.setdefault(w, []).append((k, n * self.weight[w] / norm))
        self.lengths = np.array([sum(bag.values()) for bag in bags], dtype=np.int64)

    def best(self, text: str) -> tuple[float, str | None]:
        """The best template's cosine and licence; the smaller name among equals."""
        bag = Counter(words(text))
        scores, norm = Counter(), 0.0
        for w, n in bag.items():
            value = n * self.weight.get(w, self.other)
            norm += value * value
            for k, t in self.index.get(w, ()):
                scores[k] += value * t
        if not scores:
            return 0.0, None
        top = max(scores.values())
        name = min(self.names[k] for k, s in scores.items() if s >= top - 1e-12)
        return min(1.0, top / math.sqrt(norm)), name


    def best_span(self, text: str, least: float = 0.0) -> tuple[float, str | None]:
        """As ``best``, of the windows of each template's length that hold a cue word, if at ``least`` or above.

        A text shorter than a template is one window.
        """
        text = text.lower()
        cues = [m.start() for m in CUES.finditer(text)]
        if not cues or not len(self.lengths):
            return 0.0, None
        found = list(WORD.finditer(text))
        cue = np.zeros(len(found), dtype=np.int64)
        cue[np.searchsorted([m.start() for m in found], cues, side="right") - 1] = 1
        longest, best = int(self.lengths.max()), (least, None)
        for start in range(0, len(found), BLOCK_WORDS):
            end = min(len(found), start + BLOCK_WORDS + longest - 1)
            near = np.flatnonzero(cue[start:end])
            if len(near):
                low, high = max(start, start + near[0] - longest + 1), min(end, start + near[-1] + longest)
                score, name = self._windows([m.group() for m in found[low:high]], cue[low:high], best[0])
                if name and (score > best[0] + 1e-12 or (score > best[0] - 1e-12 and name < (best[1] or "~"))):
                    best = score, name
        return best if best[1] else (0.0, None)

    def _windows(self, run: list[str], cue: np.ndarray, least: float) -> tuple[float, str | None]:
        """The best window of a run of words, if it is at ``least`` or above; windows are sums between two prefixes."""
        ids: dict[str, int] = {}
        at = np.array([ids.setdefault(w, len(ids)) for w in run])
        weight = np.array([self.weight.get(w, self.other) for w in ids])
        parts = np.zeros((len(self.names), len(ids)))
        for w, j in ids.items():
            for k, t in self.index.get(w, ()):
                parts[k, j] = t * weight[j]
        square = (weight * weight)[at]
        scores: list[tuple[float, str]] = []
        for length in np.unique(self.lengths):
            n = min(int(length), len(run))
            held = _sums(cue, n) > 0
            norm, same = _sums(square, n), None
            for k in np.flatnonzero(self.lengths == length):
                dot = _sums(parts[k][at], n)
                if (dot[held] / np.sqrt(norm[held])).max(initial=0.0) < least - 1e-9:
                    continue  # a word that comes again only adds to the norm
                if same is None:
                    same = norm + 2 * sum((_sums(np.where(at[:-d] == at[d:], square[d:], 0.0), n - d) for d in range(1, n)), np.zeros(len(norm)))
                score = (dot[held] / np.sqrt(same[held])).max(initial=0.0)
                if score > 0:
                    scores.append((min(1.0, float(score)), self.names[k]))
        if not scores:
            return 0.0, None
        top = max(s for s, _ in scores)
        return top, min(name for s, name in scores if s >= top - 1e-12)


def _sums(values: np.ndarray, n: int) -> np.ndarray:
    """The sums of all windows of ``n`` values."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[n:] - total[:-n]


def document_frequency(files: DataFrame, templates) -> tuple[dict[str, int], int]:
    """In how many texts each template word is found, and how many texts there are: at most a row per word."""
    vocabulary = {w for _, t in templates for w in words(t)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in column(batch, "text"):
                found.update(vocabulary.intersection(words(text or "")))
                found[""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    rows = files.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    frequency = {r["word"]: r["n"] for r in rows}
    return frequency, frequency.pop("", 0)


def parent(path: Column) -> Column:
    """The directory of a path, '' at the top; null for a null path."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def nearest_covered(directories: DataFrame, covered: DataFrame) -> DataFrame:
    """dir, inherited, inherited_score: the licence of each directory's nearest covered ancestor or itself.

    A directory is one row for each of its levels; the join key is a path, and the deepest match wins.
    """
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    levels = directories.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"), parts.alias("parts"))
    above = levels.select("dir", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("above"))
    found = above.join(covered.withColumnRenamed("dir", "above"), "above")
    deepest = F.max_by(F.struct("inherited", "inherited_score"), "depth")
    return found.groupBy("dir").agg(deepest.alias("x")).select("dir", "x.inherited", "x.inherited_score")


def with_answers(own: DataFrame, answers: DataFrame, hot_from: int) -> DataFrame:
    """``own`` with the ``inherited`` and ``inherited_score`` of each file's directory.

    Directories of more than ``hot_from`` files, at most ``HOT_SHARE`` by that bound, are broadcast. Only files of other
    directories that need an answer meet in the join on the directory; the rest is spread over ``SPREAD`` parts there.
    """
    answer = F.struct("inherited", "inherited_score")
    hot = answers.where(F.col("n") > hot_from).select(F.col("dir").alias("hot_dir"), answer.alias("hot"))
    cold = answers.where((F.col("n") <= hot_from) & F.col("inherited").isNotNull())
    cold = cold.select(F.col("dir").alias("cold_dir"), F.lit(0).cast("bigint").alias("cold_part"), answer.alias("cold"))
    files = own.join(F.broadcast(hot), F.col("dir") == F.col("hot_dir"), "left")
    asks = F.col("own").isNull() & F.col("dir").isNotNull() & F.col("hot_dir").isNull()
    # spread files match nothing, so a number that a rerun may change is good enough
    spread = 1 + F.pmod(F.xxhash64("path", "own_score", F.monotonically_increasing_id()), F.lit(SPREAD))
    files = files.withColumn("part", F.when(asks, F.lit(0)).otherwise(spread).cast("bigint"))
    met = files.join(cold, (F.col("dir") == F.col("cold_dir")) & (F.col("part") == F.col("cold_part")), "left")
    found = F.when(F.col("own").isNull(), F.coalesce("hot", "cold"))
    return met.select(*own.columns, found["inherited"].alias("inherited"), found["inherited_score"].alias("inherited_score"))


def license_scan(
    files: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", full_texts=FULL_TEXTS
) -> DataFrame:
    """doc_id, path, license, how (header, file, inherited or none) and score for every row of ``files``."""
    base = text_batches(files).select(F.col(id_col).alias("doc_id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    frequency, total = document_frequency(base, (*templates, *full_texts))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, full = Matcher(templates, frequency, total), Matcher(full_texts, frequency, total)
        for batch in batches:
            names, scores, whole = [], [], []
            for path, text in zip(column(batch, "path"), column(batch, "text"), strict=True):
                text = text or ""
                score, name = max(((s, n) for s, n in map(matcher.best, candidates(text)) if n), key=lambda x: (x[0], _last(x[1])), default=(0.0, None))
                if score < 1 - 1e-9:
                    span_score, span_name = matcher.best_span(text, max(SPAN, score))
                    if span_score > score + 1e-9:
                        score, name = span_score, span_name
                is_file = False
                if name:
                    as_whole = [x for x, least in ((matcher.best(text), WHOLE), (full.best(text), FULL)) if x[0] >= least]
                    is_file = bool(as_whole)
                    if is_file:
                        score, name = max(as_whole, key=lambda x: x[0])
                    is_file |= bool(path and LICENCE_NAME.search(path)) and score >= HEADER
                if score < HEADER:
                    score, name = 0.0, None
                names.append(name)
                scores.append(score)
                whole.append(is_file)
            out = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(whole, pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "path", "own", "own_score", "is_file"])

    kind = base.schema["doc_id"].dataType.simpleString()
    own = stored(base.mapInArrow(scan, f"doc_id {kind}, path string, own string, own_score double, is_file boolean"))
    own = own.withColumn("dir", parent(F.col("path")))
    best = F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own").alias("name")))
    covered = own.where(F.col("is_file") & F.col("dir").isNotNull()).groupBy("dir").agg(best.alias("b"))
    covered = covered.select("dir", F.col("b.name").alias("inherited"), (-F.col("b.s")).alias("inherited_score"))
    wanted = own.where(F.col("own").isNull() & F.col("dir").isNotNull()).groupBy("dir").agg(F.count(F.lit(1)).alias("n"))
    answers = stored(wanted.join(nearest_covered(wanted, covered), "dir", "left"))
    joined = with_answers(own, answers, max(HOT_FILES, total // HOT_SHARE))
    how = F.when(F.col("is_file"), "file").when(F.col("own").isNotNull(), "header").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    mine = F.col("own").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.when(mine, F.col("own")).otherwise(F.col("inherited")).alias("license"),
        how.alias("how"),
        F.when(mine, F.col("own_score")).otherwise(F.coalesce("inherited_score", F.lit(0.0))).alias("score"),
    )


def _last(name: str) -> tuple[int, ...]:
    """Orders names backwards, so that the smaller one is the greater among equal scores."""
    return tuple(-ord(c) for c in name)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: the source is the top directory, the language the one below it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", F.col("source"), F.col("lang"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return license_scan(docs.select("doc_id", path.alias("path"), "text"))
