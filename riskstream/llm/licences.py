"""Licence scans by DataFrame functions alone.

A file is a sequence of words, whatever its line breaks. Windows as long as a licence
template are compared with it by the cosine of sparse TF-IDF vectors: a word of a window
counts once, weighted by how few lines of all files have it; words that no template has
weigh as much as a word of one line. A window that has none of a template's anchors, its
heaviest words, stays below ``SIMILAR``, so only windows around those are looked at. The
best window at or above ``SIMILAR`` is the file's own statement; an SPDX identifier has
to be whole, and reserved rights count where nothing else is stated. A file is a licence
file if its name says so or if statements make up at least ``FILE_SHARE`` of its words.
It stands for its directory, and a file without a statement of its own inherits from the
nearest ancestor directory that has one: directories are joined with their ancestors'
paths first, files with their directory's answer after that.

Templates have at most a few hundred words, whatever the files: their weights are the
one thing that is broadcast.

Results by case: a null or empty text states nothing and may inherit; a file without a
path states for itself only; rows that repeat a path are one file and get one answer;
several licence files of a directory: the most similar counts, then the least path;
equal similarities go to the template first in order of names; extra columns are
ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm.common import Scratch

# How the commonest licences are named in headers, and what licence files have: their
# titles and main sentences (fixed values).
SPDX = "SPDX-License-Identifier:"
RESERVED = "Proprietary"
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        f"{SPDX} Apache-2.0",
        "Apache License Version 2.0, January 2004",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an AS IS BASIS",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        f"{SPDX} BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer",
        "endorse or promote products derived from this software without specific prior written "
        "permission",
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 License.",
        f"{SPDX} CC-BY-4.0",
        "Creative Commons Attribution 4.0 International Public License",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 License.",
        f"{SPDX} CC-BY-NC-4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International Public License",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or any later version",
        f"{SPDX} GPL-3.0",
        "GNU General Public License Version 3, 29 June 2007",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
        f"{SPDX} MIT",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License 2.0",
        f"{SPDX} MPL-2.0",
        "Mozilla Public License Version 2.0",
    ),
    RESERVED: ("All rights reserved.",),
}
SIMILAR = 0.7
FILE_SHARE = 0.5
LICENCE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"

NO_WORD = r"[^\p{L}\p{N}]+"


def words_of(text: str) -> set[str]:
    return {word for word in re.split(r"[\W_]+", text.lower()) if word}


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NO_WORD), "")


def _line_words(files: DataFrame) -> DataFrame:
    """The distinct words of each line."""
    lines = files.where("text is not null").select(
        F.explode(F.split("text", "\n")).alias("content")
    )
    return lines.select(F.explode(F.array_distinct(_split(F.col("content")))).alias("word"))


def _listed(spark: SparkSession, rows: list[Column]) -> DataFrame:
    """A small table of literals."""
    return spark.range(1).select(F.inline(F.array(*rows)))


def _weights(words: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Each template word's weight; a stranger's weight."""
    listed = _listed(words.sparkSession, [F.struct(F.lit(w).alias("word")) for w in vocabulary])
    marked = words.join(F.broadcast(listed.withColumn("known", F.lit(True))), "word", "left")
    # One row for each template word, and one for all strangers.
    own = F.when(F.col("known"), F.col("word")).alias("word")
    times = {row["word"]: row["count"] for row in marked.groupBy(own).count().collect()}
    total = sum(times.values()) + 1
    weight = {w: math.log(1 + total / max(1, times.get(w, 0))) for w in vocabulary}
    return weight, math.log(1 + total)


def _length(text: str) -> int:
    return len([word for word in re.split(r"[\W_]+", text) if word])


def _anchors(words: set[str], weight: dict[str, float], similar: float) -> list[str]:
    """The heaviest words: what has none of them is less than ``similar``."""
    total = sum(weight[w] ** 2 for w in words)
    rest, found = total, []
    for w in sorted(words, key=lambda w: (-weight[w], w)):
        if rest < similar**2 * total * (1 - 1e-9):
            break
        found.append(w)
        rest -= weight[w] ** 2
    return found


def statements(
    files: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    similar: float = SIMILAR,
) -> DataFrame:
    """(path, start, size, words, order, licence, similarity): windows that state a licence.

    ``start`` and ``size`` of the window and ``words`` of the file are numbers of words.
    """
    listed = [(name, text) for name in sorted(templates) for text in templates[name]]
    sets = [words_of(text) for _, text in listed]
    vocabulary = sorted(set().union(*sets))
    weight, stranger = _weights(_line_words(files), vocabulary)
    anchors_of = [_anchors(own, weight, similar) for own in sets]
    anchors = _listed(
        files.sparkSession,
        [
            F.struct(
                F.lit(w).alias("word"), F.lit(name).alias("licence"), F.lit(-k).alias("order"),
                F.lit(_length(text)).alias("size"),
                F.lit(math.sqrt(sum(weight[x] ** 2 for x in own))).alias("norm"),
                F.array(*map(F.lit, sorted(own))).alias("own"),
                F.lit(len(own) if text.startswith(SPDX) else 0).alias("needed"),
            )
            for k, ((name, text), own) in enumerate(zip(listed, sets, strict=True))
            for w in anchors_of[k]
        ],
    )
    # Each anchor with the words in whose windows it is, from ``first`` on.
    longest = max(_length(text) for _, text in listed)
    wanted = F.array(*map(F.lit, sorted(set().union(*anchors_of))))
    hits = F.filter(
        F.transform("all", lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
        lambda x: F.array_contains(wanted, x["word"]),
    )

    def surrounded(hit: Column) -> Column:
        first = F.greatest(hit["at"] - longest + 1, F.lit(0))
        around = F.slice("all", first + 1, hit["at"] - first + longest)
        return F.struct(hit["at"], hit["word"], first.alias("first"), around.alias("around"))

    begin = F.greatest(F.col("at") - F.col("size") + 1, F.lit(0))
    near = (
        files.where("text is not null")
        .select("path", _split(F.col("text")).alias("all"))
        .where(F.arrays_overlap("all", wanted))
        .select("path", F.size("all").alias("words"), F.inline(F.transform(hits, surrounded)))
        .toDF("path", "words", "at", "word", "first", "around")
        .join(F.broadcast(anchors), "word")
        .select(
            "path", "words", "licence", "order", "size", "norm", "own", "needed",
            begin.alias("begin"),
            F.slice(
                "around", begin - F.col("first") + 1, F.col("at") - begin + F.col("size")
            ).alias("near"),
        )
    )
    squares = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, weight[w] ** 2)])
    rated = F.transform(
        "near",
        lambda w: F.struct(
            w.alias("word"), F.array_contains("own", w).alias("own"),
            F.coalesce(squares[w], F.lit(stranger**2)).alias("square"),
        ),
    )

    def judged(rated: Column, start: Column) -> Column:
        # A word of a window counts once.
        sums = F.aggregate(
            F.array_distinct(F.slice(rated, start, F.col("size"))),
            F.struct(F.lit(0.0).alias("own"), F.lit(0.0).alias("all"), F.lit(0).alias("n")),
            lambda s, x: F.struct(
                (s["own"] + F.when(x["own"], x["square"]).otherwise(0.0)).alias("own"),
                (s["all"] + x["square"]).alias("all"),
                (s["n"] + x["own"].cast("int")).alias("n"),
            ),
            lambda s: F.when(
                s["n"] >= F.col("needed"), s["own"] / (F.sqrt(s["all"]) * F.col("norm"))
            ).otherwise(0.0),
        )
        return F.struct(sums.alias("similarity"), (-start).alias("earlier"))

    starts = F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("size") + 1, F.lit(1)))
    # An array of one, for the words to be rated once and not for each window.
    best = F.transform(
        F.array(rated),
        lambda r: F.array_max(F.transform(starts, lambda start: judged(r, start))),
    )
    return (
        near.withColumn("best", best[0])
        .where(F.col("best.similarity") >= similar)
        .select(
            "path", (F.col("begin") - F.col("best.earlier") - 1).alias("start"),
            F.least("size", "words").alias("size"), "words", "order", "licence",
            F.least(F.col("best.similarity"), F.lit(1.0)).alias("similarity"),
        )
        .distinct()
    )


def _parent(path: Column) -> Column:
    """The directory of a path; the topmost is the empty text."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def _ancestors(path: Column) -> Column:
    """A directory and all above it, nearest first."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, F.size(parts) - i), "/"),
    )


def licences(
    files: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    similar: float = SIMILAR, path: str = "path", text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(path, licence, similarity, origin, from_path), one row for each row of ``files``.

    origin: header, directory, or none. Columns named in ``keep`` come along, in front.
    """
    scratch = Scratch(files.sparkSession, "licences")
    # A row without a path is known by its text, and lies in no directory.
    name = F.coalesce(F.col(path), F.concat(F.lit("\0"), F.sha2(F.col(text), 256)))
    rows = files.select(
        *keep, F.col(path).alias("given"), name.alias("path"), F.col(text).alias("text")
    )
    files = rows.select("path", "text")
    found = scratch.keep(statements(files, templates, similar), "statements")
    order = F.struct(
        (F.col("licence") != RESERVED).alias("more"), "similarity",
        (-F.col("start")).alias("earlier"), "order", "licence",
    )
    places = F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)
    own = found.groupBy("path").agg(
        F.max(order).alias("best"), F.max("words").alias("words"),
        F.size(F.array_distinct(F.flatten(F.collect_set(places)))).alias("stated"),
    )
    own = scratch.keep(
        own.select("path", "best.licence", "best.similarity", "stated", "words"), "own"
    )

    is_file = (F.col("stated") >= FILE_SHARE * F.col("words")) | F.col("path").rlike(LICENCE_NAME)
    placed = ~F.col("path").startswith("\0")
    by_place = own.where(is_file & placed).withColumn(
        "directory", _parent(F.col("path"))
    )
    top = by_place.groupBy("directory").agg(F.max("similarity").alias("similarity"))
    first = by_place.join(top, ["directory", "similarity"]).groupBy("directory").agg(
        F.min(F.struct("path", "licence", "similarity")).alias("d")
    )
    paths = files.where(placed).select(_parent(F.col("path")).alias("directory"))
    places = paths.distinct().select(
        "directory", F.posexplode(_ancestors(F.col("directory"))).alias("up", "above")
    )
    nearest = (
        places.join(first.withColumnRenamed("directory", "above"), "above")
        .groupBy("directory").agg(F.min(F.struct("up", "d")).alias("near"))
        .select("directory", "near.d")
    )
    rows = (
        rows.select(*keep, "given", "path", F.when(placed, _parent(F.col("path"))).alias("directory"))
        .join(own.select("path", "licence", "similarity"), "path", "left")
        .join(nearest, "directory", "left")
    )
    stated, inherits = F.col("licence").isNotNull(), F.col("d").isNotNull()
    return rows.select(
        *keep, F.col("given").alias("path"), F.coalesce("licence", "d.licence").alias("licence"),
        F.coalesce("similarity", "d.similarity").alias("similarity"),
        F.when(stated, "header").when(inherits, "directory").otherwise("none").alias("origin"),
        F.when(stated, F.col("given")).otherwise(F.col("d.path")).alias("from_path"),
    )
