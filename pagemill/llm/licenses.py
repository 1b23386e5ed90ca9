"""License scans: TF-IDF cosine of headers to templates, then inheritance along paths.

Every segment of a text is compared with every license notice and license text: its lines and
their sentences, the sentences of its paragraphs and windows of consecutive lines (both without
comment marks, since headers are wrapped), and the whole text. Inverse document frequencies
come from all documents. A segment can only be close enough to a template if it has one of
the template's rarest words: those are chosen so that all the others together weigh too
little for the threshold, and segments without any of them are passed over.

A document whose whole text is close to a license, or that consists mostly of license lines, is
a license file and covers its directory.
Documents without a license of their own take that of the nearest directory above them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.lineage import broadcast_if_small, cut_lineage
from pagemill.llm.rows import FILE, ROW, located, shielded, text_of

# Names and notices of the licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
)
# Headers and whole texts of licenses, as their authors publish them.
TEXTS = (
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    ),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:""",
    ),
    (
        "MIT",
        """MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
        ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version.""",
    ),
    (
        "GPL-2.0",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)
        any later version.""",
    ),
)
THRESHOLD = 0.8
# Share of a document's words in license lines from which it is a license file.
FILE_SHARE = 0.5
# Between lines, and behind the end of a sentence.
_SEGMENTS = r"[\r\n]+|(?<=[.!?])[ \t]+"
_NO_WORD = r"[^\p{L}\p{N}]+"
# Marks of comments at the start and at the end of a line.
_MARKS = r"^\s*(?:/\*+|\*+/?|//+|#+|;+|--+|%+|<!--|REM\b|\(\*|\"{3}|'{3})?\s*"
_END_MARKS = r"\s*(?:\*+/|-->|\*\)|\"{3}|'{3})?\s*$"
# Consecutive lines of a window, besides single ones.
WINDOWS = (2, 3, 4)
ALL = TEMPLATES + TEXTS


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), _NO_WORD), lambda w: w != "")


def template_words(notice: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in notice.lower()).split()


@dataclass
class Weights:
    """Inverse document frequencies, unit vectors of the notices, and the words of which a
    close line has at least one."""

    idf: dict[str, float]
    unseen: float
    vectors: list[tuple[str, dict[str, float]]]
    needed: list[str]


def weigh(n: int, frequencies: dict[str, int], templates: tuple = ALL, threshold: float = THRESHOLD) -> Weights:
    rarity = lambda df: math.log((1 + n) / (1 + df)) + 1
    vocabulary = sorted({w for _, notice in templates for w in template_words(notice)})
    idf = {w: rarity(frequencies.get(w, 0)) for w in vocabulary}
    vectors, needed = [], set()
    for name, notice in templates:
        words = template_words(notice)
        raw = {w: words.count(w) * idf[w] for w in words}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        unit = {w: x / norm for w, x in sorted(raw.items())}
        vectors.append((name, unit))
        rest = 1.0
        # The rarest words first: a common one would let every document through.
        for w in sorted(unit, key=lambda w: (-idf[w], -unit[w], w)):
            if rest < threshold * threshold * 0.999:
                break  # a segment without the words so far has a cosine below the threshold
            needed.add(w)
            rest -= unit[w] ** 2
    return Weights(idf, rarity(0), vectors, sorted(needed))


def document_frequencies(docs: DataFrame, templates: tuple = ALL) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each template word."""
    vocabulary = F.array(*(F.lit(w) for w in sorted({w for _, t in templates for w in template_words(t)})))
    held = F.array_intersect(words_of(docs["text"]), vocabulary)
    # A marker counts the documents in the same pass; the rest is one row per template word.
    words = docs.select(F.explode(F.concat(F.coalesce(held, F.array().cast("array<string>")), F.array(F.lit("")))).alias("w"))
    counts = {r["w"]: r["count"] for r in words.groupBy("w").count().collect()}
    return counts.pop("", 0), counts


def bare_lines(text: Column) -> Column:
    """Lines without the marks of comments."""
    return F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.regexp_replace(F.regexp_replace(x, _MARKS, ""), _END_MARKS, ""))


def segments(text: Column, lines: Column, full: Column) -> Column:
    """``kind, s``: lines and sentences (``line``), what stands in wrapped headers (``wrapped``), and
    the whole text (``file``).

    ``lines`` are the :func:`bare_lines`, ``full`` those that are not empty: columns of their
    own, since each window would evaluate an expression once more.
    """
    paragraphs = F.transform(F.split(F.array_join(lines, "\n"), r"\n{2,}"), lambda p: F.replace(p, F.lit("\n"), F.lit(" ")))
    sentences = F.flatten(F.transform(paragraphs, lambda p: F.split(p, r"(?<=[.!?])\s+")))

    def windows(size: int) -> Column:
        starts = F.when(F.size(full) >= size, F.sequence(F.lit(1), F.size(full) - size + 1))
        return F.coalesce(
            F.transform(starts, lambda i: F.array_join(F.slice(full, i, F.lit(size)), " ")), F.array().cast("array<string>")
        )

    def of(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("s")))

    wrapped = F.array_distinct(F.concat(sentences, paragraphs, *map(windows, WINDOWS)))
    return F.concat(of("line", F.split(text, _SEGMENTS)), of("wrapped", wrapped), of("file", F.array(text)))


def license_lines(rows: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """Locator, ``line`` (its place among the segments), ``kind, license, cosine, words`` of the
    segments that are close to a template."""
    spark = rows.sparkSession
    # Tested as sets of words: an expression of so many words would try each at every character.
    needed = F.array(*map(F.lit, weights.needed))
    text = F.lower(text_of(rows))
    held = rows.where(F.arrays_overlap(F.split(text, _NO_WORD), needed))
    cut = held.select(FILE, ROW, text.alias("_text"), bare_lines(text).alias("_lines"))
    cut = cut.withColumn("_full", F.filter("_lines", lambda x: x != ""))
    all_parts = segments(F.col("_text"), F.col("_lines"), F.col("_full"))
    parts = cut.select(FILE, ROW, F.posexplode(all_parts).alias("line", "p"))
    lines = parts.select(FILE, ROW, "line", F.col("p.kind").alias("kind"), words_of(F.col("p.s")).alias("w"))
    lines = lines.where(F.arrays_overlap("w", needed))
    line = [FILE, ROW, "line", "kind", "words"]
    terms = lines.select(FILE, ROW, "line", "kind", F.size("w").alias("words"), F.explode("w").alias("word"))
    terms = terms.groupBy(*line, "word").count()
    idf = spark.createDataFrame(sorted(weights.idf.items()), "word string, idf double")
    vectors = [(i, name, w, x) for i, (name, v) in enumerate(weights.vectors) for w, x in v.items()]
    notices = spark.createDataFrame(vectors, "notice int, license string, word string, weight double")
    # Both are as small as the templates.
    weighted = terms.join(F.broadcast(idf), "word", "left").withColumn(
        "x", F.col("count") * F.coalesce("idf", F.lit(weights.unseen))
    )
    norms = weighted.groupBy(*line).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = weighted.join(F.broadcast(notices), "word").groupBy(*line, "notice", "license").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    cosine = F.round(F.col("dot") / F.col("norm"), 9)
    best = dots.join(norms, line).withColumn("cosine", cosine).where(F.col("cosine") >= threshold)
    # Of equally close notices the one whose name sorts last.
    return best.groupBy(*line).agg(F.max(F.struct("cosine", "license")).alias("best")).select(*line, "best.cosine", "best.license")


def directory_of(path: Column) -> Column:
    """What stands before the last slash; empty for a file at the top."""
    return F.regexp_replace(path, r"(?s)/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """``depth, at`` of a directory and all above it up to the top, which is empty."""
    parts = F.split(directory, "/")
    depth = F.when(directory == "", 0).otherwise(F.size(parts))
    return F.transform(
        F.sequence(F.lit(0), depth), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), "/").alias("at"))
    )


def inherited(files: DataFrame, directories: DataFrame) -> DataFrame:
    """``directory, license`` for each directory of ``files`` at or under a licensed one.

    ``directories`` are ``at, license``, one row each. Joins run on distinct directories, so
    one that holds a third of all files counts once.
    """
    up = files.select("directory").where("directory IS NOT NULL").distinct()
    up = up.select("directory", F.explode(ancestors(F.col("directory"))).alias("a")).select("directory", "a.depth", "a.at")
    found = up.join(directories, "at").groupBy("directory").agg(F.max(F.struct("depth", "license")).alias("nearest"))
    return found.select("directory", F.col("nearest.license").alias("inherited"))


@shielded("path", "text")
def license_scan(docs: DataFrame, templates: tuple = ALL, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (with ``path`` and ``text``) and their ``license, license_from, cosine, license_words``.

    ``license`` is that of the closest segment, of equally close ones the name that sorts last;
    ``license_words`` are the words in license lines, or in the longest wrapped segment that is
    one if that has more;
    ``license_from`` is ``own`` or ``inherited``, both null without a license. Several
    license files of one directory count as the closest of them. A null text has no license
    of its own, a null path inherits none; repeated rows are judged alike; an empty table
    stays empty; columns of ``docs`` named like the added ones are replaced.
    """
    rows = located(docs)
    weights = weigh(*document_frequencies(rows, templates), templates, threshold)
    lines = cut_lineage(license_lines(rows, weights, threshold))
    own = lines.groupBy(FILE, ROW).agg(
        F.max(F.struct("cosine", "license")).alias("best"),
        F.greatest(F.sum(F.when(F.col("kind") == "line", F.col("words"))), F.max("words")).cast("bigint").alias("license_words"),
        F.max(F.col("kind") == "file").alias("whole"),
    )
    own, _ = broadcast_if_small(cut_lineage(own.select(FILE, ROW, "best.cosine", "best.license", "license_words", "whole")))
    marked = rows.join(own, [FILE, ROW], "left").withColumn("directory", directory_of(F.col("path")))
    # Only rows with a license can be license files, so only their words are counted.
    share = F.col("license_words") / F.size(words_of(text_of(marked)))
    is_file = F.col("license").isNotNull() & F.col("directory").isNotNull() & (F.col("whole") | (share >= FILE_SHARE))
    covers = marked.where(is_file).groupBy(F.col("directory").alias("at")).agg(F.max(F.struct("cosine", "license")).alias("b"))
    covers = cut_lineage(covers.select("at", "b.license"))
    above, _ = broadcast_if_small(cut_lineage(inherited(rows.select(directory_of(F.col("path")).alias("directory")), covers)))
    out = marked.join(above, "directory", "left")
    source = F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited")
    return out.select(
        *docs.columns,
        F.coalesce("license", "inherited").alias("license"),
        source.alias("license_from"),
        "cosine",
        F.coalesce("license_words", F.lit(0).cast("bigint")).alias("license_words"),
    )
