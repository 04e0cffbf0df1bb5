"""Licences of files: notices in them, licence files, and inheritance down directories.

Every line of a text, and the text as a whole, is a sparse TF-IDF vector over its words;
its cosine with the templates' vectors names its licence. Weights come from document
frequencies over all files; words outside the templates count as rare ones in a length,
so that a line of other words comes near nothing. A line near a notice is a header of its
file, and so is any run of words, over lines or inside one, that is as long as a licence's
text and near it. A file that is near a licence's text as a whole, or bears a licence file's name and
holds a notice, states the licence of its directory. A file without a licence of its own
takes that of the nearest directory above it that has one, by joins over distinct
directories and their ancestors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from marketlane.llm.common import fresh_name, hashed_words, slices, stored, with_text_columns, without

# Notices by which files name their licence, by SPDX identifier.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
)

# Texts of short licences, the notices that longer ones ask for, and how those begin.
LICENCE_TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
                     "binary form must reproduce the above copyright notice. Neither the name of the copyright holder "
                     "nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License. Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an AS IS "
                   "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                   "for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version. This program is distributed in the hope that it will be "
                "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
                "A PARTICULAR PURPOSE."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                     "in binary form must reproduce the above copyright notice, this list of conditions and the "
                     "following disclaimer in the documentation and/or other materials provided with the distribution. "
                     "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR "
                     "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                     "in binary form must reproduce the above copyright notice, this list of conditions and the "
                     "following disclaimer in the documentation and/or other materials provided with the distribution. "
                     "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission. "
                     "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR "
                     "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
                "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
                "PARTICULAR PURPOSE."),
    ("LGPL-2.1", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                 "License, or (at your option) any later version. This program is distributed in the hope that it will "
                 "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
                 "FOR A PARTICULAR PURPOSE."),
    ("LGPL-3.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 3 of the "
                 "License, or (at your option) any later version. This program is distributed in the hope that it will "
                 "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
                 "FOR A PARTICULAR PURPOSE."),
    ("AGPL-3.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation; either version 3 of the "
                 "License, or (at your option) any later version. This program is distributed in the hope that it will "
                 "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
                 "FOR A PARTICULAR PURPOSE."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, "
                "Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and "
                "distribute verbatim copies of this license document, but changing it is not allowed. Preamble The "
                "licenses for most software are designed to take away your freedom to share and change it. By contrast, "
                "the GNU General Public License is intended to guarantee your freedom to share and change free software"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. "
                "https://fsf.org/ Everyone is permitted to copy and distribute verbatim copies of this license "
                "document, but changing it is not allowed. Preamble The GNU General Public License is a free, copyleft "
                "license for software and other kinds of works."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software "
                 "Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to "
                 "copy and distribute verbatim copies of this license document, but changing it is not allowed. This is "
                 "the first released version of the Lesser GPL. It also counts as the successor of the GNU Library "
                 "Public License, version 2, hence the version number 2.1."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software "
                 "Foundation, Inc. https://fsf.org/ Everyone is permitted to copy and distribute verbatim copies of "
                 "this license document, but changing it is not allowed. This version of the GNU Lesser General Public "
                 "License incorporates the terms and conditions of version 3 of the GNU General Public License, "
                 "supplemented by the additional permissions listed below."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software "
                 "Foundation, Inc. https://fsf.org/ Everyone is permitted to copy and distribute verbatim copies of "
                 "this license document, but changing it is not allowed. Preamble The GNU Affero General Public License "
                 "is a free, copyleft license for software and other kinds of works, specifically designed to ensure "
                 "cooperation with the community in the case of network server software."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR "
                   "USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. License shall mean the terms and conditions for "
                   "use, reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal "
                "entity that creates, contributes to the creation of, or owns Covered Software. 1.2. Contributor "
                "Version means the combination of the Contributions of others (if any) used by a Contributor"),
    ("CC0-1.0", "CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES. "
                "DISTRIBUTION OF THIS DOCUMENT DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP. CREATIVE COMMONS "
                "PROVIDES THIS INFORMATION ON AN AS-IS BASIS."),
)

LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
ADDED = ("license", "how", "similarity", "from_directory")


@dataclass(frozen=True)
class Templates:
    notices: tuple[tuple[str, str], ...] = NOTICES
    texts: tuple[tuple[str, str], ...] = LICENCE_TEXTS
    header: float = 0.75
    whole: float = 0.75
    words: np.ndarray = field(init=False)

    def __post_init__(self):
        texts = [t for _, t in (*self.notices, *self.texts)]
        object.__setattr__(self, "words", np.unique(hashed_words(pa.array(texts, pa.large_string()))[0]))


def _numbers(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    where = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[where] == hashes, where + 1, 0)


def _entries(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each unit: unit, hash, count."""
    unit = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((hashes, unit))
    unit, hashes = unit[order], hashes[order]
    new = np.ones(len(unit), dtype=bool)
    new[1:] = (unit[1:] != unit[:-1]) | (hashes[1:] != hashes[:-1])
    starts = np.flatnonzero(new)
    return unit[starts], hashes[starts], np.diff(np.append(starts, len(unit)))


def document_frequencies(files: DataFrame, text: str, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Files that hold each template word, and all files: a row per word and task."""
    size, source = len(vocabulary) + 1, files.select(text)

    def run(batches):
        seen = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                part = batch.column(0).slice(start, stop - start).fill_null("")
                hashes, at = hashed_words(part)
                number = _numbers(vocabulary, hashes)
                row = np.repeat(np.arange(stop - start), np.diff(at))
                pairs = np.unique(row[number > 0] * np.int64(size) + number[number > 0])
                seen += np.bincount(pairs % size, minlength=size)
                seen[0] += stop - start
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(seen)], names=["word", "n"])

    out = np.zeros(size, dtype=np.int64)
    for word, n in source.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n")).collect():
        out[word] = n
    return out[1:], int(out[0])


@dataclass(frozen=True)
class Matcher:
    """Bounded by the templates: their words, weights and vectors."""

    vocabulary: np.ndarray
    weight: np.ndarray  # number 0: a word outside the templates
    vectors: np.ndarray  # (words + 1) x templates, of unit length
    names: tuple[str, ...]

    @staticmethod
    def of(named: tuple[tuple[str, str], ...], vocabulary: np.ndarray, weight: np.ndarray) -> Matcher:
        vectors = np.zeros((len(vocabulary) + 1, len(named)))
        for i, (_, text) in enumerate(named):
            _, words, count = _entries(*hashed_words(pa.array([text], pa.large_string())))
            vectors[_numbers(vocabulary, words), i] = count * weight[_numbers(vocabulary, words)]
        vectors /= np.linalg.norm(vectors, axis=0)
        return Matcher(vocabulary, weight, vectors, tuple(n for n, _ in named))

    def best(self, hashes: np.ndarray, at: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Best template and cosine of each unit; -1 and 0 below ``least``."""
        units = len(at) - 1
        name, cosine = np.full(units, -1), np.zeros(units)
        unit, words, count = _entries(hashes, at)
        number = _numbers(self.vocabulary, words)
        value = count * self.weight[number]
        length = np.bincount(unit, weights=value * value, minlength=units)
        inner = np.bincount(unit, weights=value * value * (number > 0), minlength=units)
        # A cosine cannot exceed the share of a unit's length that template words have.
        possible = (inner > 0) & (inner >= least * least * length)
        pick = possible[unit] & (number > 0)
        if not pick.any():
            return name, cosine
        unit, products = unit[pick], value[pick, None] * self.vectors[number[pick]]
        starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        scores = np.add.reduceat(products, starts, axis=0) / np.sqrt(length[unit[starts]])[:, None]
        top = scores.argmax(axis=1)
        value = np.minimum(scores[np.arange(len(top)), top], 1.0)
        good = value >= least
        name[unit[starts][good]], cosine[unit[starts][good]] = top[good], value[good]
        return name, cosine


def blocks(wholes: Matcher, lengths: list[int], hashes: np.ndarray, at: np.ndarray, least: float):
    """Best licence text and cosine of each row's runs of words as long as a text; the first run counts.

    A run's cosine with a text is at most the root of the share of the text's squared
    length that the run's words have: few runs are compared.
    """
    rows = len(at) - 1
    name, cosine, start = np.full(rows, -1), np.zeros(rows), np.zeros(rows, dtype=np.int64)
    number = _numbers(wholes.vocabulary, hashes)
    for i, size in enumerate(lengths):
        if len(hashes) < size:
            continue
        covered = np.concatenate([[0.0], np.cumsum(wholes.vectors[:, i][number] ** 2)])
        first = np.flatnonzero(covered[size:] - covered[:-size] >= least * least - 1e-6)
        row = np.searchsorted(at, first, side="right") - 1
        inside = first + size <= at[row + 1]
        first, row = first[inside], row[inside]
        step = max(1, 200_000 // size)
        for a in range(0, len(first), step):
            some = first[a : a + step]
            runs = hashes[some[:, None] + np.arange(size)].ravel()
            found, near = wholes.best(runs, np.arange(len(some) + 1) * size, least)
            for k in np.flatnonzero(found >= 0).tolist():
                r, c = int(row[a + k]), float(near[k])
                if c > cosine[r] + 1e-12 or (c > cosine[r] - 1e-12 and some[k] < start[r]):
                    name[r], cosine[r], start[r] = found[k], c, some[k]
    return name, cosine


def with_licences(
    files: DataFrame, path: str = "path", text: str = "text", templates: Templates | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows with ``license, how, similarity, from_directory``.

    ``how`` is file (the row is a licence file), header, inherited or none. Of several
    notices the nearest counts, then the first in the text. If files of one directory
    state several licences, the nearest text wins, then the first name. A null path is in
    no directory; null and empty texts hold no notice. Columns already called like the new
    ones are replaced; all others stay unless ``keep`` names some.
    """
    templates = templates or Templates()
    files = without(files, [c for c in ADDED if c.lower() not in (path.lower(), text.lower())])
    keep = list(dict.fromkeys([*(files.columns if keep is None else keep), path]))
    vocabulary = templates.words
    seen, total = document_frequencies(files, text, vocabulary)
    weight = np.concatenate([[np.log(total + 2.0)], np.log((total + 2.0) / (seen + 1.0))])
    weight = np.maximum(weight, 0.01)
    notices = Matcher.of(templates.notices, vocabulary, weight)
    wholes = Matcher.of(templates.texts, vocabulary, weight)
    lengths = np.diff(hashed_words(pa.array([t for _, t in templates.texts], pa.large_string()))[1]).tolist()

    def compute(texts: pa.Array) -> list:
        lines = pc.split_pattern(texts, "\n")
        at = np.asarray(lines.offsets) - np.asarray(lines.offsets)[0]
        hashes, line_at = hashed_words(lines.flatten())
        name, cosine = notices.best(hashes, line_at, templates.header)
        whole, near = wholes.best(hashes, line_at[at], templates.whole)
        header, similar = [None] * len(texts), np.zeros(len(texts))
        hit = np.flatnonzero(name >= 0)
        for i in hit.tolist():
            row = int(np.searchsorted(at, i, side="right")) - 1
            if cosine[i] > similar[row] + 1e-12:
                header[row], similar[row] = notices.names[name[i]], cosine[i]
        inner, nearest = blocks(wholes, lengths, hashes, line_at[at], templates.header)
        for row in np.flatnonzero((inner >= 0) & (nearest > similar + 1e-12)).tolist():
            header[row], similar[row] = wholes.names[inner[row]], nearest[row]
        return [
            pa.array(header, pa.string()), pa.array(np.round(similar, 9)),
            pa.array([wholes.names[w] if w >= 0 else None for w in whole], pa.string()), pa.array(np.round(near, 9)),
        ]

    new = {n: fresh_name(files, n) for n in ("_header", "_near", "_whole", "_close", "_dir", "_at", "_inherited", "_ancestor")}
    fields = [
        StructField(new["_header"], StringType()), StructField(new["_near"], DoubleType()),
        StructField(new["_whole"], StringType()), StructField(new["_close"], DoubleType()),
    ]
    found = with_text_columns(files, text, compute, fields, keep)
    base = F.substring_index(F.col(path), "/", -1)
    folder = F.when(F.contains(F.col(path), F.lit("/")), F.regexp_replace(F.col(path), "/[^/]*$", "")).otherwise(F.lit(""))
    named = F.regexp_like(base, F.lit(LICENCE_FILE)) & F.col(new["_header"]).isNotNull()
    is_file = F.col(new["_whole"]).isNotNull() | F.coalesce(named, F.lit(False))
    own = F.coalesce(new["_whole"], new["_header"])
    near = F.when(F.col(new["_whole"]).isNotNull(), F.col(new["_close"])).otherwise(F.col(new["_near"]))
    found = stored(
        found.withColumn(new["_dir"], F.when(F.col(path).isNotNull(), folder))
        .withColumn("license", own).withColumn("how", F.when(is_file, "file").when(own.isNotNull(), "header"))
        .withColumn("similarity", near).drop(new["_header"], new["_near"], new["_whole"], new["_close"]),
        "licences",
    )
    nearest = stored(nearest_directories(found, new["_dir"]), "licence-directories").select(
        F.col("directory").alias(new["_at"]), F.col("license").alias(new["_inherited"]), F.col("ancestor").alias(new["_ancestor"])
    )
    out = found.join(nearest, F.col(new["_dir"]) == F.col(new["_at"]), "left")
    inherits = F.col("license").isNull() & F.col(new["_inherited"]).isNotNull()
    return out.select(
        *[f"`{c}`" for c in keep], F.coalesce("license", new["_inherited"]).alias("license"),
        F.when(inherits, "inherited").otherwise(F.coalesce("how", F.lit("none"))).alias("how"),
        "similarity", F.when(inherits, F.col(new["_ancestor"])).alias("from_directory"),
    )


def nearest_directories(found: DataFrame, directory: str) -> DataFrame:
    """``directory, ancestor, license``: the nearest stated licence at or above each directory.

    Directories are reduced to distinct ones before they meet their ancestors.
    """
    stating = found.filter((F.col("how") == "file") & F.col(directory).isNotNull())
    stated = stating.groupBy(F.col(directory).alias("ancestor")).agg(
        F.min(F.struct(-F.col("similarity"), F.col("license").alias("license"))).alias("best")
    ).select("ancestor", F.col("best.license").alias("license"))
    folders = found.select(F.col(directory).alias("directory")).filter("directory IS NOT NULL").distinct()
    steps = F.split("directory", "/")
    ancestors = F.concat(
        F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/")), F.array(F.lit(""))
    )
    pairs = folders.select("directory", F.explode(F.array_distinct(ancestors)).alias("ancestor"))
    met = pairs.join(stated, "ancestor").groupBy("directory").agg(
        F.max(F.struct(F.length("ancestor").alias("n"), "ancestor", "license")).alias("best")
    )
    return met.select("directory", "best.ancestor", "best.license")


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: a source is a repository with a directory per language."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    return docs.select("doc_id", "text", F.concat_ws("/", part("source"), part("lang"), part("doc_id")).alias("path"))


def digest(docs: DataFrame) -> DataFrame:
    """Each document's licence, how it was found, and how near the notice is."""
    found = with_licences(document_paths(docs), keep=["doc_id"])
    return found.select("doc_id", "path", "license", "how", "similarity", "from_directory")
