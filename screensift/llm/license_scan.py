"""License scan: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory (operator 1).

Every run of consecutive lines (blank ones left out) of up to the longest template's words, single lines among
them (a header notice, wrapped or not), and the whole text (a licence file) of a file is
a sparse TF-IDF vector, compared with one vector per template by cosine.
Document frequencies of the templates' words are counted over all files; a
word outside the templates only lengthens a vector, with the weight of the rarest word. Files
without a licence of their own inherit from the nearest directory above them
that holds a licence file: the distinct directories are joined with their ancestors'
paths, and the deepest one that declares a licence wins. The directory '' of a relative path
without a slash is the root above all relative paths.

SPDX-License-Identifier lines are read as such, not by cosine. Reserved rights are a class
of their own: a file that reserves them inherits nothing, and a directory passes them on only
where it declares no licence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screensift.llm.frames import chunks, materialise, text_of

#: The class of reserved rights: not an open licence.
RESERVED = "All-Rights-Reserved"

# Licence notices, as usually written at the head of a file (the first line)
# and in a licence file's opening paragraph; short licences and the GNU notices also in full.
_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
             "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS {}BE LIABLE FOR ANY CLAIM, DAMAGES OR "
             "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
             "OTHER DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. {}"
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software "
        "Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for more "
        "details. You should have received a copy of the {0} along with this program. If not, see <https://www.gnu.org/licenses/>.")
TEMPLATES = {
    RESERVED: ["All rights reserved.", "Copyright (c). All rights reserved.", "Proprietary and confidential. All rights reserved."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.",
                 "GNU Affero General Public License Version 3, 19 November 2007",
                 _GNU.format("GNU Affero General Public License", 3)],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
                   "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
                   "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
                   "limitations under the License."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
                     _BSD.format("")],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met",
                     _BSD.format("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                                 "promote products derived from this software without specific prior written permission. ")],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "GNU General Public License Version 2, June 1991",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
                _GNU.format("GNU General Public License", 2)],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
                "GNU General Public License Version 3, 29 June 2007",
                _GNU.format("GNU General Public License", 3)],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
            "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
            "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
            "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.",
                 "GNU Lesser General Public License Version 3, 29 June 2007",
                 _GNU.format("GNU Lesser General Public License", 3)],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
            "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software. " + _WARRANTY.format("OR COPYRIGHT HOLDERS ")],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Mozilla Public License Version 2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
                  "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
                  "any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
                  "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of "
                  "our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights "
                  "to this software under copyright law. " + _WARRANTY.format("") + " For more information, please refer to <https://unlicense.org>"],
}
#: Least cosine of a line or text; share of a file's words in notices from which on it is a licence file whatever its name.
MIN_COSINE, LICENCE_FILE_SHARE = 0.8, 0.6
#: A file of such a name with a notice of its own is a licence file, whatever the share (the long licences name themselves once).
LICENCE_NAME = r"(?i)(^|/)(un)?licen[cs]e([._-][^/]*)?$|(^|/)copying([._-][^/]*)?$"
#: Compared runs of one text that are remembered.
RUN_MEMORY = 1 << 14
#: Runs of so many first lines are compared at a time.
RUN_BLOCK = 4096
#: A directory with more than one part in so many of all files is hot.
HOT_PARTS = 1000

#: A copyright line that reserves all rights, whoever holds them.
_RESERVING = re.compile(r"(?:copyright|\(c\)|\u00a9)[^\n]*\ball rights reserved\b", re.I)
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([\w.+() \t-]+)", re.I)

_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def spdx_of(line: str) -> str | None:
    """The licence an SPDX line names: a template's name for its identifiers, else the expression as written."""
    got = _SPDX.search(line)
    expression = " ".join(got[1].split()) if got else ""
    while expression.count("(") < expression.count(")") and expression.endswith(")"):  # of the comment around it
        expression = expression[:-1].rstrip()
    # a comment may close behind the expression, other words do not belong to it
    words = re.match(r"\(*[\w.+-]*\w[\w.+]*\)*(?: (?:AND|OR|WITH) \(*[\w.+-]*\w[\w.+]*\)*)*", expression, re.I)
    if words is None or words[0].upper() == "NOASSERTION":
        return None
    if words[0].upper() == "NONE":
        return RESERVED
    if " " in words[0]:
        return words[0]
    plain = re.sub(r"(?:-only|-or-later|\+)$", "", words[0].strip("()"), flags=re.I)
    return {name.lower(): name for name in TEMPLATES}.get(plain.lower(), words[0].strip("()"))


def is_open(licence: str) -> bool:
    """Neither reserved rights nor somebody's own terms."""
    return licence != RESERVED and not licence.lower().startswith("licenseref-")


class Matcher:
    """Template vectors under given document frequencies."""

    def __init__(self, n_docs: int, df: dict[bytes, int], templates: dict[str, list[str]], min_cosine: float):
        texts = [(name, words_of(t)) for name in sorted(templates) for t in templates[name]]
        self.names = [name for name, _ in texts]
        vocabulary = sorted({w for _, words in texts for w in words})
        self.number = {w: i for i, w in enumerate(vocabulary)}
        self.idf = [math.log((1 + n_docs) / (1 + df.get(w, 0))) + 1 for w in vocabulary]
        self.rare = math.log(1 + n_docs) + 1
        self.min_cosine = min_cosine
        self.templates = np.zeros((len(texts), len(vocabulary)))
        for i, (_, words) in enumerate(texts):
            for w, n in Counter(words).items():
                self.templates[i, self.number[w]] = n * self.idf[self.number[w]]
        self.templates /= np.linalg.norm(self.templates, axis=1, keepdims=True)
        self.sizes = [len(words) for _, words in texts]

    def best(self, words: list[bytes]) -> tuple[float, int]:
        """Largest cosine and its template (the first by name, then order); (0, -1) below the least cosine."""
        number, idf = self.number, self.idf
        known = [i for w in words if (i := number.get(w)) is not None]
        outside = len(words) - len(known)
        if not known:
            return 0.0, -1
        counts = Counter(known)
        inside = sum((n * idf[i]) ** 2 for i, n in counts.items())
        # even with every outside word distinct (the least they can add), can this text reach the cosine?
        if inside < (self.min_cosine ** 2 - 1e-9) * (inside + outside * self.rare ** 2):
            return 0.0, -1
        other = Counter(w for w in words if w not in number)
        norm = math.sqrt(inside + sum((n * self.rare) ** 2 for n in other.values()))
        at = np.fromiter(counts, np.int64)
        weight = np.array([n * idf[i] for i, n in counts.items()]) / norm
        scores = np.round(self.templates[:, at] @ weight, 12)
        i = int(scores.argmax())
        return (float(scores[i]), i) if scores[i] >= self.min_cosine else (0.0, -1)

    def runs(self, lines: list[list[bytes]]) -> Iterator[tuple[int, int, float, int]]:
        """(start, end, cosine, template) of the runs of two or more lines, up to the longest template's words, that reach the cosine.

        The product of a run with a template is the sum of its lines' products, and its squared norm is at least
        the sum of theirs; only runs whose bound reaches the cosine are compared. A run that starts or ends in a line
        without template words is worse than the one without that line, so it is left out.
        """
        longest = max(self.sizes, default=0)
        known = [Counter(i for w in words if (i := self.number.get(w)) is not None) for words in lines]
        # equal runs (a notice repeated many times) are compared once
        numbers: dict[tuple, int] = {}
        same = [numbers.setdefault(tuple(words), len(numbers)) for words in lines]
        compared: dict[tuple, tuple[float, int]] = {}
        for first in range(0, len(lines), RUN_BLOCK):
            stop = min(first + RUN_BLOCK, len(lines))
            last, room = stop, longest  # the lines that a run from this block can reach
            while last < len(lines) and (room := room - len(lines[last])) > 0:
                last += 1
            size = last - first
            dots, norms = np.zeros((size + 1, len(self.names))), np.zeros(size + 1)
            words = np.cumsum([0, *(len(x) for x in lines[first:last])])
            any_known = np.array([bool(known[first + k]) for k in range(size)], bool)
            for k in range(size):
                counts = known[first + k]
                if counts:
                    at = np.fromiter(counts, np.int64)
                    weight = np.array([n * self.idf[i] for i, n in counts.items()])
                    dots[k + 1] = self.templates[:, at] @ weight
                    norms[k + 1] = weight @ weight
                norms[k + 1] += (len(lines[first + k]) - sum(counts.values())) * self.rare ** 2
            if not any_known.any():
                continue
            dots, norms = np.cumsum(dots, 0), np.cumsum(norms)
            starts = np.nonzero(any_known[:stop - first])[0]
            for n in range(2, size + 1):
                starts = starts[starts + n <= size]
                starts = starts[words[starts + n] - words[starts] <= longest]  # longer runs from there hold more words
                if not len(starts):
                    break
                here = starts[any_known[starts + n - 1]]
                bound = (dots[here + n] - dots[here]).max(1)
                for k in here[bound >= (self.min_cosine - 1e-6) * np.sqrt(norms[here + n] - norms[here])]:
                    run = tuple(same[first + k:first + k + n])
                    if run not in compared:
                        if len(compared) >= RUN_MEMORY:
                            compared.clear()
                        compared[run] = self.best([w for line in lines[first + k:first + k + n] for w in line])
                    cosine, i = compared[run]
                    if i >= 0:
                        yield int(first + k), int(first + k + n), cosine, i

    def scan(self, text: str) -> tuple[str | None, float, float]:
        """(licence, cosine, share of words in notices) of a file: the best of its runs of lines and its whole text.

        Of runs that share lines the best one is a notice; one inside a run that reaches the cosine to a longer
        template is a part of that notice. An SPDX line, or a copyright line that reserves all rights, has cosine 1;
        open licences go before reserved rights.
        """
        everything, got = [], []
        for line in text.split("\n"):
            words = words_of(line)
            if not words:
                continue
            n = len(everything)
            everything.append(words)
            low = line.lower()
            said = spdx_of(line) if "spdx" in low else None
            cosine, i = self.best(words) if said is None else (1.0, -1)
            if i >= 0:
                said = self.names[i]
            elif said is None and "rights reserved" in low and _RESERVING.search(line):
                cosine, said = 1.0, RESERVED
            if said is not None:
                got.append((n, n + 1, cosine, i, said))
        total, n = sum(map(len, everything)), len(everything)
        got += [(*run, self.names[run[3]]) for run in self.runs(everything)]
        if n > 1 and total > max(self.sizes, default=0):
            cosine, i = self.best([w for line in everything for w in line])
            if i >= 0:
                got.append((0, n, cosine, i, self.names[i]))
        # a run inside one of a longer template is left out
        reach, parts = np.full(n, -1), set()
        for size in sorted({self.sizes[g[3]] for g in got if g[3] >= 0}, reverse=True):
            mine = [g for g in got if g[3] >= 0 and self.sizes[g[3]] == size]
            furthest = np.maximum.accumulate(reach)
            parts.update(g[:2] for g in mine if furthest[g[0]] >= g[1])
            for g in mine:
                reach[g[0]] = max(reach[g[0]], g[1])
        whole = [g for g in got if g[:2] not in parts]
        found, taken = [], set()
        for g in sorted(whole, key=lambda g: (-g[2], g[3], g[0], g[1])):
            if taken.isdisjoint(range(g[0], g[1])):
                taken.update(range(g[0], g[1]))
                found.append(g)
        if not found:
            return None, 0.0, 0.0
        _, _, cosine, _, licence = max(found, key=lambda g: (is_open(g[4]), g[2], -g[3]))
        return licence, cosine, sum(len(everything[k]) for k in taken) / total


def document_frequencies(files: DataFrame, vocabulary: list[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of files, and in how many each vocabulary word occurs: (text) rows, all of them."""
    words = set(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, Counter()
        for b in chunks(batches, "text"):
            n += b.num_rows
            for text in b.column("text").to_pylist():
                seen.update(words.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array([b"", *seen], pa.binary()), pa.array([n, *seen.values()], pa.int64())], ["word", "n"])

    rows = files.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {bytes(r.word): r.n for r in rows}  # the templates' words only
    return counts.pop(b"", 0), counts


def _inherited(own: DataFrame, orphan: Column, reach: DataFrame) -> DataFrame:
    """``own`` plus above and declared of each orphan's directory, from ``reach`` (directory, files, above, declared).

    A directory with more than 1 / ``HOT_PARTS`` of all files is hot. There are fewer than
    ``HOT_PARTS`` of these, so they are broadcast; files of the others meet theirs by a shuffle.
    """
    total = own.count()
    known = materialise(reach, "licence-directories")
    is_hot = F.col("files") * HOT_PARTS > total
    hot = known.where(is_hot).select("directory", F.col("above").alias("hot_above"), F.col("declared").alias("hot_declared"), F.lit(True).alias("hot"))
    marked = own.join(F.broadcast(hot), "directory", "left")
    meets = orphan & F.col("hot").isNull()
    columns = [F.col(c) for c in own.columns]
    settled = marked.where(~meets).select(*columns, *[F.when(orphan, F.col(f"hot_{c}")).alias(c) for c in ("above", "declared")])
    cold = known.where(~is_hot & F.col("above").isNotNull()).select("directory", "above", "declared")
    return settled.unionByName(marked.where(meets).select(*columns).join(cold, "directory", "left"))


def scan_licenses(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
                  templates: dict[str, list[str]] | None = None, min_cosine: float = MIN_COSINE,
                  licence_file_share: float = LICENCE_FILE_SHARE) -> DataFrame:
    """(id, path, licence, cosine, origin, directory), one row per input row.

    ``origin``: 'file' (its own notices, or its name and one notice, make it a licence file), 'header' (its own, a notice
    in a larger text), 'inherited' (from ``directory``, the nearest above it with a licence
    file) or 'none'. A directory with several licence files takes those with such a name first, then an open licence
    before reserved rights, then the one with the largest cosine, then the first by licence name. NULL texts are empty; a NULL path lies in no
    directory; a relative path lies below the directory ''; repeated rows are scanned each; an empty table gives an empty result.
    """
    templates = TEMPLATES if templates is None else templates
    spark = files.sparkSession
    rows = files.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{path_col}`").alias("path"), text_of(f"`{text_col}`").alias("text"))
    vocabulary = sorted({w for texts in templates.values() for t in texts for w in words_of(t)})
    matcher = spark.sparkContext.broadcast(Matcher(*document_frequencies(rows, vocabulary), templates, min_cosine))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            got = [matcher.value.scan(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("path"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.float64())], ["id", "path", "licence", "cosine", "share"])

    kind = files.schema[id_col].dataType.simpleString()
    own = rows.mapInArrow(scan, f"id {kind}, path string, licence string, cosine double, share double")
    # the directory of a file keeps its closing slash, so 'a/' is above 'a/b/' and not above 'ab/'
    own = materialise(own.withColumn("directory", F.regexp_extract("path", "^(.*/)[^/]*$", 1)), "licences")
    unnamed = ~F.coalesce(F.col("path").rlike(LICENCE_NAME), F.lit(False))
    is_file = F.col("licence").isNotNull() & ((F.col("share") >= licence_file_share) | ~unnamed)
    closed = (F.col("licence") == RESERVED) | F.lower("licence").startswith("licenseref-")
    declared = own.where(is_file & F.col("directory").isNotNull()).groupBy("directory").agg(
        F.min(F.struct(unnamed.alias("unnamed"), closed.alias("closed"), (-F.col("cosine")).alias("low"), F.col("licence").alias("licence"))).alias("best")).select(
        F.col("directory").alias("above"), F.col("best.licence").alias("declared"))
    orphan = F.col("licence").isNull() & F.col("directory").isNotNull()
    places = own.where(orphan).groupBy("directory").agg(F.count("*").alias("files"))
    steps = F.split(F.expr("substring(directory, 1, length(directory) - 1)"), "/", -1)
    ancestors = places.where("directory <> ''").withColumn("above", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda n: F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/")))))
    nearest = ancestors.join(declared, "above").groupBy("directory").agg(
        F.max(F.struct(F.length("above").alias("depth"), "above", "declared")).alias("near")).select(
        "directory", F.col("near.above").alias("above"), F.col("near.declared").alias("declared"))
    # the root of the relative paths is above them all: one row, broadcast, so its directories gather nowhere
    root = declared.where("above = ''").select(F.col("above").alias("root"), F.col("declared").alias("root_declared"))
    relative = F.when(F.col("above").isNull() & ~F.col("directory").startswith("/"), F.lit(""))
    reach = places.join(nearest, "directory", "left").withColumn("root", relative).join(F.broadcast(root), "root", "left").select(
        "directory", "files", F.coalesce("above", F.when(F.col("root_declared").isNotNull(), F.lit(""))).alias("above"),
        F.coalesce("declared", "root_declared").alias("declared"))
    out = _inherited(own, orphan, reach)
    origin = F.when(is_file, "file").when(F.col("licence").isNotNull(), "header").when(
        F.col("declared").isNotNull(), "inherited").otherwise("none")
    return out.select(F.col("id").alias(id_col), F.col("path").alias(path_col), F.coalesce("licence", "declared").alias("licence"),
                      F.round("cosine", 6).alias("cosine"), origin.alias("origin"),
                      F.when(F.col("licence").isNull(), F.col("above")).otherwise(F.col("directory")).alias("directory"))
