"""Operator 1: licence scan by Dice coefficient over word bigrams. DataFrame functions only.

The text is normalised (lower case, everything but letters a-z, digits and line
feeds becomes one space). Its units are its lines, its paragraphs (parted by
blank lines) and the whole of it, each once; a template of m bigrams is also
compared with every window of m bigrams of the whole text, so that a notice
within a line or paragraph is found, wrapped or not. A unit of n bigrams can
reach Dice t with a template of m bigrams only if ``2 * min(n, m) >= t * (n + m)``.
Dice counts bigrams with their repetitions. Of a match, the variant words
(licence names, sa, nc, lesser, ...) and versions must be the template's.

A match lacks fewer of a template's bigrams than it has ``anchors``, so a text
without any anchor has no match; one regular expression tells, and most texts
cost no more. Windows are compared where they hold an anchor. All of it is one
projection over the row: no shuffle, no join; the templates are a literal of a
fixed, small size.

Edge cases: a null text counts as empty and has no units; rows are judged one
by one, so repeated rows and null doc_ids change nothing; of equal scores the
licence that sorts first wins; an empty table gives no rows; other columns are
ignored. A text of any length is judged whole, in the memory of its own row.
A window has exactly a template's number of bigrams: a notice with a word put in
is found on a line or paragraph of its own, within a sentence only if it still
reaches the least coefficient at that length.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow
from .quality_rules import let

#: Least Dice coefficient, in hundredths.
LEAST = 80

# Notices by which works declare a licence, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


_GNU = ("This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software "
        "Foundation{0} either version {2} of the License, or (at your option) any later version.")
_WORK = "This work is licensed under a Creative Commons {} International License."
_CC = "Creative Commons {} International Public License. By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms"
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, "
        "OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_NEITHER = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
            "software without specific prior written permission. ")

# Full texts of the short licences, and of the long ones their heading and opening; families that TEMPLATES lacks.
MORE = {
    "MIT": [
        "Licensed under the MIT License.", "Distributed under the MIT License.",
        TEMPLATES["MIT"][2] + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Released under the ISC License.", "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License.", _BSD.format(""),
        "in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED",
    ],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License.", _BSD.format(_NEITHER)],
    "Apache-2.0": [
        "Released under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.", _GNU.format(";", "General Public License", "2"),
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    ],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.", _GNU.format(";", "Lesser General Public License", "2.1"),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.", _GNU.format(":", "Lesser General Public License", "3"),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.", _GNU.format(":", "Affero General Public License", "3"),
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    ],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",
    ],
    "CC-BY-4.0": [_CC.format("Attribution 4.0")],
    "CC-BY-SA-4.0": [_CC.format("Attribution-ShareAlike 4.0")],
    "CC-BY-NC-4.0": [_CC.format("Attribution-NonCommercial 4.0")],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", _WORK.format("Attribution-NoDerivatives 4.0"), _CC.format("Attribution-NoDerivatives 4.0")],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", _WORK.format("Attribution-NonCommercial-ShareAlike 4.0"), _CC.format("Attribution-NonCommercial-ShareAlike 4.0")],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", _WORK.format("Attribution-NonCommercial-NoDerivatives 4.0"), _CC.format("Attribution-NonCommercial-NoDerivatives 4.0")],
    "CC0-1.0": ["Creative Commons CC0 1.0 Universal"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
}

#: Words that tell one licence from another, and where a version stands (a final .0 does not count).
VARIANTS = ["mit", "isc", "bsd", "apache", "mozilla", "gnu", "gpl", "lgpl", "agpl", "lesser", "library", "affero", "cc", "cc0", "sa", "nc", "nd",
            "sharealike", "noncommercial", "noderivatives", "noderivs", "zlib", "boost", "artistic", "eclipse"]
VERSION = r"\b(?:version|v|license|licence|by|sa|nc|nd|attribution|sharealike|noncommercial|noderivatives|gpl|lgpl|agpl|mpl|apache|bsd|cc0) (\d+(?: [1-9]\b)?)"


def template_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def all_templates() -> dict[str, list[str]]:
    return {name: TEMPLATES.get(name, []) + MORE.get(name, []) for name in {*TEMPLATES, *MORE}}


def template_marks(words: list[str]) -> list[str]:
    return sorted({w for w in words if w in VARIANTS} | set(re.findall(VERSION, " ".join(words))))


def marks(words: Column) -> Column:
    """The variant words and versions among ``words``, sorted."""
    return F.array_sort(F.array_union(F.filter(words, lambda w: w.isin(VARIANTS)), F.regexp_extract_all(F.array_join(words, " "), F.lit(VERSION), F.lit(1))))


def anchors(bigrams: list[str], least: int) -> list[str]:
    """Bigrams of which every unit or window at ``least`` hundredths holds one:
    together they stand in the template more often than such a match may lack."""
    m = len(bigrams)
    n = -(-least * m // (200 - least))  # bigrams of the shortest unit within the bound
    spare = m - max(1, -(-least * (n + m) // 200))
    out, held = [], 0
    for g in sorted(set(bigrams), key=lambda g: (not set(g.split()) & set(VARIANTS), -len(g), g)):
        if held <= spare:
            out.append(g)
            held += bigrams.count(g)
    return out


def units(text: Column) -> Column:
    clean = F.regexp_replace(F.lower(text), "[^a-z0-9\n]+", " ")

    def parts(t):
        paragraphs = F.transform(F.split(t, r"\n(?: *\n)+"), lambda p: F.translate(p, "\n", " "))
        every = F.concat(F.split(t, "\n"), paragraphs, F.array(F.translate(t, "\n", " ")))
        return F.array_distinct(F.filter(F.transform(every, lambda u: F.trim(F.regexp_replace(u, " +", " "))), lambda u: u != ""))

    return let(clean, parts)


def shared(a: Column, b: Column) -> Column:
    """Size of the intersection of two bigram lists, repetitions counted."""
    times = lambda x, in_: F.size(F.filter(in_, lambda y: y == x))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    slow = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(x, a), times(x, b)))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(slow)


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, least: int = LEAST,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_units, n_candidates (pairs of a unit and a
    template within the size bound), and of the best match of a unit or window at or
    above ``least`` hundredths its license, shared (bigrams) and total (bigrams of
    both), else null. The default is to look for TEMPLATES and MORE."""
    names = templates or all_templates()
    rows = [(name, len(w) - 1, [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)], template_marks(w))
            for name in sorted(names) for w in map(template_words, names[name]) if len(w) > 1]
    rows = [(*r, anchors(r[2], least)) for r in rows]
    strings = lambda x: F.array(*map(F.lit, x)).cast("array<string>")
    known = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(m).alias("m"), strings(b).alias("bigrams"), strings(own).alias("marks"), strings(some).alias("anchors"))
                      for name, m, b, own, some in rows])
    every = sorted({g for r in rows for g in r[4]})
    anchored = " (?:" + "|".join(f"{c}(?:{'|'.join(g[1:] for g in every if g[0] == c)})" for c in sorted({g[0] for g in every})) + ") "
    longest = max(m for _, m, *_ in rows) * (200 - least) // least  # of a unit within any template's bound
    counted = F.array(*[F.lit(sum(min(n, m) * 200 >= (n + m) * least for _, m, *_ in rows)) for n in range(longest + 1)])
    bounded = lambda n, m: F.least(n, m) * 200 >= (n + m) * least
    kind = "struct<shared:int,total:int,name:string>"
    none = F.array().cast(f"array<{kind}>")

    def bigrams(words):
        n = F.greatest(F.size(words) - 1, F.lit(0))
        return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))

    def scored(words, grams, t):
        """The match in a list of its own, or an empty list."""
        total = F.size(grams) + t["m"]

        def judged(n):
            return F.when((n * 200 >= total * least) & (marks(words) == t["marks"]),
                          F.array(F.struct(n.alias("shared"), total.alias("total"), t["name"].alias("name")))).otherwise(none)

        return let(shared(grams, t["bigrams"]), judged)

    def in_unit(unit):
        def of_words(words):
            n = F.size(words) - 1
            near = F.filter(known, lambda t: bounded(n, t["m"]))
            return F.when(n < 1, none).otherwise(let(bigrams(words), lambda grams: F.flatten(F.transform(near, lambda t: scored(words, grams, t)))))

        return let(F.split(unit, " "), of_words)

    def in_windows(words, grams):
        n = F.size(grams)

        def of_template(t):
            hits = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(t["anchors"], g), i)), lambda i: i.isNotNull())
            starts = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.sequence(F.greatest(i - t["m"] + 1, F.lit(0)), F.least(i, n - t["m"])))))
            return F.flatten(F.transform(starts, lambda i: scored(F.slice(words, i + 1, t["m"] + 1), F.slice(grams, i + 1, t["m"]), t)))

        some = F.array_intersect(grams, strings(every))
        return let(some, lambda own: F.flatten(F.transform(F.filter(known, lambda t: (t["m"] <= n) & F.arrays_overlap(t["anchors"], own)), of_template)))

    def better(best, x):
        # fractions compared crosswise; of equal ones the name that sorts first
        left, right = x["shared"].cast("long") * best["total"], best["shared"].cast("long") * x["total"]
        wins = best["name"].isNull() | (left > right) | ((left == right) & (
            (x["name"] < best["name"]) | ((x["name"] == best["name"]) & (x["total"] > best["total"]))))
        return F.when(wins, x).otherwise(best)

    df = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", units(F.coalesce(F.col("text"), F.lit(""))).alias("units"))
    pairs = F.aggregate("units", F.lit(0).cast("long"), lambda k, u: k + F.coalesce(F.get(counted, F.size(F.split(u, " ")) - 1), F.lit(0)))
    whole = F.coalesce(F.try_element_at("units", F.lit(-1)), F.lit(""))  # the last unit
    found = F.concat(F.flatten(F.transform("units", in_unit)), let(F.split(whole, " "), lambda words: let(bigrams(words), lambda grams: in_windows(words, grams))))
    best = F.when(F.concat(F.lit(" "), whole, F.lit(" ")).rlike(anchored), F.aggregate(found, F.lit(None).cast(kind), better))
    df = df.select("doc_id", F.size("units").cast("long").alias("n_units"), pairs.alias("n_candidates"), best.alias("best"))
    return df.select("doc_id", "n_units", "n_candidates", F.col("best.name").alias("license"),
                     F.col("best.shared").cast("long").alias("shared"), F.col("best.total").cast("long").alias("total"))
