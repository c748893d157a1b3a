"""Licence notices in documents, by likeness to templates.

A text is normalised (lower case, runs of anything but a-z and 0-9 as one
space), and runs of its words of any length are compared with licence templates
by the Dice coefficient of their sets of word pairs:
2 * common / (pairs of one + pairs of the other). A notice is found wherever it
stands: on lines of its own, over several of them, or inside a longer sentence.

Two sets can reach `least` only if the smaller has at least least / (2 - least)
of the larger's pairs, so runs are as long as the template's range of sizes
allows and no longer. A run does best when it begins and ends with a pair of
the template: others need not be looked at. And where the whole text shares too
few pairs with a template, none of its runs is; most texts end there.

Everything is column expressions inside one row: nothing is exploded, moved or
broadcast but the templates, which are literals.

Defined cases: a null or empty text, and one of fewer than two words, has no
pairs and matches nothing; repeated rows are judged alike; of equally good
templates all are named; very long texts are compared whole, in the memory of
one row; rows without doc_id are judged like any other; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from .native import let

LEAST = 0.8
#: Pairs of a run, repeats included, as a multiple of the template's.
LONGEST = 3

#: Licence notices by name. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def template_pairs(text: str) -> list[str]:
    """Distinct word pairs of a normalised template."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_range(n: int, least: float) -> tuple[float, float]:
    """Sizes of sets that can reach `least` with a set of n."""
    return n * least / (2 - least), n * (2 - least) / least


def _pairs(text: Column) -> Column:
    """A text's word pairs in order, repeats included."""
    spaced = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    return let(F.split(spaced, " "), lambda w: F.when(F.size(w) > 1, F.transform(
        F.slice(w, 1, F.size(w) - 1), lambda word, i: F.concat(word, F.lit(" "), F.get(w, i + 1)))).otherwise(
            F.array().cast("array<string>")))


def _best_run(pairs: Column, mine: list[str], least: float) -> Column:
    """The best coefficient of any run of pairs with a template's pairs `mine`."""
    template, n = F.array(*map(F.lit, mine)), len(mine)
    most = int(size_range(n, least)[1] + 1e-9)
    hits = F.filter(F.transform(pairs, lambda p, i: F.when(F.array_contains(template, p), i)), lambda i: i.isNotNull())

    def from_hit(at):
        # Runs may repeat pairs, so their length isn't bound by the range; but
        # only that of their distinct pairs. A run that has grown past it stays so.
        def longer(i, k):
            ends = F.filter(F.slice(at, k + 1, F.size(at)), lambda j: j < i + LONGEST * n)
            return F.array_max(F.transform(ends, lambda j: let(
                F.array_distinct(F.slice(pairs, (i + 1).cast("int"), (j - i + 1).cast("int"))), lambda run: F.when(
                    F.size(run) <= most, 2.0 * F.size(F.array_intersect(run, template)) / (F.size(run) + n)).otherwise(0.0))))

        return F.coalesce(F.array_max(F.transform(at, longer)), F.lit(0.0))

    return let(hits, from_hit)


def matches(text: Column, least: float = LEAST, templates: dict[str, str] | None = None) -> Column:
    """An array of (licence, dice) structs: each template that a run of the
    text's words reaches, with its best coefficient, by name."""
    known = {k: template_pairs(v) for k, v in sorted((templates or TEMPLATES).items())}
    fewest = min(size_range(len(v), least)[0] for v in known.values())
    every = sorted({p for v in known.values() for p in v})
    text = F.coalesce(text, F.lit(""))

    def of(pairs):
        def match(name, mine, seen):
            # What a run needs to have in common with the template.
            needs = least * (size_range(len(mine), least)[0] + len(mine)) / 2 - 1e-9
            enough = F.size(F.array_intersect(seen, F.array(*map(F.lit, mine)))) >= needs
            return F.struct(F.lit(name).alias("licence"), F.when(enough, _best_run(pairs, mine, least)).otherwise(0.0).alias("dice"))

        return let(F.array_intersect(pairs, F.array(*map(F.lit, every))), lambda seen: F.filter(
            F.array(*(match(k, v, seen) for k, v in known.items())), lambda m: m["dice"] >= least))

    none = F.array().cast("array<struct<licence:string,dice:double>>")
    return F.when(F.length(text) >= 2 * fewest, let(_pairs(text), of)).otherwise(none)


def licence_report(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, n_licences, licences (names in order, joined by commas) and dice
    (the best coefficient; 0 without a match)."""
    rows = docs.select("doc_id", matches(F.col("text"), least).alias("found"))
    return rows.select(
        "doc_id", F.size("found").cast("bigint").alias("n_licences"),
        F.array_join("found.licence", ",").alias("licences"),
        F.coalesce(F.array_max("found.dice"), F.lit(0.0)).alias("dice"))
