import re

import pytest
from pyspark.sql import functions as F

from quire.llm import licences as li

from .plain import odd_rows


def plain(text, least=li.LEAST):
    """Every run of word pairs against every template."""
    words = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    best = {}
    for name, mine in ((k, set(li.template_pairs(v))) for k, v in li.TEMPLATES.items()):
        for i in range(len(pairs)):
            run = set()
            for j in range(i, min(len(pairs), i + li.LONGEST * len(mine))):
                run.add(pairs[j])
                dice = 2 * len(run & mine) / (len(run) + len(mine))
                if dice >= least:
                    best[name] = max(best.get(name, 0), dice)
    return sorted(best.items())


TEXTS = [
    "Some prose.\nReleased under the MIT License.\nMore prose.",
    "released   UNDER the mit license",
    "Released under the terms of the MIT License of old.",
    li.TEMPLATES["MIT permission"],
    "\n".join(li.TEMPLATES["Apache-2.0 header"].split(". ")),
    "Intro\n\n" + li.TEMPLATES["GPL-3.0 header"].replace(" Public", "\nPublic") + "\n \nOutro",
    "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.",
    "under the the the",
    "Copyright 2020 X. Released under the MIT License. See LICENSE.",
    "This file is licensed under CC BY 4.0. Please attribute.",
    "x = 1  # " + li.TEMPLATES["Apache-2.0 header"] + " y = 2",
    "released under the released under the mit mit license",
    "Licensed\nunder\nCC BY 4.0 or\n\nlicensed under CC BY-NC 4.0",
]


def test_matches_equal_a_plain_comparison(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    for r in df.select("doc_id", li.matches(F.col("text")).alias("m")).collect():
        assert [(m.licence, pytest.approx(m.dice)) for m in r.m] == plain(TEXTS[r.doc_id])


def test_notices_inside_longer_lines_are_found(spark):
    found = {i: [name for name, _ in plain(t)] for i, t in enumerate(TEXTS)}
    assert "MIT" in found[8] and "CC-BY-4.0" in found[9] and "Apache-2.0 header" in found[10]


def test_odd_rows(odd, empty):
    got = li.licence_report(odd).collect()
    assert len(got) == len(odd_rows()) and all(r.n_licences == 0 and r.dice == 0 for r in got)
    assert li.licence_report(empty).collect() == []


def test_sizes_out_of_range_cannot_reach_the_limit():
    for n in (4, 10, 60):
        low, high = li.size_range(n, 0.8)
        for m in range(1, 120):
            best = 2 * min(n, m) / (n + m)
            assert best < 0.8 or low <= m + 1e-9 and m <= high + 1e-9


def test_no_python_on_the_executors(odd):
    plan = li.licence_report(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
