import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kerbside.llm import licenses
from tests_llm_data import HARD, SF

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "Released under the MIT License. Released UNDER THE MIT\nLICENSE!",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0, and CC BY-NC-SA 4.0 elsewhere",
    "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
    "or (at your option) any later version",
    "SPDX-License-Identifier: BSD-3-Clause\nCopyright (c) 2019 X. All rights reserved.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "See https://www.apache.org/licenses/LICENSE-2.0.html and http://creativecommons.org/licenses/by-nd/4.0/",
    "We placed it in the public domain. Proprietary and confidential. Not for commercial use only.",
    "under the mit licenses, apache license version 20, cc by n c, 1mit",
    "ünder the mit license é under the mit license",
    "A Mozilla Public License v2.0 file, an Open Source licence",
]


PATTERNS = [re.compile(rf"(?<![^ ])(?:{rule.pattern})(?![^ ])", re.ASCII) for rule in licenses.RULES]


def plain(text):
    """All rules over all texts, and suppression by comparing all pairs."""
    words = WORD.findall((text or "").translate(UPPER))
    line = " ".join(words)
    found = []
    for order, (rule, pattern) in enumerate(zip(licenses.RULES, PATTERNS)):
        for match in pattern.finditer(line):
            start = line.count(" ", 0, match.start())
            found.append((start, start + match[0].count(" ") + 1, order, rule))

    def beaten(a, b):
        inside = b[0] <= a[0] and a[1] <= b[1]
        return inside and (b[3].priority, b[1] - b[0], -b[2]) > (a[3].priority, a[1] - a[0], -a[2])

    base = [d for d in found if d[3].base]
    standing = [a for a in found if a[3].base or not any(beaten(a, b) for b in found)]
    starts = [d[0] for d in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({d[3].label for d in base})), ",".join(sorted({d[3].label for d in standing})),
        max((d[3].weight for d in standing), default=0.0),
    )


def test_query_against_plain_work(spark, build, tmp_path):
    rows = [(i, text, "en", "a") for i, text in enumerate(TEXTS)] + [(50, " -- ".join(TEXTS), "en", "b")]
    rows += [row for row in HARD if row[1] is None or len(row[1]) < 5000]
    build(rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["op11_license_rules"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *plain(r[1])) for r in rows), key=repr)


def test_query_on_the_table(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op11_license_rules"](spark, SF).collect()}
    assert len(got) == len(documents)
    for row in documents:
        if len(row.text or "") < 3000:
            assert got[row.doc_id] == plain(row.text)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        (TEXTS[0], "apache-2"),
        (TEXTS[2], "gpl-3"),
        (TEXTS[3], "cc-by-nc,cc-by-nc-4.0,cc-by-nc-sa-4.0"),
        (TEXTS[4], "lgpl-2.1-or-later"),
        (TEXTS[5], "all-rights-reserved,bsd-3-clause,copyright"),
        (TEXTS[7], "apache-2,cc-by-nd"),
        ("the license of the day", ""),
    ],
)
def test_labels(spark, build, text, labels):
    found = licenses.scan(build([(1, text, "en", "a")]))
    assert found.select(licenses.labels_of(F.col("base"), F.col("detections"))).first()[0] == labels


def test_rules_are_gated_by_words_that_each_match_has():
    scanner = licenses.Scanner(licenses.RULES)
    for text in (*TEXTS, " ".join(TEXTS)):
        words = licenses.words_of(text.encode())
        assert sorted(scanner.matches(words, scanner.gated(words))) == sorted(scanner.matches(words, range(len(licenses.RULES))))
    assert scanner.gated(b"the people of the town went by under the bridge") == []


def test_many_detections_in_one_long_text(spark, build):
    text = "Under the MIT license. " * 20_000
    row = licenses.scan(build([(1, text, "en", "a")])).select("n_words", F.size("base"), F.size("detections")).first()
    assert tuple(row) == (80_000, 20_000, 20_000)


def test_no_rows(spark, build):
    assert licenses.scan(build([])).count() == 0
