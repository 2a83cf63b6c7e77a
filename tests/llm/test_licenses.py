import re

from cartloom.llm import licenses
from cartloom.llm.license_rules import GATES, RULES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in licenses.BASE:
        own = phrase.split(" ")
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def brute_method(text):
    """Labels and score of the matches that no match of higher priority contains."""
    joined = " " + " ".join(words_of(text)) + " "
    if not any(g in joined for g in GATES):
        return set(), 0.0
    found = [(m.start(), m.end(), r.priority, r.label, r.weight) for r in RULES if r.keyword in joined
             for m in re.finditer(f"(?<= )({r.pattern})(?= )", joined)]
    kept = [m for m in found if not any(o[2] < m[2] and o[0] <= m[0] and o[1] >= m[1] for o in found)]
    return {m[3] for m in kept}, max((m[4] for m in kept), default=0.0)


TEXTS = [None, "", " \n\t", "MIT License mit license MIT-LICENSE", "under the GNU General Public License, version 3 or later", "cc by cc by-sa 4.0",
         "Apache License, Version 2.0 (the License)", "SPDX-License-Identifier: Apache-2.0", "SPDX-License-Identifier: MIT\nMIT License",
         "permit license", "mıt lıcense MİT LİCENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy",
         "Licensed under the BSD 3-Clause License. All rights reserved.", "it is released into the public domain", "é apache\x01license\x02 x",
         "x " * 3000 + "mit license " * 500 + "apache license", "Creative Commons Attribution-ShareAlike 4.0 International", "licensed under cc by nc 4.0"]


def check(rows):
    for r in rows:
        base = brute(r.text)
        assert (r.n_words, len(r.places), min(r.places, default=None), max(r.places, default=None), list(r.base)) == base, r.text
        labels, score = brute_method(r.text)
        assert set(r.labels) == labels | set(base[4]) and list(r.labels) == sorted(r.labels), r.text
        assert r.score == (max(score, 0.8) if base[1] else score)


def scanned(docs):
    found = licenses.scan(docs).alias("a")
    return [r for r in found.join(docs.select("doc_id", "text"), "doc_id").collect()]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "joined", 1.0) for i, t in enumerate(TEXTS)], "doc_id long, text string, words string, score double").repartition(4)
    check(scanned(docs))
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_given_texts_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(scanned(docs))


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (None, "cc by")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_words, len(r.places)) for r in licenses.scan(docs).collect()) == [(0, 2, 1), (1, 2, 1), (1, 2, 1)]


def test_rules_are_many_and_gated():
    assert len(RULES) >= 300
    assert all(0 < r.weight <= 1 and r.priority in licenses.LEVELS for r in RULES)


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
