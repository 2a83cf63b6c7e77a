import re

import pytest

from cartloom.llm import licenses
from cartloom.llm.license_rules import GATES, RULES, forms, implied
from tests.llm.test_licenses import TEXTS, brute, words_of

LOST = [("https://www.apache.org/licenses/LICENSE-2.0", "apache-2", 0.9), ("see www.apache.org/licenses/LICENSE-2.0 there", "apache-2", 0.9),
        ("released under the Expat License", "mit", 0.95), ("Expat licence", "mit", 0.8),
        ("You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "gpl", 0.95),
        ("this must not be copied by anyone without permission", "proprietary", 0.6),
        ("without restriction, including without limitation the rights to use, copy, modify, merge, publish", "mit", 0.95),
        ("under the same terms as Perl itself", "perl", 0.8),
        ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors", "zlib", 0.9)]


def brute_ungated(text):
    """Labels and score by all rules on all texts."""
    joined = " " + " ".join(words_of(text)) + " "
    found = [(m.start(), m.end(), r.priority, r.label, r.weight) for r in RULES for m in re.finditer(f"(?<= )({r.pattern})(?= )", joined)]
    kept = [m for m in found if not any(o[2] < m[2] and o[0] <= m[0] and o[1] >= m[1] for o in found)]
    return {m[3] for m in kept}, max((m[4] for m in kept), default=0.0)


def check(rows):
    for r in rows:
        labels, score = brute_ungated(r.text)
        base = brute(r.text)
        assert set(r.labels) == labels | set(base[4]), r.text
        assert r.score == (max(score, 0.8) if base[1] else score), r.text


def scanned(docs):
    return licenses.scan(docs).join(docs.select("doc_id", "text"), "doc_id").collect()


def test_texts_that_gates_lost(spark):
    texts = [*TEXTS, *[t for t, _, _ in LOST]]
    rows = scanned(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert len(rows) == len(texts)
    check(rows)
    found = {r.text: r for r in rows}
    for text, label, score in LOST:
        assert label in found[text].labels and found[text].score >= score, text


def test_given_texts_without_gates(spark):
    check(scanned(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))


@pytest.mark.parametrize("rule", sorted({(r.core, r.pattern, r.keyword) for r in RULES}))
def test_every_match_passes_the_gates(rule):
    core, pattern, keyword = rule
    assert core in pattern
    assert implied(core, [keyword]) and implied(core, GATES)


def test_forms():
    assert set(forms("a(b|c)? [sc]")) == {"a \0", "ab \0", "ac \0"}
    assert set(forms("x( y)* z.{1,9}?\\d+")) == {"x z\0", "x\0 z\0", "x z\0\0", "x\0 z\0\0"}
    assert implied("(mit|expat) licen[sc]e", ["licen"]) and not implied("(mit|expat) licen[sc]e", ["mit"])
    assert implied("may (not )?be", ["may"]) and not implied("may( not)? be", ["may be"]) and not implied("ab+c", ["abc"])
