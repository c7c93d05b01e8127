import random
import re

import pytest

from cellgrid.llm import license_scan as L

from plain import tokens


def plain_base(text):
    """(places of base phrases as (word, label)) by comparing every window of words."""
    w = tokens(text)
    return sorted((i, label) for phrase, label in L.BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())


def plain_terms(expression):
    """Strictest-of-and, mildest-of-or by recursive descent, for well-formed expressions without exceptions."""
    toks = re.findall(r"\(|\)|[^\s()]+", expression)

    def operand():
        t = toks.pop(0)
        if t == "(":
            v = either()
            assert toks.pop(0) == ")"
            return v
        return frozenset([L.family(t)[0]]), L.family(t)[1]

    def joined(part, word, choose):
        v = part()
        while toks and toks[0] == word:
            toks.pop(0)
            x = part()
            v = v[0] | x[0], choose(v[1], x[1])
        return v

    def both():
        return joined(operand, "AND", max)

    def either():
        return joined(both, "OR", min)

    return either()


def test_expressions_equal_recursive_descent():
    rng = random.Random(5)
    names = ["MIT", "Apache-2.0", "GPL-3.0-only", "AGPL-3.0-or-later", "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "Nobody-1.0"]

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(names)
        inner = f" {rng.choice(['AND', 'OR'])} ".join(make(depth - 1) for _ in range(rng.randint(1, 3)))
        return f"({inner})" if rng.random() < 0.6 else inner

    for _ in range(500):
        text = make(4)
        got = L.evaluate(text.encode() + b"\nAND not this line")
        assert got == (*plain_terms(text), len(text))


@pytest.mark.parametrize("text, labels, terms", [
    ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, "weak copyleft"),
    ("GPL-2.0-only WITH Some-exception", {"gpl"}, "copyleft"),
    ("MIT OR GPL-2.0-only WITH Classpath-exception-2.0 AND AGPL-3.0-only", {"mit", "gpl", "agpl"}, "permissive"),
    ("(MIT", {"invalid"}, "unknown"), ("AND MIT", {"invalid"}, "unknown"), ("MIT OR )", {"invalid"}, "unknown"),
    ("(MIT OR Apache-2.0) WITH x", {"mit", "apache"}, "permissive"), ("mit or apache-2.0 and so on", {"mit", "apache"}, "permissive"),
    ("MIT.", {"mit"}, "permissive"), ("GPL-2.0+", {"gpl"}, "copyleft"), ("(" * 3000 + "MIT" + ")" * 3000, {"mit"}, "permissive")])
def test_expression_cases(text, labels, terms):
    got = L.evaluate(text.encode())
    assert set(got[0]) == labels and L.TERMS[got[1]] == terms


def test_nothing_to_read_is_no_expression():
    assert L.evaluate(b"") is None and L.evaluate(b"; x") is None


def test_report_equals_plain_search(spark):
    rng = random.Random(3)
    vocab = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "é世", "x", "CC", "BY-NC", "License:", "\n", "MIT"]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows = {r.doc_id: r for r in L.report(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    for i, t in docs:
        found, r = plain_base(t), rows[i]
        assert (r.n_words, r.n_base) == (len(tokens(t)), len(found))
        assert (r.first_word, r.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        assert ("mit" in r.labels.split(",")) == bool(re.search(r"(?i)license *: +(\n )?mit|mit\W+license", t) and "mit" in r.labels)


def test_tags_notices_and_places(spark):
    text = "Intro.\n# SPDX-License-Identifier: (MIT OR GPL-2.0-only) \nLicense: see file. Licensed under the Apache License, Version 2.0. All rights reserved"
    docs = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, label string")
    got = {(r.kind, r.label, r.word, r.terms, r.expression) for r in L.places(docs).collect()}
    assert got == {("tag", "mit", 1, "permissive", "(MIT OR GPL-2.0-only)"), ("tag", "gpl", 1, "permissive", "(MIT OR GPL-2.0-only)"),
                   ("notice", "apache", 16, None, None), ("base", "reserved", 21, None, None)}
    r = L.report(docs).first()
    assert (r.labels, r.base_labels, r.terms, r.n_tags) == ("apache,gpl,mit,reserved", "reserved", "permissive", 1)
    assert r.score == pytest.approx(1 - 0.2 * 0.05 * 0.05 * 0.5)


def test_long_text_with_late_and_overlapping_places(spark):
    text = "cc by " * 50_000 + "word " * 200_000 + "all rights reserved"
    r = L.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_base, r.first_word, r.last_word, r.labels) == (50_001, 0, 300_000, "cc-by,reserved")


def test_odd_rows(spark, odd_docs, no_docs):
    assert L.report(no_docs).count() == 0 and L.places(no_docs).count() == 0
    rows = L.report(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.score == 0 and r.labels == "" for r in rows)
    assert {r.doc_id: r.n_words for r in rows}[6] == 30_000 and {r.doc_id: r.n_words for r in rows}[1] == 0
