"""Signatures against a plain version without prefilter, the query against the base contract."""

import random
import re
import time

import pytest
from brute import license_places
from test_edges import TEXTS, documents as odd_documents

from crisis_posts.llm import licenses
from crisis_posts.llm.license_rules import RULES, Rule


def normal(text):
    return f" {b' '.join(text.encode().translate(licenses._WORD_BYTES).split()).decode('latin-1')} "


def sample(pattern, rng):
    """Some text that the pattern matches."""
    choice = re.compile(r"\(\?:([^()]*)\)(\?)?")
    while match := choice.search(pattern):
        options = match[1].split("|") + ([""] if match[2] else [])
        pattern = pattern[: match.start()] + rng.choice(options) + pattern[match.end() :]
    pattern = re.sub(r"\[0-9\]\{2\}", "17", pattern)
    pattern = re.sub(r"\[(\w)\w*\]", r"\1", pattern)
    return re.sub(r"(.)\?", lambda m: rng.choice(["", m[1]]), pattern)


def plain(words, rules):
    """Every pattern is run; each interval is compared with all others."""
    found = [(*m.span(), i) for i, rule in enumerate(rules) for m in rule.compiled().finditer(words)]

    def beats(x, y):
        if x == y or not (x[0] <= y[0] and x[1] >= y[1]):
            return False
        a, b = rules[x[2]].priority, rules[y[2]].priority
        longer = x[1] - x[0] > y[1] - y[0]
        return a < b or (a == b and (longer or x[2] < y[2]))

    return sorted(y for y in found if not any(beats(x, y) for x in found))


def test_every_signature_matches_its_samples_and_holds_its_keywords():
    rng = random.Random(1)
    assert len(RULES) > 500
    for rule in RULES:
        for _ in range(3):
            words = f" a {sample(rule.pattern, rng)} z "
            assert rule.compiled().search(words), rule
            assert rule.keywords() and all(k in words for k in rule.keywords()), rule


def test_prefilter_and_suppression_change_nothing():
    rng = random.Random(2)
    signatures = licenses.Signatures()
    for _ in range(60):
        parts = [sample(rng.choice(RULES).pattern, rng) for _ in range(rng.randint(1, 6))]
        words = " " + " ".join(x for p in parts for x in (p, *["filler"] * rng.randint(0, 2))) + " "
        assert signatures.find(words) == plain(words, RULES)


def test_suppression_on_random_intervals():
    rng = random.Random(3)
    rules = [Rule(f"l{i}", "x", rng.randrange(4), 0.5, "x") for i in range(12)]
    for _ in range(300):
        found = list({(s, s + rng.randint(1, 9), rng.randrange(12)) for s in [rng.randrange(20) for _ in range(15)]})

        def beats(x, y):
            a, b = rules[x[2]].priority, rules[y[2]].priority
            inside = x != y and x[0] <= y[0] and x[1] >= y[1]
            return inside and (a < b or (a == b and (x[1] - x[0] > y[1] - y[0] or x[2] < y[2])))

        expected = sorted(y for y in found if not any(beats(x, y) for x in found))
        assert licenses.unsuppressed(found, rules) == expected


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
        ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0+"}),
        ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
        ("see https://creativecommons.org/licenses/by-nc-sa/4.0/", {"cc-by-nc-sa-4.0"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("© 2020 Me. All rights reserved.", {"reserved"}),
        ("mit Licht und einem Apachen", set()),
        ("the general public, licensed drivers", set()),
    ],
)
def test_statements(text, labels):
    signatures = licenses.Signatures()
    assert {signatures.rules[n].label for *_, n in signatures.find(normal(text))} == labels


def test_many_statements_in_one_text_take_linear_time():
    signatures = licenses.Signatures()
    words = normal("licensed under the MIT License all rights reserved cc by " * 40_000)
    start = time.perf_counter()
    assert len(signatures.find(words)) == 120_000
    assert time.perf_counter() - start < 20


def test_odd_texts(spark):
    rows = licenses.find_licenses(odd_documents(spark)).collect()
    assert sorted(row.doc_id for row in rows) == sorted(TEXTS)
    for row in rows:
        assert (row.n_words, [(x.start, x.label) for x in row.base]) == license_places(TEXTS[row.doc_id])
        assert row.found == [] and row.score == 0.0
    assert licenses.find_licenses(odd_documents(spark).where("false")).count() == 0


def test_repeated_null_and_invalid_rows(spark):
    docs = spark.sql(
        "select * from values (1, 'CC BY 4.0'), (1, 'x'), (null, 'all rights reserved'), (1, 'CC BY 4.0') t(doc_id, text)"
        " union all select 5, cast(unhex('ff20616c6c2072696768747320726573657276656420fe') as string)"
    ).withColumnRenamed("doc_id", "id").selectExpr("cast(id as long) doc_id", "text")
    rows = sorted((row.doc_id or 0, row.n_words, len(row.base), row.score) for row in licenses.find_licenses(docs).collect())
    assert [r[:3] for r in rows] == [(0, 3, 1), (1, 1, 0), (1, 4, 1), (1, 4, 1), (5, 5, 1)]


def test_op12(spark):
    from test_queries import result, table

    found = result(spark, "op12_license_scan")
    texts = table("documents", "doc_id, text")
    assert len(found) == len(texts)
    hits = 0
    for doc, text in texts:
        n_words, places = license_places(text)
        row = found[doc]
        base = {label for _, label in places}
        ends = (places[0][0], places[-1][0]) if places else (None, None)
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (n_words, len(places), *ends)
        assert row.base_labels == ",".join(sorted(base))
        labels = row.labels.split(",") if row.labels else []
        assert labels == sorted(set(labels)) and base <= set(labels)
        assert (row.score > 0) == bool(labels) and 0 <= row.score <= 1
        hits += bool(labels)
    assert hits > 0
