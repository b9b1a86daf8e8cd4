"""The source audit on odd and small tables, against a plain version; SQL is in test_oracle."""

import random

import pytest
from brute import source_audit

from crisis_posts.llm import divergence

COLUMNS = "lang string, source string, text string, term string, n long, place int, value long"


def audited(spark, rows, **options):
    docs = spark.createDataFrame([(*row, "x", 1, 2, 3) for row in rows], COLUMNS)
    return [tuple(row) for row in divergence.audit_sources(docs, **options).collect()]


def random_rows(seed, documents=150, sources=9):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}{chr(97 + i // 26)}" for i in range(80)]
    return [
        (
            rng.choice(["en", "de", None, ""]),
            rng.choice([None, "é", *(f"s{k}" for k in range(sources))]),
            rng.choice([None, "", " 1 2 ", " ".join(rng.choices(vocabulary, k=rng.randint(1, 40))).upper()]),
        )
        for _ in range(documents)
    ]


@pytest.mark.parametrize("min_docs", [1, 4, 1000])
def test_equals_plain_version(spark, min_docs):
    rows = random_rows(min_docs)
    found = audited(spark, rows, min_docs=min_docs)
    assert len(found) == len(set(found))
    assert set(found) == source_audit(rows, min_docs)


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    rows = random_rows(7)
    expected = source_audit(rows, 2)
    monkeypatch.setattr(divergence, "_BLOCK", 4)
    # Shipped by value, so that the workers see these constants.
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(divergence)
    try:
        monkeypatch.setattr(divergence, "_CHUNK", 3)
        monkeypatch.setattr(divergence, "_ENTRIES", 5)
        assert set(audited(spark, rows, min_docs=2)) == expected
    finally:
        cloudpickle.unregister_pickle_by_value(divergence)


def test_ties_go_by_utf8_and_ranks_stop_in_the_middle_of_a_value(spark):
    names = [f"t{chr(0x61 + i % 26)}{chr(0xE0 + i // 26)}" for i in range(120)]
    rows = [("en", "a", " ".join(names)), ("en", "b", "other")] * 3
    found = audited(spark, rows, min_docs=3)
    assert set(found) == source_audit(rows, 3)
    assert sorted(r[5] for r in found if r[1] == "a" and r[2] == "term") == list(range(1, 51))


def test_empty_table_and_groups_without_terms(spark):
    assert audited(spark, []) == []
    found = audited(spark, [(None, "a", None), ("", "b", "1 2"), ("en", "a", "")], min_docs=1)
    assert sorted(found) == [("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)]


def test_counts_beyond_32_bits(spark):
    counts = spark.createDataFrame([(30_000_000_000_000, 10**15)], "n long, total long")
    value = counts.select(divergence.frequency("n", "total")).first()[0]
    assert value == 1 + 10**9 * (30_000_000_000_000 + 5) // 10**15


def test_a_long_text_and_bytes_that_are_no_utf8(spark):
    long = " ".join(f"w{chr(97 + i % 26)}" for i in range(300_000))
    docs = spark.sql("select 'en' lang, 'a' source, cast(unhex('61ff6220c3a9') as string) text").union(
        spark.createDataFrame([("en", "b", long)], "lang string, source string, text string")
    )
    found = divergence.audit_sources(docs, min_docs=1).where("part = 'term' and source = 'a'")
    assert found.count() == 2
