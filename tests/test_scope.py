"""Sentiment with scope: golden cases, and random texts against a plain state machine."""

import random
import re

import pytest

from crisis_posts.operators import enrich, scope

BOTH_PATHS = pytest.mark.parametrize("max_rows", [50_000, 0])

LEXICON = [
    ("good", 0.6, 0.5), ("bad", -0.7, 0.6), ("Great", 0.8, 0.75), ("not  bad at all", 0.4, 0.3),
    ("not bad", 0.2, 0.2), ("over", 0.1, 0.1), ("don't panic", 0.5, 0.5), ("empty", None, 0.3),
    (" ", 9.0, 9.0), (None, 9.0, 9.0), ("very", 0.2, 0.3),
]
MODIFIERS = [
    ("not", "negator", -0.5), ("never", "negator", -0.5), ("very", "booster", 1.3),
    ("slightly", "booster", 0.5), ("kind of", "booster", 0.8), ("odd", "unknown", 7.0),
]


def tables(spark, lexicon=LEXICON, modifiers=MODIFIERS):
    return (
        spark.createDataFrame(lexicon, "word string, polarity double, subjectivity double"),
        spark.createDataFrame(modifiers, "word string, kind string, factor double"),
    )


def scores(spark, texts, max_rows=50_000, **options):
    posts = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    scored = scope.with_scoped_sentiment(posts, *tables(spark), max_rows=max_rows, **options)
    assert scored.columns == ["id", "text", "sentiment_polarity", "sentiment_subjectivity"]
    rows = sorted(scored.collect())
    return [(row.sentiment_polarity, row.sentiment_subjectivity) for row in rows]


def plain(text, reach=3):
    if text is None:
        return None, None
    entries = {}
    for word, p, s in LEXICON:
        if word and word.strip() and p is not None:
            entries[tuple(word.lower().split())] = [p, s, None, None]
    for word, kind, factor in MODIFIERS:
        if kind != "unknown":
            entry = entries.setdefault(tuple(word.split()), [None, None, None, None])
            entry[2 if kind == "negator" else 3] = factor
    tokens = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.,;:!?]", text.lower())
    at, until, negation, boost_at, boost = 0, -1, 1.0, -1, 1.0
    found = []
    while at < len(tokens):
        if tokens[at] in ".,;:!?":
            until, boost_at = -1, -1
        n = next((n for n in (4, 3, 2, 1) if tuple(tokens[at : at + n]) in entries and at + n <= len(tokens)), 0)
        if n:
            p, s, negates, boosts = entries[tuple(tokens[at : at + n])]
            active = negation if at <= until else 1.0
            boosted = boost if at == boost_at else 1.0
            if p is not None:
                found.append((max(-1, min(1, p * boosted * active)), max(0, min(1, s * boosted))))
            if negates is not None:
                negation, until = active * negates, at + n - 1 + reach
            if boosts is not None:
                boost, boost_at = boosted * boosts, at + n
        at += max(n, 1)
    return tuple(sum(x[i] for x in found) / len(found) if found else 0.0 for i in (0, 1))


GOLDEN = {
    "good": (0.6, 0.5),
    "not good": (-0.3, 0.5),
    "very good": ((0.2 + 0.78) / 2, (0.3 + 0.65) / 2),  # "very" is an entry itself
    "slightly good": (0.3, 0.25),
    "kind of good": (0.48, 0.4),
    "not slightly good": (-0.15, 0.25),
    "never not good": (0.15, 0.5),
    "not a b good": (-0.3, 0.5),
    "not a b c good": (0.6, 0.5),
    "not. good": (0.6, 0.5),
    "slightly, good": (0.6, 0.5),
    "slightly a good": (0.6, 0.5),
    "not good, good": (0.15, 0.5),
    "not bad at all": (0.4, 0.3),
    "not bad at": (0.2, 0.2),
    "not bad.": (0.2, 0.2),
    "GREAT": (0.8, 0.75),
    "Don't panic": (0.5, 0.5),
    "don’t good": (0.6, 0.5),
    "goodness": (0.0, 0.0),
    "odd good": (0.6, 0.5),
    "": (0.0, 0.0),
}


@BOTH_PATHS
def test_golden_cases(spark, max_rows):
    found = scores(spark, [*GOLDEN, None], max_rows)
    assert found[-1] == (None, None)
    for (text, expected), score in zip(GOLDEN.items(), found, strict=False):
        assert score == pytest.approx(expected), text
        assert plain(text) == pytest.approx(expected), text


def random_texts(n):
    rng = random.Random(4)
    words = [w for entry, *_ in LEXICON + MODIFIERS if entry for w in entry.split()]
    words += ["a", "sea", ".", ",", "!", "’", "don't", "9"]
    return [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(n)]


def test_random_texts_and_both_ways_agree(spark):
    texts = random_texts(250)
    texts += texts[:20]  # copies fold into one in the joined way
    sent, joined = (scores(spark, texts, max_rows) for max_rows in (50_000, 0))
    assert sent == joined
    for text, score in zip(texts, sent, strict=True):
        assert score == pytest.approx(plain(text)), text


def test_scope_is_a_parameter(spark):
    assert scores(spark, ["not a b good"], scope=2) == [(0.6, 0.5)]


def test_a_long_text_is_folded_in_linear_time(spark):
    long = "not very good and bad at all . " * 50_000
    ((polarity, _),) = scores(spark, [long])
    assert polarity == pytest.approx(plain(long)[0])


def test_empty_tables(spark):
    posts = spark.createDataFrame([(1, "good")], "id int, text string")
    lexicon, modifiers = tables(spark)
    for some in ((lexicon.limit(0), modifiers), (lexicon.limit(0), modifiers.limit(0))):
        assert scope.with_scoped_sentiment(posts, *some).first().sentiment_polarity == 0.0
    only = scope.with_scoped_sentiment(posts, lexicon, modifiers.limit(0))
    assert only.first().sentiment_polarity == 0.6


def test_enrichment_takes_modifiers(spark):
    from crisis_posts.schemas import RAW_POST

    raw = spark.createDataFrame([{"id": 1, "text": "not good", "truncated": False}], RAW_POST)
    labels = spark.createDataFrame([(1, "x")], "id long, aidr_label string")
    lexicon, modifiers = tables(spark)
    scored = enrich.enrich_posts(raw, labels, lexicon, modifiers=modifiers)
    assert scored.first().sentiment_polarity == pytest.approx(-0.3)
    assert enrich.enrich_posts(raw, labels, lexicon).first().sentiment_polarity == 0.6
