"""Filters, refinement, means and result tables on hand-written enriched posts."""

import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from crisis_posts.functions.texts import sentiment_band
from crisis_posts.operators import means, views
from crisis_posts.operators.selection import PostQuery
from crisis_posts.plans import binding
from crisis_posts.schemas import AIDR_LABELS, US_STATES

ROWS = [
    # id, label, verified, sensitive, date, state, phase, polarity, subjectivity
    (1, "a", True, False, datetime(2017, 8, 16, 23, 59, 59), "TX", 0, 1.0, 0.1),
    (2, "a", False, None, datetime(2017, 8, 17), "TX", 1, 3.0, 0.3),
    (3, "b", None, True, datetime(2017, 9, 12), "DC", 1, None, None),
    (4, "zz", True, True, datetime(2017, 9, 12, 23, 59, 59), None, 2, 9.0, 0.9),
    (5, None, None, None, datetime(2017, 9, 13), "LA", 2, -1.0, 0.5),
    (6, "b", False, False, None, "LA", None, -0.5, 0.5),
]
SCHEMA = (
    "id long, aidr_label string, verified boolean, possibly_sensitive boolean,"
    "date timestamp_ntz, place_state string, phase int,"
    "sentiment_polarity double, sentiment_subjectivity double"
)


@pytest.fixture(scope="module")
def query(spark):
    return PostQuery(spark.createDataFrame(ROWS, SCHEMA))


def ids(query):
    return sorted(row.id for row in query.rows().collect())


@pytest.mark.parametrize(
    "filters, expected",
    [
        ({}, [1, 2, 3, 4, 5, 6]),
        ({"labels": [], "place": [], "phase": [], "verified": None}, [1, 2, 3, 4, 5, 6]),
        ({"labels": ["a", "zz"]}, [1, 2, 4]),
        ({"created_at": date(2017, 9, 12)}, [3, 4]),
        ({"created_at": "2017-09-12"}, [3, 4]),
        ({"created_at": date(2017, 8, 17), "created_at_end": date(2017, 9, 12)}, [2, 3, 4]),
        ({"created_at": date(2017, 9, 13), "created_at_end": date(2017, 9, 12)}, []),
        ({"created_at_end": date(2017, 9, 12)}, []),
        ({"created_at": date.min, "created_at_end": date.max}, [1, 2, 3, 4, 5]),
        ({"verified": "True"}, [1, 4]),
        ({"verified": "False"}, [2, 6]),
        ({"verified": "Tutti"}, [1, 2, 3, 4, 5, 6]),
        ({"possibly_sensitive": "True"}, [3, 4]),
        ({"possibly_sensitive": False}, [1, 6]),
        ({"place": ["TX", "DC"]}, [1, 2, 3]),
        ({"phase": ["Pre"]}, [1]),
        ({"phase": ["Durante", "Post"]}, [2, 3, 4, 5]),
        ({"labels": ["a"], "verified": "True", "place": ["TX"], "phase": ["Pre"]}, [1]),
    ],
)
def test_filters(query, filters, expected):
    assert ids(query.where(**filters)) == expected
    assert query.where(**filters).size().first().n == len(expected)


def test_bad_filters(query):
    with pytest.raises(ValueError):
        query.where(phase=["Dopo"])
    with pytest.raises(TypeError):
        query.where(created_at=datetime(2017, 9, 12, 10))


def test_where_starts_afresh_and_refine_accumulates(query):
    texas = query.where(place=["TX"])
    assert ids(texas.refine(verified="True")) == [1]
    assert ids(texas.refine(verified="True").refine(verified="False")) == []
    assert ids(texas) == [1, 2]
    assert ids(texas.where(verified="True")) == [1, 4]
    both = query.where(place=["TX"], verified="True")
    assert ids(texas.refine(verified="True")) == ids(both)


def test_preview_is_bounded(query):
    assert len(query.preview(2)) == 2


def test_means(query):
    assert query.where(labels=["a"]).mean_polarity() == pytest.approx([2.0, 0.2])
    assert query.where(labels=["nosuch"]).mean_polarity() == [None, None]
    assert query.where(labels=["b"]).mean_polarity() == [-0.5, 0.5]
    assert query.mean_label_polarity(["b", "nosuch", "a", "b"]) == [
        [-0.5, 0.5], [None, None], pytest.approx([2.0, 0.2]), [-0.5, 0.5],
    ]
    assert query.mean_state_polarity()[list(US_STATES.values()).index("LA")] == [-0.75, 0.5]
    assert len(query.mean_label_polarity()) == len(AIDR_LABELS) == 10
    assert len(query.mean_state_polarity()) == 50


def test_all_means_equal_the_single_ones(query):
    chosen = query.where(verified="False").refine(created_at="2017-08-17")
    for selection in (query, chosen):
        table = selection.all_means(["b", "nosuch", "a"], ["TX", "LA", "XX"]).collect()
        found = {(r.dimension, r.position): [r.polarity, r.subjectivity] for r in table}
        assert found.pop(("overall", 0)) == pytest.approx(selection.mean_polarity())
        labels = selection.mean_label_polarity(["b", "nosuch", "a"])
        states = selection.mean_state_polarity(["TX", "LA", "XX"])
        for i in range(3):
            assert found[means.BY_LABEL, i] == pytest.approx(labels[i])
            assert found[means.BY_STATE, i] == pytest.approx(states[i])
        assert len(found) == 6


def test_domains_of_any_length(query):
    assert query.mean_label_polarity([]) == []
    assert len(query.all_means([], []).collect()) == 1
    long = [f"x{i}" for i in range(means.MAX_BROADCAST)] + ["a"]
    assert query.mean_label_polarity(long)[-1] == pytest.approx([2.0, 0.2])
    plan = query.means_by("aidr_label", long)._jdf.queryExecution().analyzed().toString()
    assert "hint" not in plan


def test_mean_of_one_label_equals_its_selection(spark):
    posts = PostQuery(
        binding.enriched_posts(
            spark, "/root/testdata/sf0.001", "aidr_label",
            "sentiment_polarity", "sentiment_subjectivity",
        )
    )
    [pair] = posts.mean_label_polarity(["view"])
    assert pair == pytest.approx(posts.where(labels=["view"]).mean_polarity())


def test_bands(spark):
    values = [-0.31, -0.3, 0.3, 0.31, None, math.nan]
    table = spark.createDataFrame([(v,) for v in values], "p double")
    bands = [row[0] for row in table.select(sentiment_band(F.col("p"))).collect()]
    assert bands == ["red", "blue", "blue", "green", "green", "green"]


def test_captions_round_the_exact_value(spark):
    rng = random.Random(6)
    values = [0.00015, 0.33335, -0.00035, 0.00005, -0.00001, 0.0, 1.0, -1.0]
    values += [rng.uniform(-1, 1) for _ in range(2000)]
    values += [rng.randint(-9999, 9999) / 10000 + 0.00005 for _ in range(2000)]
    table = spark.createDataFrame([(v, -v) for v in values], "polarity double, subjectivity double")
    found = [row.caption for row in views.mean_captions(table).collect()]
    assert found == [f"{v:.4f}, {-v:.4f}" for v in values]


def test_captions(spark):
    table = spark.createDataFrame(
        [("a", 0.123449, -1.0), ("b", None, None), ("c", -0.5, 0.25)],
        "member string, polarity double, subjectivity double",
    )
    rows = [(r.member, r.band, r.caption) for r in views.mean_captions(table).collect()]
    assert rows == [
        ("a", "blue", "0.1234, -1.0000"),
        ("b", None, "no data"),
        ("c", "red", "-0.5000, 0.2500"),
    ]


def test_markers_need_both_coordinates(spark):
    posts = spark.createDataFrame(
        [(1.0, 2.0, 3.0, None, "p"), (1.0, None, 5.0, 6.0, "q")],
        "latitude double, longitude double, place_latitude double, place_longitude double,"
        "place_name string",
    ).withColumns({"sentiment_polarity": F.lit(0.4), "sentiment_subjectivity": F.lit(0.2)})
    exact = [tuple(row) for row in views.exact_markers(posts).collect()]
    assert exact == [(1.0, 2.0, "green", 0.4, 0.2)]
    places = [tuple(row) for row in views.place_markers(posts).collect()]
    assert places == [(5.0, 6.0, "green", 0.4, 0.2, "q")]
