"""Pages joined are the selection, with ties, nulls, NaN and repeated rows."""

import random
from datetime import datetime

import pytest

from crisis_posts.operators.pages import DIGEST, _from, _with_digest, page, pages

SCHEMA = "id long, date timestamp_ntz, score double, text string"


def make_rows(n=300):
    rng = random.Random(7)
    dates = [None, datetime(2017, 8, 1), datetime(2017, 8, 2, 3, 4, 5, 678901), datetime(2017, 8, 3)]
    rows = [
        (rng.choice([None, 1, 2, 3]), rng.choice(dates), rng.choice([None, float("nan"), 0.5, -1.0]), rng.choice([None, "", "a", "é"]))
        for _ in range(n)
    ]
    return rows + [(9, dates[1], 0.25, "copy")] * 50


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(make_rows(), SCHEMA).cache()


@pytest.mark.parametrize("order", [("date",), ("date", "id"), ("score", "date"), ("text",)])
@pytest.mark.parametrize("size", [1, 29, 350, 1000])
def test_joined_pages_are_the_selection(spark, posts, order, size):
    if size == 1:
        posts = posts.filter("id = 9 or id is null").limit(12)
        posts = spark.createDataFrame(posts.collect(), SCHEMA)
    found = list(pages(posts, size, order))
    rows = [row for p in found for row in p.rows]
    assert sorted(map(repr, rows)) == sorted(map(repr, posts.collect()))
    assert all(len(p.rows) == size for p in found[:-1]) and 0 < len(found[-1].rows) <= size
    plain = posts.orderBy(*(posts[c].asc_nulls_first() for c in order)).select(*order).collect()
    assert [repr(tuple(r[c] for c in order)) for r in rows] == [repr(tuple(r)) for r in plain]


def test_a_row_added_before_shifts_no_page(spark, posts):
    first = page(posts, 100, order=("date", "id"))
    early = spark.createDataFrame([(0, None, 0.0, "new")], SCHEMA)
    again = page(posts.union(early), 100, first.after, ("date", "id")).rows
    assert list(map(repr, again)) == list(map(repr, page(posts, 100, first.after, ("date", "id")).rows))


def test_empty_selections_and_sizes(posts):
    assert page(posts.limit(0), 5).rows == [] and page(posts.limit(0), 5).after is None
    assert page(posts, 350).after is None and page(posts, 349).after is not None
    with pytest.raises(ValueError, match="row"):
        page(posts, 0)


def test_the_condition_reaches_the_scan(spark, posts, tmp_path):
    posts.write.parquet(str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    after = page(stored, 200, order=("date", "id")).after
    rest = _with_digest(stored).filter(_from(("date", "id", DIGEST), after.values))
    assert "GreaterThanOrEqual(date," in rest._jdf.queryExecution().executedPlan().toString()
