"""Sizes and means from a stored rollup equal those from the posts, for any filter."""

import random
from datetime import datetime
from itertools import combinations

import pytest

from crisis_posts.operators import rollup
from crisis_posts.operators.selection import PostQuery
from crisis_posts.schemas import AIDR_LABELS, ENRICHED, US_STATES

STATES = tuple(US_STATES.values())
FILTERS = [
    {}, {"labels": ["personal", AIDR_LABELS[0]]}, {"place": ["TX", "Houston"]}, {"phase": ["Durante"]},
    {"verified": "True"}, {"possibly_sensitive": False}, {"created_at": "2017-08-30"},
    {"created_at": "2017-08-20", "created_at_end": "2017-09-02"}, {"created_at_end": "2017-09-02"},
]


def make_posts(spark, n=1500, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        date = datetime(2017, rng.choice([8, 9]), rng.randint(1, 30), rng.randint(0, 23), 59, 59, 999999)
        scored = rng.random() < 0.9
        rows.append({
            "aidr_label": rng.choice([None, *AIDR_LABELS[:4], "personal"]),
            "place_state": rng.choice([None, "TX", "LA", "Houston"]),
            "phase": rng.choice([0, 1, 2]), "date": rng.choice([None, date, date, date]),
            "verified": rng.choice([None, True, False]), "possibly_sensitive": rng.choice([None, True, False]),
            "sentiment_polarity": rng.uniform(-1, 1) if scored else None,
            "sentiment_subjectivity": rng.random() if rng.random() < 0.8 else None, "text": f"t{i}",
        })
    return spark.createDataFrame(rows, ENRICHED)


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    posts = make_posts(spark).cache()
    path = str(tmp_path_factory.mktemp("rollup") / "cells")
    for phase in (0, 1, 2, 1):  # one batch comes twice
        rollup.write_batch(posts.filter(f"phase = {phase}"), path, f"run{phase}")
    return PostQuery(posts), rollup.RollupQuery(rollup.read_rollup(spark, path)), path


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert [v is None for v in x] == [v is None for v in y]
        assert [v or 0 for v in x] == pytest.approx([v or 0 for v in y], rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("chosen", [*FILTERS, *({**a, **b} for a, b in list(combinations(FILTERS[1:], 2))[::5])])
def test_any_filter_gives_what_the_posts_give(both, chosen):
    posts, cells, _ = both
    posts, cells = posts.where(**chosen), cells.where(**chosen)
    assert cells.size().first().n == posts.size().first().n
    same([cells.means().first()], [posts.means().first()])
    every = [
        {(r.dimension, r.member): (r.position, r.polarity, r.subjectivity) for r in q.all_means().collect()}
        for q in (posts, cells)
    ]
    assert every[0].keys() == every[1].keys()
    same(every[0].values(), [every[1][k] for k in every[0]])


def test_lists_of_means_and_refining(both):
    posts, cells, _ = (q.where(phase=["Pre", "Post"]).refine(place=["TX"]) if not isinstance(q, str) else q for q in both)
    assert cells.mean_polarity() == pytest.approx(posts.mean_polarity())
    same(cells.mean_label_polarity(), posts.mean_label_polarity())
    same(cells.mean_state_polarity(("TX", "LA")), posts.mean_state_polarity(("TX", "LA")))


def test_only_the_rollup_is_read(both):
    _, cells, path = both
    plan = cells.where(labels=["personal"]).means()
    assert plan.inputFiles() and all(path in file for file in plan.inputFiles())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(aidr_label)" in text and "text" not in text.split("ReadSchema")[1]


def test_merging_in_any_order_and_depth(spark, both):
    posts = both[0].posts
    parts = [rollup.rollup(posts.filter(f"phase = {p}")) for p in (0, 1, 2)]
    once = rollup.merge_rollups(parts[0].union(parts[1]).union(parts[2]))
    deep = rollup.merge_rollups(rollup.merge_rollups(parts[2].union(parts[0])).union(parts[1]))
    whole = rollup.rollup(posts)

    def rows(table):
        return sorted(map(str, (tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in table.collect())))

    assert rows(once) == rows(deep) == rows(whole)
    assert rollup.rollup(posts.limit(0)).count() == 0


def test_a_batch_replaces_itself_alone(spark, tmp_path):
    posts, path = make_posts(spark, 40, 2), str(tmp_path / "cells")
    rollup.write_batch(posts, path, "a")
    rollup.write_batch(posts.limit(7), path, "b")
    rollup.write_batch(posts.limit(3), path, "a")
    assert rollup.RollupQuery(rollup.read_rollup(spark, path)).size().first().n == 10
    rollup.write_batch(posts.limit(0), path, "b")
    assert rollup.RollupQuery(rollup.read_rollup(spark, path)).size().first().n == 3
    rollup.write_batch(posts.limit(5), path, "c/d=é %")
    assert rollup.RollupQuery(rollup.read_rollup(spark, path)).size().first().n == 8
    with pytest.raises(ValueError, match="batch"):
        rollup.write_batch(posts, path, "")
    assert rollup.RollupQuery(rollup.read_rollup(spark, path)).where(labels=["x"]).size().first().n == 0
