"""Map tiles and density bins against plain counts of the posts."""

import random
from collections import Counter
from math import floor, isnan, nan

import pytest

from crisis_posts.operators import density, tiles
from crisis_posts.operators.views import exact_markers

SCHEMA = (
    "latitude double, longitude double, sentiment_polarity double, sentiment_subjectivity double, aidr_label string"
)
EDGES = [
    (90.0, -180.0), (-90.0, 180.0), (0.0, 0.0), (91.0, 200.0), (-1e9, -1e9), (None, 5.0), (5.0, None), (nan, 1.0),
    (1.0, nan), (float("inf"), float("-inf")),
]


def make_rows(n=3000, seed=5):
    rng = random.Random(seed)

    def score(low):
        return None if rng.random() < 0.1 else rng.choice([rng.uniform(low, 1), 1.0, low])

    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]
    points += [(29.76, -95.36)] * n + EDGES  # one place holds half of all posts
    return [(*p, score(-1.0), score(0.0), rng.choice(["a", "b", None])) for p in points]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def posts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


def cell(value, span, level):
    x = value / span * 2**level
    return 0 if x < 0 else 2**level - 1 if x >= 2**level else floor(x)


def test_cells_are_those_of_a_plain_count(posts, rows):
    found = {(r.level, r.x, r.y): r for r in tiles.tile_pyramid(posts, deepest=6).collect()}
    placed = [r for r in rows if r[0] is not None and r[1] is not None and not isnan(r[0]) and not isnan(r[1])]
    for level in range(7):
        plain = Counter((level, cell(r[1] + 180, 360, level), cell(90 - r[0], 180, level)) for r in placed)
        assert {k: r.n for k, r in found.items() if k[0] == level} == plain
    top = found[0, 0, 0]
    assert top.n == len(placed) == top.n_red + top.n_blue + top.n_green
    scored = [r for r in placed if r[2] is not None and r[3] is not None]
    assert top.n_scored == len(scored) and top.sum_polarity == pytest.approx(sum(r[2] for r in scored))


def test_every_level_sums_to_the_markers(posts):
    markers = {r.band: r["count"] for r in exact_markers(posts.filter("not isnan(latitude) and not isnan(longitude)")).groupBy("band").count().collect()}
    for r in tiles.tile_pyramid(posts).groupBy("level").sum("n_red", "n_blue", "n_green").collect():
        assert {"red": r[1], "blue": r[2], "green": r[3]} == markers


def test_batches_add_up(posts):
    parts = [tiles.tile_pyramid(posts.filter(c), deepest=5) for c in ("aidr_label = 'a'", "aidr_label = 'b'", "aidr_label is null")]
    merged = tiles.merge_pyramids(parts[2].union(parts[0]).union(parts[1]))
    keys = ["level", "x", "y", "n", "n_red", "n_blue", "n_green", "n_scored"]
    once = tiles.tile_pyramid(posts, deepest=5)
    assert sorted(merged.select(keys).collect()) == sorted(once.select(keys).collect())


@pytest.mark.parametrize("box", [(-180, -90, 180, 90), (-96, 29, -95, 30), (-96.1, 29.7, -96.1, 29.7), (170, 80, 400, 95)])
@pytest.mark.parametrize("most", [1, 50, 2000])
def test_a_box_has_bounded_markers(spark, posts, tmp_path, box, most):
    level = tiles.level_for(*box, most)
    x0, y0, x1, y1 = tiles.strips(level, *box)
    assert level == 0 or (x1 - x0 + 1) * (y1 - y0 + 1) <= most
    found = tiles.box_markers(tiles.tile_pyramid(posts), *box, most).collect()
    assert len(found) <= most
    assert all(r.level == level and x0 <= r.x <= x1 and y0 <= r.y <= y1 for r in found)


def test_a_stored_box_reads_one_level(spark, posts, tmp_path):
    path = str(tmp_path / "pyramid")
    tiles.write_pyramid(tiles.tile_pyramid(posts, deepest=6), path)
    box = tiles.box_markers(spark.read.parquet(path), -96, 29, -95, 30, 4, 6)
    plan = box._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(level" in plan and "GreaterThanOrEqual(x," in plan
    assert sum(r.n for r in box.collect()) >= 3000
    with pytest.raises(ValueError, match="west"):
        tiles.box_markers(spark.read.parquet(path), 10, 0, -10, 5)


def plain_bin(value, low, high, bins):
    if value is None or isnan(value):
        return None
    return min(max(floor((value - low) / (high - low) * bins), 0), bins - 1)


def test_bins_are_those_of_a_plain_count(posts, rows):
    found = density.density(posts, by=["aidr_label"], bins=10).collect()
    plain = Counter((r[4], plain_bin(r[2], -1, 1, 10), plain_bin(r[3], 0, 1, 10)) for r in rows)
    assert {(r.aidr_label, r.x_bin, r.y_bin): r.n for r in found} == plain
    assert sum(r.n for r in found) == len(rows) and len(found) <= 3 * 11 * 11
    bars = density.histogram(posts, "aidr_label", bins=10).collect()
    assert {(r.aidr_label, r.x_bin): r.n for r in bars} == Counter((r[4], plain_bin(r[2], -1, 1, 10)) for r in rows)


def pearson(pairs):
    n = len(pairs)
    mx, my = (sum(p[i] for p in pairs) / n for i in (0, 1))
    over = sum((x - mx) * (y - my) for x, y in pairs)
    return over / (sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs)) ** 0.5


def test_correlations_of_groups_and_of_merged_bins(posts, rows):
    cells = density.density(posts, by=["aidr_label"])
    for r in density.correlation(cells, ["aidr_label"]).collect():
        pairs = [(a[2], a[3]) for a in rows if a[4] == r.aidr_label and a[2] is not None and a[3] is not None]
        assert r.n_pairs == len(pairs) and r.correlation == pytest.approx(pearson(pairs))
    whole = density.correlation(density.density(posts)).first()
    merged = density.correlation(density.merge_density(cells)).first()
    assert merged.n == whole.n == len(rows) and merged.correlation == pytest.approx(whole.correlation)


def test_no_spread_has_no_correlation(spark):
    def found(pairs):
        table = spark.createDataFrame([(None, None, *p, "a") for p in pairs], SCHEMA)
        return density.correlation(density.density(table)).first().correlation

    assert found([(0.1, 0.2)]) is None and found([(0.1, 0.2), (0.1, 0.3), (0.1, 0.7)]) is None
    assert found([(None, 0.5), (nan, 0.25)]) is None and found([]) is None
    assert found([(0.1, 0.2), (0.3, 0.4)]) == pytest.approx(1.0)
    assert found([(0.1, 0.4), (0.3, 0.2)]) == pytest.approx(-1.0)
