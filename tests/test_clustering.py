"""Clustered storage: the same rows, and each filter alone skips most row groups."""

import glob
import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest

from crisis_posts.operators.selection import PostQuery
from crisis_posts.schemas import AIDR_LABELS, US_STATES
from crisis_posts.sources import clustering

SCHEMA = (
    "id long, aidr_label string, place_state string, date timestamp_ntz, verified boolean, "
    "possibly_sensitive boolean, phase int"
)
FILTERS = {
    "aidr_label": {"labels": [AIDR_LABELS[3]]},
    "place_state": {"place": ["TX"]},
    "date": {"created_at": "2017-08-30"},
    "verified": {"verified": "True"},
    "possibly_sensitive": {"possibly_sensitive": "True"},
}


def make_posts(spark, n=20_000, hot=0):
    rng = random.Random(3)
    states = [*US_STATES.values(), None]
    start = datetime(2017, 8, 1)
    rows = [
        (
            i, rng.choice(AIDR_LABELS), rng.choice(states), start + timedelta(minutes=rng.randrange(60 * 24 * 60)),
            rng.random() < 0.1, rng.choice([True, False, False, False, None]), 0,
        )
        for i in range(n)
    ]
    rows += [(i, "personal", "TX", start, False, None, 0) for i in range(n, n + hot)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    posts = make_posts(spark).cache()
    path = str(tmp_path_factory.mktemp("clustered") / "posts")
    clustering.write_clustered(posts, path, 64)
    return posts, path


def row_groups(path, column):
    """(smallest, largest, whether any value) of a column in each row group."""
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                chunk = group.column(c)
                if chunk.path_in_schema == column:
                    known = chunk.statistics.has_min_max
                    yield (chunk.statistics.min, chunk.statistics.max) if known else None


def kept(path, column, ranges):
    """The share of row groups that a filter on one range reads, on average over the ranges."""
    groups = list(row_groups(path, column))
    hits = [sum(g is not None and g[0] <= high and g[1] >= low for g in groups) for low, high in ranges]
    return sum(hits) / len(hits) / len(groups)


@pytest.mark.parametrize("chosen", [*FILTERS.values(), {**FILTERS["date"], **FILTERS["place_state"]}, {}])
def test_rows_are_the_same(spark, stored, chosen):
    posts, path = stored
    read = spark.read.schema(posts.schema).parquet(path)
    both = [sorted(map(repr, PostQuery(t).where(**chosen).rows().collect())) for t in (posts, read)]
    assert both[0] == both[1] and both[0]


DAYS = [datetime(2017, 8, 1) + timedelta(days=i) for i in range(60)]


@pytest.mark.parametrize(
    ("column", "ranges", "most"),
    [
        ("aidr_label", [(x, x) for x in AIDR_LABELS], 0.6),
        ("place_state", [(x, x) for x in US_STATES.values()], 0.6),
        ("date", [(x, x + timedelta(hours=23, minutes=59)) for x in DAYS], 0.6),
        ("verified", [(True, True)], 0.3),
        ("possibly_sensitive", [(True, True)], 0.6),
    ],
)
def test_each_filter_alone_skips_row_groups(stored, column, ranges, most):
    # 64 files leave a column about one bit: half of the files, and those across its bounds.
    assert 0 < kept(stored[1], column, ranges) <= most


def test_filters_reach_the_scan_and_ranges_say_what_is_skipped(spark, stored):
    posts, path = stored
    read = spark.read.schema(posts.schema).parquet(path)
    plan = PostQuery(read).where(**FILTERS["place_state"]).rows()._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(place_state,TX)" in plan or "In(place_state" in plan
    ranges = clustering.file_ranges(read).collect()
    assert len(ranges) == 64 and sum(r.posts for r in ranges) == posts.count()
    touched = [r for r in ranges if r.min_place_state and r.min_place_state <= "TX" <= r.max_place_state]
    assert len(touched) <= 32


def test_a_hot_cell_fills_many_files(spark, tmp_path):
    clustering.write_clustered(make_posts(spark, 4000, hot=4000), str(tmp_path / "hot"), 16)
    rows = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/hot/*.parquet")]
    assert sum(rows) == 8000 and max(rows) < 1500


def test_ranks_keep_the_order(spark):
    texts = ["", "A", "AL", "TX", "Texas", "é", "日本", "\U0001f600", None]
    posts = spark.createDataFrame([(t,) for t in texts], "t string")
    found = posts.select("t", clustering.ordinal(posts, "t").alias("n")).filter("t is not null").collect()
    assert [r.t for r in sorted(found, key=lambda r: r.n)] == sorted(texts[:-1], key=lambda t: t.encode())
    cuts = clustering.quantile_cuts(posts, ["t"])
    keys = {r.t: r.k for r in posts.select("t", clustering.interleaved(posts, cuts).alias("k")).collect()}
    known = [keys[t] for t in texts[:-1]]
    assert keys[None] == 0 and known == sorted(known) and len(set(known)) >= 7


def test_empty_tables_nulls_and_unknown_kinds(spark, tmp_path):
    posts = make_posts(spark, 5)
    clustering.write_clustered(posts.limit(0), str(tmp_path / "none"), 4)
    assert spark.read.schema(posts.schema).parquet(str(tmp_path / "none")).count() == 0
    nulls = posts.selectExpr("id", *(f"cast(null as {t}) as {c}" for c, t in posts.dtypes[1:]))
    clustering.write_clustered(nulls, str(tmp_path / "nulls"), 2)
    assert spark.read.schema(posts.schema).parquet(str(tmp_path / "nulls")).count() == 5
    with pytest.raises(TypeError, match="rank"):
        clustering.ordinal(spark.createDataFrame([([1],)], "a array<int>"), "a")
    with pytest.raises(ValueError, match="bits"):
        clustering.interleaved(posts, {c: list(range(60_000)) for c in clustering.CLUSTERED})
