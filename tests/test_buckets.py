"""Posts and labels in buckets: the same rows as the plain join, without a shuffle of posts."""

import glob

import pytest

from crisis_posts.operators.enrich import join_labels
from crisis_posts.sources import buckets

POSTS = "id long, text string, aidr_confidence string"


@pytest.fixture
def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def tables(spark, hot=500):
    rows = [(i, f"t{i}", "c") for i in range(400)] + [(7, f"hot{i}", "c") for i in range(hot)]
    rows += [(None, f"none{i}", "c") for i in range(9)] + [(3, "again", "c")]
    posts = spark.createDataFrame(rows, POSTS)
    labels = [(i, f"l{i % 3}") for i in range(0, 600, 2)] + [(7, "a"), (7, "b"), (4, "second"), (None, "x")]
    return posts, spark.createDataFrame(labels, "id long, aidr_label string")


def plan_of(table):
    table.collect()
    return table._jdf.queryExecution().executedPlan().toString()


def sorted_rows(table):
    return sorted(map(tuple, table.select("id", "text", "aidr_label").collect()))


@pytest.mark.parametrize("hot_rows", [100, 10_000])
def test_rows_are_those_of_the_plain_join(spark, without_broadcast, tmp_path, hot_rows):
    posts, labels = tables(spark)
    name = f"b{hot_rows}"
    buckets.store_posts(posts, f"posts_{name}", str(tmp_path / "p"), 8, hot_rows)
    buckets.store_labels(labels, f"labels_{name}", str(tmp_path / "l"), 8)
    found = buckets.labelled_posts(spark, f"posts_{name}", f"labels_{name}")
    assert sorted_rows(found) == sorted_rows(join_labels(posts, labels))
    assert len(sorted_rows(found)) > 1000
    hot = spark.table(f"posts_{name}_hot")
    assert hot.count() == (501 + 9 if hot_rows == 100 else 9)
    assert len(glob.glob(str(tmp_path / "p/posts/*.parquet"))) <= 8
    for table in (f"posts_{name}", f"posts_{name}_hot", f"labels_{name}"):
        spark.sql(f"DROP TABLE {table}")


def test_bucketed_posts_are_joined_without_an_exchange(spark, without_broadcast, tmp_path):
    posts, labels = tables(spark, hot=5)
    buckets.store_posts(posts, "posts_plan", str(tmp_path / "p"), 8)
    buckets.store_labels(labels, "labels_plan", str(tmp_path / "l"), 8)
    plan = plan_of(join_labels(spark.table("posts_plan"), spark.table("labels_plan")))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert "Exchange" in plan_of(join_labels(posts, labels))
    # A part of the columns and rows is all that is read.
    part = plan_of(join_labels(spark.table("posts_plan").filter("id > 5").select("id", "text"), spark.table("labels_plan")))
    assert "Exchange" not in part and "GreaterThan(id,5)" in part and "aidr_confidence" not in part
    for table in ("posts_plan", "posts_plan_hot", "labels_plan"):
        spark.sql(f"DROP TABLE {table}")


def test_files_are_attached_in_a_later_session_and_labels_exchanged(spark, without_broadcast, tmp_path):
    posts, labels = tables(spark)
    buckets.store_posts(posts, "posts_first", str(tmp_path / "p"), 4, 100)
    for table in ("posts_first", "posts_first_hot"):  # their files stay
        spark.sql(f"DROP TABLE {table}")
    later = spark.newSession()
    later.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    buckets.attach(later, "posts_later", str(tmp_path / "p/posts"), POSTS, 4)
    buckets.attach(later, "posts_later_hot", str(tmp_path / "p/hot"), POSTS)
    for name, some in (("one", labels), ("two", labels.replace("second", "third"))):
        buckets.store_labels(some, f"labels_{name}", str(tmp_path / name), 4)
        found = buckets.labelled_posts(later, "posts_later", f"labels_{name}")
        assert sorted_rows(found) == sorted_rows(join_labels(posts, some))
        assert "Bucketed: true" in plan_of(found)
    for table in ("posts_later", "posts_later_hot", "labels_one", "labels_two"):
        spark.sql(f"DROP TABLE {table}")


def test_empty_tables(spark, tmp_path):
    posts, labels = tables(spark)
    buckets.store_posts(posts.limit(0), "posts_none", str(tmp_path / "p"), 2)
    buckets.store_labels(labels.limit(0), "labels_none", str(tmp_path / "l"), 2)
    assert buckets.labelled_posts(spark, "posts_none", "labels_none").count() == 0
    for table in ("posts_none", "posts_none_hot", "labels_none"):
        spark.sql(f"DROP TABLE {table}")
