"""Posts and labels stored in buckets by id, so that giving posts new labels moves no post.

Both tables are dealt to the same number of buckets when they are written; a join of the two then
reads bucket by bucket, without a shuffle. A bucket is one task, so ids that hold very many posts
(and posts without an id) are kept in a table of their own, where the rows are joined like any
others and an id's rows are split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crisis_posts.operators.enrich import join_labels

BUCKETS = 1024
# Posts of one id from which it is kept apart.
HOT_ROWS = 1_000_000


def store_posts(
    posts: DataFrame, name: str, path: str, buckets: int = BUCKETS, hot_rows: int = HOT_ROWS
) -> None:
    """Write posts as the tables ``name`` and ``name_hot`` below ``path``.

    Posts are counted by id first, on the map side; there are at most posts / hot_rows hot ids.
    """
    counts = posts.filter("id is not null").groupBy("id").count()
    hot = counts.filter(F.col("count") >= hot_rows).select("id")
    many = posts.join(hot, "id", "left_semi").unionByName(posts.filter("id is null"))
    few = posts.filter("id is not null").join(hot, "id", "left_anti")
    _write(few, name, f"{path}/posts", buckets)
    many.write.mode("overwrite").option("path", f"{path}/hot").saveAsTable(f"{name}_hot")


def store_labels(labels: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Write the labels that have an id as the table ``name``; buckets must be those of the posts."""
    _write(labels.select("id", "aidr_label").filter("id is not null"), name, path, buckets)


def attach(spark: SparkSession, name: str, path: str, schema: str, buckets: int = 0) -> None:
    """Make files written before a table of this session; buckets 0 is for the hot posts."""
    dealt = f"CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet {dealt} LOCATION '{path}'")


def labelled_posts(spark: SparkSession, posts: str, labels: str) -> DataFrame:
    """The stored posts with their labels, as ``join_labels`` gives them: an inner join on id.

    The posts in buckets are joined where they lie. Where the labels are small Spark sends them
    to the tasks instead, which moves no post either.
    """
    given = spark.table(labels)
    return join_labels(spark.table(posts), given).unionByName(
        join_labels(spark.table(f"{posts}_hot"), given)
    )


def _write(table: DataFrame, name: str, path: str, buckets: int) -> None:
    # One file for each bucket: the rows are dealt out before they are written.
    (
        table.repartition(buckets, "id").write.mode("overwrite").option("path", path)
        .bucketBy(buckets, "id").sortBy("id").saveAsTable(name)
    )
