"""A stored rollup of the posts: counts and sums for every filter the queries know.

A cell holds the posts of one label, state, phase, day and pair of flags, any of them null. All
filters are about these, so sizes and means of any selection are sums over cells, and cells of
different batches add up. The table grows with the days and not with the posts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crisis_posts.operators import means
from crisis_posts.operators.means import MEASURES
from crisis_posts.operators.selection import PostQuery
from crisis_posts.schemas import AIDR_LABELS, ROLLUP, US_STATES
from crisis_posts.sources.tables import part_path

DIMENSIONS = ("aidr_label", "place_state", "phase", "date", "verified", "possibly_sensitive")
_SUMS = tuple(name for m in MEASURES for name in (f"sum_{m}", f"count_{m}"))


def rollup(posts: DataFrame) -> DataFrame:
    """One row per cell that has posts; ``date`` is the day's midnight, summed on the map side."""
    sums = [
        column for m in MEASURES for column in (
            F.sum(f"sentiment_{m}").alias(f"sum_{m}"), F.count(f"sentiment_{m}").alias(f"count_{m}"),
        )
    ]
    return (
        posts.withColumn("date", F.col("date").cast("date").cast("timestamp_ntz"))
        .groupBy(*DIMENSIONS).agg(F.count("*").alias("posts"), *sums)
    )


def merge_rollups(cells: DataFrame) -> DataFrame:
    """Add up cells of the same posts' properties; merging is associative, in any order."""
    return cells.groupBy(*DIMENSIONS).agg(*(F.sum(c).alias(c) for c in ("posts", *_SUMS)))


def write_batch(posts: DataFrame, path: str, batch: str) -> None:
    """Store the rollup of a batch of posts; a batch stored again takes the place of the first."""
    rollup(posts).write.mode("overwrite").parquet(part_path(path, "batch", batch))


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The cells of all stored batches, added up."""
    return merge_rollups(spark.read.schema(ROLLUP).parquet(path))


def _mean_columns() -> list[Column]:
    return [F.try_divide(F.sum(f"sum_{m}"), F.sum(f"count_{m}")).alias(m) for m in MEASURES]


@dataclass(frozen=True)
class RollupQuery(PostQuery):
    """A selection answered from cells: ``posts`` is a rollup, and ``rows`` gives its cells.

    Sizes and means are those of the posts, but for the order in which numbers are added.
    """

    def size(self) -> DataFrame:
        return self.rows().agg(F.coalesce(F.sum("posts"), F.lit(0)).alias("n"))

    def means(self) -> DataFrame:
        return self.rows().agg(*_mean_columns())

    def means_by(self, column: str, domain: Sequence[str]) -> DataFrame:
        chosen = self.rows().filter(F.col(column).isin(*domain))
        return means.for_domain(chosen.groupBy(column).agg(*_mean_columns()), column, domain)

    def all_means(
        self,
        labels: Sequence[str] = AIDR_LABELS,
        states: Sequence[str] = tuple(US_STATES.values()),
    ) -> DataFrame:
        return means.all_means_of_sums(self.rows(), labels, states)
