"""Sentiment means, overall and over a fixed ordered domain of group values."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions import literals

# The means of a domain have a row per member at most; up to here they are broadcast.
MAX_BROADCAST = 10_000

MEASURES = ("polarity", "subjectivity")
OVERALL, BY_LABEL, BY_STATE = "overall", "aidr_label", "place_state"


def _mean_columns() -> list[Column]:
    return [
        F.avg("sentiment_polarity").alias("polarity"),
        F.avg("sentiment_subjectivity").alias("subjectivity"),
    ]


def overall_means(posts: DataFrame) -> DataFrame:
    """One row; nulls are skipped and no post at all gives nulls."""
    return posts.agg(*_mean_columns())


def means_by(posts: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """One row per domain member, in its order; null means where it has no posts.

    One aggregation for the whole domain, which keeps at most one row per member.
    """
    grouped = posts.filter(F.col(column).isin(*domain)).groupBy(column).agg(*_mean_columns())
    return for_domain(grouped, column, domain)


def for_domain(grouped: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """``grouped`` means, one row per value of ``column``, as ``means_by`` gives them."""
    members = literals.rows(
        grouped.sparkSession,
        [{"position": i, column: member} for i, member in enumerate(domain)],
        f"position int, `{column}` string",
    )
    return (
        members.join(_bounded(grouped, len(domain)), column, "left")
        .select("position", column, "polarity", "subjectivity")
        .orderBy("position")
    )


def all_means(posts: DataFrame, labels: Sequence[str], states: Sequence[str]) -> DataFrame:
    """Overall, label and state means in one pass over the posts.

    ``dimension`` is ``overall``, ``aidr_label`` or ``place_state``. Posts are summed once
    per label and state; the three kinds of group are formed from those few sums.
    """
    sums = posts.groupBy(BY_LABEL, BY_STATE).agg(
        *[F.sum(f"sentiment_{m}").alias(f"sum_{m}") for m in MEASURES],
        *[F.count(f"sentiment_{m}").alias(f"count_{m}") for m in MEASURES],
    )
    return all_means_of_sums(sums, labels, states)


def all_means_of_sums(sums: DataFrame, labels: Sequence[str], states: Sequence[str]) -> DataFrame:
    """The same from sums and counts per label and state, in any number of rows."""
    level = F.col("level")
    is_overall, is_label, is_state = level == 3, level == 1, level == 2
    grouped = (
        sums.groupingSets([[BY_LABEL], [BY_STATE], []], BY_LABEL, BY_STATE)
        .agg(
            F.grouping_id().alias("level"),
            *[
                F.try_divide(F.sum(f"sum_{m}"), F.sum(f"count_{m}")).alias(m)
                for m in MEASURES
            ],
        )
        .filter(
            is_overall
            | (is_label & F.col(BY_LABEL).isin(*labels))
            | (is_state & F.col(BY_STATE).isin(*states))
        )
        .select(
            F.when(is_overall, OVERALL)
            .when(is_label, BY_LABEL)
            .otherwise(BY_STATE)
            .alias("dimension"),
            F.when(is_overall, OVERALL)
            .when(is_label, F.col(BY_LABEL))
            .otherwise(F.col(BY_STATE))
            .alias("member"),
            "polarity",
            "subjectivity",
        )
    )
    groups = [(OVERALL, [OVERALL]), (BY_LABEL, labels), (BY_STATE, states)]
    members = literals.rows(
        sums.sparkSession,
        [
            {"dimension": dimension, "position": i, "member": member}
            for dimension, domain in groups
            for i, member in enumerate(domain)
        ],
        "dimension string, position int, member string",
    )
    bounded = _bounded(grouped, 1 + len(labels) + len(states))
    return members.join(bounded, ["dimension", "member"], "left").select(
        "dimension", "position", "member", *MEASURES
    )


def _bounded(grouped: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(grouped) if rows <= MAX_BROADCAST else grouped
