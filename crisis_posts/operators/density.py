"""Density bins behind the point charts: counts per cell of the chart, and correlations from them.

A chart of every post grows with the posts; its bins do not. Each bin keeps the sums that a
correlation needs, so the coefficient of any part of the bins, or of bins of several batches added
up, is exact and not one of bin middles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLARITY = ("sentiment_polarity", -1.0, 1.0)
SUBJECTIVITY = ("sentiment_subjectivity", 0.0, 1.0)
BINS = 40
_SUMS = ("n", "n_pairs", "sum_x", "sum_y", "sum_xx", "sum_yy", "sum_xy")


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """The half-open bin from 0 on; the last holds ``high`` too, and each end what lies beyond it.

    A null and NaN have none.
    """
    place = F.floor((value - low) / (high - low) * float(bins)).cast("int")
    return F.when(value.isNotNull() & ~F.isnan(value), F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)))


def density(
    posts: DataFrame,
    x: tuple[str, float, float] = POLARITY,
    y: tuple[str, float, float] = SUBJECTIVITY,
    by: Sequence[str] = (),
    bins: int = BINS,
) -> DataFrame:
    """One row per group of ``by``, bin of x and bin of y that has posts, null bins included.

    ``x`` and ``y`` are (column, low, high). ``n`` counts all posts, so it sums to them; the other
    sums are over the ``n_pairs`` posts that have both numbers. At most (bins + 1)^2 rows a group.
    """
    first, second = (F.nanvl(F.col(axis[0]), F.lit(None).cast("double")) for axis in (x, y))
    pair = first.isNotNull() & second.isNotNull()
    terms = {
        "sum_x": first, "sum_y": second,
        "sum_xx": first * first, "sum_yy": second * second, "sum_xy": first * second,
    }
    return posts.groupBy(
        *by, bin_of(F.col(x[0]), *x[1:], bins).alias("x_bin"), bin_of(F.col(y[0]), *y[1:], bins).alias("y_bin")
    ).agg(
        F.count("*").alias("n"), F.count_if(pair).alias("n_pairs"),
        *(F.coalesce(F.sum(F.when(pair, term)), F.lit(0.0)).alias(name) for name, term in terms.items()),
    )


def histogram(
    posts: DataFrame,
    by: str,
    x: tuple[str, float, float] = POLARITY,
    bins: int = BINS,
) -> DataFrame:
    """(by, x_bin, n, total) of the charts of one number against a label or state.

    ``total`` is the sum of the numbers. Only labels and states that occur give rows.
    """
    number = F.nanvl(F.col(x[0]), F.lit(None).cast("double"))
    return posts.groupBy(by, bin_of(F.col(x[0]), *x[1:], bins).alias("x_bin")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(number), F.lit(0.0)).alias("total")
    )


def merge_density(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add up bins of several batches."""
    return cells.groupBy(*by, "x_bin", "y_bin").agg(*(F.sum(c).alias(c) for c in _SUMS))


def correlation(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, n_pairs, correlation): Pearson's coefficient of each group, or of all posts.

    Null for fewer than two pairs and where either number never changes: a spread that is within
    the rounding of its sums counts as none.
    """
    grouped = cells.groupBy(*by).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS))
    n = F.col("n_pairs")

    def spread(squares: str, total: str) -> Column:
        found = n * F.col(squares) - F.col(total) * F.col(total)
        return F.when(found > n * F.col(squares) * 1e-12, found)

    over = n * F.col("sum_xy") - F.col("sum_x") * F.col("sum_y")
    under = F.sqrt(spread("sum_xx", "sum_x")) * F.sqrt(spread("sum_yy", "sum_y"))
    return grouped.select(*by, "n", "n_pairs", F.when(n > 1, over / under).alias("correlation"))
