"""A pyramid of map tiles: markers counted in quadtree cells, from the whole world down.

A map shows cells of the level that suits its box, so what it draws is bounded by the box and not
by the posts. Cells are counts and sums: those of different batches of posts add up.

Level 0 is one cell; each level halves both sides. Cells are numbered from the north-west corner,
``x`` to the east and ``y`` to the south, over degrees of longitude and latitude.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions.texts import sentiment_band
from crisis_posts.schemas import BAND_BOUNDS, BAND_NAMES

DEEPEST = 16
KEYS = ("level", "x", "y")
_BANDS = tuple(f"n_{band}" for band in BAND_NAMES)
_SUMS = ("n", *_BANDS, "n_scored", "sum_polarity", "sum_subjectivity", "sum_latitude", "sum_longitude")


def _cell(degrees: Column, span: int, level: int) -> Column:
    """The half-open strip of a coordinate that starts at 0; what lies outside falls in the last one."""
    strip = F.floor(degrees / float(span) * float(2**level)).cast("long")
    return F.least(F.greatest(strip, F.lit(0)), F.lit(2**level - 1)).cast("long")


def tile_pyramid(
    posts: DataFrame,
    latitude: str = "latitude",
    longitude: str = "longitude",
    deepest: int = DEEPEST,
    bounds: tuple[float, float] = BAND_BOUNDS,
) -> DataFrame:
    """One row per level and cell that holds posts, from level 0 to ``deepest``.

    ``n`` and the bands count the posts that have both coordinates, as the marker tables do; a
    coordinate that is NaN is none. Posts are counted in the deepest cells first, on the map side;
    only those cells are repeated for the levels above.
    """
    placed = posts.filter(
        F.col(latitude).isNotNull() & F.col(longitude).isNotNull()
        & ~F.isnan(latitude) & ~F.isnan(longitude)
    )
    band = sentiment_band(F.col("sentiment_polarity"), bounds)
    scored = F.col("sentiment_polarity").isNotNull() & F.col("sentiment_subjectivity").isNotNull()
    cells = (
        placed.groupBy(
            _cell(F.col(longitude) + 180.0, 360, deepest).alias("x"),
            _cell(90.0 - F.col(latitude), 180, deepest).alias("y"),
        )
        .agg(
            F.count("*").alias("n"),
            *(F.count_if(band == name).alias(f"n_{name}") for name in BAND_NAMES),
            F.count_if(scored).alias("n_scored"),
            *(F.sum(F.when(scored, F.col(f"sentiment_{m}"))).alias(f"sum_{m}") for m in ("polarity", "subjectivity")),
            F.sum(latitude).alias("sum_latitude"),
            F.sum(longitude).alias("sum_longitude"),
        )
    )
    levels = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
    above = F.expr(f"{deepest} - level")
    return merge_pyramids(
        levels.withColumns({c: F.call_function("shiftright", F.col(c), above) for c in ("x", "y")})
    )


def merge_pyramids(cells: DataFrame) -> DataFrame:
    """Add up cells of the same level and place, of any number of batches, in any order."""
    return cells.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in _SUMS))


def write_pyramid(cells: DataFrame, path: str) -> None:
    """A folder for each level, cells near to each other in the same files: a box reads few of them."""
    cells.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS).write.mode("overwrite").partitionBy(
        "level"
    ).parquet(path)


def strips(level: int, west: float, south: float, east: float, north: float) -> tuple[int, int, int, int]:
    """(first x, first y, last x, last y) of the cells that a box touches."""
    if west > east or south > north:
        raise ValueError("a box goes from west to east and from south to north")

    def at(degrees: float, span: int) -> int:
        return min(max(int(degrees / span * 2**level // 1), 0), 2**level - 1)

    return at(west + 180, 360), at(90 - north, 180), at(east + 180, 360), at(90 - south, 180)


def level_for(
    west: float, south: float, east: float, north: float, most: int, deepest: int = DEEPEST
) -> int:
    """The deepest level at which a box touches at most ``most`` cells (level 0 has one)."""
    for level in range(deepest, 0, -1):
        x0, y0, x1, y1 = strips(level, west, south, east, north)
        if (x1 - x0 + 1) * (y1 - y0 + 1) <= most:
            return level
    return 0


def box_markers(
    cells: DataFrame,
    west: float,
    south: float,
    east: float,
    north: float,
    most: int = 2_000,
    deepest: int = DEEPEST,
) -> DataFrame:
    """At most ``most`` markers for a box: one for each cell it touches, at the mean of its posts.

    ``deepest`` is the pyramid's. ``n`` and the bands sum to the posts of those cells. The conditions are plain comparisons of
    level, x and y, so they reach the scan of a stored pyramid.
    """
    level = level_for(west, south, east, north, most, deepest)
    x0, y0, x1, y1 = strips(level, west, south, east, north)
    inside = (F.col("level") == level) & F.col("x").between(x0, x1) & F.col("y").between(y0, y1)
    return cells.filter(inside).select(
        *KEYS, "n", *_BANDS,
        (F.col("sum_latitude") / F.col("n")).alias("latitude"),
        (F.col("sum_longitude") / F.col("n")).alias("longitude"),
        *(F.try_divide(F.col(f"sum_{m}"), F.col("n_scored")).alias(m) for m in ("polarity", "subjectivity")),
    )
