"""The tables behind the result page: markers, points, result rows, captions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions.texts import sentiment_band
from crisis_posts.schemas import BAND_BOUNDS

RESULT_COLUMNS = (
    "aidr_label", "name", "screen_name", "date", "verified", "latitude", "longitude",
    "place_name", "place_latitude", "place_longitude", "possibly_sensitive",
    "sentiment_polarity", "sentiment_subjectivity", "favorite_count", "text", "phase",
)


def _marker_columns(bounds: tuple[float, float]) -> list[Column]:
    return [
        sentiment_band(F.col("sentiment_polarity"), bounds).alias("band"),
        F.col("sentiment_polarity"),
        F.col("sentiment_subjectivity"),
    ]


def exact_markers(posts: DataFrame, bounds: tuple[float, float] = BAND_BOUNDS) -> DataFrame:
    """One marker per post with an exact point."""
    return posts.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "latitude", "longitude", *_marker_columns(bounds)
    )


def place_markers(posts: DataFrame, bounds: tuple[float, float] = BAND_BOUNDS) -> DataFrame:
    """One marker per post with a place point."""
    return posts.filter(
        F.col("place_latitude").isNotNull() & F.col("place_longitude").isNotNull()
    ).select("place_latitude", "place_longitude", *_marker_columns(bounds), "place_name")


def subjectivity_points(posts: DataFrame) -> DataFrame:
    return posts.select("sentiment_polarity", "sentiment_subjectivity")


def label_points(posts: DataFrame) -> DataFrame:
    return posts.select("aidr_label", "sentiment_polarity")


def state_points(posts: DataFrame) -> DataFrame:
    return posts.select("place_state", "sentiment_polarity")


def result_table(posts: DataFrame) -> DataFrame:
    return posts.select(*RESULT_COLUMNS)


def four_decimals(name: str) -> Column:
    """A number with four decimals, rounded by its exact value; exact ties go to the even digit.

    Spark's own formats round the shortest decimal that reads as the number. Here a number is
    compared with the midpoint of its neighbours, and where it is the double nearest to that
    midpoint, with the midpoint's exact value: what the division left over, which products of
    a short factor give without error.
    """
    # Beyond this size a double has no four decimals to speak of; NaN has none either.
    size = F.when(F.abs(name) < 1e9, F.abs(name))
    below = F.floor(size * 10_000).cast("long")
    # Multiplying may round up to the next whole number; the midpoint below is then passed.
    below = F.when(size < below / F.lit(10_000.0), below - 1).otherwise(below)
    odd = (below * 2 + 1).cast("double")
    midpoint = odd / 20_000.0
    high = (midpoint * 32).cast("float").cast("double")
    left = (odd - high * 625) - (midpoint * 32 - high) * 625
    up = (size > midpoint) | (
        (size == midpoint) & ((left < 0) | ((left == 0) & (below % 2 == 1)))
    )
    digits = below + F.when(up, 1).otherwise(0)
    text = F.concat(
        F.when(F.col(name).cast("string").startswith("-"), "-").otherwise(""),
        F.floor(digits / 10_000).cast("string"),
        F.lit("."),
        F.lpad((digits % 10_000).cast("string"), 4, "0"),
    )
    return F.coalesce(text, F.format_string("%.4f", name))


def mean_captions(
    table: DataFrame, missing: str = "no data", bounds: tuple[float, float] = BAND_BOUNDS
) -> DataFrame:
    """Add ``band`` and ``caption`` (four decimals each) to a table of means.

    Decimals are those of the exact value, as ``%.4f`` gives them in C and Python.
    """
    known = F.col("polarity").isNotNull()
    text = F.concat_ws(", ", *(four_decimals(name) for name in ("polarity", "subjectivity")))
    return table.withColumns(
        {
            "band": F.when(known, sentiment_band(F.col("polarity"), bounds)),
            "caption": F.when(known, text).otherwise(missing),
        }
    )
