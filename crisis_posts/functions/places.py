"""Points and states from the place and coordinates of a post.

``get`` gives null where an array is too short; a bare index would abort the job.
"""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from crisis_posts.functions.literals import text_map
from crisis_posts.schemas import US_STATES


def place_point(bounding_box: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of the first corner of the first ring."""
    corner = F.get(F.get(bounding_box, F.lit(0)), F.lit(0))
    return F.get(corner, F.lit(1)), F.get(corner, F.lit(0))


def exact_point(position: Column) -> tuple[Column, Column]:
    """(longitude, latitude): positions are stored in that order."""
    return F.get(position, F.lit(0)), F.get(position, F.lit(1))


def place_state(
    country_code: Column,
    place_type: Column,
    place_name: Column,
    states: Mapping[str, str] = US_STATES,
) -> Column:
    """State code of a US place, else null.

    A state-level place is looked up by name in ``states``. A city's second name
    part is taken as it stands, unchecked.
    """
    parts = F.split(place_name, ", ")
    by_type = F.when(place_type == "admin", text_map(states)[F.get(parts, F.lit(0))]).when(
        place_type == "city", F.get(parts, F.lit(1))
    )
    return F.when(country_code == "US", by_type)
