"""Post dates: parsing, event phase, hour bucket, whole-day bounds.

Everything stays ``timestamp_ntz``: the wall clock written in the post is kept
whatever its offset or the session time zone.
"""

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from crisis_posts.functions.literals import text_map
from crisis_posts.schemas import PHASE_CUTS

MONTHS = (
    "january", "february", "march", "april", "may", "june", "july",
    "august", "september", "october", "november", "december",
)

_MONTH = "(?=(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + ") )([a-z]{3})[a-z]*"
_CLOCK = r"(\d{1,2}:\d{2}(?::\d{2})?)"

# Wed Sep 13 05:08:45 +0200 2017, or Wed, 13 Sep 2017 05:08:45 +0200; the weekday and the
# offset may be missing.
POST_DATE = (
    r"(?i)^\s*(?:[a-z]+,? +)?(?:"
    rf"{_MONTH} +(\d{{1,2}}) +{_CLOCK} +(?:[+-]\d{{4}} +)?(\d{{4}})"
    rf"|(\d{{1,2}}) +{_MONTH} +(\d{{4}}) +{_CLOCK}(?: .*)?"
    r")\s*$"
)
_YEAR_MONTH_DAY_CLOCK = "$4$7-$1$6-$2$5 $3$8"


def parse_post_date(created_at: Column) -> Column:
    """Mail-style or post-style date text to ``timestamp_ntz``; null if unreadable."""
    months = text_map({name[:3]: f"{number:02d}" for number, name in enumerate(MONTHS, 1)})

    def read(ordered: Column) -> Column:
        month = months[F.lower(F.substring(ordered, 6, 3))]
        iso = F.concat(F.left(ordered, F.lit(5)), month, F.substring(ordered, 9, 20))
        # Text that does not match the pattern is left as it was.
        return F.when(ordered != created_at, iso.try_cast("timestamp_ntz"))

    # The lambda names the replaced text, so the pattern runs once and not at each use.
    ordered = F.regexp_replace(created_at, POST_DATE, _YEAR_MONTH_DAY_CLOCK)
    return F.get(F.transform(F.array(ordered), read), F.lit(0))


def midnight(day: date | str) -> Column:
    """The zone-less start of a day. Takes a date or ISO day text, not a moment."""
    if isinstance(day, datetime):
        raise TypeError("expected a day, got a moment")
    if not isinstance(day, date):
        day = date.fromisoformat(day)
    return F.lit(day.isoformat()).cast("date").cast("timestamp_ntz")


def midnight_after(day: date | str) -> Column:
    return F.date_add(midnight(day).cast("date"), 1).cast("timestamp_ntz")


def phase(moment: Column, cuts: tuple[str, str] = PHASE_CUTS) -> Column:
    """0 before the first cut, 1 up to the second cut's midnight, else 2; null stays null."""
    start, end = midnight(cuts[0]), midnight(cuts[1])
    return F.when(moment < start, 0).when(moment <= end, 1).when(moment > end, 2)


def hour_bucket(moment: Column) -> Column:
    """End of the clock hour the post falls in, 1 to 24."""
    return F.hour(moment) + 1
