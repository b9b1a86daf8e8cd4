"""Filtered selections of the enriched posts and what is reported about them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions.dates import midnight, midnight_after
from crisis_posts.operators import means
from crisis_posts.schemas import AIDR_LABELS, PHASE_CODES, US_STATES

if TYPE_CHECKING:
    import pandas as pd

Day = date | str | None


def in_list(column: str, members: Sequence | None) -> list[Column]:
    """No condition for no members; a null never matches."""
    return [F.col(column).isin(*members)] if members else []


def on_days(first: Day, last: Day) -> list[Column]:
    """One whole day, or first to last with both days whole.

    A last day without a first one selects nothing, as a comparison with null would.
    The bounds are plain comparisons of ``date``, so they reach the scan.
    """
    if first is None:
        return [] if last is None else [F.lit(False)]
    end = first if last is None else last
    return [F.col("date") >= midnight(first), F.col("date") < midnight_after(end)]


def flag_is(column: str, wanted: str | bool | None) -> list[Column]:
    """``"True"`` or ``"False"`` (or the booleans); anything else is no condition."""
    flag = {"True": True, "False": False}.get(str(wanted))
    return [] if flag is None else [F.col(column) == F.lit(flag)]


def in_phases(names: Sequence[str] | None) -> list[Column]:
    unknown = set(names or ()) - PHASE_CODES.keys()
    if unknown:
        raise ValueError(f"unknown phase {sorted(unknown)}; known: {list(PHASE_CODES)}")
    return in_list("phase", [PHASE_CODES[name] for name in names or ()])


def conditions(
    labels: Sequence[str] | None = None,
    verified: str | bool | None = None,
    created_at: Day = None,
    created_at_end: Day = None,
    possibly_sensitive: str | bool | None = None,
    place: Sequence[str] | None = None,
    phase: Sequence[str] | None = None,
) -> tuple[Column, ...]:
    """The conditions that are set; ``None`` and an empty list set none."""
    return (
        *in_list("aidr_label", labels),
        *flag_is("verified", verified),
        *flag_is("possibly_sensitive", possibly_sensitive),
        *on_days(created_at, created_at_end),
        *in_list("place_state", place),
        *in_phases(phase),
    )


@dataclass(frozen=True)
class PostQuery:
    """A selection of posts. Immutable: narrowing it gives another query."""

    posts: DataFrame
    filters: tuple[Column, ...] = ()

    def where(self, **filters) -> PostQuery:
        """Start afresh from all posts with the filters of ``conditions``."""
        return replace(self, filters=conditions(**filters))

    def refine(self, **filters) -> PostQuery:
        """Narrow the current selection further."""
        return replace(self, filters=self.filters + conditions(**filters))

    def rows(self) -> DataFrame:
        return self.posts.filter(reduce(and_, self.filters)) if self.filters else self.posts

    def size(self) -> DataFrame:
        return self.rows().agg(F.count("*").alias("n"))

    def preview(self, n: int) -> pd.DataFrame:
        """The first ``n`` rows met, on the driver."""
        return self.rows().limit(n).toPandas()

    def means(self) -> DataFrame:
        return means.overall_means(self.rows())

    def means_by(self, column: str, domain: Sequence[str]) -> DataFrame:
        return means.means_by(self.rows(), column, domain)

    def all_means(
        self,
        labels: Sequence[str] = AIDR_LABELS,
        states: Sequence[str] = tuple(US_STATES.values()),
    ) -> DataFrame:
        return means.all_means(self.rows(), labels, states)

    # The same means as plain lists: one value pair per domain member, in order.

    def mean_polarity(self) -> list[float | None]:
        return list(self.means().first())

    def mean_label_polarity(self, labels: Sequence[str] = AIDR_LABELS) -> list[list[float | None]]:
        return _pairs(self.means_by("aidr_label", labels))

    def mean_state_polarity(
        self, states: Sequence[str] = tuple(US_STATES.values())
    ) -> list[list[float | None]]:
        return _pairs(self.means_by("place_state", states))


def _pairs(table: DataFrame) -> list[list[float | None]]:
    return [[row.polarity, row.subjectivity] for row in table.collect()]
