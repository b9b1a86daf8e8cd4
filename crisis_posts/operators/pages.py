"""Result pages by a total order and the last row seen, so that no page is counted through.

A page begins after the last row of the one before. What it costs does not grow with its number: its
condition reaches the scan, and each task keeps one page of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import isnan
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

ORDER = ("date",)
DIGEST = "_row_digest"


@dataclass(frozen=True)
class Cursor:
    """The order's values of the last row seen, and how many rows with just these were seen."""

    values: tuple
    seen: int


@dataclass(frozen=True)
class Page:
    rows: list[Row]
    after: Cursor | None  # None where no row follows


def _with_digest(posts: DataFrame) -> DataFrame:
    """A digest of the whole row breaks ties, so that rows of one place in the order are equal."""
    whole = F.to_json(F.struct(*(F.col(f"`{c}`") for c in posts.columns)), {"ignoreNullFields": "false"})
    return posts.withColumn(DIGEST, F.sha2(whole, 256))


def _from(order: Sequence[str], values: tuple) -> Column:
    """The rows at or after ``values`` in ascending order, nulls first."""
    after: list[Column] = []
    same: list[Column] = []
    for name, value in zip(order, values, strict=True):
        here = F.col(f"`{name}`")
        after.append(reduce(and_, [*same, F.coalesce(_above(here, value), F.lit(False))]))
        same.append(F.isnan(here) if _is_nan(value) else here.eqNullSafe(F.lit(value)))
    found = reduce(or_, [*after, reduce(and_, same)])
    if values[0] is None or isinstance(values[0], float):
        return found
    # Follows from the rest; said alone, it is what the scan can use.
    return (F.col(f"`{order[0]}`") >= F.lit(values[0])) & found


def _above(here: Column, value: object) -> Column:
    """NaN comes last. It is named, as the bounds that a store keeps of its rows leave NaN out."""
    if value is None:
        return here.isNotNull()
    if _is_nan(value):
        return F.lit(False)
    return (here > F.lit(value)) | F.isnan(here) if isinstance(value, float) else here > F.lit(value)


def _is_nan(value: object) -> bool:
    return isinstance(value, float) and isnan(value)


def page(
    posts: DataFrame, size: int, after: Cursor | None = None, order: Sequence[str] = ORDER
) -> Page:
    """The next ``size`` rows after a cursor, by ``order`` (nulls first), then a digest of the row.

    Rows may repeat: a cursor counts how many equal ones were seen, and only for those the work
    grows. Posts added or gone between two pages shift no other row.
    """
    if size < 1:
        raise ValueError("a page has at least one row")
    keys = (*order, DIGEST)
    table = _with_digest(posts)
    chosen = table.filter(_from(keys, after.values)) if after else table
    skipped = after.seen if after else 0
    # One row more tells whether another page follows.
    found = (
        chosen.orderBy(*(F.col(f"`{key}`").asc_nulls_first() for key in keys))
        .offset(skipped).limit(size + 1).collect()
    )
    rows = found[:size]
    plain = [Row(**{c: row[c] for c in posts.columns}) for row in rows]
    if len(found) <= size:
        return Page(plain, None)
    last = tuple(rows[-1][key] for key in keys)
    same = sum(row[DIGEST] == last[-1] for row in rows)
    if after and last[-1] == after.values[-1]:
        same += after.seen
    return Page(plain, Cursor(last, same))


def pages(posts: DataFrame, size: int, order: Sequence[str] = ORDER) -> Iterator[Page]:
    """All pages, one after the other; each is fetched when it is asked for."""
    after = None
    while True:
        found = page(posts, size, after, order)
        yield found
        after = found.after
        if after is None:
            return
