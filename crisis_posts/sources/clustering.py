"""Enriched posts stored so that a filter on any one of several columns skips most row groups.

Each clustered column is ranked by cuts at its own quantiles, and the ranks' bits are interleaved
to one key, by which posts are dealt to files and sorted in them. The smallest and largest values
that Parquet keeps for a row group are then close together in every clustered column, and not
only in the first one as after a plain sort.

The cuts come from one mergeable sketch per column, summed on the map side: at most ``2^bits - 1``
numbers a column reach the driver, whatever the posts. They change where rows lie, never which.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLUSTERED = ("aidr_label", "place_state", "date", "verified", "possibly_sensitive")
MOST_BITS = 6
_KEY_BITS = 62
# Bytes of a text that its rank looks at: as many as a double counts without error.
_TEXT_BYTES = 6
_ACCURACY = 10_000


def ordinal(posts: DataFrame, column: str) -> Column:
    """A number that grows with the column: days of dates, the first bytes of texts."""
    kind = posts.schema[column].dataType
    if isinstance(kind, T.StringType):
        first = F.rpad(F.substring(F.encode(column, "UTF-8"), 1, _TEXT_BYTES), _TEXT_BYTES, F.lit(b"\x00"))
        return F.conv(F.hex(first), 16, 10).cast("double")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.unix_date(F.col(column).cast("date")).cast("double")
    if isinstance(kind, (T.BooleanType, T.NumericType)):
        return F.col(column).cast("double")
    raise TypeError(f"{column} is {kind.simpleString()}, which has no rank")


def quantile_cuts(
    posts: DataFrame, columns: Sequence[str] = CLUSTERED, bits: int = MOST_BITS
) -> dict[str, list[float]]:
    """The distinct values at up to ``2^bits - 1`` quantiles of each column, in one pass."""
    shares = F.lit([i / 2**bits for i in range(1, 2**bits)])
    found = posts.agg(
        *(F.percentile_approx(ordinal(posts, c), shares, _ACCURACY).alias(c) for c in columns)
    ).first()
    return {c: sorted(set(found[c] or ())) for c in columns}


def interleaved(posts: DataFrame, cuts: Mapping[str, Sequence[float]]) -> Column:
    """The ranks' bits as one number, highest bits of all columns first. A null ranks lowest.

    A column takes as many bits as its cuts can use, so a flag takes its two and leaves the
    others to columns that have more values; ranks are spread over them, so that a first bit halves.
    """
    widths = {c: (len(known) + 1).bit_length() for c, known in cuts.items()}
    if sum(widths.values()) > _KEY_BITS:
        raise ValueError(f"ranks of {widths} do not fit into {_KEY_BITS} bits")
    key = F.lit(0).cast("long")
    ranks = {
        c: F.floor(_rank(ordinal(posts, c), known) * 2 ** widths[c] / (len(known) + 2))
        for c, known in cuts.items()
    }
    for level in range(max(widths.values(), default=0)):
        for column, width in widths.items():
            if level < width:
                bit = F.shiftright(ranks[column], width - 1 - level).bitwiseAND(F.lit(1).cast("long"))
                key = key * 2 + bit
    return key


def _rank(value: Column, cuts: Sequence[float]) -> Column:
    """0 for a null, else 1 and the number of cuts below the value."""
    below = F.size(F.filter(F.lit(list(cuts)), lambda cut: cut < value)) if cuts else F.lit(0)
    return F.when(value.isNull(), 0).otherwise(below + 1).cast("long")


def write_clustered(
    posts: DataFrame,
    path: str,
    files: int,
    columns: Sequence[str] = CLUSTERED,
    bits: int = MOST_BITS,
    row_group_bytes: int | None = None,
) -> None:
    """Write posts as ``files`` Parquet files, clustered by ``columns``; read as any enriched table.

    The posts are read three times: for the cuts, for the bounds of the files, to be written. Posts
    with equal keys are dealt out by a digest of the row, so a label, state and day that hold a
    third of all posts fill a third of the files.
    """
    cuts = quantile_cuts(posts, columns, bits)
    keyed = posts.withColumns({"_key": interleaved(posts, cuts), "_salt": F.xxhash64(*posts.columns)})
    dealt = keyed.repartitionByRange(files, "_key", "_salt").sortWithinPartitions("_key")
    writer = dealt.drop("_key", "_salt").write.mode("overwrite")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def file_ranges(posts: DataFrame, columns: Sequence[str] = CLUSTERED) -> DataFrame:
    """(file, posts, smallest and largest of each column) of a stored table: what filters can skip."""
    return posts.groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("posts"),
        *(f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))),
    )
