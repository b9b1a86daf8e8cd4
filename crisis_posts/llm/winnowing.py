"""Document fingerprints by winnowing, in Spark's own functions only.

A text is cut into words; a word of more than eight characters yields a piece of eight at each
of its positions, so that pieces don't depend on where a long word begins. Hashes of runs of
four pieces are built up from those of shorter runs. Of each window of eight such hashes the
smallest is chosen, the rightmost of equals, and kept with its position. So any passage of
eleven pieces that two texts share, as eleven words of up to eight characters or eighteen
characters without spaces, leaves a common hash in both fingerprints, and a hash's position
tells where.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# At each position: eight characters, or a whole shorter word.
_PIECE = r"(?=(\S{8}|(?<!\S)\S{1,7}(?!\S)))\S"
RUN = 4
WINDOW = 8
# A mark holds a hash's upper 40 bits and, below, its position counted downwards, so that the
# smallest mark of equal hashes is the rightmost. Positions start anew after 2**24 runs.
_POSITION_BITS = 24
_POSITION = (1 << _POSITION_BITS) - 1
_MOST_RANGES = 1_000


def _shifted(values: str, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def with_marks(table: DataFrame, text: str, marks: str) -> DataFrame:
    """Add the marks of a text column, in order of position; none for a text without words."""
    runs, windows, own = "_runs", "_windows", table.columns
    table = table.withColumn(runs, F.regexp_extract_all(text, F.lit(_PIECE), F.lit(1)))
    table = table.withColumn("_n", F.size(runs))
    table = table.withColumn(runs, F.transform(runs, lambda piece: F.xxhash64(piece)))
    width = 1
    while width < RUN:
        table = table.withColumn(
            runs, F.zip_with(runs, _shifted(runs, width), lambda a, b: F.xxhash64(a, b))
        )
        width *= 2
    count = F.greatest(F.col("_n") - (RUN - 1), F.least("_n", F.lit(1)))
    table = table.withColumn(
        windows,
        F.transform(
            F.slice(runs, 1, count),
            lambda h, i: h.bitwiseAND(F.lit(~_POSITION)).bitwiseOR(
                F.lit(_POSITION) - F.pmod(i.cast("long"), F.lit(_POSITION + 1))
            ),
        ),
    ).withColumn("_n", F.size(windows))
    width = 1
    while width < WINDOW:
        table = table.withColumn(
            windows, F.zip_with(windows, _shifted(windows, width), lambda a, b: F.least(a, b))
        )
        width *= 2
    count = F.greatest(F.col("_n") - (WINDOW - 1), F.least("_n", F.lit(1)))
    table = table.withColumn(marks, F.array_distinct(F.slice(windows, 1, count)))
    return table.select(*own, marks)


def spelled(marks: str) -> Column:
    """hash:position of each mark, comma-joined."""
    return F.array_join(
        F.transform(
            marks,
            lambda m: F.concat(
                F.hex(F.shiftrightunsigned(m, _POSITION_BITS)), F.lit(":"),
                (F.lit(_POSITION) - m.bitwiseAND(F.lit(_POSITION))).cast("string"),
            ),
        ),
        ",",
    )


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two fingerprints' hashes, 0 to 1; two empty ones are alike."""

    def hashes(marks: str) -> Column:
        return F.array_distinct(
            F.transform(marks, lambda m: F.shiftrightunsigned(m, _POSITION_BITS))
        )

    both = F.size(F.array_intersect(hashes(a), hashes(b)))
    either = F.size(F.array_union(hashes(a), hashes(b)))
    return F.when(either == 0, 1.0).otherwise(both / either)


def beside_next(documents: DataFrame) -> DataFrame:
    """(doc_id, text, marks, next_text, next_marks) by descending doc_id; the first follows the last.

    Documents meet in ranges of ids of about equal numbers, at most a thousand, whose bounds
    are ids that occur; the document at a range's upper bound is also dealt to the range
    above, where it stands after the last. Only the bounds reach the driver. Null texts count
    as empty; null ids come last; rows of equal id are ordered by text.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    steps = [i / _MOST_RANGES for i in range(1, _MOST_RANGES)]
    found = texts.agg(
        F.array_sort(F.array_distinct(F.percentile_approx("doc_id", steps))).alias("bounds"),
        F.max("doc_id").alias("first"),
    ).first()
    bounds = F.lit(found["bounds"] or []).cast("array<long>")
    own = F.size(F.filter(bounds, lambda bound: bound < F.col("doc_id")))
    # (range, place): 0 for the document itself, 1 behind a range's last, 2 behind the very last.
    places = F.array_compact(
        F.array(
            F.struct(own.alias("range"), F.lit(0).alias("place")),
            F.when(
                F.array_contains(bounds, F.col("doc_id")), F.struct((own + 1).alias("range"), F.lit(1).alias("place"))
            ),
            F.when(
                F.col("doc_id").eqNullSafe(F.lit(found["first"])), F.struct(F.lit(0).alias("range"), F.lit(2).alias("place"))
            ),
        )
    )
    dealt = texts.withColumn("dealt", F.explode(places)).select("doc_id", "text", "dealt.*")
    order = Window.partitionBy("range").orderBy("place", F.desc("doc_id"), "text")
    dealt = dealt.withColumn("next_text", F.lead("text").over(order))
    dealt = with_marks(dealt, "text", "marks")
    dealt = dealt.withColumn("next_marks", F.lead("marks").over(order))
    return dealt.where("place = 0").drop("range", "place")


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, text, marks): the fingerprint of each whole text; null texts count as empty."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_marks(texts, "text", "marks")
