"""How the sources of a language differ in the terms they use, with exact integer arithmetic.

Terms are counted once for each (lang, source). A smoothed frequency depends on a count alone,
so the terms of a group that share (group count, lang count) are one cell: the difference is
evaluated per cell, cells of equal value are merged and ranked by their cumulative multiplicity,
and only cells that begin within the ranks asked for are expanded into terms, in UTF-8 order.
Sources are compared in blocks: each task holds some terms and two blocks of sources, takes equal
rows of counts as one cell, and gives partial sums that are added up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crisis_posts.llm.shared import map_rows, written

MIN_DOCS = 30
MOST_TERMS = 50
SMOOTHING = 5
SCALE = 1_000_000_000

# Terms are runs of ASCII letters and of bytes beyond ASCII; A-Z becomes a-z, the rest a space.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_ENTRIES = 500_000  # held by a task before it hands them on
_ROWS_AT_ONCE = 256
_DOC = 1 << 40
_BLOCK = 256  # sources
_CHUNK = 2_048  # terms


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), all names binary; a null term stands for the group itself.

    n counts occurrences and docs documents. Null lang, source and text are read as ''. Columns
    besides these three are not looked at; repeated rows count each time.
    """
    texts = documents.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    schema = "lang binary, source binary, term binary, n long, docs long"
    return texts.mapInArrow(_partial_counts, schema).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task, handed on whenever enough of them are held."""
    groups: dict[tuple, dict] = {}
    held = 0
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            rows = batch.slice(at, _ROWS_AT_ONCE).columns
            for lang, source, text in zip(*(c.cast(pa.binary()).to_pylist() for c in rows), strict=True):
                counts = groups.setdefault((lang, source), {})
                before = len(counts)
                counts[None] = counts.get(None, 0) + _DOC
                for term, n in Counter(text.translate(_TERM_BYTES).split()).items():
                    counts[term] = counts.get(term, 0) + n + _DOC
                held += len(counts) - before
            if held >= _ENTRIES:
                yield from _handed_on(groups)
                groups, held = {}, 0
    yield from _handed_on(groups)


def _handed_on(groups: dict[tuple, dict]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    for key, counts in groups.items():
        terms = iter(counts)
        while some := list(islice(terms, 1 << 16)):
            packed = np.fromiter(map(counts.__getitem__, some), np.int64, len(some))
            columns = [pa.repeat(pa.scalar(name, pa.binary()), len(some)) for name in key]
            columns += [pa.array(some, pa.binary()), pa.array(packed % _DOC), pa.array(packed // _DOC)]
            yield pa.RecordBatch.from_arrays(columns, names)


def frequency(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / total); total is the sum over terms, smoothed too."""
    return F.expr(
        f"1 + (cast({count} + {SMOOTHING} as decimal(20, 0)) * cast({SCALE} as decimal(10, 0)))"
        f" div cast({total} as decimal(20, 0))"
    )


def audit_sources(
    documents: DataFrame, min_docs: int = MIN_DOCS, most_terms: int = MOST_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank) for each (lang, source) that occurs.

    Each lang keeps the terms in at least min_docs of its documents. Part ``pair`` ranks the other
    sources of the lang by the summed differences of all kept terms, part ``term`` the kept terms
    of the group that are more frequent than in the lang as a whole, down to rank most_terms;
    ties go by the UTF-8 order of the items. A lang without kept terms has pairs of value 0, a
    lang of one source no pairs, an empty table no rows.
    """
    counts = written(term_counts(documents))
    kept = written(
        counts.where("term is not null").groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= min_docs).drop("docs")
    )
    used = written(counts.drop("docs").join(kept, ["lang", "term"]))
    groups = written(_groups(counts, kept, used))
    names = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "part", "item")]
    return (
        _pairs(used, groups).unionByName(_terms(used, groups, most_terms))
        .select(*names, "value", F.col("rank").cast("int").alias("rank"))
    )


def _groups(counts: DataFrame, kept: DataFrame, used: DataFrame) -> DataFrame:
    """Each group's place among the sources of its lang, and what its frequencies are taken of.

    A lang's sources meet in one task, where they are numbered; the result has their square.
    """
    of_lang = kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")
    )
    of_group = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = Window.partitionBy("lang")
    smoothed = SMOOTHING * F.col("terms")
    return (
        counts.where("term is null").select("lang", "source")
        .join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
        .fillna(0, ["terms", "lang_total", "total"])
        .withColumns({
            "total": F.col("total") + smoothed,
            "lang_total": F.col("lang_total") + smoothed,
            "place": F.row_number().over(sources.orderBy("source")) - 1,
            "sources": F.count("*").over(sources),
        })
        .withColumn("floor", F.when(F.col("terms") > 0, frequency("0", "total")).otherwise(0))
    )


def _terms(used: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """The terms of a group that its lang has less often, by cells of equal counts."""
    group = ["lang", "source"]
    cells = (
        used.groupBy(*group, "n", "lang_n").agg(F.count("*").alias("size"))
        .join(groups.select(*group, "total", "lang_total"), group)
        .withColumn("value", frequency("n", "total") - frequency("lang_n", "lang_total"))
        .where("value > 0").drop("total", "lang_total")
    )
    by_value = Window.partitionBy(*group).orderBy(F.desc("value"))
    values = (
        cells.groupBy(*group, "value").agg(F.sum("size").alias("size"))
        .withColumn("nth", F.row_number().over(by_value)).where(F.col("nth") <= most)
        .withColumn("before", F.sum("size").over(by_value) - F.col("size"))
        .where(F.col("before") < most).drop("size", "nth")
    )
    in_order = Window.partitionBy(*group, "value").orderBy("term")
    return (
        used.join(cells.drop("size").join(values, [*group, "value"]), [*group, "n", "lang_n"])
        .withColumn("nth", F.row_number().over(in_order)).where(F.col("nth") <= most)
        .withColumn("rank", F.col("before") + F.col("nth")).where(F.col("rank") <= most)
        .select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )


def _pairs(used: DataFrame, groups: DataFrame) -> DataFrame:
    """Summed differences of all pairs of sources of a lang, largest first."""
    spark = used.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.ceil(F.col("sources") / _BLOCK).cast("int")
    # A row meets each block of sources once, in the order of the two blocks.
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    block = F.floor(F.col("place") / _BLOCK).cast("int")
    here = groups.withColumn("block", block)
    placed = [
        "lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "shard", "term", "place", "value", "terms",
    ]
    floors = (
        here.select("*", other).select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        .withColumns({"term": F.lit(None).cast("binary"), "value": F.col("floor")}).select(*placed)
    )
    found = (
        used.join(here, ["lang", "source"]).select("*", other)
        .withColumns({
            "shard": F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"),
            "value": frequency("n", "total"),
        })
        .select(*placed)
    )
    key = ["lang", "low", "high", "shard"]
    dealt = floors.unionByName(found).repartition(*key).sortWithinPartitions(*key, "term", "place")
    sums = (
        map_rows(dealt, "lang binary, a int, b int, value long", _partial_sums)
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    named = groups.select("lang", F.col("place").alias("a"), "source")
    partner = groups.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.join(named, ["lang", "a"]).join(partner, ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(ranked).alias("rank"),
    )


class _BlockSums:
    """Differences of the sources of two blocks, summed over the terms of one shard."""

    def __init__(self, lang: bytes, low: int, high: int, shard: int):
        self.lang, self.same = lang, low == high
        self.starts = (low * _BLOCK,) if low == high else (low * _BLOCK, high * _BLOCK)
        self.shard, self.terms = shard, 0
        self.floors: list[tuple[int, int]] = []
        self.floor: np.ndarray | None = None
        self.last, self.cells = None, []  # (row, column, value) of the terms held
        self.row = -1

    def column(self, place: int) -> int:
        at = place - self.starts[-1]
        return place - self.starts[0] if self.same or at < 0 else _BLOCK + at

    def add(self, term: bytes | None, place: int, value: int, terms: int) -> None:
        if term is None:  # these come first
            self.floors.append((self.column(place), value))
            self.terms = terms
            return
        if self.floor is None:
            self._begin()
        if term != self.last:
            if self.row + 1 == _CHUNK:
                self._sum_up()
            self.row, self.last = self.row + 1, term
        self.cells.append((self.row, self.at[self.column(place)], value))

    def _begin(self) -> None:
        self.columns = sorted(column for column, _ in self.floors)
        self.at = {column: i for i, column in enumerate(self.columns)}
        self.floor = np.array([value for _, value in sorted(self.floors)], np.int64)
        self.split = sum(column < _BLOCK for column in self.columns)
        self.total = self._differences(self.floor[None, :], np.ones(1, np.int64))
        self.total *= self.terms if self.shard == 0 else 0

    def _differences(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        left = values if self.same else values[:, : self.split]
        right = values if self.same else values[:, self.split :]
        return np.stack([sizes @ np.abs(right - left[:, [i]]) for i in range(left.shape[1])])

    def _sum_up(self) -> None:
        n = self.row + 1
        values = np.tile(self.floor, (n, 1))
        rows, columns, found = zip(*self.cells, strict=True)
        values[list(rows), list(columns)] = found
        cells, sizes = np.unique(values, axis=0, return_counts=True)
        self.total += self._differences(cells, sizes)
        self.total -= n * self._differences(self.floor[None, :], np.ones(1, np.int64))
        self.row, self.cells = -1, []

    def sums(self) -> Iterator[tuple]:
        if self.floor is None:
            self._begin()
        if self.cells:
            self._sum_up()
        places = [self.starts[-1] + c - _BLOCK if c >= _BLOCK else self.starts[0] + c for c in self.columns]
        left, right = (places, places) if self.same else (places[: self.split], places[self.split :])
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                if a < b:
                    yield self.lang, a, b, int(self.total[i, j])


def _partial_sums(rows: Iterator[tuple]) -> Iterator[tuple]:
    now, block = None, None
    for lang, low, high, shard, *rest in rows:
        if now != (key := (lang, low, high, shard)):
            if block:
                yield from block.sums()
            now, block = key, _BlockSums(*key)
        block.add(*rest)
    if block:
        yield from block.sums()
