"""Look up every word of a post in a word table without exploding or shuffling posts.

A table of checked size travels with the tasks as one constant: an array of small
maps, a word's slot being its hash, so a look-up does not scan the table. Posts are
then scored in the task that reads them. A larger table is first cut to the words that occur
in the posts, which are counted on the map side. Only if those are too many as well is the
table joined to the exploded words, by whatever join its size asks for, and each text gets a
small map of the words found, which is read in the same way. All ways give the same arrays. The sizes are counted when the plan is built: one job over the table and, for a large
table only, one over the texts.

The explodes are outer ones: for an inner one the optimizer first tests for empty arrays,
which computes the words twice.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 50_000
MAX_BYTES = 4 * 1024 * 1024


def unique_words(table: DataFrame, word: str, value: Column) -> DataFrame:
    """One row per non-null ``word`` with the ``value`` aggregate over its rows."""
    return table.filter(F.col(word).isNotNull()).groupBy(word).agg(value.alias("value"))


def rows_if_small(
    table: DataFrame, word: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> int | None:
    """The number of rows, counted, of a table that may travel with the tasks; else None."""
    row_bytes = F.octet_length(F.to_json(F.struct(word, "value")))
    size = (
        table.limit(max_rows + 1)
        .agg(F.count("*").alias("rows"), F.sum(row_bytes).alias("bytes"))
        .first()
    )
    return size.rows if size.rows <= max_rows and (size.bytes or 0) <= max_bytes else None


class Lookup:
    """Posts whose words can be looked up in a table of unique ``word`` and ``value`` columns.

    ``derive`` adds columns that come from the column ``text`` alone, ``asked`` adds to these
    the array ``_asked`` of all words that may be looked up; it is called for a large table only. ``posts``
    has the derived columns, and ``close`` takes away what the look-up has added.
    """

    def __init__(
        self, posts: DataFrame, text: str, derive: Callable[[DataFrame], DataFrame],
        asked: Callable[[DataFrame], DataFrame], table: DataFrame, word: str, max_rows: int,
    ):
        derived = derive(posts)
        self._table, self._word = table, word
        self._rows = rows_if_small(table, word, max_rows)
        if self._rows is None:
            if posts.isStreaming:
                raise ValueError("arriving posts need a word table that may travel with the tasks; raise max_rows")
            occurring = _words_asked(asked(derived), word).distinct()
            cut = table.join(occurring, word, "left_semi")
            self._rows = rows_if_small(cut, word, max_rows)
            if self._rows is not None:
                self._table = cut
        if self._rows is None:
            derived = _joined(posts, text, derive, asked, table, word)
        self.posts = derived

    def add(self, out: str, found: Callable[[Callable[[Column], Column]], Column]) -> None:
        """Add the column ``out``; ``found`` makes it of a function from a word to its value or null."""
        if self._rows is None:
            last = F.size("_maps") - 1
            value = lambda w: F.get("_maps", F.hash(w).bitwiseAND(last))[w]
            self.posts = self.posts.withColumn(out, found(value))
            return
        slots = 1 << (4 * self._rows).bit_length()
        self.posts = (
            self.posts.withColumn("_constant", _constant(self._table, self._word, slots))
            .withColumn(out, found(lambda w: F.get("_constant", slot_of(w, slots))[w]))
            .drop("_constant")
        )

    def add_values(self, words: str, out: str) -> None:
        """Add the array ``out``, parallel to the array ``words``: each word's value or null."""
        self.add(out, lambda value: F.transform(words, value))

    def add_hits(self, words: str, out: str) -> None:
        """Add the array ``out`` of struct(position, value): the words the table holds, in order."""

        def hits(value):
            every = F.transform(
                words, lambda w, i: F.struct(i.alias("position"), value(w).alias("value"))
            )
            return F.filter(every, lambda x: x["value"].isNotNull())

        self.add(out, hits)

    def close(self) -> DataFrame:
        return self.posts.drop("_maps")


def _joined(
    posts: DataFrame, text: str, derive: Callable[[DataFrame], DataFrame],
    asked: Callable[[DataFrame], DataFrame], table: DataFrame, word: str,
) -> DataFrame:
    """For a table of any size: the derived posts and ``_maps``, what the table holds of their words.

    Each different word of a text is asked for once, and the posts that meet the answers hold the text
    only: what is derived from it is derived again, as it is far wider. Copies of a text fold into one
    set on the map side.
    """
    keyed = posts.withColumn("_digest", _digest(text))
    answers = (
        _words_asked(asked(derive(keyed)), word, "_digest").join(table, word)
        .groupBy("_digest")
        .agg(F.collect_set(F.struct(word, "value")).alias("_answers"))
    )
    met = keyed.join(answers, "_digest", "left").withColumn("_maps", _slotted("_answers", word))
    return derive(met.drop("_digest", "_answers"))


def _words_asked(posts: DataFrame, word: str, *columns: str) -> DataFrame:
    """A row for each different word that a post asks for."""
    return posts.select(*columns, F.explode_outer(F.array_distinct("_asked")).alias(word))


def _slotted(entries: str, word: str) -> Column:
    """An array of maps, one per slot; about as many slots as entries in a slot."""
    slots = F.pow(F.lit(2), F.floor(F.log2(F.greatest(F.size(entries), F.lit(1))) / 2)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), slots - 1),
        lambda s: F.map_from_entries(
            F.filter(entries, lambda e: F.hash(e[word]).bitwiseAND(slots - 1) == s)
        ),
    )


def _digest(text: str) -> Column:
    """Stands for a text as a key, where copies may be treated as one."""
    return F.unhex(F.sha2(F.col(text), 256))


def slot_of(word: Column, slots: int) -> Column:
    """The hash of a word cut to ``slots``, a power of two."""
    return F.hash(word).bitwiseAND(F.lit(slots - 1))


def _constant(table: DataFrame, word: str, slots: int) -> Column:
    """The whole (small) table as a scalar subquery: an array of maps, one per slot."""
    return by_slot(
        table, word, slots, F.collect_list(F.struct(word, "value")), F.map_from_entries
    )


def by_slot(
    table: DataFrame, word: str, slots: int, of_slot: Column, entry: Callable[[Column], Column]
) -> Column:
    """A scalar subquery: an array of ``entry`` of each slot's aggregate, null where it has no rows."""
    filled = table.groupBy(slot_of(F.col(word), slots).alias("slot")).agg(of_slot.alias("of_slot"))
    every = table.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    in_order = F.sort_array(F.collect_list(F.struct("slot", "of_slot")))
    array = F.transform(in_order, lambda s: entry(s["of_slot"]))
    return every.join(filled, "slot", "left").agg(array).scalar()
