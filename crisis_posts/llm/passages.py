"""Removal of repeated passages, by windows that meet at recurring phrases.

A window is 50 consecutive words of a document. Each window has an anchor, the phrase of 16
words in it whose hash is smallest (the rightmost of equals), so a window that two documents
share has the same anchor in both. Neighbouring windows with one anchor form a context.

1. Anchors that occur in several documents are recurring; a bitmap of fixed size marks them.
2. Documents yield the contexts of marked anchors. A task sends the words of equal contexts
   once, with the smallest doc_id; each occurrence is a row of its own without words.
3. Each window of a context gets the smallest doc_id that holds it. Contexts of an anchor
   that has few meet in one task and are compared as words; those of an anchor that has many
   are cut into windows, which meet by a 128-bit digest of their words, as contexts do.
4. Each occurrence looks up its context; words under a window that starts in a smaller
   doc_id go.

A false mark in the bitmap only sends a context too many. There is no automaton: anchors
tell where phrases recur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crisis_posts.llm.shared import map_rows, run_hashes, word_hashes, written

WINDOW = 50
PHRASE = 16
_BITMAP_BITS = 26
_HELD_CONTEXTS = 20_000
# Anchors with more rows of contexts than this never meet in one task.
_WIDE_ROWS = 1_000
_RUNS = "anchor long, context binary, runs array<struct<first:long,last:long,doc_id:long>>"


def anchors(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of each anchor of a text."""
    hashes = run_hashes(word_hashes(text or b""), PHRASE)
    span = WINDOW - PHRASE + 1
    if len(hashes) < span:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)
    low = np.uint64(0xFFFFFFFF)
    least = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    place = (low - (least & low)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(place) - 1]])
    return hashes[place[first]], place[first], first, last


def _recurring(documents: DataFrame) -> np.ndarray:
    """Bitmap over hashes: a bit is set if an anchor with it occurs in several documents."""

    def rows_of(rows):
        for doc, text in rows:
            yield doc, np.unique(anchors(text)[0]).view(np.int64)

    found = map_rows(documents, "doc_id long, anchors array<long>", rows_of)
    bit = F.pmod("anchor", F.lit(1 << _BITMAP_BITS))
    words = (
        found.select("doc_id", F.explode("anchors").alias("anchor"))
        .groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high")
        .select(F.shiftright(bit, 3).alias("byte"), F.pmod(bit, F.lit(8)).cast("int").alias("bit"))
        .groupBy("byte").agg(F.expr("bit_or(shiftleft(1, bit))").alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (_BITMAP_BITS - 3), np.uint8)
    bitmap[words["byte"].to_numpy()] = words["bits"].to_numpy()
    return bitmap


def _contexts(documents: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Occurrences (anchor, context, doc_id, start) and contexts' words (anchor, context, doc_id, words)."""
    sent = documents.sparkSession.sparkContext.broadcast(bitmap)
    low_bits = np.uint64((1 << _BITMAP_BITS) - 1)

    def rows_of(rows):
        marked = sent.value
        held: dict[tuple[int, bytes], list] = {}
        for doc, text in rows:
            hashes, _, firsts, lasts = anchors(text)
            bit = hashes & low_bits
            chosen = np.flatnonzero(marked[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
            if not len(chosen):
                continue
            words = text.split()
            columns = (x[chosen].tolist() for x in (hashes.view(np.int64), firsts, lasts))
            for anchor, first, last in zip(*columns, strict=True):
                context = b" ".join(words[first : last + WINDOW])
                digest = hashlib.blake2b(context, digest_size=16).digest()
                yield anchor, digest, doc, first, None
                known = held.get((anchor, digest))
                if known is None:
                    held[anchor, digest] = [doc, context]
                elif doc < known[0]:
                    known[0] = doc
            if len(held) >= _HELD_CONTEXTS:
                yield from _flushed(held)
                held = {}
        yield from _flushed(held)

    schema = "anchor long, context binary, doc_id long, start long, words string"
    return map_rows(documents, schema, rows_of)


def _flushed(held: dict) -> Iterator[tuple]:
    for (anchor, digest), (doc, context) in held.items():
        yield anchor, digest, doc, None, context


def _dealt(contexts: DataFrame, wide_rows: int) -> tuple[DataFrame, DataFrame]:
    """Contexts of anchors with at most wide_rows rows, and those of anchors with more."""
    own = contexts.where("start is null").select("anchor", "context", "doc_id", "words")
    sizes = own.groupBy("anchor").agg(F.count("*").alias("rows"))
    wide = written(sizes.where(F.col("rows") > wide_rows).select("anchor"))
    return own.join(wide, "anchor", "left_anti"), own.join(wide, "anchor", "left_semi")


def _windows(context: bytes) -> list[bytes]:
    words = context.split(b" ")
    return [b" ".join(words[at : at + WINDOW]) for at in range(len(words) - WINDOW + 1)]


def _compared(narrow: DataFrame) -> DataFrame:
    """(anchor, context, runs): the contexts of one anchor, few enough, are compared in one task."""
    dealt = narrow.repartition("anchor").sortWithinPartitions("anchor", "context", "doc_id")

    def rows_of(rows):
        for anchor, group in groupby(rows, itemgetter(0)):
            # The first row of each context has its smallest doc_id.
            own = [next(same) for _, same in groupby(group, itemgetter(1))]
            first: dict[bytes, int] = {}
            for _, _, doc, words in own:
                for window in _windows(words):
                    first[window] = min(first.get(window, doc), doc)
            for _, digest, _, words in own:
                yield anchor, digest, _runs(first[window] for window in _windows(words))

    return map_rows(dealt, _RUNS, rows_of)


def _counted(wide: DataFrame) -> DataFrame:
    """The same for anchors of any number of contexts: windows meet by a digest of their words.

    Spark takes the smallest doc_id of each window, in each task first; only windows of
    several doc_ids are looked up. No task needs an anchor's contexts together.
    """

    def rows_of(rows):
        for anchor, digest, doc, words in rows:
            for at, window in enumerate(_windows(words)):
                yield anchor, digest, doc, at, hashlib.blake2b(window, digest_size=16).digest()

    schema = "anchor long, context binary, doc_id long, at long, window binary"
    windows = written(map_rows(wide, schema, rows_of))
    shared = written(
        windows.groupBy("window").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high").select("window", "low")
    )
    found = (
        windows.join(shared, "window", "left")
        .groupBy("anchor", "context", "at").agg(F.min(F.coalesce("low", "doc_id")).alias("doc"))
        .groupBy("anchor", "context").agg(F.collect_list(F.struct("at", "doc")).alias("docs"))
    )

    def runs_of(rows):
        for anchor, digest, docs in rows:
            yield anchor, digest, _runs(doc for _, doc in sorted((x["at"], x["doc"]) for x in docs))

    return map_rows(found, _RUNS, runs_of)


def _runs(docs: Iterable[int]) -> list[dict]:
    """Runs of windows with one smallest doc_id, from that of each window in order."""
    runs: list[dict] = []
    for at, doc in enumerate(docs):
        if runs and runs[-1]["doc_id"] == doc:
            runs[-1]["last"] = at
        else:
            runs.append({"first": at, "last": at, "doc_id": doc})
    return runs


def repeated_ranges(documents: DataFrame, wide_rows: int = _WIDE_ROWS) -> DataFrame:
    """(doc_id, ranges): (start, end) word ranges under windows that start in a smaller doc_id."""
    documents = documents.select("doc_id", "text").where("doc_id is not null")
    contexts = written(_contexts(documents, _recurring(documents)))
    occurrences = contexts.where("start is not null").select("anchor", "context", "doc_id", "start")
    narrow, wide = _dealt(contexts, wide_rows)
    holders = _compared(narrow).union(_counted(wide))
    run = F.col("run")
    return (
        occurrences.join(holders, ["anchor", "context"])
        .select("doc_id", "start", F.explode("runs").alias("run"))
        .where(run["doc_id"] < F.col("doc_id"))
        .groupBy("doc_id")
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("start") + run["first"]).alias("start"),
                    (F.col("start") + run["last"] + WINDOW).alias("end"),
                )
            ).alias("ranges")
        )
    )


def remove_repeats(documents: DataFrame, wide_rows: int = _WIDE_ROWS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without what smaller ids already hold.

    Words are what ASCII white space separates; kept words are joined by one space. A null or
    empty text has no words. Rows that repeat a doc_id are taken as the same document; one
    without doc_id loses nothing. Columns besides doc_id and text are not looked at.
    """
    texts = documents.select("doc_id", "text")
    joined = texts.join(repeated_ranges(texts, wide_rows), "doc_id", "left").select("doc_id", "text", "ranges")

    def rows_of(rows):
        for doc, text, ranges in rows:
            words = (text or b"").split()
            if not ranges:
                yield doc, len(words), 0, b" ".join(words)
                continue
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, [r["start"] for r in ranges], 1)
            np.add.at(gone, [r["end"] for r in ranges], -1)
            keep = np.cumsum(gone)[:-1] == 0
            kept = [words[i] for i in np.flatnonzero(keep)]
            yield doc, len(words), len(words) - len(kept), b" ".join(kept)

    return map_rows(joined, "doc_id long, n_words long, n_removed long, kept string", rows_of)
