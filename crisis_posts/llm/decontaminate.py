"""Benchmark decontamination by Wu-Manber search for word windows.

The benchmark's items are cut into windows of a fixed number of words (an item with fewer
words is one window). Windows of one length share a search table: a block of two words says
how far the search may skip; where it may not, the bucket of windows that end in that block
is compared with the document directly, after a look at each window's first block.

Windows are dealt into blocks of at most ``block_windows`` by their hash. A task holds one block
and searches its documents for it; with more than one block the documents are written once, each
row with a number of its own, and read again for each block.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.llm.shared import map_rows, written

WINDOW = 10
BLOCK_WINDOWS = 200_000
_BLOCK = 2

# Bytes outside words become spaces; A-Z become a-z.
_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """The words of a text: runs of a-z, 0-9 and characters beyond ASCII, in lower case."""
    return text.translate(_WORD_TABLE).split() if text else []


class WuManber:
    """Search tables for windows of one length; window i is windows[i], a tuple of words."""

    def __init__(self, windows: list[tuple[bytes, ...]], length: int):
        self.length = length
        self.block = min(_BLOCK, length)
        self.longest = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list] = defaultdict(list)
        for number, window in enumerate(windows):
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.longest), length - end)
            self.buckets[window[-self.block :]].append((window[: self.block], window, number))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Yield (start, window number) of each occurrence, by start."""
        length, block, longest, shift = self.length, self.block, self.longest, self.shift
        end, n = length, len(words)
        while end <= n:
            suffix = tuple(words[end - block : end])
            skip = shift.get(suffix, longest)
            if not skip:
                start = end - length
                prefix = tuple(words[start : start + block])
                for first, window, number in self.buckets[suffix]:
                    if first == prefix and tuple(words[start:end]) == window:
                        yield start, number
                skip = 1
            end += skip


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window, item_id) rows; a window is its words joined by spaces."""

    def cut(rows):
        for item, text in rows:
            words = plain_words(text)
            for at in range(max(1, len(words) - window + 1) if words else 0):
                yield b" ".join(words[at : at + window]).decode(), item.decode()

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    items = items.where(F.col("item_id").isNotNull())
    return map_rows(items, "window string, item_id string", cut).distinct()


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """(doc_id, n_words, hits, items): the word ranges that occurring windows cover, and whose.

    hits are (start, end) pairs, end exclusive, in order and disjoint; items are item ids as
    strings, sorted. A null or empty text has no words; an item without words or without id is
    no item. Every row has the hits of its own text, also where doc_id is null or repeated;
    columns besides doc_id and text are not looked at. block_windows changes no row.
    """
    windows = benchmark_windows(benchmark, window)
    blocks = max(1, math.ceil(windows.count() / block_windows))
    windows = windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    texts = documents.select("doc_id", "text")
    if blocks == 1:
        return _search_block(texts, windows.drop("block"), "doc_id long")
    texts = written(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    found = [
        _search_block(texts, windows.where(F.col("block") == number).drop("block"), "row long, doc_id long")
        for number in range(blocks)
    ]
    gathered = None
    for table in found:
        hits = table.where(F.size("hits") > 0).select("row", "hits", "items")
        gathered = hits if gathered is None else gathered.union(hits)
    merged = gathered.groupBy("row").agg(
        _disjoint(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return (
        found[0].select("row", "doc_id", "n_words")
        .join(merged, "row", "left")
        .select(
            "doc_id", "n_words",
            F.coalesce("hits", F.array().cast("array<struct<start:long,end:long>>")).alias("hits"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def _search_block(texts: DataFrame, windows: DataFrame, keys: str) -> DataFrame:
    """The keys of each row, its words and hits. At most a block's windows are brought to the driver and sent to the executors."""
    held = windows.groupBy("window").agg(F.collect_set("item_id").alias("items")).collect()
    sent = texts.sparkSession.sparkContext.broadcast([(row.window, row["items"]) for row in held])

    def search(rows):
        groups = defaultdict(list)
        for joined, owners in sent.value:
            words = tuple(joined.encode().split(b" "))
            groups[len(words)].append((words, owners))
        searchers = [
            (length, WuManber([w for w, _ in group], length), [o for _, o in group])
            for length, group in sorted(groups.items())
        ]
        for *key, text in rows:
            words = plain_words(text)
            ranges, items = [], set()
            for length, searcher, owners in searchers:
                for start, number in searcher.search(words):
                    ranges.append((start, start + length))
                    items.update(owners[number])
            yield *key, len(words), _united(ranges), sorted(items)

    schema = f"{keys}, n_words long, hits array<struct<start:long,end:long>>, items array<string>"
    return map_rows(texts, schema, search)


def _united(ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def _disjoint(ranges: Column) -> Column:
    """Join ranges that overlap or touch."""
    none = F.array().cast("array<struct<start:long,end:long>>")

    def joined(kept: Column, r: Column) -> Column:
        last = F.element_at(kept, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))
        apart = (F.size(kept) == 0) | (F.try_element_at(kept, F.lit(-1))["end"] < r["start"])
        return F.when(apart, F.concat(kept, F.array(r))).otherwise(
            F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(longer))
        )

    return F.aggregate(F.array_sort(ranges), none, joined)


def covered(ranges: Column) -> Column:
    """The number of words in disjoint ranges."""
    return F.aggregate(ranges, F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
