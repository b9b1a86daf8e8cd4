"""Jaccard self-join of documents on word n-grams, by R-trees over count vectors.

A document's set holds hashes of its distinct n-grams. Hashed into groups, the set becomes a
vector of counts per group. Two sets overlap at most by the sum of the smaller counts of each
group, so a pair whose sum stays below what the similarity asks for is no link. An R-tree
over the vectors applies the same bound to boxes, by their largest counts; pairs that survive
are verified on the sets themselves.

How pairs meet: similar sets share one of their first few n-grams in any order that all sets
agree on (the rest of either set is too small to reach the overlap). The order here is by
hash, with n-grams that very many documents hold last, so a common passage brings nobody
together unless a document has little else. The group of a document is all that share such a
key with it, where it is the key's smallest holder; so two similar documents are in one group.

1. Equal sets become one class, represented by its smallest doc_id.
2. In each group every member is compared with the smallest one. Linked members form
   components, so that a large group of near copies is settled without its pairs.
3. Groups that still hold several components get an R-tree each, which yields the pairs
   across components that the bound admits. Large groups are cut into blocks, and each pair
   of blocks is a task of its own.
4. Components over all verified links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crisis_posts.llm.components import connected_components
from crisis_posts.llm.shared import map_rows, run_hashes, word_hashes, written

WORDS = 5
# Links need 100 * intersection >= 80 * union, so overlap >= 4/9 of both sizes' sum.
_SHARE, _OF = 4, 9
# A shingle is common from so many documents on, or from this share of them if that is more:
# common shingles are then at most 2,000 times an average set.
COMMON_FROM = 50
COMMON_SHARE = 2_000
_CHUNK = 1_000_000
_SEEN = 4
_FOLD = 4
_FANOUT = 16
_BLOCK = 512
_VERIFY_GROUP = 128
_BROADCAST_ROWS = 1_000_000


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's n-grams; of a shorter text, of all its words as one."""
    hashes = word_hashes((text or b"").lower())
    return np.unique(run_hashes(hashes, min(words, len(hashes)))) if len(hashes) else hashes


def least_overlap(a, b):
    """The smallest intersection that links sets of these sizes."""
    return -(-_SHARE * (a + b) // _OF)


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    need = least_overlap(len(a), len(b))
    if min(len(a), len(b)) < need:
        return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def count_vector(hashes: np.ndarray) -> np.ndarray:
    """Counts by group; groups are a power of two, at least half the size, and counts at most 15."""
    groups = 64
    while 2 * groups < len(hashes):
        groups *= 2
    while True:
        counts = np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
        if counts.max(initial=0) <= 15:
            return counts.astype(np.uint8)
        groups *= 2


def packed(vector: np.ndarray) -> bytes:
    """Two counts to a byte."""
    return (vector[0::2] | vector[1::2] << 4).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    pairs = np.frombuffer(data, np.uint8)
    return np.stack([pairs & 15, pairs >> 4], axis=1).ravel()


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    """The vector over fewer groups."""
    return vector.reshape(-1, groups).sum(axis=0, dtype=np.int32)


class CountTree:
    """A packed R-tree over count vectors of one length, sorted by set size."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, components: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        level = (
            vectors[self.order], sizes[self.order], sizes[self.order],
            components[self.order], components[self.order],
        )
        self.levels = [level]
        while len(level[0]) > _FANOUT:
            starts = np.arange(0, len(level[0]), _FANOUT)
            level = (
                np.maximum.reduceat(level[0], starts), np.minimum.reduceat(level[1], starts),
                np.maximum.reduceat(level[2], starts), np.minimum.reduceat(level[3], starts),
                np.maximum.reduceat(level[4], starts),
            )
            self.levels.append(level)

    def candidates(self, vector: np.ndarray, size: int, component: int) -> np.ndarray:
        """Indices of the points of other components whose bound admits a link."""
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most, first, last = (part[nodes] for part in self.levels[depth])
            other = np.maximum(least, -(-4 * size // 5))
            open_ = (most >= other) & (4 * least <= 5 * size)
            open_ &= (first != component) | (last != component)
            nodes, high, other = nodes[open_], high[open_], other[open_]
            bound = np.minimum(high, vector).sum(axis=1)
            nodes = nodes[bound >= least_overlap(size, other)]
            if depth:
                below = len(self.levels[depth - 1][0])
                nodes = (nodes[:, None] * _FANOUT + np.arange(_FANOUT)).ravel()
                nodes = nodes[nodes < below]
        return self.order[nodes]


def group_pairs(members: list[tuple]) -> Iterator[tuple[int, int]]:
    """Pairs of different components that the bound admits.

    Members are (doc, size, component, vector). The tree holds folded vectors; what it admits
    is looked at once more with all groups of the coarser of both vectors.
    """
    docs, sizes, components = (np.array(x) for x in list(zip(*members, strict=True))[:3])
    vectors = [unpacked(m[3]) for m in members]
    lengths = np.array([len(v) for v in vectors])
    for groups in np.unique(lengths):
        own = lengths == groups
        near = np.flatnonzero(own | ((lengths > groups) & (4 * sizes <= 5 * sizes[own].max())))
        if len(near) < 2:
            continue
        fine = np.stack([folded(vectors[i], groups) for i in near])
        coarse = fine.reshape(len(near), _FOLD, -1).sum(axis=1)
        tree = CountTree(coarse, sizes[near], components[near])
        for at, i in enumerate(near):
            if own[i]:
                found = tree.candidates(coarse[at], sizes[i], components[i])
                bound = np.minimum(fine[found], fine[at]).sum(axis=1)
                found = near[found[bound >= least_overlap(sizes[i], sizes[near[found]])]]
                for j in docs[found].tolist():
                    yield (int(docs[i]), j) if docs[i] < j else (j, int(docs[i]))


# The steps


def _sets(documents: DataFrame, words: int) -> DataFrame:
    """One pass: (doc_id, size, digest) of each document, and shingles that a task saw often."""

    def rows_of(rows):
        held, total, docs = [], 0, 0
        for doc, text in rows:
            hashes = shingles(text, words)
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            yield doc, len(hashes), digest, None, None
            held.append(hashes)
            total, docs = total + len(hashes), docs + 1
            if total >= _CHUNK:
                yield from _often(held, docs)
                held, total, docs = [], 0, 0
        yield from _often(held, docs)

    schema = "doc_id long, size long, digest binary, shingle long, seen long"
    return map_rows(documents, schema, rows_of)


def _often(held: list[np.ndarray], docs: int) -> Iterator[tuple]:
    if held:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        chosen = counts >= max(_SEEN, docs // (2 * COMMON_SHARE))
        pairs = zip(values[chosen].view(np.int64).tolist(), counts[chosen].tolist(), strict=True)
        yield from ((None, None, None, shingle, seen) for shingle, seen in pairs)


def _common(scanned: DataFrame, documents: int) -> np.ndarray:
    """The common shingles: a list of bounded length, and any list gives right results."""
    least = max(COMMON_FROM, documents // COMMON_SHARE)
    rows = (
        scanned.where("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen"))
        .where(F.col("seen") >= least).select("shingle").collect()
    )
    return np.sort(np.array([row.shingle for row in rows], np.int64).view(np.uint64))


def _classes(documents: DataFrame, words: int, common: np.ndarray) -> DataFrame:
    """(doc_id, size, vector, keys) of the document of smallest id of each different set."""
    sent = documents.sparkSession.sparkContext.broadcast(common)

    def rows_of(rows):
        common = sent.value
        for doc, text in rows:
            hashes = shingles(text, words)
            if not len(hashes):
                continue
            n = len(hashes)
            first = n - -(-4 * n // 5) + 1
            if len(common):
                at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
                rare = common[at] != hashes
                keys = np.concatenate([hashes[rare][:first], hashes[~rare][:first]])[:first]
            else:
                keys = hashes[:first]
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            yield doc, n, digest, packed(count_vector(hashes)), keys.view(np.int64)

    schema = "doc_id long, size long, digest binary, vector binary, keys array<long>"
    return (
        map_rows(documents, schema, rows_of).groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"), F.first("size").alias("size"),
            F.first("vector").alias("vector"), F.first("keys").alias("keys"),
        )
    )


def _verified(documents: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) that are links. The texts of b come to a's, in groups of bounded size."""
    pairs = written(pairs)
    degrees = pairs.groupBy("a").count().select("a", F.ceil(F.col("count") / _VERIFY_GROUP).alias("parts"))
    dealt = pairs.join(degrees, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    members = written(
        dealt.select("a", "part", F.col("b").alias("doc_id"))
        .unionByName(dealt.select("a", "part", F.col("a").alias("doc_id")).distinct())
    )
    if members.count() <= _BROADCAST_ROWS:
        members = F.broadcast(members)
    met = (
        documents.join(members, "doc_id").select("a", "part", "doc_id", "text")
        .repartition("a", "part").sortWithinPartitions("a", "part", "doc_id")
    )

    def rows_of(rows):
        # a is the smallest of its group, so it comes first.
        for _, group in groupby(rows, lambda row: row[:2]):
            own = None
            for a, _, doc, text in group:
                if doc == a:
                    own = shingles(text, words)
                elif _linked(own, shingles(text, words)):
                    yield a, doc

    return map_rows(met, "a long, b long", rows_of)


def _stars(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of each group's smallest member and another that the bound admits."""

    def side(name: str, *columns: str) -> DataFrame:
        named = [F.col("doc_id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns)]
        return classes.select(*named)

    pairs = (
        members.where("a < doc_id").withColumnRenamed("doc_id", "b")
        .join(side("a", "size"), "a").where("4 * size_a <= 5 * size and 4 * size <= 5 * size_a")
        .join(side("b", "vector"), "b").join(side("a", "vector"), "a")
    )

    def rows_of(rows):
        for a, b, size_a, size_b, vector_a, vector_b in rows:
            x, y = unpacked(vector_a), unpacked(vector_b)
            shorter = min(len(x), len(y))
            bound = np.minimum(folded(x, shorter), folded(y, shorter)).sum()
            if bound >= least_overlap(size_a, size_b):
                yield a, b

    columns = pairs.select("a", "b", "size_a", "size", "vector_a", "vector_b")
    return map_rows(columns, "a long, b long", rows_of)


def _across(members: DataFrame, classes: DataFrame, components: DataFrame) -> DataFrame:
    """Pairs (a, b) across components, from one R-tree for each group or pair of its blocks."""
    labelled = members.join(
        components.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    ).withColumn("component", F.coalesce("component", "doc_id"))
    several = (
        labelled.groupBy("a")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
        .where("low < high").select("a", F.ceil(F.col("n") / _BLOCK).alias("blocks"))
    )
    dealt = (
        labelled.join(several, "a").join(classes.select("doc_id", "vector"), "doc_id")
        .withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "a", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "doc_id", "size", "component", "vector",
        )
        .repartition("a", "low", "high").sortWithinPartitions("a", "low", "high")
    )

    def rows_of(rows):
        for _, group in groupby(rows, lambda row: row[:3]):
            yield from set(group_pairs([row[3:] for row in group]))

    return map_rows(dealt, "a long, b long", rows_of).distinct()


def near_duplicates(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document.

    A text without words, empty or null has no n-grams and links with nothing, not even its
    like. Rows that repeat a doc_id are taken as copies of one document if their texts are equal; ids
    are expected to tell documents apart. Columns besides doc_id and text are not looked at.
    """
    documents = documents.select("doc_id", "text")
    scanned = written(_sets(documents, words))
    sets = scanned.where("digest is not null").select("doc_id", "size", "digest")
    classes = written(_classes(documents, words, _common(scanned, sets.count())))

    keys = classes.select("doc_id", "size", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("high"))
    holders = keys.join(shared.where("a < high").select("key", "a"), "key")
    members = written(holders.select("a", "doc_id", "size").distinct())

    links = written(_verified(documents, _stars(members, classes), words))
    rest = _across(members, classes, connected_components(links))
    more = written(_verified(documents, rest.join(links, ["a", "b"], "left_anti"), words))
    components = connected_components(links.unionByName(more))

    named = classes.select("digest", F.col("doc_id").alias("node")).join(components, "node", "left")
    named = named.select("digest", F.coalesce("component", "node").alias("component_id"))
    return sets.join(named, "digest", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
