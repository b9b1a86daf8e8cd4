"""Alignment of two tokenizers' tokens, and how many documents link each pair of ids.

A text's tokens by both tokenizers cover the same bytes; tokens are linked where their byte ranges
overlap, and offsets where tokens of both end cut them into groups. How widely a pair of ids is
linked takes the whole corpus:

1. All documents are encoded, and the ids of both tokenizers written. A first pass aligns them; each
   task counts, for each pair, the documents that link it.
2. The distinct pairs get a minimal perfect hash function: pairs are dealt into buckets by their
   first id, and a bucket's function is a few levels of bits, each key setting a bit of its own at
   the first level where no other key hashes to the same place; its slot is the number of bits
   before. Each slot keeps its key, so that a look-up is verified.
3. The tasks' counts become dense vectors, indexed by slot, which are summed in a tree: first
   within parts of a bucket, then over the parts.
4. A second pass aligns the written ids again and looks up the count of every link. Up to
   most_pairs pairs travel to the tasks, the most widely linked ones if there are more; links of
   the others, each of which few documents hold, are joined to the table of counts.

Pairs are bounded by the product of the vocabularies, whatever the number of documents.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import groupby

import numpy as np
import sentencepiece
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crisis_posts.llm.shared import map_rows, mixed, written
from crisis_posts.llm.token_counts import _byte_symbols

MOST_PAIRS = 2_000_000

_BUCKETS = 512
_PARTS = 16
_ROWS_AT_ONCE = 256
_BYTES_AT_ONCE = 1 << 20
_KEYS_HELD = 2_000_000
_LONG_RUN = re.compile(rb"[^ \n]{1000}|\s{1000}")
_FURTHEST_LEAD = 0xC8  # of two bytes for a character below U+0240


class Tokenizers:
    """Both tokenizers of a worker, the bytes of their tokens, and the alignment of texts."""

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbols = {symbol: byte for byte, symbol in enumerate(_byte_symbols())}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(symbols[c] for c in token if c in symbols)
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
            for piece in [self.b.id_to_piece(i)]
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.fast = self._as_ranks(a_path)
        self.spelled = [
            b"%d%c" % (i, mark)
            for size, marks in ((len(self.a_bytes), b",|"), (len(self.b_bytes), b",;"))
            for i in range(size)
            for mark in marks
        ]

    def _as_ranks(self, path: str) -> tiktoken.Encoding | None:
        """The same encoder over ranks, where ids are numbered in the order of the merges."""
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        merges = [m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"]]
        vocabulary = read["model"]["vocab"]
        ranks = {self.a_bytes[i]: i for i in vocabulary.values() if len(self.a_bytes[i])}
        numbers = [vocabulary["".join(pair)] for pair in merges]
        level = read["pre_tokenizer"]
        same = level["type"] == "ByteLevel" and not level["add_prefix_space"] and not read["normalizer"]
        if not same or numbers != list(range(256, 256 + len(numbers))):
            return None
        ranks = {token: number for token, number in ranks.items() if number < 256 + len(numbers)}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def by_ranks(self, raw: bytes) -> bool:
        """Whether classes of characters are the same in every library, and runs are short."""
        return (
            self.fast is not None
            and (raw.isascii() or np.frombuffer(raw, np.uint8).max() <= _FURTHEST_LEAD)
            and not (len(raw) >= 1000 and _LONG_RUN.search(raw))
        )

    def encode_a(self, text: str, by_ranks: bool) -> list[int]:
        if by_ranks:
            return self.fast.encode_ordinary(" " + text)
        return self.a.encode(" " + text, add_special_tokens=False).ids

    def encoded(self, texts: list[bytes | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both; none for texts that are null, empty, no UTF-8 or not covered by the tokens."""
        decoded = []
        for text in texts:
            try:
                decoded.append((text or b"").decode())
            except UnicodeDecodeError:
                decoded.append("")
        all_b = self.b.encode(decoded, num_threads=1)
        all_a = []
        for i, (raw, text) in enumerate(zip(texts, decoded, strict=True)):
            ids = []
            if text:
                whole, by_ranks = b" " + raw, self.by_ranks(raw)
                ids = self.encode_a(text, by_ranks)
                # Ranks cut any bytes into tokens that are these bytes.
                if b"".join(map(self.b_bytes.__getitem__, all_b[i])) != whole or not (
                    by_ranks or b"".join(map(self.a_bytes.__getitem__, ids)) == whole
                ):
                    ids = []
            if not ids:
                all_b[i] = []
            all_a.append(ids)
        return all_a, all_b

    def align(self, ids_a: list[bytes], ids_b: list[bytes]) -> Alignment:
        """From written ids."""
        a, b = (
            [np.frombuffer(ids, kind) for ids in own]
            for own, kind in ((ids_a, _kind(self.a_bytes)), (ids_b, _kind(self.b_bytes)))
        )
        return Alignment(self, a, b)


class Alignment:
    """Links and groups of some documents, taken together: a document's end is the end of a group."""

    def __init__(self, tokenizers: Tokenizers, ids_a: list[np.ndarray], ids_b: list[np.ndarray]):
        self.tokenizers = tokenizers
        self.n_a = np.array([len(x) for x in ids_a], np.int64)
        self.n_b = np.array([len(x) for x in ids_b], np.int64)
        self.a, self.b = (np.concatenate(x).astype(np.int64) for x in (ids_a, ids_b))
        ends_a = np.cumsum(tokenizers.a_sizes[self.a])
        ends_b = np.cumsum(tokenizers.b_sizes[self.b])
        ending = np.zeros((ends_a[-1] if len(ends_a) else 0) + 1, np.uint8)
        ending[ends_a] |= 1
        ending[ends_b] |= 2
        cuts = np.flatnonzero(ending)
        kinds = ending[cuts]
        # A link's overlap ends at one cut: the tokens are those that no earlier cut ended.
        of_a = np.cumsum(kinds & 1) - (kinds & 1)
        of_b = np.cumsum(kinds >> 1) - (kinds >> 1)
        self.keys = self.a[of_a] * len(tokenizers.b_bytes) + self.b[of_b]
        self.common = cuts[kinds == 3]
        self.group_a = np.searchsorted(ends_a, self.common, "right")
        self.group_b = np.searchsorted(ends_b, self.common, "right")
        doc_ends = np.concatenate([[0], ends_a])[np.cumsum(self.n_a)]
        self.links_to = np.searchsorted(cuts, doc_ends, "right")
        self.n_links = np.diff(self.links_to, prepend=0)
        self.n_groups = np.diff(np.searchsorted(self.common, doc_ends, "right"), prepend=0)

    def document_keys(self) -> np.ndarray:
        """The distinct keys of each document, one document after the other."""
        size = len(self.tokenizers.a_bytes) * len(self.tokenizers.b_bytes)
        document = np.repeat(np.arange(len(self.n_links)), self.n_links)
        return np.unique(document * size + self.keys) % size

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over each document's links."""
        total = np.concatenate([[0], np.cumsum(values)])
        return np.diff(total[self.links_to], prepend=0)

    def spelled(self) -> Iterator[bytes]:
        """Each document's groups: a1,a2|b1;a3|b2,b3."""
        sizes_a, sizes_b = np.diff(self.group_a, prepend=0), np.diff(self.group_b, prepend=0)
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        at_a = np.arange(len(self.a)) + np.repeat(self.group_b - sizes_b, sizes_a)
        at_b = np.arange(len(self.b)) + np.repeat(self.group_a, sizes_b)
        codes[at_a] = 2 * self.a
        codes[at_b] = 2 * (len(self.tokenizers.a_bytes) + self.b)
        codes[at_a[self.group_a - 1]] += 1
        codes[at_b[self.group_b - 1]] += 1
        table, at = self.tokenizers.spelled, 0
        for n in (self.n_a + self.n_b).tolist():
            yield b"".join(map(table.__getitem__, codes[at : at + n].tolist()))[:-1]
            at += n


def _kind(vocabulary: list) -> type:
    """Of the numbers that ids are written as."""
    return np.uint16 if len(vocabulary) <= 1 << 16 else np.uint32


@cache
def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def _in_batches(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows whose last field is a text or ids, up to a number of rows and bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if len(held) == _ROWS_AT_ONCE or size >= _BYTES_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


# The minimal perfect hash function of a bucket


def _placed(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mixed(keys.astype(np.uint64) + seed) % np.asarray(size, np.uint64)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes of the levels, their bits, the keys by slot) for distinct keys."""
    sizes, bits, slots = [], [], []
    left = keys
    while len(left):
        size = 64 * -(-len(left) * 3 // 128)
        place = _placed(left, len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        settled = alone[place]
        slots.append(left[settled][np.argsort(place[settled])])
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little"))
        left = left[~settled]
    joined = np.concatenate(bits) if bits else np.empty(0, np.uint8)
    by_slot = np.concatenate(slots) if slots else np.empty(0, np.int64)
    return np.array(sizes, np.int64), joined.view(np.uint64), by_slot


class PerfectHashes:
    """The functions of some buckets, looked up together; slots go on from bucket to bucket."""

    def __init__(self, functions: list[tuple[int, bytes, bytes, bytes]], vocabulary_b: int):
        self.vocabulary_b = vocabulary_b
        levels = [np.frombuffer(sizes, np.int64) for _, sizes, _, _ in functions]
        self.depth = max(map(len, levels), default=0)
        self.sizes = np.zeros((_BUCKETS, self.depth), np.int64)
        self.starts = np.zeros((_BUCKETS, self.depth), np.int64)
        at = 0
        for (bucket, *_), sizes in zip(functions, levels, strict=True):
            self.sizes[bucket, : len(sizes)] = sizes
            self.starts[bucket, : len(sizes)] = at + np.cumsum(sizes) - sizes
            at += sizes.sum()
        self.words = np.frombuffer(b"".join(bits for _, _, bits, _ in functions), np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.keys = np.frombuffer(b"".join(keys for *_, keys in functions), np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, verified; -1 for one that has none."""
        out = np.full(len(keys), -1, np.int64)
        buckets = bucket_of(keys, self.vocabulary_b)
        left = np.arange(len(keys))
        for level in range(self.depth):
            left = left[self.sizes[buckets[left], level] > 0]
            if not len(left):
                break
            bucket = buckets[left]
            place = _placed(keys[left], level, self.sizes[bucket, level])
            place += self.starts[bucket, level]
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            found = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            slot = self.before[place >> 6] + np.bitwise_count(below)
            out[left[found]] = slot[found]
            left = left[~found]
        known = np.flatnonzero(out >= 0)
        out[known[self.keys[out[known]] != keys[known]]] = -1
        return out


def bucket_of(keys: np.ndarray, vocabulary_b: int) -> np.ndarray:
    """All pairs of one first id lie in one bucket."""
    return (keys // vocabulary_b) % _BUCKETS


# The jobs


_TABLE = "bucket int, sizes binary, bits binary, keys binary, docs binary"


def encode_both(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, a, b) of each document: the ids of both tokenizers, as bytes of their numbers.

    Empty where the text is null, empty, not valid UTF-8 or not the bytes of its tokens.
    """

    def encoded(rows):
        tokenizers = _tokenizers(a_path, b_path)
        kinds = _kind(tokenizers.a_bytes), _kind(tokenizers.b_bytes)
        for batch in _in_batches(rows):
            both = tokenizers.encoded([text for _, text in batch])
            for (doc, _), *ids in zip(batch, *both, strict=True):
                yield doc, *(np.array(own, kind).tobytes() for own, kind in zip(ids, kinds, strict=True))

    return map_rows(documents.select("doc_id", "text"), "doc_id long, a binary, b binary", encoded)


def pair_table(encoded: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The distinct linked pairs by bucket: their hash function, keys and document counts by slot.

    ``encoded`` is what encode_both gives, written. A key is the first id times the size of the second vocabulary plus the second id.
    """

    def partial(rows):
        tokenizers = _tokenizers(a_path, b_path)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def handed_on():
            keys, docs = _summed(held)
            held.clear()
            buckets = bucket_of(keys, len(tokenizers.b_bytes))
            order = np.argsort(buckets, kind="stable")
            ends = np.cumsum(np.bincount(buckets, minlength=_BUCKETS))
            for bucket, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
                if start < end:
                    of = order[start:end]
                    yield bucket, keys[of].tobytes(), docs[of].tobytes()

        for batch in _in_batches(rows):
            found = tokenizers.align(*zip(*batch, strict=True)).document_keys()
            held.append(np.unique(found, return_counts=True))
            if sum(len(keys) for keys, _ in held) >= _KEYS_HELD:
                held[:] = [_summed(held)]
                if len(held[0][0]) >= _KEYS_HELD // 2:
                    yield from handed_on()
        if held:
            yield from handed_on()

    counted = map_rows(encoded.select("a", "b"), "bucket int, keys binary, docs binary", partial)
    parts = (F.spark_partition_id() % _PARTS).alias("part")
    counted = written(counted.select("bucket", parts, "keys", "docs"))

    hashed = counted.select("bucket", "part", "keys")
    for within, last in ((["bucket", "part"], False), (["bucket"], True)):
        hashed = _by_bucket(hashed, within, _united, "bucket int, part int, keys binary")
        if last:
            hashed = map_rows(hashed.select("bucket", "keys"), _TABLE, _functions)
    hashed = written(hashed)

    summed = counted
    for within in (["bucket", "part"], ["bucket"]):
        summed = _with_functions(summed, hashed, within)
        summed = _by_bucket(summed, within, _vectors, f"part int, {_TABLE}")
        if within != ["bucket"]:
            summed = summed.select("bucket", "part", F.lit(None).cast("binary").alias("keys"), "docs")
    return written(summed.drop("part"))


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    docs = np.zeros(len(keys), np.int64)
    np.add.at(docs, place, np.concatenate([n for _, n in held]))
    return keys, docs


def _by_bucket(table: DataFrame, within: list[str], merge: Callable, schema: str) -> DataFrame:
    """Rows of equal keys one after the other in a task, each run of them merged into one row."""

    def merged(rows):
        for key, run in groupby(rows, lambda row: row[: len(within)]):
            yield merge(key, run)

    order = [*within, *(c for c in ("kind",) if c in table.columns)]
    rest = [c for c in table.columns if c not in order]
    dealt = table.repartition(*within).sortWithinPartitions(*order).select(*order, *rest)
    return map_rows(dealt, schema, merged)


def _united(key: tuple, run: Iterator[tuple]) -> tuple:
    united = np.empty(0, np.int64)
    for *_, keys in run:
        united = np.union1d(united, np.frombuffer(keys, np.int64))
    return key[0], key[-1], united.tobytes()


def _functions(rows: Iterator[tuple]) -> Iterator[tuple]:
    for bucket, keys in rows:
        sizes, bits, by_slot = perfect_hash(np.frombuffer(keys, np.int64))
        yield bucket, sizes.tobytes(), bits.tobytes(), by_slot.tobytes(), None


def _with_functions(counts: DataFrame, hashed: DataFrame, within: list[str]) -> DataFrame:
    """Counts, and before them in each bucket, or each part of one, its function."""
    part = F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))) if len(within) > 1 else F.lit(0)
    first = hashed.select("bucket", part.alias("part"), F.lit(0).alias("kind"), "sizes", "bits", "keys", "docs")
    none = F.lit(None).cast("binary")
    then = counts.select(
        "bucket", "part", F.lit(1).alias("kind"), none.alias("sizes"), none.alias("bits"), "keys", "docs"
    )
    return first.unionByName(then)


def _vectors(key: tuple, run: Iterator[tuple]) -> tuple:
    """The sum of a bucket's counts as a dense vector, indexed by the slots of its function."""
    *_, sizes, bits, keys, _ = next(run)
    vector = np.zeros(len(keys) // 8, np.int64)
    by_slot = np.frombuffer(keys, np.int64)
    for *_, found, docs in run:
        counts = np.frombuffer(docs, np.int64)
        if found is None:
            vector += counts
            continue
        wanted = np.frombuffer(found, np.int64)
        slots = _own_slots(sizes, bits, wanted)
        if (by_slot[slots] != wanted).any():
            raise ValueError("a pair is missing from the hash function of its bucket")
        vector[slots] += counts
    return key[-1], key[0], sizes, bits, keys, vector.tobytes()


def _own_slots(sizes: bytes, bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Slots of keys that the bucket's function was made for."""
    words = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
    rank = np.cumsum(words, dtype=np.int64)
    out, left, start = np.zeros(len(keys), np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(np.frombuffer(sizes, np.int64)):
        place = start + _placed(keys[left], level, size)
        found = words[place] == 1
        out[left[found]] = rank[place[found]] - 1
        left, start = left[~found], start + size
    return out


def pair_counts(table: DataFrame, b_path: str) -> DataFrame:
    """(a, b, docs, best) from a pair table: best says that no pair of the first id has more."""
    size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()

    def rows(buckets):
        for _, keys, docs in buckets:
            found, counts = np.frombuffer(keys, np.int64), np.frombuffer(docs, np.int64)
            for key, n, best in zip(found.tolist(), counts.tolist(), _best(found, counts, size), strict=True):
                yield key // size, key % size, n, bool(best)

    return map_rows(
        table.select("bucket", "keys", "docs"), "a int, b int, docs long, best boolean", rows
    )


def _best(keys: np.ndarray, docs: np.ndarray, vocabulary_b: int) -> np.ndarray:
    """Whether a pair's count is the highest of its first id; all pairs of an id must be there."""
    first, place = np.unique(keys // vocabulary_b, return_inverse=True)
    most = np.zeros(len(first), np.int64)
    np.maximum.at(most, place, docs)
    return docs == most[place]


def _widest(table: DataFrame, most_pairs: int, vocabulary_b: int) -> tuple[DataFrame, bool]:
    """(the buckets' functions, keys, counts and best marks for what may travel, whether that is all).

    Where the pairs are too many, those whose count reaches a power of two that leaves at most
    most_pairs of them get functions of their own.
    """

    def powers(buckets):
        for _, docs in buckets:
            sizes = np.bincount(np.log2(np.frombuffer(docs, np.int64)).astype(int), minlength=1)
            for power, n in enumerate(sizes.tolist()):
                if n:
                    yield power, n

    counts = map_rows(table.select("bucket", "docs"), "power int, pairs long", powers)
    by_power = dict(counts.groupBy("power").agg(F.sum("pairs")).collect())  # 64 rows at most
    least, total = 0, 0
    for power in sorted(by_power, reverse=True):
        total += by_power[power]
        if total > most_pairs:
            least = 1 << (power + 1)
            break

    def cut(buckets):
        for bucket, sizes, bits, keys, docs in buckets:
            found, n = np.frombuffer(keys, np.int64), np.frombuffer(docs, np.int64)
            best = _best(found, n, vocabulary_b)
            if least:
                wide = n >= least
                sizes, bits, by_slot = perfect_hash(np.sort(found[wide]))
                order = np.argsort(found)
                of = order[np.searchsorted(found[order], by_slot)]
                sizes, bits, keys = sizes.tobytes(), bits.tobytes(), by_slot.tobytes()
                n, best = n[of], best[of]
            yield bucket, sizes, bits, keys, n.tobytes(), best.tobytes()

    return map_rows(table, f"{_TABLE}, best binary", cut), not least


class _Counts:
    """The counts that came with the tasks."""

    def __init__(self, rows: list[tuple], vocabulary_b: int):
        self.functions = PerfectHashes([row[:4] for row in rows], vocabulary_b)
        # The last entry is that of slot -1: a pair that did not come along.
        self.docs = np.append(np.frombuffer(b"".join(row[4] for row in rows), np.int64), 0)
        self.best = np.append(np.frombuffer(b"".join(row[5] for row in rows), bool), False)


_loaded: dict[str, _Counts] = {}  # by a name that is new for each broadcast


def align_documents(
    documents: DataFrame,
    a_path: str,
    b_path: str,
    digests: bool = False,
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each whole text.

    The first tokenizer encodes a space and the text, the second the text, before which it sets a
    space itself. groups spells the ids as ``a1,a2|b1;a3|b2,b3``, or is the SHA-256 of that with
    digests. n_best counts links whose pair is linked in as many documents as any pair of its
    first id, count_sum adds up the documents of each link's pair. A text that is null, empty, not
    valid UTF-8 or not the bytes of its tokens has no tokens: zeros and an empty groups. Rows with
    equal or null doc_id each count as a document; other columns are not looked at.
    """
    encoded = written(encode_both(documents, a_path, b_path))
    table = pair_table(encoded, a_path, b_path)
    vocabulary_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    widest, complete = _widest(table, most_pairs, vocabulary_b)
    sent = documents.sparkSession.sparkContext.broadcast([tuple(row) for row in widest.collect()])
    name = uuid.uuid4().hex

    def aligned(rows):
        tokenizers = _tokenizers(a_path, b_path)
        if name not in _loaded:
            _loaded.clear()
            _loaded[name] = _Counts(sent.value, vocabulary_b)
        counts = _loaded[name]
        for batch in _in_batches(rows):
            docs_of, *ids = zip(*batch, strict=True)
            found = tokenizers.align(*ids)
            keys, place = np.unique(found.keys, return_inverse=True)
            slots = counts.functions.slots(keys)
            best = found.sums(counts.best[slots][place].astype(np.int64))
            docs = found.sums(counts.docs[slots][place])
            missing = _missing(found, keys[slots < 0], (slots < 0)[place]) if not complete else None
            columns = [found.n_a, found.n_b, found.n_groups, found.n_links, best, docs]
            for i, (doc, *numbers) in enumerate(zip(
                docs_of, *(c.tolist() for c in columns), found.spelled(), strict=True
            )):
                groups = numbers[-1]
                if digests and groups:
                    numbers[-1] = hashlib.sha256(groups).hexdigest()
                else:
                    numbers[-1] = groups.decode()
                yield doc, *numbers, *([missing[i]] if missing else [])

    counted = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups string"
    )
    if complete:
        return map_rows(encoded, counted, aligned)
    found = map_rows(encoded, f"{counted}, missing array<long>", aligned)
    return _with_missing(found, pair_counts(table, b_path), vocabulary_b)


def _missing(found: Alignment, wanted: np.ndarray, which: np.ndarray) -> list[list[int]]:
    """Of each document the keys of the links that are still to be looked up."""
    ends = np.concatenate([[0], np.cumsum(which)])[found.links_to]
    return [x.tolist() for x in np.split(found.keys[which], ends[:-1])] if len(ends) else []


def _with_missing(found: DataFrame, pairs: DataFrame, vocabulary_b: int) -> DataFrame:
    """Add what the tasks could not look up; no such pair is held by a large part of the documents."""
    found = written(found.withColumn("row", F.monotonically_increasing_id()))
    pairs = pairs.select(
        (F.col("a").cast("long") * vocabulary_b + F.col("b")).alias("key"), "docs", "best"
    )
    links = found.select("row", F.explode("missing").alias("key")).groupBy("row", "key").agg(
        F.count("*").alias("times")
    )
    added = links.join(pairs, "key").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("docs") * F.col("times")).alias("more_docs"),
    )
    return (
        found.join(added, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_docs", F.lit(0)))
        .drop("row", "missing", "more_best", "more_docs")
    )
