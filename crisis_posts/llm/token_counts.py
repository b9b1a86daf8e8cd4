"""Token counts at every prefix of a text, by dynamic programming over prefixes.

The last token of a prefix's encoding follows from shorter prefixes: it is the one token
that ends the prefix and may stand after the last token of what precedes it. Two tokens may
stand side by side if byte-pair merging of both together leaves the two. So each prefix of a
word gets its last token and its exact count from shorter ones, and the counts of a text's
prefixes are the sums over its words; no prefix is encoded again.

Words are cached per worker with a bounded number of entries. Counts are those of the
tokenizer's library, without added special tokens.
"""

from __future__ import annotations

import bisect
import json
import re
import unicodedata
from collections.abc import Sequence
from functools import cache
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crisis_posts.llm.shared import Memo, bpe_merge, map_rows

_END = "</w>"


def _byte_symbols() -> list[str]:
    """The symbol of each byte in byte-level vocabularies: itself if printable, else one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def _in_latin(pattern: str) -> str:
    """A pattern with its classes spelled out for texts of characters below U+0250."""
    chars = [chr(c) for c in range(0x250)]
    kinds = {kind: [c for c in chars if unicodedata.category(c)[0] == kind] for kind in "LNZ"}
    classes = {r"\p{" + kind + "}": "".join(map(re.escape, members)) for kind, members in kinds.items()}
    for name, members in (classes | {r"\s": r"\t-\r\x85" + classes[r"\p{Z}"]}).items():
        pattern = pattern.replace(name, members)
    return pattern


class PrefixCounter:
    """Counts for a word-level BPE vocabulary file with an end-of-word mark."""

    def __init__(self, path: str, cache_entries: int = 250_000):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        model = read["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _END:
            raise ValueError(f"{path} is no BPE vocabulary with {_END}")
        split = read["pre_tokenizer"]["pretokenizers"][0]
        pattern = split["pattern"]["Regex"]
        self.library = Tokenizer.from_file(path)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in read["added_tokens"]))
        self.splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.words = re.compile(_in_latin(pattern))
        self.beyond_latin = re.compile(r"[^\x00-ɏ]")
        self.symbols = _byte_symbols()
        self.vocabulary = model["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.longest = max(len(token.removesuffix(_END)) for token in self.vocabulary)
        self.neighbours = Memo(self._may_follow, cache_entries)
        self.states = Memo(self._state, cache_entries)
        self.counts = Memo(self._word_count, cache_entries)

    def _may_follow(self, pair: tuple[str, str]) -> bool:
        """Whether merging leaves the two tokens; an empty first one asks for the second alone."""
        left, right = pair
        marked = right.endswith(_END)
        symbols = [*left, *(right.removesuffix(_END))]
        if marked:
            symbols[-1] += _END
        merged = bpe_merge(symbols, lambda a, b: self.ranks.get((a, b)))
        return merged == [token for token in pair if token]

    def _last(self, prefix: str, mark: str) -> tuple[str, int]:
        for size in range(min(self.longest, len(prefix)), 0, -1):
            token = prefix[-size:] + mark
            if token in self.vocabulary:
                before, count = self._at(prefix[:-size])
                if count >= 0 and self.neighbours[before, token]:
                    return token, count + 1
        return "", -1

    def _state(self, prefix: str) -> tuple[str, int]:
        return self._last(prefix, "")

    def _at(self, prefix: str) -> tuple[str, int]:
        return self.states[prefix] if prefix else ("", 0)

    def prefix_counts(self, word: str) -> list[int]:
        """The exact count of each prefix of a word, the first of one byte, each taken as a word."""
        mapped = "".join(self.symbols[b] for b in word.encode())
        for end in range(1, len(mapped)):  # shorter prefixes first: no deep recursion
            self._at(mapped[:end])
        return [self._last(mapped[:end], _END)[1] for end in range(1, len(mapped) + 1)]

    def _word_count(self, word: str) -> int:
        mapped = "".join(self.symbols[b] for b in word.encode())
        if len(mapped) > 64:
            return self._long_word(mapped)
        return self._last(mapped, _END)[1]

    def _long_word(self, mapped: str) -> int:
        """The same over an array: prefixes of very long words aren't kept."""
        states, n = [("", 0)], len(mapped)
        for end in range(1, n + 1):
            mark = _END if end == n else ""
            for size in range(min(self.longest, end), 0, -1):
                token = mapped[end - size : end] + mark
                before, count = states[end - size]
                if token in self.vocabulary and count >= 0 and self.neighbours[before, token]:
                    states.append((token, count + 1))
                    break
            else:
                states.append(("", -1))
        return states[-1][1]

    def split(self, text: str) -> list[tuple[str, int]]:
        """(word, its end) in normalized code points; a special token's string is one word."""
        out, offset = [], 0
        for part, special in self._parts(text):
            if special:
                offset += len(part)
                out.append((part, offset))
                continue
            normal = self._normal(part)
            if self.beyond_latin.search(normal):
                pieces = [(w, end) for w, (_, end) in self.splitter.pre_tokenize_str(normal)]
            else:
                pieces = [(m.group(), m.end()) for m in self.words.finditer(normal)]
            out += [(w, offset + end) for w, end in pieces]
            offset += len(normal)
        return out

    def _parts(self, text: str):
        at = 0
        for match in self.special.finditer(text):
            yield text[at : match.start()], False
            yield match.group(), True
            at = match.end()
        yield text[at:], False

    def _normal(self, text: str) -> str:
        return text.lower() if text.isascii() else self.library.normalizer.normalize_str(text)

    def count(self, text: str) -> int:
        total = 0
        for part, special in self._parts(text):
            if special:
                total += 1
                continue
            normal = self._normal(part)
            if self.beyond_latin.search(normal):
                words = [w for w, _ in self.splitter.pre_tokenize_str(normal)]
            else:
                words = self.words.findall(normal)
            total += sum(map(self.counts.__getitem__, words))
        return total

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """Ends of the words, in normalized code points, and the count of tokens up to each."""
        words = self.split(text)
        special = self.special.fullmatch
        sizes = (1 if special(w) else self.counts[w] for w, _ in words)
        return [end for _, end in words], list(accumulate(sizes))

    def fit(self, text: str, budget: int) -> int:
        """The end of the last word with which the tokens are at most budget."""
        ends, totals = self.table(text)
        at = bisect.bisect_right(totals, budget)
        return ends[at - 1] if at else 0


@cache
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(documents: DataFrame, path: str, budgets: Sequence[int] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, fits): tokens of each whole text, and where it must end to fit.

    fits[i] is the end, in code points of the normalized text, of the longest prefix of whole
    words that keeps to budgets[i]; null where the whole text does. A null text counts as
    empty. Columns besides doc_id and text are not looked at.
    """
    wanted = list(budgets)

    def count(rows):
        counter = _counter(path)
        for doc, text in rows:
            text = text or b""
            decoded = text.decode()
            total = counter.count(decoded)
            fits = [counter.fit(decoded, b) if total > b else None for b in wanted]
            yield doc, len(text), total, fits

    schema = "doc_id long, n_bytes long, n_tokens long, fits array<long>"
    return map_rows(documents.select("doc_id", "text"), schema, count)


def prefix_tables(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ends, counts): tokens up to the end of every word, for budgets asked later on."""

    def tables(rows):
        counter = _counter(path)
        for doc, text in rows:
            yield doc, *counter.table((text or b"").decode())

    schema = "doc_id long, ends array<long>, counts array<long>"
    return map_rows(documents.select("doc_id", "text"), schema, tables)


def tokens_before(ends: str, counts: str, end):
    """From a prefix table: the tokens of the words that end at or before a position."""
    n = F.size(F.filter(F.col(ends), lambda e: e <= end))
    return F.when(n > 0, F.element_at(F.col(counts), n)).otherwise(F.lit(0).cast("long"))
