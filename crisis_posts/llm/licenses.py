"""License statements in texts by ordered signatures.

A text is reduced to its lower-case words. One pass of an automaton over all keywords tells which
of the signatures (``license_rules``) can match at all; only their patterns are run. Where found
intervals lie within each other, a signature of higher priority suppresses what it contains, of
equal priority the longer interval does, and of equal intervals the earlier rule.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Sequence
from functools import cache
from itertools import accumulate, groupby

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from crisis_posts.llm.license_rules import BASE, RULES, Rule
from crisis_posts.llm.shared import map_rows

# Words are runs of ASCII letters and digits and of bytes beyond ASCII.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
    for b in range(256)
)

Found = tuple[int, int, int]  # start, end, number of the rule


class Signatures:
    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = rules
        self.patterns: list[re.Pattern | None] = [None] * len(rules)  # compiled when first needed
        self.needs: dict[str, list[int]] = {}
        for number, rule in enumerate(rules):
            for keyword in rule.keywords():
                self.needs.setdefault(keyword, []).append(number)
        self.missing = [len(rule.keywords()) for rule in rules]
        self.always = [number for number, n in enumerate(self.missing) if not n]
        self.automaton = ahocorasick.Automaton()
        for keyword in self.needs:
            self.automaton.add_word(keyword, keyword)
        self.automaton.make_automaton()

    def candidates(self, words: str) -> list[int]:
        """The rules all of whose keywords stand in the words."""
        seen = {keyword for _, keyword in self.automaton.iter(words)}
        missing: dict[int, int] = {}
        for keyword in seen:
            for number in self.needs[keyword]:
                missing[number] = missing.get(number, self.missing[number]) - 1
        return sorted([number for number, n in missing.items() if not n] + self.always)

    def matches(self, words: str, number: int) -> list[tuple[int, int]]:
        if self.patterns[number] is None:
            self.patterns[number] = self.rules[number].compiled()
        return [match.span() for match in self.patterns[number].finditer(words)]

    def find(self, words: str) -> list[Found]:
        """Character intervals that no better signature contains, by start."""
        found = [(*span, n) for n in self.candidates(words) for span in self.matches(words, n)]
        return unsuppressed(found, self.rules) if found else []


def unsuppressed(found: Sequence[Found], rules: Sequence[Rule]) -> list[Found]:
    """What is left of the intervals when each has suppressed those it contains."""
    kept: list[Found] = []
    starts: list[int] = []
    furthest: list[int] = []  # of the intervals of higher priority up to each start

    def priority(x: Found) -> int:
        return rules[x[2]].priority

    better: list[Found] = []
    for _, group in groupby(sorted(found, key=priority), priority):
        own = sorted(group, key=lambda x: (x[0], -x[1], x[2]))
        reached = -1  # the furthest end of own intervals so far
        for start, end, number in own:
            at = bisect_right(starts, start)
            if end > reached and not (at and furthest[at - 1] >= end):
                kept.append((start, end, number))
            reached = max(reached, end)
        better = sorted([*better, *own])
        starts = [x[0] for x in better]
        furthest = list(accumulate((x[1] for x in better), max))
    return sorted(kept)


@cache
def _signatures() -> Signatures:
    return Signatures()


def find_licenses(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, base, found, score) of each whole text.

    base lists (label, start) of all places of the fixed phrases, by start; found lists (label,
    form, start, end, confidence) of the signatures that no better one contains. Places are words,
    from 0, ends exclusive. score is the highest confidence in found, 0.0 without any. A null or
    empty text has no words. Rows with equal or null doc_id are judged one by one; columns besides
    doc_id and text are not looked at.
    """

    def scan(rows):
        signatures = _signatures()
        for doc, text in rows:
            words = b" ".join((text or b"").translate(_WORD_BYTES).split())
            n_words = words.count(b" ") + 1 if words else 0
            spaced = f" {words.decode('latin-1')} "
            found = signatures.find(spaced)
            places = [
                (at + 1, label) for phrase, label in BASE
                for at in _occurrences(spaced, f" {phrase} ")
            ] if found else []
            if not found:
                yield doc, n_words, [], [], 0.0
                continue
            starts = np.flatnonzero(np.frombuffer(spaced.encode("latin-1"), np.uint8) == 32) + 1
            word_at = starts.searchsorted
            base = sorted((int(word_at(at)), label) for at, label in places)
            shown = [
                (rule.label, rule.form, int(word_at(start)), int(word_at(end)), rule.confidence)
                for start, end, number in found for rule in [signatures.rules[number]]
            ]
            yield doc, n_words, [(label, at) for at, label in base], shown, max(x[-1] for x in shown)

    schema = (
        "doc_id long, n_words long, base array<struct<label:string,start:long>>, "
        "found array<struct<label:string,form:string,start:long,end:long,confidence:double>>, "
        "score double"
    )
    return map_rows(documents.select("doc_id", "text"), schema, scan)


def _occurrences(text: str, phrase: str) -> list[int]:
    out, at = [], text.find(phrase)
    while at >= 0:
        out.append(at)
        at = text.find(phrase, at + 1)
    return out
