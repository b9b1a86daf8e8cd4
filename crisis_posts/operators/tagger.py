"""A sequence tagger for names, learned from texts in which a gazetteer marks them.

Tokens are words and marks. A word with a capital may be part of a name; others never are. In
training texts a run of such words is marked if the gazetteer holds it as a whole, else each of
its words that the gazetteer holds, and the rest is a name of the default type. The first word of
a sentence teaches nothing, as its capital has no meaning; that is what lets lower-case
occurrences of a word tell it from a name there.

Spark counts which tag follows which and which tag a word has, O for words outside of names and
two tags, first and further word, for each type. A text is decoded run by run with Viterbi's
algorithm: around a run every tag is O. Scores are whole numbers (thousandths of natural
logarithms), so ties are real ties and go to the earlier tag.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions.texts import CAPITAL_WORD, CASED_TOKEN
from crisis_posts.operators import wordtable
from crisis_posts.operators.mentions import DEFAULT_TYPE
from crisis_posts.schemas import MENTIONS
from crisis_posts.sources.scratch import written

# An ordinary word has a capital within a sentence once in so many times.
CAPITAL_WITHIN = 100
MAX_TYPES = 100

_OUTSIDE = 0
_NEVER = -(10**9)
_RUNS_KEPT = 100_000


@dataclass(frozen=True)
class Tagger:
    """Scores of tags after tags, of unknown words, and the words' counts by tag.

    ``words`` has ``word`` in lower case and ``value``, its counts in the order of the tags; it
    holds only words that occur with a capital. ``totals`` and ``kinds`` count the words of a tag
    and its different words, ``follows[a][b]`` how often tag b follows tag a.
    """

    types: tuple[str, ...]
    words: DataFrame | None
    totals: tuple[int, ...]
    kinds: tuple[int, ...]
    follows: tuple[tuple[int, ...], ...]
    vocabulary: int

    def word_score(self, tag: int, count: int) -> int:
        """Witten-Bell smoothing: unknown words share what the tag's different words suggest."""
        kinds = max(self.kinds[tag], 1)
        return _thousandths(
            count * self.vocabulary + kinds, (self.totals[tag] + kinds) * self.vocabulary
        )

    def step_scores(self) -> list[list[int]]:
        """A further word needs a word of its type before it."""
        n = len(self.totals)
        allowed = [[b == _OUTSIDE or b % 2 == 1 or (b - 1) // 2 == (a - 1) // 2 and a > 0 for b in range(n)] for a in range(n)]
        out = []
        for a in range(n):
            total = sum(self.follows[a]) + sum(allowed[a])
            out.append([
                _thousandths(self.follows[a][b] + 1, total) if allowed[a][b] else _NEVER
                for b in range(n)
            ])
        return out


def _thousandths(part: int, whole: int) -> int:
    return round(1000 * math.log(part / whole))


def _tokens(text: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(CASED_TOKEN), F.lit(1))


def _capital_words(text: str) -> Column:
    """All tokens with a capital, and capitals within a token that has none: no other token is made."""
    return F.regexp_extract_all(F.col(text), F.lit(CAPITAL_WORD), F.lit(1))


def _is_capital(token: Column) -> Column:
    return F.coalesce(token.rlike(r"^\p{Lu}"), F.lit(False))


def _begins_sentence(tokens: str, at: Column) -> Column:
    return (at == 0) | F.get(tokens, at - 1).rlike(r"^[.!?]")


def _ends(of: str, at: Column, step: int) -> Column:
    """Whether a run of true elements of an array begins (step -1) or ends (1) at a place."""
    there = F.get(of, at + step) if step > 0 else F.when(at > 0, F.get(of, at - 1))
    return F.get(of, at) & ~F.coalesce(there, F.lit(False))


def _runs(of: str) -> Column:
    """struct(start, end) of the runs of true elements; both ends belong to them."""
    places = F.sequence(F.lit(0), F.size(of) - 1)
    every = F.when(F.size(of) > 0, places).otherwise(F.array().cast("array<int>"))
    starts = F.filter(every, lambda i: _ends(of, i, -1))
    ends = F.filter(every, lambda i: _ends(of, i, 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))


def _marked(posts: DataFrame, gazetteer: DataFrame, types: Sequence[str], text: str, max_rows: int) -> DataFrame:
    """Add ``_tokens`` and ``_tags``: null for the capital that begins a sentence."""
    kinds = F.array_position(F.array(*map(F.lit, types)), F.col("type")).cast("int") - 1
    spelled = F.regexp_replace(F.trim("entity"), r"\s+", " ")
    known = wordtable.unique_words(
        gazetteer.withColumn("entity", spelled).filter("entity != ''"), "entity", F.min(kinds)
    )

    def with_names(posts: DataFrame) -> DataFrame:
        opens = F.transform("_tokens", lambda w, i: _is_capital(w) & ~_begins_sentence("_tokens", i))
        inner = F.transform("_runs", lambda r: F.slice("_tokens", r["start"] + 1, r["end"] - r["start"] + 1))
        return (
            posts.withColumn("_tokens", _tokens(text)).withColumn("_open", opens)
            .withColumn("_runs", _runs("_open")).withColumn("_inner", inner)
            .withColumn("_names", F.transform("_inner", lambda words: F.array_join(words, " ")))
        )

    found = wordtable.Lookup(
        posts.filter(F.col(text).isNotNull()).select(text), text, with_names,
        lambda p: p.withColumn("_asked", F.concat("_names", F.flatten("_inner"))),
        known, "entity", max_rows,
    )
    found.add_values("_names", "_whole")
    found.add("_singles", lambda value: F.transform("_inner", lambda words: F.transform(words, value)))
    posts = found.close()
    default = list(types).index(DEFAULT_TYPE) if DEFAULT_TYPE in types else len(types) - 1

    def inside(k: Column) -> Column:
        whole, singles = F.get("_whole", k), F.get("_singles", k)

        def tag(single: Column, j: Column) -> Column:
            first = j == 0
            goes_on = ~first & F.when(~first, F.get(singles, j - 1)).isNull()
            return (
                F.when(whole.isNotNull(), 2 * whole + F.when(first, 1).otherwise(2))
                .when(single.isNotNull(), 2 * single + 1)
                .when(goes_on, 2 * default + 2)
                .otherwise(2 * default + 1)
            )

        return F.transform(singles, tag)

    def outside(start: Column, end: Column) -> Column:
        words = F.slice("_tokens", start + 1, end - start)
        return F.transform(words, lambda w: F.when(~_is_capital(w), _OUTSIDE).cast("int"))

    # Runs and what lies before each of them, in order; then what follows the last.
    after = lambda k: F.when(k > 0, F.get("_runs", k - 1)["end"] + 1).otherwise(0)
    parts = F.transform("_runs", lambda r, k: F.concat(outside(after(k), r["start"]), inside(k)))
    rest = outside(after(F.size("_runs")), F.size("_tokens"))
    return posts.withColumn("_tags", F.concat(F.flatten(parts), rest))


def learn_tagger(
    posts: DataFrame,
    gazetteer: DataFrame,
    text: str = "text",
    default_type: str = DEFAULT_TYPE,
    max_rows: int = wordtable.MAX_ROWS,
) -> Tagger:
    """Count tags and words over all posts with text.

    The types of the gazetteer come to the driver, and the counts of tags after tags; there may
    be MAX_TYPES types. The words' counts stay a table, counted on the map side.
    """
    listed = gazetteer.filter("entity is not null and type is not null").select("type").distinct()
    found = {row.type for row in listed.limit(MAX_TYPES + 1).collect()} | {default_type}
    if len(found) > MAX_TYPES:
        raise ValueError(f"the gazetteer has more than {MAX_TYPES} types")
    types = (*sorted(found - {default_type}), default_type)
    n = 2 * len(types) + 1
    marked = _marked(posts, gazetteer, types, text, max_rows)
    counts = written(_counts(marked))
    steps = counts.filter("word is null").collect()  # a row for two tags that meet
    follows = {(row.before, row.tag): row["count"] for row in steps}
    by_word = counts.filter("word is not null").groupBy("word").agg(
        F.array(*(F.sum(F.when(F.col("tag") == t, F.col("count")).otherwise(0)) for t in range(n))).alias("value"),
        F.max("capital").alias("capital"),
    )
    by_word = written(by_word)
    totals = by_word.agg(
        F.count_if(F.exists("value", lambda c: c > 0)).alias("words"),
        *(F.sum(F.col("value")[t]).alias(f"n{t}") for t in range(n)),
        *(F.count_if(F.col("value")[t] > 0).alias(f"k{t}") for t in range(n)),
    ).first()
    return Tagger(
        types=types,
        words=by_word.filter("capital").select("word", "value"),
        totals=tuple(totals[f"n{t}"] or 0 for t in range(n)),
        kinds=tuple(totals[f"k{t}"] for t in range(n)),
        follows=tuple(tuple(follows.get((a, b), 0) for b in range(n)) for a in range(n)),
        vocabulary=max(totals.words, 1),
    )


def _counts(marked: DataFrame) -> DataFrame:
    """How often a word has a tag, and how often a tag comes after another (a null word).

    A capital that begins a sentence has no tag, but its word will be asked for. Tokens are counted as
    they are; what a token is as a word is asked of each different one.
    """
    # One longer than the tokens, which leaves a row without a token.
    before = F.concat(F.array(F.lit(None).cast("int")), "_tags")
    zipped = F.arrays_zip(
        F.col("_tokens").alias("token"), before.alias("before"), F.col("_tags").alias("tag")
    )
    one = marked.select(F.explode_outer(zipped).alias("x")).select("x.*").filter("token is not null")
    met = one.groupBy("token", "before", "tag").count()
    none = F.lit(None)
    word = F.when(
        F.col("token").rlike(r"^\p{L}"),
        F.struct(
            F.lower("token").alias("word"), none.cast("int").alias("before"), "tag",
            _is_capital(F.col("token")).alias("capital"), "count",
        ),
    )
    step = F.when(
        F.col("before").isNotNull() & F.col("tag").isNotNull(),
        F.struct(
            none.cast("string").alias("word"), "before", "tag", F.lit(False).alias("capital"), "count"
        ),
    )
    rows = met.select(F.explode_outer(F.array(word, step)).alias("x")).filter("x is not null").select("x.*")
    return rows.groupBy("word", "before", "tag", "capital").agg(F.sum("count").alias("count"))


def tag_names(
    posts: DataFrame, tagger: Tagger, text: str = "text", max_rows: int = wordtable.MAX_ROWS
) -> DataFrame:
    """Add ``entities``, an array of struct(entity, type), to the posts with text.

    A name's words are joined by single spaces. ``max_rows`` words of the tagger may travel with
    the tasks; it changes no name.
    """

    def with_capitals(posts: DataFrame) -> DataFrame:
        numbered = F.transform("_tokens", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
        capitals = F.filter(numbered, lambda x: _is_capital(x["word"]))
        return (
            posts.withColumn("_tokens", _tokens(text)).withColumn("_capitals", capitals)
            .withColumn("_words", F.transform("_capitals", lambda x: F.lower(x["word"])))
        )

    look_up = wordtable.Lookup(
        posts.filter(F.col(text).isNotNull()), text, with_capitals,
        lambda p: p.withColumn("_asked", F.transform(_capital_words(text), F.lower)),
        tagger.words, "word", max_rows,
    )
    look_up.add_values("_words", "_counts")
    found = look_up.close()
    candidates = F.zip_with(
        "_capitals", "_counts",
        lambda x, counts: F.struct(
            x["word"].alias("word"),
            ((x["at"] == 0) | ~_is_capital(F.when(x["at"] > 0, F.get("_tokens", x["at"] - 1)))).alias("first"),
            _begins_sentence("_tokens", x["at"]).alias("begins"),
            counts.alias("counts"),
        ),
    )
    # Spark does not take a Python function out of an expression that holds the small table; what
    # a generator gives is no such expression.
    return (
        found.select("*", F.explode_outer(F.array(candidates)).alias("_candidates"))
        .withColumn("entities", _decoder(tagger)(F.col("_candidates")))
        .drop("_tokens", "_capitals", "_words", "_counts", "_candidates")
    )


def _decoder(tagger: Tagger):
    """An Arrow function from the capitals of texts to their names."""
    # The workers have no session: they get the numbers only.
    numbers, steps = replace(tagger, words=None), tagger.step_scores()
    within = _thousandths(1, CAPITAL_WITHIN)
    met: dict[tuple, list[int]] = {}  # tags of runs decoded before, by the counts of their words
    known: list[dict[int, int]] = [{} for _ in steps]  # scores by tag and count

    def score(tag: int, count: int) -> int:
        own = known[tag]
        if count not in own:
            own[count] = numbers.word_score(tag, count)
        return own[count]

    def scores(counts: Sequence[int], begins: bool) -> list[int]:
        out = list(map(score, range(len(counts)), counts))
        if not begins:
            out[_OUTSIDE] += within
        return out

    def tags(begins: bool, counts: Sequence[tuple[int, ...]]) -> list[int]:
        key = (begins, *counts)
        if key not in met:
            if len(met) >= _RUNS_KEPT:
                met.clear()
            met[key] = viterbi([scores(c, begins and not k) for k, c in enumerate(counts)], steps)
        return met[key]

    def rows_of(counts: pa.ListArray) -> list[tuple[int, ...]]:
        """A word that was not counted has no counts, which are zeros."""
        out = np.zeros((len(counts), len(numbers.totals)), np.int64)
        out[counts.is_valid().to_numpy(zero_copy_only=False)] = (
            counts.flatten().to_numpy(zero_copy_only=False).reshape(-1, out.shape[1])
        )
        return list(map(tuple, out.tolist()))

    def decode(column: pa.Array) -> pa.Array:
        flat = column.flatten()
        words, first, begins = (flat.field(f).to_pylist() for f in ("word", "first", "begins"))
        counts = rows_of(flat.field("counts"))
        entities, kinds, ends = [], [], [0]
        at = 0
        for size in column.value_lengths().to_pylist():
            end = at + (size or 0)
            while at < end:
                upto = at + 1
                while upto < end and not first[upto]:
                    upto += 1
                run = words[at:upto]
                for name in named(run, numbers.types, tags(begins[at], counts[at:upto])):
                    entities.append(name["entity"])
                    kinds.append(name["type"])
                at = upto
            ends.append(len(entities))
        pairs = pa.StructArray.from_arrays(
            [pa.array(entities, pa.string()), pa.array(kinds, pa.string())], ["entity", "type"]
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    return F.arrow_udf(decode, MENTIONS)


def viterbi(words: Sequence[Sequence[int]], steps: Sequence[Sequence[int]]) -> list[int]:
    """The best tags of a run of words between tags O; of equal ones the earliest tag."""
    tags = range(len(steps))
    best, back = [steps[_OUTSIDE][t] + words[0][t] for t in tags], []
    for scores in words[1:]:
        totals = [[best[a] + steps[a][t] for a in tags] for t in tags]
        best = [max(own) for own in totals]
        back.append([own.index(most) for own, most in zip(totals, best, strict=True)])
        best = [most + scores[t] for t, most in enumerate(best)]
    last = [best[t] + steps[t][_OUTSIDE] for t in tags]
    out = [last.index(max(last))]
    for came in reversed(back):
        out.append(came[out[-1]])
    return out[::-1]


def named(words: Sequence[str], types: Sequence[str], tags: Sequence[int]) -> list[dict]:
    """The names that tags make of words."""
    out = []
    for word, tag in zip(words, tags, strict=True):
        if tag % 2 == 1:
            out.append({"entity": word, "type": types[(tag - 1) // 2]})
        elif tag:
            out[-1]["entity"] += f" {word}"
    return out
