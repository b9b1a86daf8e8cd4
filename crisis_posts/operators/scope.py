"""Sentiment with scope: negation, intensifiers and entries of several words.

A text is read from left to right by a state machine over its tokens:

- A lexicon entry adds its polarity and subjectivity. Of the entries that begin at a token the
  one of most words counts, and the tokens it covers begin no other.
- A negator multiplies the polarity of the entries that begin within the next ``scope`` tokens
  by its factor. One within another's scope multiplies the factors and starts the scope anew.
- A booster multiplies the entry that begins right after it, or passes its factor on to a
  booster there: polarity and subjectivity both, within their ranges.
- A mark that ends a clause ends what negators and boosters have begun.

The score is the mean over the entries that count. Words are looked up as in ``wordtable``; a
phrase is looked up only where its first word begins a phrase of that many words, so all that
is folded are the few tokens that mean something.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions.texts import CLAUSE_MARKS, tokens
from crisis_posts.operators import wordtable
from crisis_posts.operators.sentiment import MEASURES

NEGATION_SCOPE = 3
NEGATOR, BOOSTER = "negator", "booster"
# Places of the array that tells which tokens may begin a phrase.
MAX_SLOTS = 1 << 18

_MEANING = ("polarity", "subjectivity", "negate", "boost")


def entries(lexicon: DataFrame, modifiers: DataFrame) -> DataFrame:
    """The look-up table: ``word``, an entry in lower case with single spaces, and its ``value``.

    Rows of one entry are averaged. An entry may be in both tables: it is scored first, and
    what it modifies comes after it. A modifier of another kind is left out. The first word of a
    phrase also has the most words of a phrase that it begins.
    """
    none = F.lit(None).cast("double")
    scored = lexicon.dropna(subset=list(MEASURES)).select(
        "word", *MEASURES, none.alias("negate"), none.alias("boost")
    )
    modifying = modifiers.filter(F.col("kind").isin(NEGATOR, BOOSTER)).select(
        "word", *(none.alias(m) for m in MEASURES),
        F.when(F.col("kind") == NEGATOR, F.col("factor")).alias("negate"),
        F.when(F.col("kind") == BOOSTER, F.col("factor")).alias("boost"),
    )
    spelled = F.regexp_replace(F.trim(F.lower("word")), r"\s+", " ")
    parts = F.split("word", " ")
    entry = F.struct("word", *_MEANING, F.lit(None).cast("int").alias("longest"))
    beginning = F.struct(
        parts[0].alias("word"), *(none.alias(m) for m in _MEANING), F.size(parts).alias("longest")
    )
    return (
        scored.unionByName(modifying).withColumn("word", spelled).filter(F.col("word") != "")
        .select(F.inline(F.when(F.size(parts) > 1, F.array(entry, beginning)).otherwise(F.array(entry))))
        .groupBy("word")
        .agg(F.struct(*(F.avg(m).alias(m) for m in _MEANING), F.max("longest").alias("longest")).alias("value"))
    )


def with_scoped_sentiment(
    posts: DataFrame,
    lexicon: DataFrame,
    modifiers: DataFrame,
    text: str = "text",
    scope: int = NEGATION_SCOPE,
    max_rows: int = wordtable.MAX_ROWS,
) -> DataFrame:
    """Add both sentiment columns, by the state machine described above.

    ``lexicon`` has word, polarity and subjectivity, ``modifiers`` word, kind (negator or
    booster) and factor. A text without an entry scores 0.0 and a null text null. ``max_rows``
    entries may travel with the tasks; it changes no score.
    """
    table = entries(lexicon, modifiers)
    found = wordtable.Lookup(
        posts, text, lambda p: p.withColumn("_tokens", tokens(F.col(text))),
        lambda p: _with_asked(p, table), table, "word", max_rows,
    )
    found.add_hits("_tokens", "_hits")
    found.posts = found.posts.withColumn("_possible", _possible_phrases()).withColumn(
        "_phrases", F.col("_possible.phrase")
    )
    found.add_hits("_phrases", "_phrase_hits")
    last = _folded(F.array_sort(F.concat(_marks(), _words(), _whole_phrases())), scope)
    unhit = F.when(F.col(text).isNotNull(), 0.0)
    scores = {
        f"sentiment_{m}": F.coalesce(F.try_divide(F.col("_last")[m], F.col("_last.n")), unhit)
        for m in MEASURES
    }
    return (
        found.close().withColumn("_last", last)
        .withColumns(scores)
        .drop("_tokens", "_hits", "_possible", "_phrases", "_phrase_hits", "_last")
    )


def _possible_phrases() -> Column:
    """struct(at, words, phrase) for each number of words that a phrase from a token may have."""

    beginning = F.filter("_hits", lambda hit: hit["value"]["longest"].isNotNull())
    return F.flatten(
        F.transform(beginning, lambda hit: _phrases_at(hit["position"], hit["value"]["longest"]))
    )


def _phrases_at(at: Column, longest: Column) -> Column:
    most = F.least(longest, F.size("_tokens") - at)
    lengths = F.when(most > 1, F.sequence(F.lit(2), most)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        lengths,
        lambda n: F.struct(
            at.alias("at"), n.alias("words"),
            F.array_join(F.slice("_tokens", at + 1, n), " ").alias("phrase"),
        ),
    )


def _with_asked(posts: DataFrame, table: DataFrame) -> DataFrame:
    """Add the tokens, and every phrase that may be looked up once the tokens' values are known.

    How long a phrase may be is told by the slot of its first word: an array of checked size, which
    may ask for some phrases too many and for none too few.
    """
    beginning = table.filter(F.col("value.longest").isNotNull()).select("word", "value.longest")
    rows = beginning.limit(MAX_SLOTS).count()
    slots = min(1 << (4 * rows).bit_length(), MAX_SLOTS)
    longest = wordtable.by_slot(beginning, "word", slots, F.max("longest"), lambda most: most)
    reach = F.transform(
        "_tokens",
        lambda w, i: F.struct(
            i.alias("at"), F.get("_longest", wordtable.slot_of(w, slots)).alias("longest")
        ),
    )
    begin = F.filter("_reach", lambda x: x["longest"].isNotNull())
    phrases = F.flatten(F.transform(begin, lambda x: _phrases_at(x["at"], x["longest"])))
    return (
        posts.withColumn("_longest", longest).withColumn("_reach", reach).drop("_longest")
        .withColumn("_asked", F.concat("_tokens", phrases["phrase"]))
    )


def _event(at: Column, words: Column, mark: bool, value: Column | None) -> Column:
    """Sorted by its place, longer ones first."""
    null = F.lit(None).cast("double")
    return F.struct(
        at.alias("at"), (-words).alias("shorter"), F.lit(mark).alias("mark"),
        *((null if value is None else value[m]).alias(m) for m in _MEANING),
    )


def _marks() -> Column:
    numbered = F.transform("_tokens", lambda w, i: F.struct(i.alias("at"), w.alias("token")))
    marks = F.filter(numbered, lambda x: x["token"].isin(*CLAUSE_MARKS))
    return F.transform(marks, lambda x: _event(x["at"], F.lit(1), True, None))


def _words() -> Column:
    def means_something(hit: Column) -> Column:
        value = hit["value"]
        return F.coalesce(*(value[m] for m in _MEANING)).isNotNull()

    return F.transform(
        F.filter("_hits", means_something),
        lambda hit: _event(hit["position"], F.lit(1), False, hit["value"]),
    )


def _whole_phrases() -> Column:
    def event(hit: Column) -> Column:
        phrase = F.get("_possible", hit["position"])
        return _event(phrase["at"], phrase["words"], False, hit["value"])

    return F.transform("_phrase_hits", event)


def _folded(events: Column, scope: int) -> Column:
    """The state after the last token: sums over the entries, and their number."""
    one = F.lit(1.0)
    start = F.struct(
        F.lit(0).alias("covered"), one.alias("negate"), F.lit(-1).alias("negate_until"),
        one.alias("boost"), F.lit(-1).alias("boost_at"),
        F.lit(0.0).alias("polarity"), F.lit(0.0).alias("subjectivity"), F.lit(0).alias("n"),
    )

    def step(state: Column, event: Column) -> Column:
        at, end = event["at"], event["at"] - event["shorter"]
        negate = F.when(at <= state["negate_until"], state["negate"]).otherwise(one)
        boost = F.when(at == state["boost_at"], state["boost"]).otherwise(one)
        scored = event["polarity"].isNotNull()
        polarity = F.greatest(F.least(event["polarity"] * boost * negate, one), -one)
        subjectivity = F.greatest(F.least(event["subjectivity"] * boost, one), F.lit(0.0))
        negates, boosts = event["negate"].isNotNull(), event["boost"].isNotNull()
        after = F.struct(
            end.alias("covered"),
            F.when(negates, negate * event["negate"]).otherwise(state["negate"]).alias("negate"),
            F.when(negates, end - 1 + scope).otherwise(state["negate_until"]).alias("negate_until"),
            F.when(boosts, boost * event["boost"]).otherwise(state["boost"]).alias("boost"),
            F.when(boosts, end).otherwise(state["boost_at"]).alias("boost_at"),
            (state["polarity"] + F.when(scored, polarity).otherwise(0.0)).alias("polarity"),
            (state["subjectivity"] + F.when(scored, subjectivity).otherwise(0.0)).alias("subjectivity"),
            (state["n"] + F.when(scored, 1).otherwise(0)).alias("n"),
        )
        ended = F.struct(
            state["covered"].alias("covered"), one.alias("negate"), F.lit(-1).alias("negate_until"),
            one.alias("boost"), F.lit(-1).alias("boost_at"), state["polarity"].alias("polarity"),
            state["subjectivity"].alias("subjectivity"), state["n"].alias("n"),
        )
        return (
            F.when(event["mark"], ended).when(at < state["covered"], state).otherwise(after)
        )

    return F.aggregate(events, start, step)
