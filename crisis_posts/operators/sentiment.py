"""Sentiment of a post: from a word lexicon, or from any scorer the caller plugs in."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions.texts import words
from crisis_posts.operators import wordtable

MEASURES = ("polarity", "subjectivity")


def with_lexicon_sentiment(
    posts: DataFrame,
    lexicon: DataFrame,
    text: str = "text",
    max_rows: int = wordtable.MAX_ROWS,
) -> DataFrame:
    """Add both sentiment columns: the mean over the text's words found in the lexicon.

    A repeated word counts each time, a text without a hit scores 0.0 and a null text
    scores null. Lexicon words are matched in lower case; rows of one word are averaged.
    Hits are summed in the order of the text, however they were looked up; ``max_rows`` is the
    number of lexicon rows that may travel with the tasks.
    """
    folded = lexicon.dropna(subset=list(MEASURES)).withColumn("word", F.lower("word"))
    table = wordtable.unique_words(folded, "word", F.struct(*[F.avg(m).alias(m) for m in MEASURES]))
    found = wordtable.Lookup(
        posts, text, lambda p: p.withColumn("_words", words(F.col(text))),
        lambda p: p.withColumn("_asked", F.col("_words")), table, "word", max_rows,
    )
    found.add_hits("_words", "_hits")

    def mean(measure: str) -> Column:
        total = F.aggregate("_hits", F.lit(0.0), lambda sum_, hit: sum_ + hit["value"][measure])
        return F.when(F.size("_hits") > 0, total / F.size("_hits"))

    unhit = F.when(F.col(text).isNotNull(), 0.0)
    scores = {f"sentiment_{m}": F.coalesce(mean(m), unhit) for m in MEASURES}
    return found.close().withColumns(scores).drop("_words", "_hits")


def with_scorer_sentiment(
    posts: DataFrame, scorer: Callable[[Column], Column], text: str = "text"
) -> DataFrame:
    """As above with a pandas UDF from text to struct(polarity, subjectivity).

    The scorer never meets a null: a null text is handed over empty and its score dropped.
    """
    score = F.when(F.col(text).isNotNull(), scorer(F.coalesce(text, F.lit(""))))
    return (
        posts.withColumn("_score", score)
        .withColumns({f"sentiment_{m}": F.col(f"_score.{m}") for m in MEASURES})
        .drop("_score")
    )
