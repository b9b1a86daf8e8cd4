"""Text of a post, its words, its name-like words, and the sentiment band."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from crisis_posts.schemas import BAND_BOUNDS, BAND_NAMES

# A word is a whole run of letters. A name is a run of words that each begin with a capital
# and have two letters or more, so a word in capitals is one. The other alternatives step over
# the words that are no names, so that no name starts inside a word.
WORD = r"([\p{L}\p{M}]+)"
NAME = (
    r"(\p{Lu}[\p{L}\p{M}]+(?: \p{Lu}[\p{L}\p{M}]+)*)"
    r"|\p{Lu}|[\p{Ll}\p{Lt}\p{Lm}\p{Lo}\p{M}][\p{L}\p{M}]*"
)

# A word with its inner apostrophes, or a mark that ends a clause.
TOKEN = r"([\p{L}\p{M}]+(?:['’][\p{L}\p{M}]+)*|[.,;:!?])"
# The same for texts in their own case, with marks that end a sentence kept in one token, and
# any other character but white space as a token of its own.
CASED_TOKEN = r"([\p{L}\p{M}]+(?:['’-][\p{L}\p{M}]+)*|[.!?]+|[^\s\p{L}\p{M}])"
# A word that begins with a capital, at the start of such a token or within one after a mark.
CAPITAL_WORD = r"(?<![\p{L}\p{M}])(\p{Lu}[\p{L}\p{M}]*(?:['’-][\p{L}\p{M}]+)*)"
CLAUSE_MARKS = (".", ",", ";", ":", "!", "?")


def effective_text(truncated: Column, text: Column, full_text: Column) -> Column:
    """The full text of a truncated post, else its text (also when the flag is null)."""
    return F.when(truncated, full_text).otherwise(text)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(1))


def tokens(text: Column) -> Column:
    """Words in lower case and the marks between clauses, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(1))


def names(text: Column, pattern: str = NAME) -> Column:
    """Every match of the pattern's first group, in order, from the whole text.

    A match that leaves the group out is none.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.filter(found, lambda name: name != "")


def sentiment_band(
    polarity: Column,
    bounds: tuple[float, float] = BAND_BOUNDS,
    bands: Sequence[str] = BAND_NAMES,
) -> Column:
    """Low, middle (bounds included) or high band; null and NaN fall in the high band."""
    low, high = bounds
    return (
        F.when(polarity < low, bands[0])
        .when(polarity.between(low, high), bands[1])
        .otherwise(bands[2])
    )
