"""Raw posts and classifier labels to the enriched table.

One scan of the raw posts: every derived column is row-wise, so the only shuffle is the
label join. All other work, scoring included, comes before it: it then follows the input
splits and not the keys, so an id that holds many posts delays nothing but the join.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions import dates, places
from crisis_posts.functions.texts import effective_text
from crisis_posts.operators.scope import with_scoped_sentiment
from crisis_posts.operators.sentiment import with_lexicon_sentiment, with_scorer_sentiment
from crisis_posts.operators.wordtable import MAX_ROWS
from crisis_posts.schemas import CORRUPT, ENRICHED, PHASE_CUTS, US_STATES


def project_posts(raw: DataFrame) -> DataFrame:
    """Flatten to the 13 columns the enrichment reads."""
    return raw.select(
        "id", "user.name", "user.screen_name", "user.verified", "text",
        "extended_tweet.full_text", "created_at", "retweeted_status", "truncated",
        "possibly_sensitive", "favorite_count", "place", "coordinates",
    )


def drop_reposts(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("retweeted_status").isNull())


def derive_columns(
    posts: DataFrame,
    states: Mapping[str, str] = US_STATES,
    phase_cuts: tuple[str, str] = PHASE_CUTS,
) -> DataFrame:
    """Text, date, points, state, phase and hour, in place of what they come from."""
    place_latitude, place_longitude = places.place_point(
        F.col("place.bounding_box.coordinates")
    )
    longitude, latitude = places.exact_point(F.col("coordinates.coordinates"))
    state = places.place_state(
        F.col("place.country_code"), F.col("place.place_type"), F.col("place.full_name"), states
    )
    return posts.select(
        "id",
        "name",
        "screen_name",
        "verified",
        effective_text(F.col("truncated"), F.col("text"), F.col("full_text")).alias("text"),
        "possibly_sensitive",
        "favorite_count",
        dates.parse_post_date(F.col("created_at")).alias("date"),
        place_latitude.alias("place_latitude"),
        place_longitude.alias("place_longitude"),
        F.col("place.full_name").alias("place_name"),
        longitude.alias("longitude"),
        latitude.alias("latitude"),
        state.alias("place_state"),
    ).withColumns(
        {
            "phase": dates.phase(F.col("date"), phase_cuts),
            "timerange_end": dates.hour_bucket(F.col("date")),
        }
    )


def join_labels(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join on id: unlabelled posts drop out, several labels give several rows.

    No strategy is forced: a small label side is broadcast by its measured size, and an
    id that holds many rows on either side is split by the adaptive skew join.
    """
    return posts.join(labels.select("id", "aidr_label"), "id")


def enrich_posts(
    raw: DataFrame,
    labels: DataFrame,
    lexicon: DataFrame | None = None,
    scorer: Callable[[Column], Column] | None = None,
    keep_id: bool = False,
    states: Mapping[str, str] = US_STATES,
    phase_cuts: tuple[str, str] = PHASE_CUTS,
    max_words: int = MAX_ROWS,
    modifiers: DataFrame | None = None,
) -> DataFrame:
    """The enriched table, scored from ``lexicon`` or by ``scorer`` (one is needed).

    With ``modifiers`` the lexicon is read with scope: negation, boosters, entries of several words.
    ``max_words`` lexicon rows may travel with the tasks; it changes no score.
    """
    if (lexicon is None) == (scorer is None):
        raise ValueError("give either a lexicon or a scorer")
    posts = derive_columns(drop_reposts(project_posts(raw)), states, phase_cuts)
    if scorer is not None:  # a model is dear: only posts that will stay are scored
        posts = posts.join(labels.select("id").distinct(), "id", "left_semi")
    if scorer is not None:
        scored = with_scorer_sentiment(posts, scorer)
    elif modifiers is not None:
        scored = with_scoped_sentiment(posts, lexicon, modifiers, max_rows=max_words)
    else:
        scored = with_lexicon_sentiment(posts, lexicon, max_rows=max_words)
    return join_labels(scored, labels).select(*(["id"] if keep_id else []), *ENRICHED.names)


def post_rejects(raw: DataFrame) -> DataFrame:
    """Posts that the enriched table lacks or has only in part, with the first reason.

    ``post`` holds the whole post: a field is read, and found unreadable, only if something
    asks for it.
    """
    kept = drop_reposts(raw)
    text = effective_text(F.col("truncated"), F.col("text"), F.col("extended_tweet.full_text"))
    reason = (
        F.when(F.col(CORRUPT).isNotNull() & F.col("id").isNotNull(), "unreadable field")
        .when(F.col(CORRUPT).isNotNull(), "unreadable line")
        .when(F.col("id").isNull(), "no id")
        .when(text.isNull(), "no text")
        .when(dates.parse_post_date(F.col("created_at")).isNull(), "unreadable date")
    )
    return kept.select(
        "id", text.alias("text"), "created_at", CORRUPT, reason.alias("reason"),
        F.to_json(F.struct(*raw.columns)).alias("post"),
    ).filter(F.col("reason").isNotNull())
