"""Table schemas and the fixed domains that results must agree on."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

LONG, INT, DOUBLE, STRING, BOOLEAN = (
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.StringType(),
    T.BooleanType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Only the fields the enrichment reads: the JSON scan skips everything else.
RAW_POST = _struct(
    id=LONG,
    user=_struct(name=STRING, screen_name=STRING, verified=BOOLEAN),
    text=STRING,
    extended_tweet=_struct(full_text=STRING),
    created_at=STRING,
    retweeted_status=_struct(id=LONG),
    truncated=BOOLEAN,
    possibly_sensitive=BOOLEAN,
    favorite_count=LONG,
    place=_struct(
        full_name=STRING,
        country_code=STRING,
        place_type=STRING,
        bounding_box=_struct(coordinates=T.ArrayType(T.ArrayType(T.ArrayType(DOUBLE)))),
    ),
    coordinates=_struct(coordinates=T.ArrayType(DOUBLE)),
    **{CORRUPT: STRING},
)

LABEL = _struct(id=LONG, date=STRING, aidr_label=STRING, aidr_confidence=STRING)

ENRICHED = _struct(
    name=STRING,
    screen_name=STRING,
    verified=BOOLEAN,
    text=STRING,
    possibly_sensitive=BOOLEAN,
    favorite_count=LONG,
    date=T.TimestampNTZType(),
    sentiment_polarity=DOUBLE,
    sentiment_subjectivity=DOUBLE,
    aidr_label=STRING,
    place_latitude=DOUBLE,
    place_longitude=DOUBLE,
    place_name=STRING,
    longitude=DOUBLE,
    latitude=DOUBLE,
    place_state=STRING,
    phase=INT,
    timerange_end=INT,
)

ROLLUP = _struct(
    aidr_label=STRING,
    place_state=STRING,
    phase=INT,
    date=T.TimestampNTZType(),
    verified=BOOLEAN,
    possibly_sensitive=BOOLEAN,
    posts=LONG,
    sum_polarity=DOUBLE,
    count_polarity=LONG,
    sum_subjectivity=DOUBLE,
    count_subjectivity=LONG,
)

# Return types of a plugged-in scorer and tagger.
SENTIMENT = _struct(polarity=DOUBLE, subjectivity=DOUBLE)
MENTIONS = T.ArrayType(_struct(entity=STRING, type=STRING))

LEXICON = _struct(word=STRING, polarity=DOUBLE, subjectivity=DOUBLE)
MODIFIER = _struct(word=STRING, kind=STRING, factor=DOUBLE)
GAZETTEER = _struct(entity=STRING, type=STRING)
ENTITY_TOTAL = _struct(entity=STRING, type=STRING, total_count=LONG)

# Full state name -> postal code, as place names are normalized.
US_STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR",
    "California": "CA", "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID",
    "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS",
    "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS",
    "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY",
    "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK",
    "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC",
    "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT",
    "Vermont": "VT", "Virginia": "VA", "Washington": "WA", "West Virginia": "WV",
    "Wisconsin": "WI", "Wyoming": "WY",
}

# The classifier labels that means are reported for, in display order.
AIDR_LABELS = (
    "affected_individual",
    "caution_and_advice",
    "donation_and_volunteering",
    "infrastructure_and_utilities_damage",
    "injured_or_dead_people",
    "not_related_or_irrelevant",
    "personal",
    "relevant_information",
    "response_efforts",
    "sympathy_and_support",
)

# Phase names offered by the filter and their codes.
PHASE_CODES = {"Pre": 0, "Durante": 1, "Post": 2}

# First midnight of phase 1 and the midnight that is its last moment.
PHASE_CUTS = ("2017-08-17", "2017-09-12")

# Canonical entity, the full-match pattern it replaces, its type.
ENTITY_RULES = (
    ("Harvey", "(?i)^(harvey|hurricane harvey)$", "MISC"),
    ("Irma", "(?i)^irma$", "MISC"),
)

# Both bounds belong to the middle band.
BAND_BOUNDS = (-0.3, 0.3)
BAND_NAMES = ("red", "blue", "green")
