"""The test tables seen as posts: raw, enriched, and as label-file lines.

An event is a post with its date, label and score. The document of the same id, where there
is one, is its text, the document's quality and toxicity its flags, the embedding of the id
its point, the event's customer its author and place. Side tables have unique keys, so a
query that does not read a side's columns leaves that join out.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crisis_posts.functions import dates, literals, places

# 25 nations stand for the states; one is left out as the unknown name.
STATES = {f"NATION_{i}": f"N{i}" for i in range(25) if i != 21}
PHASE_CUTS = ("2024-01-02", "2024-01-03")
LABELS = ("click", "error", "nosuch", "purchase", "signup", "view")
STATE_DOMAIN = tuple(f"N{i}" for i in range(26))

LEXICON = (
    {"word": "the", "polarity": 0.5, "subjectivity": 0.4},
    {"word": "of", "polarity": -0.6, "subjectivity": 0.9},
    {"word": "and", "polarity": 0.1, "subjectivity": 0.2},
    {"word": "in", "polarity": -0.2, "subjectivity": 0.5},
)
# For scores with scope: more entries, some of several words, and what modifies them.
SCOPED_LEXICON = (
    *LEXICON,
    {"word": "of the", "polarity": -0.9, "subjectivity": 0.3},
    {"word": "of the and", "polarity": 0.7, "subjectivity": 0.8},
    {"word": "that", "polarity": 0.3, "subjectivity": 0.6},
)
MODIFIERS = (
    {"word": "to", "kind": "negator", "factor": -0.5},
    {"word": "by", "kind": "negator", "factor": -0.8},
    {"word": "is", "kind": "booster", "factor": 1.5},
    {"word": "was", "kind": "booster", "factor": 0.5},
    {"word": "that", "kind": "booster", "factor": 1.25},
)
GAZETTEER = (
    {"entity": "The", "type": "ART"},
    {"entity": "Of", "type": "PREP"},
    {"entity": "Ción", "type": "LOC"},
    {"entity": "Orre", "type": "PER"},
)
# For the tagger: names of several words too, and one that is also an ordinary word.
MARKED = (
    *GAZETTEER,
    {"entity": "Éèpa Éèpa", "type": "LOC"},
    {"entity": "Is Of", "type": "PER"},
    {"entity": "And", "type": "PER"},
)
RULES = (
    ("The", "(?i)^(the|of)$", "WORD"),
    ("Orre", "(?i)^orre$", "NAME"),
)

TEXT = {"text", "source", "favorite_count"}
FLAGS = {"verified", "possibly_sensitive"}
POINT = {"longitude", "latitude"}
PLACE = {
    "name", "screen_name", "country_code", "place_type", "place_name",
    "place_latitude", "place_longitude", "place_state",
}
EVERY_SIDE = TEXT | FLAGS | POINT | PLACE

# The columns read; a given schema spares a job per table that looks for it.
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    "labels": "doc_id long, quality int, toxic int",
    "embeddings": "vec_id long, embedding array<float>",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession) -> DataFrame:
    return literals.rows(spark, LEXICON, "word string, polarity double, subjectivity double")


def scoped_lexicon(spark: SparkSession) -> DataFrame:
    return literals.rows(spark, SCOPED_LEXICON, "word string, polarity double, subjectivity double")


def modifiers(spark: SparkSession) -> DataFrame:
    return literals.rows(spark, MODIFIERS, "word string, kind string, factor double")


def marked_names(spark: SparkSession) -> DataFrame:
    return literals.rows(spark, MARKED, "entity string, type string")


def gazetteer(spark: SparkSession) -> DataFrame:
    return literals.rows(spark, GAZETTEER, "entity string, type string")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation and region: one row per author."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            F.lower("c_name").alias("screen_name"),
            F.when(F.col("r_name").isin("AMERICA", "ASIA"), "US")
            .otherwise("XX")
            .alias("country_code"),
            "c_mktsegment",
            "n_name",
            "n_nationkey",
            F.when(F.col("n_regionkey") != 4, F.col("n_nationkey") * 2.5 - 90).alias("place_longitude"),
            F.when(F.col("n_regionkey") != 4, F.col("n_regionkey") * 7.25 + 10).alias("place_latitude"),
        )
    )


def _joined(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    """All events, and the sides that ``wanted`` touches. Texts come last: no other join moves them."""
    posts = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("ts").alias("date"),
        F.col("event_type").alias("aidr_label"),
        (F.col("value") / 50 - 1).alias("sentiment_polarity"),
        (F.col("value") / (F.col("value") + 50)).alias("sentiment_subjectivity"),
    )
    if wanted & PLACE:
        state_level = F.col("aidr_label").isin("view", "click")
        nation_code = F.concat(F.lit(", N"), F.col("n_nationkey").cast("string"))
        posts = (
            posts.join(_places(spark, sf_dir), "user_id", "left")
            .withColumn("country_code", F.coalesce("country_code", F.lit("XX")))
            .withColumn(
                "place_type",
                F.when(state_level, "admin")
                .when(F.col("aidr_label").isin("error", "signup"), "city")
                .otherwise("poi"),
            )
            .withColumn(
                "place_name",
                F.when(state_level, F.concat("n_name", F.lit(", USA"))).otherwise(
                    F.concat("c_mktsegment", nation_code)
                ),
            )
        )
    if wanted & FLAGS:
        flags = table(spark, sf_dir, "labels").select(
            F.col("doc_id").alias("id"),
            (F.col("quality") == 1).alias("verified"),
            (F.col("toxic") == 1).alias("possibly_sensitive"),
        )
        posts = posts.join(flags, "id", "left")
    if wanted & POINT:
        points = table(spark, sf_dir, "embeddings").select(
            F.col("vec_id").alias("id"),
            (F.get("embedding", F.lit(0)).cast("double") * 180).alias("longitude"),
            (F.get("embedding", F.lit(1)).cast("double") * 90).alias("latitude"),
        )
        posts = posts.join(points, "id", "left")
    if wanted & TEXT:
        documents = table(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("id"), "source", "text", F.col("n_chars").alias("favorite_count")
        )
        posts = posts.join(documents, "id", "left")
    return posts


def enriched_posts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The enriched columns asked for, plus ``id``."""
    posts = _joined(spark, sf_dir, set(columns))
    derived: dict[str, Column] = {
        "phase": dates.phase(F.col("date"), PHASE_CUTS),
        "timerange_end": dates.hour_bucket(F.col("date")),
    }
    if "place_state" in columns:
        derived["place_state"] = places.place_state(
            F.col("country_code"), F.col("place_type"), F.col("place_name"), STATES
        )
    return posts.withColumns(derived).select("id", *columns)


def raw_posts(
    spark: SparkSession, sf_dir: str, wanted: set[str] = EVERY_SIDE
) -> DataFrame:
    """The shape ``read_raw_posts`` gives: nested, dates as text, reposts included.

    Sign-ups write their date in mail style, errors write none that can be read and
    purchases are reposts. Posts of good quality are truncated and hold a full text.
    Fields from the sides that ``wanted`` does not touch are null.
    """
    posts = _joined(spark, sf_dir, wanted)
    missing = EVERY_SIDE - set(posts.columns)
    posts = posts.withColumns({name: F.lit(None).cast(_side_type(name)) for name in missing})
    weekday_month_day = F.date_format("date", "EEE MMM dd")
    clock = F.date_format("date", "HH:mm:ss")
    created_at = (
        F.when(
            F.col("aidr_label") == "signup",
            F.concat(F.date_format("date", "EEE, dd MMM yyyy "), clock, F.lit(" -0600")),
        )
        .when(F.col("aidr_label") == "error", F.concat(F.lit("about "), weekday_month_day))
        .otherwise(
            F.concat(
                weekday_month_day,
                F.lit(" "),
                clock,
                F.lit(" +0200 "),
                F.date_format("date", "yyyy"),
            )
        )
    )
    corner = F.array("place_longitude", "place_latitude")
    opposite = F.array(F.col("place_longitude") + 1, F.col("place_latitude") + 1)
    return posts.select(
        "id",
        F.struct("name", "screen_name", "verified").alias("user"),
        "text",
        F.struct(F.concat("source", F.lit(" "), "text").alias("full_text")).alias("extended_tweet"),
        created_at.alias("created_at"),
        F.when(F.col("aidr_label") == "purchase", F.struct("id")).alias("retweeted_status"),
        F.col("verified").alias("truncated"),
        "possibly_sensitive",
        "favorite_count",
        F.struct(
            F.col("place_name").alias("full_name"),
            "country_code",
            "place_type",
            F.struct(F.array(F.array(corner, opposite)).alias("coordinates")).alias("bounding_box"),
        ).alias("place"),
        F.when(
            F.col("longitude").isNotNull(),
            F.struct(F.array("longitude", "latitude").alias("coordinates")),
        ).alias("coordinates"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )


def _side_type(name: str) -> str:
    if name in FLAGS:
        return "boolean"
    if name == "favorite_count":
        return "long"
    return "double" if name.endswith("itude") else "string"


HEADER = "id\tdate\taidr_label\taidr_confidence"


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label-file lines: one per event, one short line per quality label, and faults.

    Documents with a quality label therefore have two lines. Documents that are not in
    English give header lines in mid-file, or lines whose id is not a number.
    """
    events = table(spark, sf_dir, "events").select(
        F.concat_ws(
            "\t", F.col("event_id").cast("string"), F.col("ts").cast("date").cast("string"),
            "event_type", F.lit("0.5"),
        ).alias("value")
    )
    quality = table(spark, sf_dir, "labels").select(
        F.concat(
            F.col("doc_id").cast("string"), F.lit("\t\tquality_"), F.col("quality").cast("string")
        ).alias("value")
    )
    faults = (
        table(spark, sf_dir, "documents")
        .filter(F.col("lang") != "en")
        .select(
            F.when(F.col("lang") == "fr", HEADER)
            .otherwise(F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit("\tx\ty\t0")))
            .alias("value")
        )
    )
    return events.unionByName(quality).unionByName(faults)
