"""Entity mentions: extraction, canonical names, counts, totals."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.functions.texts import NAME, names
from crisis_posts.operators import wordtable
from crisis_posts.schemas import ENTITY_RULES

DEFAULT_TYPE = "MISC"
Rule = tuple[str, str, str]


def extract_mentions(
    posts: DataFrame,
    gazetteer: DataFrame,
    text: str = "text",
    pattern: str = NAME,
    default_type: str = DEFAULT_TYPE,
    max_rows: int = wordtable.MAX_ROWS,
) -> DataFrame:
    """Add ``entities``, an array of struct(entity, type), to the posts with text.

    Names match ``pattern``; their type comes from the gazetteer (the least type where
    an entity has several), else it is ``default_type``.
    """
    found = wordtable.Lookup(
        posts.filter(F.col(text).isNotNull()), text,
        lambda p: p.withColumn("_names", names(F.col(text), pattern)),
        lambda p: p.withColumn("_asked", F.col("_names")), _types(gazetteer), "entity", max_rows,
    )
    found.add_values("_names", "_types")
    entities = F.zip_with(
        "_names",
        "_types",
        lambda name, kind: F.struct(
            name.alias("entity"), F.coalesce(kind, F.lit(default_type)).alias("type")
        ),
    )
    return found.close().withColumn("entities", entities).drop("_names", "_types")


def tag_mentions(
    posts: DataFrame, tagger: Callable[[Column], Column], text: str = "text"
) -> DataFrame:
    """As above with a pandas UDF from text to an array of struct(entity, type)."""
    return posts.filter(F.col(text).isNotNull()).withColumn("entities", tagger(F.col(text)))


def explode_mentions(posts: DataFrame) -> DataFrame:
    """One ``Entity``, ``Type`` row per mention; posts without mentions have none.

    For a plain explode the optimizer adds a test for empty lists that runs the whole
    extraction, or the tagger, a second time; dropping the outer rows does not.
    """
    return (
        posts.select(F.posexplode_outer("entities").alias("position", "m"))
        .filter(F.col("position").isNotNull())
        .select(F.col("m.entity").alias("Entity"), F.col("m.type").alias("Type"))
    )


def canonical_mentions(mentions: DataFrame, rules: Sequence[Rule] = ENTITY_RULES) -> DataFrame:
    """Replace names that a rule's pattern matches, then set the type of rule entities.

    The type follows the rewritten name, so a name already canonical gets it as well.
    """
    entity, kind = F.col("Entity"), F.col("Type")
    if rules:
        entity = _first_match([(F.col("Entity").rlike(p), name) for name, p, _ in rules], entity)
        kind = _first_match([(F.col("Entity") == name, t) for name, _, t in rules], kind)
    return mentions.withColumn("Entity", entity).withColumn("Type", kind)


def mention_counts(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("Entity", "Type").count()


def text_mention_counts(
    posts: DataFrame,
    gazetteer: DataFrame,
    text: str = "text",
    pattern: str = NAME,
    default_type: str = DEFAULT_TYPE,
    rules: Sequence[Rule] = ENTITY_RULES,
) -> DataFrame:
    """Extract, canonicalize and count in one go; equal to the steps above.

    Names are counted first, so types and rules apply to the vocabulary and not to each
    mention, and the gazetteer may have any size: both join sides hold a name once.
    """
    counted = (
        posts.select(F.explode(names(F.col(text), pattern)).alias("entity"))
        .groupBy("entity")
        .agg(F.count("*").alias("n"))
    )
    typed = counted.join(_types(gazetteer), "entity", "left").select(
        F.col("entity").alias("Entity"),
        F.coalesce("value", F.lit(default_type)).alias("Type"),
        "n",
    )
    return (
        canonical_mentions(typed, rules)
        .groupBy("Entity", "Type")
        .agg(F.sum("n").alias("count"))
    )


def merge_counts(counts: DataFrame) -> DataFrame:
    """Totals over the counts of many runs, largest first, ties by name and type."""
    return (
        counts.groupBy(F.col("entity").alias("entity"), F.col("type").alias("type"))
        .agg(F.sum("count").alias("total_count"))
        .orderBy(F.desc("total_count"), "entity", "type")
    )


def entity_table(totals: DataFrame) -> DataFrame:
    return totals.select("entity", "type", "total_count")


def _types(gazetteer: DataFrame) -> DataFrame:
    return wordtable.unique_words(gazetteer, "entity", F.min("type"))


def _first_match(cases: Sequence[tuple[Column, str]], otherwise: Column) -> Column:
    condition, value = cases[0]
    chain = F.when(condition, value)
    for condition, value in cases[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)
