"""Entity counts and totals, and the word tables a job is given."""

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crisis_posts.schemas import ENTITY_TOTAL, GAZETTEER, LEXICON, MODIFIER


def part_path(path: str, column: str, value: str) -> str:
    """The folder of one part of a table, which can be written again without touching the others."""
    if not value:
        raise ValueError(f"{column} needs a name")
    return f"{path.rstrip('/')}/{column}={quote(value, safe='')}"


def write_entity_counts(
    counts: DataFrame, path: str, fmt: str = "json", run: str | None = None
) -> None:
    """With ``run``, the counts of one run among those of others.

    A run that is written again takes the place of its first counts, so totals over the path hold
    each run once, however often it is replayed. The folders are the ledger of the runs.
    """
    path = path if run is None else part_path(path, "run", run)
    counts.write.mode("overwrite").format(fmt).save(path)


def counted_runs(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """(run, lines) of the runs whose counts lie below a path."""
    lines = spark.read.text(path) if fmt == "json" else spark.read.format(fmt).load(path)
    return lines.groupBy(F.col("run").cast("string").alias("run")).agg(F.count("*").alias("lines"))


def _count_lines(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``value``, the line, and its fields; JSON keys are case sensitive, here they are not.

    A line that has one of the fields twice has no count.
    """
    if fmt != "json":
        rows = spark.read.format(fmt).load(path)
        named = {column.lower(): column for column in rows.columns}
        return rows.select(
            F.to_json(F.struct("*")).alias("value"),
            *(F.col(named[c]).try_cast("string").alias(c) for c in ("entity", "type")),
            F.col(named["count"]).try_cast("long").alias("count"),
        )
    lines = spark.read.text(path)
    pairs = F.map_entries(F.from_json("value", "map<string, string>"))

    def field(name: str) -> tuple[Column, Column]:
        own = F.filter("pairs", lambda pair: F.lower(pair["key"]) == name)
        return F.when(F.size(own) == 1, F.get(own, F.lit(0))["value"]), F.size(own) > 1

    (entity, twice), (kind, also), (count, again) = map(field, ("entity", "type", "count"))
    return lines.select("value", pairs.alias("pairs")).select(
        "value",
        entity.alias("entity"),
        kind.alias("type"),
        F.when(~(twice | also | again), count.try_cast("long")).alias("count"),
    )


def read_entity_counts(
    spark: SparkSession, path: str, fmt: str = "json", skip_bad: bool = False
) -> DataFrame:
    """Counts of one or many runs, with ``Entity``/``Type`` or ``entity``/``type``.

    A line whose count can't be read stops the job with the line in the message;
    ``skip_bad`` leaves such lines out, and ``count_rejects`` lists them.
    """
    rows = _count_lines(spark, path, fmt)
    if skip_bad:
        return rows.filter(F.col("count").isNotNull()).drop("value")
    stop = F.raise_error(F.concat(F.lit("unreadable entity count: "), "value")).cast("long")
    return rows.select("entity", "type", F.coalesce("count", stop).alias("count"))


def count_rejects(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The lines that ``read_entity_counts`` can't read."""
    return _count_lines(spark, path, fmt).filter(F.col("count").isNull()).select("value")


def write_entity_totals(totals: DataFrame, path: str, fmt: str = "json") -> None:
    """Keeps the global order: file names follow the sorted partitions."""
    totals.write.mode("overwrite").format(fmt).save(path)


def read_entity_totals(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(ENTITY_TOTAL).format(fmt).load(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header that names word, polarity and subjectivity, in any order."""
    return _named_csv(spark, path, LEXICON)


def read_modifiers(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header that names word, kind (negator or booster) and factor, in any order."""
    return _named_csv(spark, path, MODIFIER)


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header that names entity and type, in any order."""
    return _named_csv(spark, path, GAZETTEER)


def _named_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Columns by name; a missing name, or a file with another header, is an error."""
    table = spark.read.csv(path, header=True, enforceSchema=False)
    return table.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
