"""Raw and enriched posts."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from crisis_posts.schemas import CORRUPT, ENRICHED, RAW_POST


def read_raw_posts(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; a line that is not JSON becomes a null row with its text kept aside."""
    return _raw(spark.read).json(path)


def stream_raw_posts(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same of files as they arrive, ``max_files`` of them at a time.

    A file that comes late is read too, however much older it is than the newest one.
    """
    reader = _raw(spark.readStream).option("maxFileAge", "36500d")
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).json(path)


def _raw(reader: DataFrameReader | DataStreamReader) -> DataFrameReader | DataStreamReader:
    return (
        reader.schema(RAW_POST)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def write_enriched(
    posts: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """``sort_by`` orders the rows within each file, so that filters on it skip pages."""
    if sort_by:
        posts = posts.sortWithinPartitions(*partition_by, *sort_by)
    posts.write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(path)


def read_enriched(
    spark: SparkSession, path: str, fmt: str = "parquet", with_id: bool = False
) -> DataFrame:
    """JSON output leaves null fields out and dates as text, so the schema is given."""
    schema = T.StructType([T.StructField("id", T.LongType()), *ENRICHED]) if with_id else ENRICHED
    # A partition column would come last.
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.names)
