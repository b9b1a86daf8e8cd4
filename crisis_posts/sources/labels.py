"""Classifier label file: tab separated text whose first line is a header."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crisis_posts.schemas import LABEL


def parse_label_lines(lines: DataFrame, header: str | None) -> DataFrame:
    """Split ``value`` lines by position; drops every line equal to the header.

    Short lines leave the missing fields null and an unreadable id is null.
    """
    fields = F.split("value", "\t")
    body = lines if header is None else lines.filter(F.col("value") != header)
    return body.select(
        *[
            F.get(fields, F.lit(i)).try_cast(field.dataType).alias(field.name)
            for i, field in enumerate(LABEL)
        ]
    )


def read_labels(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Lines equal to the given header are dropped.

    Without one, a file's first line counts as its header if its id is not a number. So a
    file without header keeps its first label, and files need not agree. That takes a scan
    of the lines and brings the different header lines to the driver.
    """
    lines = spark.read.text(path)
    if header is not None:
        return parse_label_lines(lines, header)
    first = (
        lines.select(
            "_metadata.file_path", "_metadata.file_block_start",
            F.struct(F.monotonically_increasing_id().alias("place"), "value").alias("line"),
        )
        .filter("file_block_start = 0")
        .groupBy("file_path")
        .agg(F.min("line")["value"].alias("value"))
        .filter(F.get(F.split("value", "\t"), F.lit(0)).try_cast("long").isNull())
    )
    headers = [row["value"] for row in first.select("value").distinct().collect()]
    return parse_label_lines(lines.filter(~F.col("value").isin(headers)), None)


def label_rejects(labels: DataFrame) -> DataFrame:
    return labels.filter(F.col("id").isNull())
