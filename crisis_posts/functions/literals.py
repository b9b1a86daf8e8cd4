"""Hand-written tables as one literal each, which the optimizer folds to a constant."""

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def text_map(entries: Mapping[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(dict(entries))), "map<string, string>")


def rows(spark: SparkSession, records: Iterable[Mapping], schema: str) -> DataFrame:
    literal = F.lit(json.dumps([dict(record) for record in records]))
    return spark.range(1).select(F.inline(F.from_json(literal, f"array<struct<{schema}>>")))
