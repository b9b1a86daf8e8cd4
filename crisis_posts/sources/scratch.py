"""Tables that a job writes once and reads several times, in the folder that all machines share."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def new_path(spark: SparkSession) -> str:
    """A path below spark.checkpoint.dir, or the warehouse where that is unset.

    What is written there goes when the session ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/scratch-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(table: DataFrame) -> DataFrame:
    """The table, written and read again, so that lost tasks restart from there."""
    path = new_path(table.sparkSession)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
