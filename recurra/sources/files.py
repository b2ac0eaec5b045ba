"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recurra import schemas

_ABSENT = {"PATH_NOT_FOUND"}


def read_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Billing events from CSV; cells that do not parse become NULL."""
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("timestampFormat", schemas.CSV_TIMESTAMP_FORMAT)
        .schema(schemas.EVENTS)
        .csv(path)
    )


def read_tenants_csv(spark: SparkSession, path: str) -> DataFrame:
    """Tenant dimension from CSV, every column as text."""
    return spark.read.option("header", True).schema(schemas.TENANTS).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, timestamps in the format the readers expect."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", schemas.CSV_TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", schemas.CSV_TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Unpartitioned Parquet table, replaced as a whole."""
    df.write.mode("overwrite").parquet(path)


def load_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet dataset, or an empty frame where the path is missing or holds no files.

    A file that can't be read is an error when its rows are, never an empty dataset.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _ABSENT:
            raise
    # no rows that the optimizer knows of, so that joins with them vanish from the plan
    nothing = (F.lit(None).cast(field.dataType).alias(field.name) for field in schema)
    return spark.range(1).select(*nothing).filter(F.lit(False))
