"""Readers and writers for tables, submissions, application and decision records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fields of one application record.
APPLICATION_SCHEMA = (
    "sk_id_curr bigint, amt_income_total double, amt_credit double, amt_goods_price double, "
    "name_income_type string, name_housing_type string, name_family_status string, "
    "name_education_type string, code_gender string, flag_own_car string, "
    "flag_own_realty string, days_birth int, age int, buy_goods boolean, loan_term_years int, "
    "existing_mortgage_payment double, existing_loan_payments double, "
    "application_time timestamp_ntz"
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Give a schema in production; without one the types are inferred,
    which reads the file twice."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.csv(path, inferSchema=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def submission(df: DataFrame, id_column: str, probability: str) -> DataFrame:
    """``SK_ID_CURR`` as an integer and ``TARGET`` as the probability to one decimal."""
    return df.select(
        F.col(id_column).cast("bigint").alias("SK_ID_CURR"),
        F.round(probability, 1).alias("TARGET"),
    )


def write_submission(df: DataFrame, id_column: str, probability: str, path: str) -> None:
    write_csv(submission(df, id_column, probability), path)


def read_applications(spark: SparkSession, path: str, stream: bool = False,
                      files_per_batch: int = 1000) -> DataFrame:
    """Application records, one JSON object per line, as a table or a stream.

    A line that is no such object keeps its text in ``malformed``.  A stream takes at most
    ``files_per_batch`` files at once, so a backlog is several batches.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if stream else spark.read
    return reader.schema(f"{APPLICATION_SCHEMA}, malformed string").option(
        "columnNameOfCorruptRecord", "malformed").json(path)


def parse_applications(df: DataFrame, column: str = "value") -> DataFrame:
    """Application records from a text column, for message sources."""
    return df.select(F.from_json(F.col(column), APPLICATION_SCHEMA).alias("r")).select("r.*")


def decision_json(df: DataFrame) -> DataFrame:
    """One JSON text per decision."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_decisions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
