"""Tabular inputs with a list of null tokens, and Parquet stages between pipeline steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.functions.cells import NULL_TOKENS, null_if_token


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Text cells that spell "missing" become null; the word "None" stays."""
    return df.select(
        *[
            null_if_token(F.col(c), tokens).alias(c) if t == "string" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def read_table(
    spark: SparkSession, path: str, *, fmt: str | None = None, tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """Read Parquet, ORC, JSON or headed CSV by extension; CSV cells stay text until cleaned."""
    kind = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read
    if kind in ("csv", "tsv"):
        # One token can be given to the reader; the list is applied after it.
        reader = reader.option("header", True).option("sep", "\t" if kind == "tsv" else ",")
        kind = "csv"
    return null_tokens(reader.format(kind).load(path), tokens)


def read_datasets(spark: SparkSession, paths: Mapping[str, str], **options) -> dict[str, DataFrame]:
    """Several named inputs as one set (training, holdback, dictionary)."""
    return {name: read_table(spark, path, **options) for name, path in paths.items()}


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a stage output as Parquet and hand back the table as read."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def read_or_compute(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], **options
) -> DataFrame:
    """The stage output when it exists, else run the stage and write it.

    Only a missing path is computed; other faults (schema, access) are raised.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return write_stage(compute(), path, **options)
