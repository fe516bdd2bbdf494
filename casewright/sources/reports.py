"""Report sinks: six-digit CSV, nested JSON records, out-of-fold probability store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def six_digits(col: Column) -> Column:
    """Round to six significant digits (half-even rounding of the scaled value)."""
    size = F.floor(F.log10(F.abs(col)))
    scale = F.pow(F.lit(10.0), F.lit(5.0) - size)
    return F.when(col == 0, F.lit(0.0)).otherwise(F.bround(col * scale) / scale)


def write_csv(df: DataFrame, path: str, *, sort_by: Sequence[str] = ()) -> None:
    """CSV with a header; doubles at six significant digits.

    A folder of part files.  Small ordered reports pass ``sort_by``; the sort is
    a distributed range sort, so parts are in order.
    """
    shown = df.select(
        *[six_digits(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )
    if sort_by:
        shown = shown.orderBy(*sort_by)
    shown.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a report back; only the empty cell is null."""
    return spark.read.option("header", True).option("nullValue", "").csv(path, schema=schema)


def write_json(df: DataFrame, path: str) -> None:
    """One nested record per line; nulls are kept as nulls."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_oof(oof: DataFrame, path: str) -> None:
    """``(id, model, repeat, proba)`` by model, so one model's rows are one folder."""
    oof.write.mode("overwrite").partitionBy("model").parquet(path)


def read_oof(spark: SparkSession, path: str, model: str) -> DataFrame:
    """One model's out-of-fold rows (partition pruning skips the others)."""
    return spark.read.parquet(path).where(F.col("model") == model)
