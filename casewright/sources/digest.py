"""File digests against a manifest of ``<hex>  <name>`` lines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_digests(spark: SparkSession, path: str, *, below: bool = False) -> DataFrame:
    """``(name, sha256)`` of every file under a path; one task per file split.

    With ``below`` all folders under ``path`` are read and a name is the path
    below it, so equal file names in two folders stay apart.

    ``binaryFile`` reads a file into one row, so this is for manifests of
    ordinary input files, as delivered, not for single files beyond 2 GB.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", below).load(path)
    full = F.url_decode("path")
    root = re.sub("^[A-Za-z0-9+.-]+:/*", "/", path).rstrip("/") + "/"
    name = F.substr(full, F.instr(full, root) + len(root)) if below else F.substring_index(full, "/", -1)
    return files.select(
        name.alias("name"),
        F.sha2("content", 256).alias("sha256"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(name, expected)``; names may hold spaces."""
    lines = spark.read.text(path)
    pattern = r"^\s*([0-9A-Fa-f]{64})\s+\*?(.*\S)\s*$"
    return lines.select(
        F.regexp_extract("value", pattern, 2).alias("name"),
        F.lower(F.regexp_extract("value", pattern, 1)).alias("expected"),
    ).where(F.col("expected") != "")


def compare_digests(digests: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files with their state: ``verified``, ``mismatch`` or ``no entry``."""
    state = (
        F.when(F.col("expected").isNull(), "no entry")
        .when(F.col("expected") == F.col("sha256"), "verified")
        .otherwise("mismatch")
    )
    return digests.join(manifest, "name", "left").withColumn("state", state)


def verify_digests(digests: DataFrame, manifest: DataFrame) -> None:
    """Raise for the first file that is not listed or does not match."""
    bad = compare_digests(digests, manifest).where(F.col("state") != "verified").first()
    if bad is not None:
        raise ValueError(f"{bad['name']}: {bad['state']} in the manifest")
