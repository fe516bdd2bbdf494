"""The training-data pipeline: toxicity, near copies, repeats, benchmark passages, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.llm.common import table
from casewright.llm.decontaminate import without_contaminated
from casewright.llm.mixing import mix_sources
from casewright.llm.parity_join import first_of_each_group
from casewright.llm.queries import test_fold
from casewright.llm.repeats import cut_repeats
from casewright.llm.toxicity import without_toxic
from casewright.session import ship_package, staged


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    ship_package(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"), held_out=test_fold())


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group with a five-word Jaccard of 0.8 or more."""
    ship_package(spark)
    return first_of_each_group(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the document with the smallest id only.

    Rows that lose nothing keep their text as it is; ``n_chars`` follows the text.
    Extra columns are passed on, whatever their names.
    """
    ship_package(spark)
    others = [c for c in docs.columns if c != "doc_id"]
    own = {c: f"_own{i}" for i, c in enumerate(others)}
    cut = cut_repeats(docs, carry=others).toDF("doc_id", *own.values(), "n_words", "n_removed", "kept_text", "repeats")
    changed = F.col("n_removed") > 0
    kept = {c: F.col(name) for c, name in own.items()}
    kept["text"] = F.when(changed, F.col("kept_text")).otherwise(kept["text"])
    if "n_chars" in kept:
        kept["n_chars"] = F.when(changed, F.length("kept_text").cast("bigint")).otherwise(kept["n_chars"])
    return cut.select(*[kept.get(c, F.col(c)).alias(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that copy no benchmark item."""
    ship_package(spark)
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


# Columns that the mix adds; extra columns of these names give way to them.
MIX_COLUMNS = ("size", "source_size", "target", "taken", "pieces")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, with how many and which."""
    ship_package(spark)
    carry = [c for c in docs.columns if c not in ("doc_id", *MIX_COLUMNS)]
    return mix_sources(docs, carry=carry).where("taken > 0")


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("source_mix", mixed),
]
# A fitted classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
