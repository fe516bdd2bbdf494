"""Sources and sinks: case tables written to a scratch folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casewright.functions import cells
from casewright.operators import metrics as M
from casewright.session import staging_root
from casewright.sources import digest, reports, tabular
from checks.fixture import (
    PLAN,
    cases,
    cleaned,
    feature_frame,
    scored,
    split_datasets,
    table,
    with_cases,
    with_clean,
    with_features,
    with_scored,
)
from checks.metrics import r, rounded
from checks.registry import query


def scratch(spark) -> str:
    """A new folder under the shared staging folder."""
    return f"{staging_root(spark)}/checks-{uuid.uuid4().hex}"


_TOKENS = "('', 'NA', 'N/A', 'n/a', 'NaN', 'nan', 'NULL', 'null', '#N/A')"
_TOKEN_CASE = (
    "CASE k % 11 WHEN 0 THEN 'NA' WHEN 1 THEN 'N/A' WHEN 2 THEN '#N/A' WHEN 3 THEN 'null'"
    " WHEN 4 THEN 'NaN' WHEN 5 THEN 'None' ELSE segment END"
)


@query(
    "s1_null_tokens",
    with_cases(
        f"SELECT CAST(k AS VARCHAR) AS k, CASE WHEN t NOT IN {_TOKENS} THEN t END AS label, route"
        f" FROM (SELECT k, {_TOKEN_CASE} AS t, route FROM cases) x"
    ),
)
def s1(spark, sf_dir):
    path = f"{scratch(spark)}/cases.csv"
    df = cases(spark, sf_dir).select("k", F.expr(_TOKEN_CASE).alias("label"), "route")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, **keep).csv(path)
    return tabular.read_table(spark, path)


@query("s2_file_digest", "SELECT 'verified' AS state, 64 AS digits")
def s2(spark, sf_dir):
    root = scratch(spark)
    early, late = split_datasets(cases(spark, sf_dir))
    early.write.parquet(f"{root}/data/part a")
    late.write.parquet(f"{root}/data/part b")
    found = digest.file_digests(spark, f"{root}/data/*/*.parquet")
    listed = found.select(F.concat_ws("  ", "sha256", "name").alias("value"))
    listed.write.text(f"{root}/manifest")
    manifest = digest.read_manifest(spark, f"{root}/manifest")
    digest.verify_digests(found, manifest)
    return digest.compare_digests(found, manifest).groupBy("state").agg(
        F.min(F.length("sha256")).alias("digits")
    )


@query(
    "s3_named_datasets",
    "SELECT 'orders' AS dataset, COUNT(*) AS n_rows FROM orders UNION ALL "
    "SELECT 'customer', COUNT(*) FROM customer UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem",
)
def s3(spark, sf_dir):
    names = ("orders", "customer", "lineitem")
    loaded = tabular.read_datasets(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})
    counts = [
        df.agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("n_rows"))
        for n, df in loaded.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "s4_serial_date",
    with_cases(
        "SELECT k, strftime(TIMESTAMP '1899-12-30' + to_days(CAST(created_serial AS INTEGER))"
        " + to_hours(CAST(k % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS created,"
        " CASE WHEN k % 5 = 0 THEN NULL ELSE strftime(TIMESTAMP '1899-12-30' + to_days(CAST(created_serial AS INTEGER)), '%Y-%m-%d %H:%M:%S') END AS parsed FROM cases"
    ),
)
def s4(spark, sf_dir):
    df = cases(spark, sf_dir)
    fraction = F.col("created_serial") + (F.col("k") % 24) / F.lit(24.0)
    text = F.when(F.col("k") % 5 == 0, "unknown").otherwise(F.col("created_serial").cast("string"))
    layout = "yyyy-MM-dd HH:mm:ss"
    return df.select(
        "k",
        F.date_format(cells.serial_to_timestamp(fraction), layout).alias("created"),
        F.date_format(cells.serial_to_timestamp(text), layout).alias("parsed"),
    )


@query(
    "s5_parquet_stage",
    with_features(
        "SELECT 'A' AS regime, k, severity, ROUND(total_loss, 6) AS total_loss, flag_count FROM features"
        " UNION ALL SELECT 'B', k, severity, ROUND(total_loss, 6), flag_count FROM features"
    ),
)
def s5(spark, sf_dir):
    clean_stage = tabular.write_stage(cleaned(spark, sf_dir), f"{scratch(spark)}/clean")
    path = f"{scratch(spark)}/features"
    from casewright.operators.features import engineer

    for regime in ("A", "B"):
        frame, _ = engineer(clean_stage, PLAN.in_regime(regime), keep=["k", "severity"])
        frame.write.parquet(f"{path}/regime={regime}")
    stage = spark.read.parquet(path)
    return rounded(stage.select("regime", "k", "severity", "total_loss", "flag_count"))


@query("s6_read_or_compute", with_clean("SELECT route, COUNT(*) AS n, 1 AS computed FROM clean GROUP BY route"))
def s6(spark, sf_dir):
    path = f"{scratch(spark)}/clean"
    runs = []

    def stage():
        runs.append(1)
        return cleaned(spark, sf_dir)

    tabular.read_or_compute(spark, path, stage)
    again = tabular.read_or_compute(spark, path, stage)
    counts = again.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("computed", F.lit(len(runs)))


@query(
    "s7_csv_sink",
    with_scored(
        "SELECT k, y, ROUND(eta, 5 - CAST(FLOOR(LOG10(ABS(eta))) AS INTEGER)) AS eta FROM scored"
    ),
)
def s7(spark, sf_dir):
    path = f"{scratch(spark)}/report"
    reports.write_csv(scored(spark, sf_dir).select("k", "y", "eta"), path, sort_by=["k"])
    return reports.read_csv(spark, path, "k bigint, y int, eta double")


@query("s8_json_sink", with_clean("SELECT route, COUNT(*) AS n, CAST(MAX(severity) AS INTEGER) AS top FROM clean GROUP BY route"))
def s8(spark, sf_dir):
    path = f"{scratch(spark)}/records"
    counts = cleaned(spark, sf_dir).groupBy("route").agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.max("severity").alias("top")).alias("summary")
    )
    reports.write_json(counts, path)
    back = spark.read.schema("route string, summary struct<n bigint, top int>").json(path)
    return back.select("route", "summary.n", "summary.top")


@query(
    "s9_oof_store",
    with_scored(
        f"SELECT 'fixed' AS model, 0 AS \"repeat\", COUNT(*) AS n, {r('SUM(p1+p2+p3+p4+p5+p6)', 'mass')} FROM scored"
    ),
)
def s9(spark, sf_dir):
    path = f"{scratch(spark)}/oof"
    oof = scored(spark, sf_dir).select(
        F.col("k").alias("id"),
        F.explode(F.array(F.lit("fixed"), F.lit("copy"))).alias("model"),
        F.lit(0).alias("repeat"),
        "proba",
    )
    reports.write_oof(oof, path)
    total = F.aggregate("proba", F.lit(0.0), lambda a, b: a + b)
    one = reports.read_oof(spark, path, "fixed").groupBy("model", "repeat")
    return rounded(one.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("mass")))


@query(
    "s10_report_read_back",
    with_scored(
        "SELECT CAST(y AS INTEGER) AS severity, COUNT(*) AS n, "
        "CASE WHEN y = 6 THEN NULL ELSE 'None' END AS note FROM scored GROUP BY y"
    ),
)
def s10(spark, sf_dir):
    path = f"{scratch(spark)}/table"
    counts = scored(spark, sf_dir).groupBy(F.col("y").alias("severity")).agg(
        F.count(F.lit(1)).alias("n")
    )
    noted = counts.withColumn("note", F.when(F.col("severity") != 6, "None"))
    reports.write_csv(noted, path, sort_by=["severity"])
    return reports.read_csv(spark, path, "severity int, n bigint, note string")
