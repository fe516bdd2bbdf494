"""Contract checks: schema audit, coercion, quarantine, violation log, missingness, cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.contracts import Catalog, ColumnContract, bounds_text, observed_values
from casewright.functions import cells

# Fixed value: reason text of a category violation.
NOT_ALLOWED = "not in allowed values"


@dataclass(frozen=True)
class SchemaAudit:
    expected_missing: list[str]
    unexpected: list[str]
    undocumented: list[str]
    leak: list[str]
    target_present: bool

    @property
    def ok(self) -> bool:
        return not self.expected_missing and not self.unexpected


def required_columns(catalog: Catalog, expect_target: bool) -> list[str]:
    skipped = {C.LEAK} if expect_target else {C.LEAK, C.TARGET}
    return [c.name for c in catalog if c.role not in skipped]


def audit_columns(columns: Sequence[str], catalog: Catalog, expect_target: bool) -> SchemaAudit:
    """Compare column names with the catalogue; reads no data."""
    present = set(columns)
    return SchemaAudit(
        expected_missing=[c for c in required_columns(catalog, expect_target) if c not in present],
        unexpected=sorted(present.difference(catalog.names)),
        undocumented=[c for c in catalog.undocumented() if c in present],
        leak=[c for c in catalog.leaks if c in present],
        target_present=bool(present.intersection(catalog.columns(role=C.TARGET))),
    )


def audit_table(df: DataFrame, catalog: Catalog, expect_target: bool) -> DataFrame:
    """The audit as rows ``(column, finding, n_values)``, with the cells each column holds."""
    seen = observed_values(df)
    wanted = catalog.to_df(df.sparkSession)
    required = wanted.where(F.col("column").isin(*required_columns(catalog, expect_target)))
    missing = required.join(seen, "column", "left_anti").select(
        "column", F.lit("expected_missing").alias("finding"), F.lit(0).cast("bigint").alias("n_values")
    )
    unexpected = seen.join(wanted, "column", "left_anti").select(
        "column", F.lit("unexpected").alias("finding"), "n_values"
    )
    known = seen.join(wanted, "column").select(
        "column",
        F.when(F.col("role") == C.LEAK, "leak")
        .when(F.col("role") == C.TARGET, "target")
        .when(~F.col("documented"), "undocumented")
        .alias("finding"),
        "n_values",
    )
    return missing.unionByName(unexpected).unionByName(known.where(F.col("finding").isNotNull()))


def missing_from_dictionary(df: DataFrame, dictionary: DataFrame, field: str) -> DataFrame:
    """Columns of the data that a dictionary table does not describe."""
    named = dictionary.select(F.col(field).alias("column"))
    return observed_values(df).join(named, "column", "left_anti")


# --- Quarantine: all of it is one projection ------------------------------------------


def checked_numeric(catalog: Catalog, columns: Sequence[str]) -> list[str]:
    """Numeric columns present, then the target when it is present."""
    names = catalog.columns(C.NUMERIC) + catalog.columns(role=C.TARGET)
    return [c for c in names if c in columns]


def checked_categories(catalog: Catalog, columns: Sequence[str]) -> list[str]:
    """Every restricted column present, the leak columns among them."""
    return [c.name for c in catalog if c.restricted and c.name in columns]


def quarantined_number(contract: ColumnContract, strategy: str) -> Column:
    value = cells.number(F.col(contract.name))
    if strategy == "clip":
        return cells.clipped(value, contract)
    if strategy == "null":
        return F.when(cells.within(value, contract), value)
    raise ValueError(f"unknown strategy {strategy}")


def quarantine_ranges(df: DataFrame, catalog: Catalog, strategy: str = "null") -> DataFrame:
    return df.withColumns(
        {c: quarantined_number(catalog[c], strategy) for c in checked_numeric(catalog, df.columns)}
    )


def quarantined_category(contract: ColumnContract) -> Column:
    """The stripped text where it is allowed; a cell that is an allowed text as it stands is not stripped first."""
    cell = F.col(contract.name).cast("string")
    text = cells.stripped(cell)
    plain = [v for v in contract.allowed if v == v.strip(cells.WHITE_SPACE)]
    return F.when(cell.isin(*plain), cell).when(text.isin(*contract.allowed), text)


def quarantine_categories(df: DataFrame, catalog: Catalog) -> DataFrame:
    return df.withColumns(
        {c: quarantined_category(catalog[c]) for c in checked_categories(catalog, df.columns)}
    )


def violation_log(df: DataFrame, catalog: Catalog, *, id_column: str | None = None) -> DataFrame:
    """Long table ``(id, column, value, reason)`` of every cell the quarantine rejects.

    One pass: each row builds the array of its bad cells and explodes it.
    ``value`` is the cell as it was read.  Without the id column the row is
    named by a surrogate row number, unique but not consecutive.
    """
    key = id_column or catalog.identifier
    row_id = (
        F.col(key).cast("string")
        if key in df.columns
        else F.monotonically_increasing_id().cast("string")
    )

    def entry(name: str, bad: Column, reason: str) -> Column:
        return F.struct(
            F.lit(name).alias("column"),
            F.col(name).cast("string").alias("value"),
            F.lit(reason).alias("reason"),
            F.coalesce(bad, F.lit(False)).alias("bad"),
        )

    checks = []
    for name in checked_numeric(catalog, df.columns):
        inside = cells.within(cells.number(F.col(name)), catalog[name])
        checks.append(entry(name, ~inside, bounds_text(catalog[name])))
    for name in checked_categories(catalog, df.columns):
        allowed = cells.stripped(F.col(name)).isin(*catalog[name].allowed)
        checks.append(entry(name, ~allowed, NOT_ALLOWED))
    bad_cells = F.filter(F.array(*checks), lambda e: e["bad"])
    return df.select(row_id.alias("id"), F.explode(bad_cells).alias("cell")).select(
        "id", "cell.column", "cell.value", "cell.reason"
    )


def violation_summary(log: DataFrame) -> DataFrame:
    """Per column: violations and how many of them are negative numbers."""
    return log.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value").try_cast("double") < 0).alias("n_negative"),
    )


# --- Missing values --------------------------------------------------------------------


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing, missing_pct, dtype)`` for the columns with gaps, worst first.

    One aggregate row is unpivoted, so the table is scanned once.
    """
    names = list(columns if columns is not None else df.columns)
    types = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names],
    )
    dtype = F.create_map(*[F.lit(x) for c in names for x in (c, types[c])])
    return (
        counts.unpivot(["_rows"], names, "column", "missing")
        .where(F.col("missing") > 0)
        .select(
            "column",
            "missing",
            F.bround(F.col("missing") / F.col("_rows") * 100, 2).alias("missing_pct"),
            dtype[F.col("column")].alias("dtype"),
        )
        .orderBy(F.desc("missing_pct"), "column")
    )


def null_rate(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(F.col(column).isNull().cast("double")).alias("null_rate"))


def null_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of missing cells; ``pattern`` has a 1 per missing column."""
    flags = [F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns]
    return (
        df.groupBy(F.concat(*flags).alias("pattern"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("n_missing", F.length(F.replace("pattern", F.lit("0"), F.lit(""))))
    )


# --- Whole cleaning pass ----------------------------------------------------------------


@dataclass(frozen=True)
class CleanResult:
    """Lazy tables of one cleaning pass; nothing runs until one of them is used."""

    source: DataFrame
    catalog: Catalog
    frame: DataFrame
    audit: SchemaAudit
    dropped: list[str]

    @property
    def log(self) -> DataFrame:
        return violation_log(self.source, self.catalog)

    @property
    def missingness(self) -> DataFrame:
        return missingness(self.frame)

    def report(self) -> DataFrame:
        """One row: what was found and changed."""
        counts = self.log.agg(
            F.count_if(F.col("reason") != NOT_ALLOWED).alias("range_violations"),
            F.count_if(F.col("reason") == NOT_ALLOWED).alias("category_violations"),
        )
        columns = [F.count_if(F.col(c).isNull()) > 0 for c in self.frame.columns]
        gaps = self.frame.agg(
            F.count(F.lit(1)).alias("n_rows"),
            sum((c.cast("int") for c in columns), F.lit(0)).alias("columns_with_gaps"),
        )
        audit = self.audit

        def listed(names: Sequence[str]) -> Column:
            return F.lit(",".join(names) if names else "none")

        both = counts.withColumn("_one", F.lit(1)).join(
            F.broadcast(gaps.withColumn("_one", F.lit(1))), "_one"
        )
        return both.select(
            "n_rows",
            "range_violations",
            "category_violations",
            "columns_with_gaps",
            listed(self.dropped).alias("dropped"),
            listed(audit.leak).alias("leak_present"),
            listed(audit.undocumented).alias("undocumented_present"),
            listed(audit.expected_missing).alias("expected_missing"),
            listed(audit.unexpected).alias("unexpected"),
            F.lit(audit.target_present).alias("target_present"),
        )


def clean(
    df: DataFrame, catalog: Catalog, *, is_training: bool, strategy: str = "null"
) -> CleanResult:
    """Audit, convert dates, quarantine, drop leak and unexpected columns; impute nothing.

    Row count and ids are kept.  The cleaned frame is one projection over the
    input, so it stays in the scan's stage.
    """
    audit = audit_columns(df.columns, catalog, expect_target=is_training)
    if audit.expected_missing:
        raise ValueError(f"missing required columns: {audit.expected_missing}")
    dropped = [*audit.leak, *audit.unexpected]
    types = dict(df.dtypes)
    numbers = set(checked_numeric(catalog, df.columns))
    texts = set(checked_categories(catalog, df.columns))

    def cleaned(name: str) -> Column:
        contract = catalog[name]
        if contract.kind == C.DATE:
            dated = types[name] in ("timestamp", "timestamp_ntz", "date")
            return F.col(name).cast("timestamp") if dated else cells.serial_to_timestamp(F.col(name))
        if name in numbers:
            value = quarantined_number(contract, strategy)
            return value.try_cast("int") if contract.role == C.TARGET and is_training else value
        return quarantined_category(contract) if name in texts else F.col(name)

    kept = [c for c in df.columns if c not in dropped]
    frame = df.select(*[cleaned(c).alias(c, metadata=catalog.metadata(c)) for c in kept])
    return CleanResult(df, catalog, frame, audit, dropped)
