"""Column contracts: what a table of case records is allowed to contain.

A :class:`Catalog` is plain data.  Every operator takes one as a parameter, so
no operator knows the columns of any particular dataset.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.session import small_table

NUMERIC, NOMINAL, ORDINAL = "numeric", "categorical", "ordinal"
BOOLEAN, DATE, IDENTIFIER = "boolean", "date", "identifier"
FEATURE, TARGET, ID, LEAK = "feature", "target", "identifier", "leak"

YES_NO = ("Yes", "No")

CONTRACT_SCHEMA = (
    "column string, kind string, role string, allowed array<string>, "
    "min_value double, max_value double, integer boolean, documented boolean"
)


@dataclass(frozen=True)
class ColumnContract:
    """Domain and purpose of one column; ``low``/``high`` of None is an open bound."""

    name: str
    kind: str
    role: str = FEATURE
    allowed: tuple[str, ...] | None = None
    low: float | None = None
    high: float | None = None
    integer: bool = False
    documented: bool = True

    @property
    def restricted(self) -> bool:
        """True where the contract lists every value the column may hold."""
        return self.allowed is not None and self.kind in (NOMINAL, ORDINAL, BOOLEAN)


class Catalog:
    """An ordered, name-indexed set of contracts."""

    def __init__(self, contracts: Iterable[ColumnContract]) -> None:
        self.contracts = tuple(contracts)
        self._by_name = {c.name: c for c in self.contracts}
        if len(self._by_name) != len(self.contracts):
            raise ValueError("a column has more than one contract")

    def __iter__(self):
        return iter(self.contracts)

    def __len__(self) -> int:
        return len(self.contracts)

    def __contains__(self, name: str) -> bool:
        return name in self._by_name

    def __getitem__(self, name: str) -> ColumnContract:
        return self._by_name[name]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.contracts]

    def columns(self, kind: str | None = None, role: str | None = FEATURE) -> list[str]:
        """Names of the contracts of a kind and role, in catalogue order."""
        return [
            c.name
            for c in self.contracts
            if (kind is None or c.kind == kind) and (role is None or c.role == role)
        ]

    def undocumented(self) -> list[str]:
        return [c.name for c in self.contracts if not c.documented]

    def _single(self, role: str) -> str:
        found = self.columns(role=role)
        if len(found) != 1:
            raise ValueError(f"the catalogue needs one column of role {role}, has {found}")
        return found[0]

    @property
    def target(self) -> str:
        return self._single(TARGET)

    @property
    def identifier(self) -> str:
        return self._single(ID)

    @property
    def leaks(self) -> list[str]:
        return self.columns(role=LEAK)

    def levels(self, name: str) -> tuple[str, ...]:
        """Levels of an ordinal column, lowest first."""
        contract = self._by_name[name]
        if contract.kind != ORDINAL or contract.allowed is None:
            raise ValueError(f"{name} is not an ordinal column")
        return contract.allowed

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The catalogue as a table, one row per contract (small by construction)."""
        rows = [
            (
                c.name,
                c.kind,
                c.role,
                list(c.allowed) if c.allowed is not None else None,
                None if c.low is None else float(c.low),
                None if c.high is None else float(c.high),
                c.integer,
                c.documented,
            )
            for c in self.contracts
        ]
        return small_table(spark, rows, CONTRACT_SCHEMA)

    def metadata(self, name: str) -> dict[str, str]:
        """Schema metadata of a column: its kind and role."""
        return {"kind": self[name].kind, "role": self[name].role}


def numeric(name: str, low: float, high: float, *, integer: bool = False, **extra) -> ColumnContract:
    return ColumnContract(name, NUMERIC, low=low, high=high, integer=integer, **extra)


def nominal(name: str, *levels: str, **extra) -> ColumnContract:
    return ColumnContract(name, NOMINAL, allowed=levels, **extra)


def ordinal(name: str, *levels: str, **extra) -> ColumnContract:
    return ColumnContract(name, ORDINAL, allowed=levels, **extra)


def yes_no(name: str, **extra) -> ColumnContract:
    return ColumnContract(name, BOOLEAN, allowed=YES_NO, **extra)


def bounds_text(contract: ColumnContract) -> str:
    """Reason text of a range violation."""
    return f"outside [{contract.low}, {contract.high}]"


def observed_values(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Non-null cells per column as ``(column, n_values)``; one aggregate over the table."""
    names = list(columns if columns is not None else df.columns)
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in names])
    return counts.unpivot([], names, "column", "n_values")
