"""Declarative data contract: one rule list gives the filter and the report.

All value rules of a batch are counted in a single aggregate, so checking costs
one pass over the columns the contract names, however many rules there are. A batch
that is written anyway is checked on its way (:class:`Watch`), without a pass of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantry.schema import CRANE_ID, LOAD, MESSAGE_ID, TIMESTAMP, VIBRATION

NOT_NULL = "not_null"
AT_LEAST = "at_least"
AT_MOST = "at_most"


@dataclass(frozen=True)
class Check:
    """One value rule. ``filtered`` rules also drop the row in Silver."""

    column: str
    kind: str
    bound: float | None = None
    filtered: bool = True

    def failed(self, value: Column) -> Column:
        """True for a value that breaks the rule; NULL bounds are not failures."""
        if self.kind == NOT_NULL:
            return value.isNull()
        if self.kind == AT_LEAST:
            return value < F.lit(self.bound)
        return value > F.lit(self.bound)

    def passed(self, value: Column) -> Column:
        """The row filter: unlike ``not failed``, a NULL does not pass a bound."""
        if self.kind == NOT_NULL:
            return value.isNotNull()
        if self.kind == AT_LEAST:
            return value >= F.lit(self.bound)
        return value <= F.lit(self.bound)


@dataclass(frozen=True)
class Violation:
    column: str
    check: str
    failures: int | None = None


@dataclass(frozen=True)
class Contract:
    """Required columns with their types, and the value rules on them.

    Closed on these columns, open on all others. Nothing is coerced.
    """

    types: dict[str, T.DataType]
    checks: list[Check]


class ContractViolation(Exception):
    """Raised when a batch breaks its contract and the caller asked to stop."""

    def __init__(self, violations: list[Violation]):
        self.violations = violations
        super().__init__("; ".join(f"{v.column}: {v.check} ({v.failures})" for v in violations))


# Required columns, their types and bounds (inclusive).
TELEMETRY_CONTRACT = Contract(
    types={
        MESSAGE_ID: T.StringType(),
        CRANE_ID: T.StringType(),
        TIMESTAMP: T.StringType(),
        LOAD: T.DoubleType(),
        VIBRATION: T.DoubleType(),
    },
    checks=[
        Check(MESSAGE_ID, NOT_NULL),
        Check(CRANE_ID, NOT_NULL),
        # Declared non-null, yet no reason to drop a reading: it reaches Silver
        # in "report" mode and stops the batch in "fail" mode.
        Check(TIMESTAMP, NOT_NULL, filtered=False),
        # A NULL measure never passes its bounds, so this needs no filter.
        Check(LOAD, NOT_NULL, filtered=False),
        Check(LOAD, AT_LEAST, 0.0),
        Check(LOAD, AT_MOST, 50000.0),
        Check(VIBRATION, NOT_NULL, filtered=False),
        Check(VIBRATION, AT_LEAST, 0.0),
        Check(VIBRATION, AT_MOST, 100.0),
    ],
)


def _declared(df: DataFrame, contract: Contract, column: str) -> Column:
    """The column as its declared type.

    A column that already has it is used bare, so the comparison reaches the
    Parquet scan as a pushed filter; one that does not goes through ``try_cast``,
    because ANSI mode would stop the job on the first value that cannot be read.
    """
    wanted = contract.types[column]
    if df.schema[column].dataType == wanted:
        return F.col(column)
    return F.col(column).try_cast(wanted)


def is_valid(df: DataFrame, contract: Contract = TELEMETRY_CONTRACT) -> Column:
    """Whether a row of ``df`` passes every filtering rule of the contract."""
    rules = [c.passed(_declared(df, contract, c.column)) for c in contract.checks if c.filtered]
    return reduce(and_, rules)


def keep_valid(df: DataFrame, contract: Contract = TELEMETRY_CONTRACT) -> DataFrame:
    """Rows that pass every filtering rule of the contract."""
    return df.filter(is_valid(df, contract))


def schema_violations(df: DataFrame, contract: Contract = TELEMETRY_CONTRACT) -> list[Violation]:
    """Missing or wrongly typed columns, read from the schema without a job."""
    found = []
    for name, wanted in contract.types.items():
        if name not in df.columns:
            found.append(Violation(name, "present"))
        elif df.schema[name].dataType != wanted:
            found.append(Violation(name, f"type {wanted.simpleString()}"))
    return found


def _usable_checks(df: DataFrame, contract: Contract) -> list[Check]:
    """The value rules on columns that are there and of their type."""
    unusable = {v.column for v in schema_violations(df, contract)}
    return [c for c in contract.checks if c.column not in unusable]


def _counts(checks: list[Check]) -> list[Column]:
    """All rows, and for each rule those that break it."""
    failures = [F.count_if(c.failed(F.col(c.column))).alias(f"f{i}") for i, c in enumerate(checks)]
    return [F.count(F.lit(1)).alias("rows_checked"), *failures]


def contract_report(df: DataFrame, contract: Contract = TELEMETRY_CONTRACT) -> DataFrame:
    """One row per value rule: (column_name, check_name, failures, rows_checked).

    Rules on a missing or wrongly typed column are left out; those columns are
    reported by :func:`schema_violations`.
    """
    checks = _usable_checks(df, contract)
    counts = df.agg(*_counts(checks))
    rows = F.array(
        *(
            F.struct(
                F.lit(c.column).alias("column_name"),
                F.lit(c.kind).alias("check_name"),
                F.col(f"f{i}").alias("failures"),
                F.col("rows_checked"),
            )
            for i, c in enumerate(checks)
        )
    )
    return counts.select(F.inline(rows))


def full_report(df: DataFrame, contract: Contract = TELEMETRY_CONTRACT) -> DataFrame:
    """:func:`contract_report` with a row for each missing or wrongly typed column, which has no count."""
    report = contract_report(df, contract)
    found = [F.struct(F.lit(v.column).alias("column_name"), F.lit(v.check).alias("check_name")) for v in schema_violations(df, contract)]
    if not found:
        return report
    rows = df.agg(F.count(F.lit(1)).alias("rows_checked"))
    schema = rows.select(F.explode(F.array(*found)).alias("rule"), "rows_checked").select(
        "rule.column_name", "rule.check_name", F.lit(None).cast("long").alias("failures"), "rows_checked"
    )
    return report.unionByName(schema)


def enforce(
    df: DataFrame, mode: str = "fail", contract: Contract = TELEMETRY_CONTRACT
) -> tuple[DataFrame, list[Violation]]:
    """Check a batch; returns it unchanged together with what it violates.

    ``fail`` raises :class:`ContractViolation` (schema rules before any job is
    run); ``report`` only returns the findings.
    """
    if mode not in ("fail", "report"):
        raise ValueError(f"unknown contract mode {mode!r}")
    found = schema_violations(df, contract)
    if found and mode == "fail":
        raise ContractViolation(found)
    if len({v.column for v in found}) < len(contract.types):
        broken = contract_report(df, contract).filter("failures > 0")
        # At most one row per rule.
        found += [Violation(r.column_name, r.check_name, r.failures) for r in broken.collect()]
    if found and mode == "fail":
        raise ContractViolation(found)
    return df, found


class Watch:
    """Checks a batch while some other job reads it, by observed metrics of that job.

    Use ``rows`` in place of the batch in exactly one write, then ask :meth:`findings` or
    :meth:`accept`: the batch is read once. A missing or wrongly typed column is known at
    once; in mode ``fail`` it is refused here, before any job. A task that is run again after
    an executor was lost counts its rows again, so counts can then be too high; a rule that
    no row breaks is never reported, and one that is broken always is.
    """

    def __init__(self, df: DataFrame, mode: str = "fail", contract: Contract = TELEMETRY_CONTRACT):
        if mode not in ("fail", "report"):
            raise ValueError(f"unknown contract mode {mode!r}")
        self.mode = mode
        self.schema = schema_violations(df, contract)
        if self.schema and mode == "fail":
            raise ContractViolation(self.schema)
        self._checks = _usable_checks(df, contract)
        self._seen = Observation()
        self.rows = df.observe(self._seen, *_counts(self._checks))

    def report(self) -> list[tuple[str, str, int, int]]:
        """As :func:`contract_report`, once the rows have been written."""
        seen = self._seen.get
        rows = seen.get("rows_checked", 0)
        return [(c.column, c.kind, seen.get(f"f{i}", 0), rows) for i, c in enumerate(self._checks)]

    def findings(self) -> list[Violation]:
        broken = [Violation(column, check, failures) for column, check, failures, _ in self.report() if failures]
        return [*self.schema, *broken]

    def accept(self) -> None:
        """Raise :class:`ContractViolation` in mode ``fail`` if the rows break a rule."""
        if self.mode == "fail" and (found := self.findings()):
            raise ContractViolation(found)
