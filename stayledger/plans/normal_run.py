"""The normal run (X2): extract, check structure, transform, check values, commit.

Passes over the raw JSON: one for schema inference (skipped when a schema is
declared) and one that evaluates the transform into the table's staging
folder (on the first run, straight into the table's first version, whose
commit row is written only after the value checks pass on it). A schema
inferred from every line with at least one field proves the input is not
empty, so no emptiness probe reads it a third time. The value checks and the commit read the staged Parquet, so the
source is never parsed again and a lost executor only re-reads Parquet.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import JOB_ERRORS, DataExtractionError
from ..operators import quality as Q
from ..operators import table as TB
from ..operators.transform import transform
from ..sources.bookings import NOT_AS_DECLARED, read_bookings


@dataclass(frozen=True)
class RunConfig:
    """Run constants: the USD rate and the two lookups.

    ``usd_rate`` is one number for every row, or a table (currency, usd_rate). With a
    table, a run fails on amounts whose currency has no rate, unless
    ``allow_missing_rates``: their dollars are then null."""

    usd_rate: float | DataFrame
    status_lookup: DataFrame
    region_lookup: DataFrame
    allow_missing_rates: bool = False

    @property
    def checks_rates(self) -> bool:
        return isinstance(self.usd_rate, DataFrame) and not self.allow_missing_rates


def run_on_raw(spark: SparkSession, raw: DataFrame, spec: TB.TableSpec, cfg: RunConfig,
               check_schema: bool = True, txn: str | None = None,
               inferred_from_all_lines: bool = False) -> TB.CommitResult:
    """Check, transform, check and commit already-scanned raw bookings.

    With ``txn``, a run that is the table's latest commit under that name is
    not redone (see ``table.write``)."""
    try:
        return _checked_run(spark, raw, spec, cfg, check_schema, txn, inferred_from_all_lines)
    except JOB_ERRORS as exc:
        if NOT_AS_DECLARED in str(exc):
            raise DataExtractionError(str(exc)) from exc
        raise


def _checked_run(spark: SparkSession, raw: DataFrame, spec: TB.TableSpec, cfg: RunConfig,
                 check_schema: bool, txn: str | None, inferred_from_all_lines: bool) -> TB.CommitResult:
    prev = TB.latest_commit(spark, spec)
    if txn is not None and prev is not None and prev.txn == txn:
        return TB._result(prev)
    if check_schema:
        Q.validate_schema(raw, inferred_from_all_lines)
    rows = transform(raw, cfg.usd_rate, cfg.status_lookup, cfg.region_lookup)
    if prev is None:
        # First run: write the rows once as the table's first version and
        # check them there; the commit row is written only if they pass.
        return TB.create_table(spark, spec, rows, _checked=True, txn=txn,
                               check=lambda written: Q.validate_quality(written, spec.key, cfg.checks_rates))
    name = f"run-{uuid.uuid4().hex[:12]}"
    staged = TB.stage(spark, spec, rows, name)
    try:
        Q.validate_quality(staged, spec.key, cfg.checks_rates)
        return TB.write(spark, spec, staged, stage_source=False, txn=txn)
    finally:
        TB.unstage(spark, spec, name)


def normal_run(spark: SparkSession, source_path: str, spec: TB.TableSpec, cfg: RunConfig,
               schema: T.StructType | None = None, txn: str | None = None) -> TB.CommitResult:
    """Read JSON-lines bookings at ``source_path`` and commit them to ``spec``."""
    raw = read_bookings(spark, source_path, schema)
    return run_on_raw(spark, raw, spec, cfg, txn=txn, inferred_from_all_lines=schema is None)
