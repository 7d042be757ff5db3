"""Batch migration (X3-X5): load the input as n commits and bring a relational
copy level with the table.

The transformed input is evaluated once into Parquet partitioned by batch id;
each batch is a partition-pruned read of it (no shuffle per batch). When the
run creates the table, later batches are appended without a key join (batch
ids are a function of the key, so their key sets are disjoint), the copy is
overwritten with the first batch and then gets every later insert from the
changelog. On a table that was there before (an earlier run, or one that failed
half-way) the batches are merged and the copy is overwritten once, at the end,
with the table's state: after every run the copy equals the table. A run that
fails leaves no audit row for what it did not finish; running it again redoes it.

Copies are parallel executor writes; a copy is replaced in one step, and appended to
once for each range of commits (see ``operators/copy.py``). Like the original, value checks are not run
here unless ``check_duplicates`` asks for the key check.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import copy as CP
from ..operators import quality as Q
from ..operators import table as TB
from ..operators.batches import BATCH, batch_id, stage_batches
from ..operators.transform import transform
from ..session import delete_path
from .normal_run import RunConfig

NUM_BATCHES = 5
DUPLICATES = ("keep", "skip")


@dataclass(frozen=True)
class SyncResult:
    first_commit: int
    last_commit: int
    synced_rows: int
    preview: DataFrame  # up to 20 synced rows, for display


@dataclass(frozen=True)
class LoadResult:
    first_commit: int  # this run's first commit
    last_commit: int
    created: bool  # whether this run created the table (and started the copy)


def batch_load(spark: SparkSession, raw: DataFrame, spec: TB.TableSpec, cfg: RunConfig,
               target, audit_path: str, n_batches: int = NUM_BATCHES,
               check_duplicates: bool = False, batch_method: str = "hash",
               always_copy_first: bool = False) -> LoadResult:
    """Commit ``raw`` in ``n_batches`` batches by key. A run that creates the table (any
    run, with ``always_copy_first``) also replaces the copy by the first batch."""
    rows = transform(raw, cfg.usd_rate, cfg.status_lookup, cfg.region_lookup)
    staging = f"{spec.path}/_staging/batches-{uuid.uuid4().hex[:12]}"
    staged = stage_batches(rows, spec.key, n_batches, staging, batch_method)
    first, last, created = None, None, False
    try:
        for i in range(n_batches):
            batch = staged.where(F.col(BATCH) == i).drop(BATCH)
            if check_duplicates:
                Q.raise_if_bad(Q.quality_report(batch, spec.key).where(F.col("check_order") == 1))
            if created:
                # Batch ids are a function of the key, and this run created the
                # table: no key of this batch can be in it, so no key join is needed.
                result = TB.append_new_keys(spark, spec, batch)
            else:
                # on an existing table: only table keys of this batch can match
                in_batch = batch_id(rows, spec.key, n_batches, batch_method) == i
                result = TB.write(spark, spec, batch, stage_source=False, key_where=in_batch)
                created = result.operation == "create"
            if i == 0:
                first = result.commit_id
                if created or always_copy_first:
                    CP.record(spark, audit_path, first, "first", target.write(batch, "overwrite"))
            last = result.commit_id
    finally:
        delete_path(spark, staging)  # every batch is committed (or the run failed)
    return LoadResult(first, last, created)


def incremental_sync(spark: SparkSession, spec: TB.TableSpec, target, audit_path: str,
                     first: int, last: int, include_updates: bool = False) -> SyncResult:
    """Append the inserts of commits (first, last] to the copy; audit them. A sync
    that is repeated appends nothing again: the copy knows the range by name."""
    rows = TB.inserts(TB.changes(spark, spec, first, last), include_updates)
    name = f"commits-{first}-{last}" + ("-with-updates" if include_updates else "")
    return _append(spark, rows, name, target, audit_path, first, last)


def _append(spark: SparkSession, rows: DataFrame, name: str, target, audit_path: str, first: int, last: int) -> SyncResult:
    n = target.append_once(rows, name)
    if n is None:  # the copy had these rows: only the audit row may be missing
        n = target.appended(spark, name)
        if not CP.is_recorded(spark, audit_path, last, "last", n):
            CP.record(spark, audit_path, last, "last", n)
    else:
        CP.record(spark, audit_path, last, "last", n)
    return SyncResult(first, last, n, rows.limit(20))


def sync_since_birth(spark: SparkSession, spec: TB.TableSpec, target, audit_path: str,
                     load: LoadResult, duplicates: str = "keep") -> SyncResult:
    """Append every insert after the table's oldest commit, up to the run's last, to a
    copy that holds the run's first batch; audit it.

    Rows of the oldest commit itself are not in that range. ``duplicates`` says what
    becomes of inserts whose key the first batch holds too: ``keep`` appends them all (a
    row that the first batch inserted then stands twice), ``skip`` leaves keys of
    the first batch out (null keys match nothing and stay)."""
    if duplicates not in DUPLICATES:
        raise ValueError(f"duplicates is {duplicates!r}, not one of {DUPLICATES}")
    oldest = TB.first_last_commit(spark, spec).first()["first_commit"]
    rows = TB.inserts(TB.changes(spark, spec, oldest, load.last_commit))
    if duplicates == "skip":
        batch = TB.inserts(TB.changes(spark, spec, load.first_commit - 1, load.first_commit), include_updates=True)
        keyed, names = F.col(spec.key).isNotNull(), rows.columns
        others = rows.where(keyed).join(batch.where(keyed).select(spec.key).distinct(), spec.key, "left_anti")
        rows = others.select(*names).union(rows.where(~keyed))
    return _append(spark, rows, f"birth-{oldest}-{load.last_commit}-{duplicates}", target, audit_path, oldest, load.last_commit)


def full_sync(spark: SparkSession, spec: TB.TableSpec, target, audit_path: str,
              first: int, last: int) -> SyncResult:
    """Overwrite the copy with the table's state at commit ``last``; audit it."""
    rows = TB.read_table(spark, spec, last)
    n = target.write(rows, "overwrite")
    CP.record(spark, audit_path, last, "last", n)
    return SyncResult(first, last, n, rows.limit(20))


def batch_migration(spark: SparkSession, raw: DataFrame, spec: TB.TableSpec, cfg: RunConfig,
                    target, audit_path: str, n_batches: int = NUM_BATCHES,
                    check_duplicates: bool = False, batch_method: str = "hash",
                    since_table_birth: bool = False, duplicates: str = "keep") -> SyncResult:
    """Audit table, batch load, and the copy brought level with the table. With
    ``since_table_birth`` the copy is, as in the original, the run's first batch and
    every insert since the table's oldest commit (`sync_since_birth`)."""
    CP.ensure_audit_table(spark, audit_path)
    load = batch_load(spark, raw, spec, cfg, target, audit_path, n_batches, check_duplicates, batch_method,
                      always_copy_first=since_table_birth)
    if since_table_birth:
        return sync_since_birth(spark, spec, target, audit_path, load, duplicates)
    sync = incremental_sync if load.created else full_sync
    return sync(spark, spec, target, audit_path, load.first_commit, load.last_commit)
