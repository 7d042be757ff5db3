"""Query definitions registered for the driver (see ``registry``).

Every query reads the driver tables ``orders`` and ``customer`` at
``sf_dir`` through the booking fixture, so its work grows with them. Queries
that need a written table (runs, commits, copies) write it under the shared
scratch root of the session; a run is done once per application and data
folder and then read by every query that inspects it.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle_sql as O
from .operators import copy as CP
from .operators import quality as Q
from .operators import table as TB
from .operators import transform as X
from .operators.batches import BATCH, with_batch_id
from .plans import migration as MG
from .plans import verify as VF
from .plans.normal_run import RunConfig, normal_run
from .registry import register
from .session import app_id, scratch_path
from .sources import fixtures as FX
from .sources import lookups as LK
from .sources.bookings import BOOKING_SCHEMA, read_bookings, write_bookings
from .streaming.ingest import run_ingest_once

# Partitioning of the tables written by queries: by month of check-in, so
# a few years of dates give tens of directories, not thousands.
PARTITION_TRANSFORM = "month"

_memo: dict[tuple, object] = {}
_memo_lock = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, what: str, build):
    key = (app_id(spark), sf_dir.rstrip("/"), what)
    with _memo_lock:
        if key not in _memo:
            _memo[key] = build()
        return _memo[key]


def forget_tables() -> None:
    """Forget which tables queries have written, so that the next ones write anew
    (the JSON-lines fixture stays)."""
    with _memo_lock:
        for key in [k for k in _memo if k[2] != "json"]:
            del _memo[key]


def run_config(spark: SparkSession) -> RunConfig:
    return RunConfig(FX.USD_RATE, LK.status_lookup(spark), LK.region_lookup(spark, FX.FIXTURE_REGIONS))


def bookings(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    cfg = run_config(spark)
    return X.transform(FX.raw_bookings(spark, sf_dir, damaged), cfg.usd_rate,
                       cfg.status_lookup, cfg.region_lookup)


def _table_spec(spark: SparkSession, name: str) -> TB.TableSpec:
    return TB.TableSpec(scratch_path(spark, name), partition_transform=PARTITION_TRANSFORM)


def raw_json_path(spark: SparkSession, sf_dir: str) -> str:
    """The nested fixture written once as JSON lines."""
    def build():
        path = scratch_path(spark, "bookings-json")
        write_bookings(FX.raw_bookings(spark, sf_dir), path)
        return path
    return _once(spark, sf_dir, "json", build)


# --- X1: the flagship transform -------------------------------------------------

@register("bookings_transform", O.q(O.transform_sql()))
def bookings_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookings(spark, sf_dir)


# --- S1: JSON scan with inferred schema ---------------------------------------

@register("scan_bookings_json", O.q("SELECT * FROM flat_bookings"))
def scan_bookings_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(read_bookings(spark, raw_json_path(spark, sf_dir)))


def _flat(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        F.col("accommodations.reservation").alias("reservation"),
        F.col("accommodation_details.accommodation").alias("accommodation"),
        F.col("booker.travel_purpose").alias("travel_purpose"),
        F.col("booker.address.country").alias("country"),
        F.col("currencies.booker").alias("currency"),
        F.col(X.REVENUE_LEAF).alias("commission_amount"),
        F.col("price.total").alias("price_total"),
        F.col("start").alias("start_s"),
        F.col("end").alias("end_s"),
        "label", "status",
    )


@register("scan_bookings_declared", O.q("SELECT * FROM flat_bookings"))
def scan_bookings_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(read_bookings(spark, raw_json_path(spark, sf_dir), BOOKING_SCHEMA))


# --- transform steps (J1, J2, C1-C5, D1, M1, P1-P4) ---------------------------

@register("map_status", O.q(O.MAP_STATUS))
def map_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = FX.raw_bookings(spark, sf_dir)
    return raw.transform(X.map_status, LK.status_lookup(spark)).select(
        F.col("accommodations.reservation").alias("transaction_id"),
        F.col("status").alias("raw_status"),
        F.col("_mapped_status").alias("status"),
    )


@register("map_region", O.q(O.MAP_REGION))
def map_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = FX.raw_bookings(spark, sf_dir)
    return raw.transform(X.map_region, LK.region_lookup(spark, FX.FIXTURE_REGIONS)).select(
        F.col("accommodations.reservation").alias("transaction_id"),
        F.col("_country_code").alias("country_code"),
        F.col("_region").alias("region"),
    )


@register("parse_label", O.q(O.cols("transaction_id", "conversion_key", "site_key", "device",
                                   "referral_property_id")))
def parse_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = FX.raw_bookings(spark, sf_dir)
    return raw.transform(X.parse_label).select(
        F.col("accommodations.reservation").alias("transaction_id"),
        F.col("label").alias("conversion_key"),
        F.col("_site_key").alias("site_key"),
        F.col("_device").alias("device"),
        F.col("_referral_property_id").alias("referral_property_id"),
    )


@register("property_id", O.q(O.cols("transaction_id", "property_id")))
def property_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookings(spark, sf_dir).select("transaction_id", "property_id")


@register("stay_dates", O.q(O.cols("transaction_id", "check_in_date", "check_out_date")))
def stay_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookings(spark, sf_dir).select("transaction_id", "check_in_date", "check_out_date")


@register("revenue_usd", O.q(O.cols("transaction_id", "revenue", "revenue_usd")))
def revenue_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookings(spark, sf_dir).select("transaction_id", "revenue", "revenue_usd")


def _rates_config(spark: SparkSession) -> RunConfig:
    return RunConfig(LK.rate_lookup(spark, FX.USD_RATES), LK.status_lookup(spark),
                     LK.region_lookup(spark, FX.FIXTURE_REGIONS))


def bookings_by_currency(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    cfg = _rates_config(spark)
    return X.transform(FX.raw_bookings(spark, sf_dir, damaged), cfg.usd_rate,
                       cfg.status_lookup, cfg.region_lookup)


@register("revenue_usd_by_currency", O.REVENUE_BY_CURRENCY)
def revenue_usd_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dollars by a rate table that lacks one of the currencies."""
    return bookings_by_currency(spark, sf_dir).select("transaction_id", "currency", "revenue", "revenue_usd")


@register("flatten_bookings", O.q(O.cols(*X.BOOKING_COLUMNS[:-1])))
def flatten_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = run_config(spark)
    return (FX.raw_bookings(spark, sf_dir)
            .transform(X.map_status, cfg.status_lookup)
            .transform(X.map_region, cfg.region_lookup)
            .transform(X.parse_label)
            .transform(X.select_final_columns))


# --- V1, V2, A1, F3-F6, A2: checks and counts ---------------------------------

@register("schema_report", O.SCHEMA_REPORT)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.schema_report(FX.raw_bookings(spark, sf_dir))


@register("dq_report", O.DQ_REPORT)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.quality_report(bookings(spark, sf_dir, damaged=True))


@register("dq_report_by_currency", O.DQ_BY_CURRENCY)
def dq_report_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.quality_report(bookings_by_currency(spark, sf_dir, damaged=True), rates=True)


@register("dq_duplicate_keys", O.DQ_DUPLICATES)
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_keys(bookings(spark, sf_dir, damaged=True))


@register("dq_negative_revenue", O.DQ_NEGATIVE)
def dq_negative_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.negative_revenue_rows(bookings(spark, sf_dir, damaged=True)).select(
        "transaction_id", "revenue", "revenue_usd")


@register("dq_invalid_currency", O.DQ_CURRENCY)
def dq_invalid_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.invalid_currency_rows(bookings(spark, sf_dir, damaged=True)).select(
        "transaction_id", "currency")


@register("dq_missing_revenue", O.DQ_MISSING)
def dq_missing_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.missing_revenue_rows(bookings(spark, sf_dir, damaged=True)).select(
        "transaction_id", F.isnan("revenue").alias("revenue_is_nan"))


@register("row_count", O.q("SELECT count(*) AS row_count FROM flat_bookings"))
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.raw_bookings(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


@register("batch_slice", O.BATCH_SLICE)
def batch_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = with_batch_id(bookings(spark, sf_dir), "transaction_id", MG.NUM_BATCHES, "modulo")
    return b.groupBy(F.col(BATCH).alias("batch")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("transaction_id").alias("key_sum"))


# --- K1-K4, J3, R2: table commits ---------------------------------------------

@register("create_table", O.q(O.cols("*")))
def create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _table_spec(spark, "create")
    TB.create_table(spark, spec, bookings(spark, sf_dir))
    return TB.read_table(spark, spec)


@register("create_table_by_purpose", O.q(O.cols("*")))
def create_table_by_purpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by a text column that holds empty strings."""
    spec = TB.TableSpec(scratch_path(spark, "by-purpose"), partition_column="travel_purpose")
    TB.create_table(spark, spec, bookings(spark, sf_dir))
    return TB.read_table(spark, spec)


@register("create_table_by_day", O.q(O.cols("*")))
def create_table_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by the check-in date as it is, the library's default."""
    spec = TB.TableSpec(scratch_path(spark, "by-day"))
    TB.create_table(spark, spec, bookings(spark, sf_dir))
    return TB.read_table(spark, spec)


def _upserted(spark: SparkSession, sf_dir: str) -> TB.TableSpec:
    def build():
        spec = _table_spec(spark, "upsert")
        b = bookings(spark, sf_dir)
        key = F.col("transaction_id")
        TB.write(spark, spec, b.where(key % 5 != 4))
        TB.write(spark, spec, b.where(key % 5 >= 3).withColumn("revenue", F.col("revenue") + 1))
        return spec
    return _once(spark, sf_dir, "upsert", build)


@register("upsert", O.UPSERT)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.read_table(spark, _upserted(spark, sf_dir))


@register("upsert_changes", O.UPSERT_CHANGES)
def upsert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.changes(spark, _upserted(spark, sf_dir), 1, 2)


@register("write_twice", O.q(O.cols("*")))
def write_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _table_spec(spark, "twice")
    b = bookings(spark, sf_dir)
    TB.write(spark, spec, b)
    TB.write(spark, spec, b)
    return TB.read_table(spark, spec)


# --- X2, S4, T3, K10: normal run and read-back ------------------------------

def _normal_run_table(spark: SparkSession, sf_dir: str) -> TB.TableSpec:
    def build():
        spec = _table_spec(spark, "normal")
        normal_run(spark, raw_json_path(spark, sf_dir), spec, run_config(spark))
        return spec
    return _once(spark, sf_dir, "normal", build)


@register("normal_run", O.q(O.cols("*")))
def normal_run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.read_table(spark, _normal_run_table(spark, sf_dir))


@register("verify_sample", O.q(O.cols(*VF.SAMPLE_COLUMNS) + " ORDER BY transaction_id LIMIT 20"))
def verify_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return VF.sample(spark, _normal_run_table(spark, sf_dir), 20, VF.SAMPLE_COLUMNS)


@register("verify_sample_full", O.q(O.cols("*") + " ORDER BY transaction_id LIMIT 20"))
def verify_sample_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return VF.sample(spark, _normal_run_table(spark, sf_dir), 20)


# --- X3-X5, S5, S6, T1, T2, F2, K6-K9: batch migration ------------------------

def _migrated(spark: SparkSession, sf_dir: str) -> dict:
    def build():
        spec = _table_spec(spark, "migration")
        target = CP.ParquetTarget(scratch_path(spark, "copy"))
        audit = scratch_path(spark, "audit")
        result = MG.batch_migration(spark, FX.raw_bookings(spark, sf_dir), spec, run_config(spark),
                                    target, audit, batch_method="modulo")
        return {"spec": spec, "target": target, "audit": audit, "result": result}
    return _once(spark, sf_dir, "migration", build)


@register("batch_load", O.q(O.cols("*")))
def batch_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.read_table(spark, _migrated(spark, sf_dir)["spec"])


@register("commit_log", O.COMMIT_LOG)
def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.commits(spark, _migrated(spark, sf_dir)["spec"]).select(
        "commit_id", "operation", "source_rows", "inserted", "updated", "row_count")


@register("first_last_commit", O.FIRST_LAST)
def first_last_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.first_last_commit(spark, _migrated(spark, sf_dir)["spec"])


@register("changelog_range", O.CHANGELOG_RANGE)
def changelog_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _migrated(spark, sf_dir)
    return TB.changes(spark, m["spec"], m["result"].first_commit, m["result"].last_commit)


@register("changelog_inserts", O.q(O.cols("*") + " WHERE transaction_id % 5 <> 0"))
def changelog_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _migrated(spark, sf_dir)
    return TB.inserts(TB.changes(spark, m["spec"], m["result"].first_commit, m["result"].last_commit))


@register("incremental_sync", O.q(O.cols("*") + " WHERE transaction_id % 5 <> 0"))
def incremental_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _migrated(spark, sf_dir)
    target = CP.ParquetTarget(scratch_path(spark, "sync-copy"))
    audit = scratch_path(spark, "sync-audit")
    CP.ensure_audit_table(spark, audit)
    MG.incremental_sync(spark, m["spec"], target, audit, m["result"].first_commit,
                        m["result"].last_commit)
    return target.read(spark)


@register("batch_migration", O.q(O.cols("*")))
def batch_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _migrated(spark, sf_dir)
    return m["target"].read(spark)


@register("migration_rerun", O.q(O.cols("*")))
def migration_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy after a second run with more rows: equal to the table, all bookings."""
    spec = _table_spec(spark, "rerun")
    target, audit = CP.ParquetTarget(scratch_path(spark, "rerun-copy")), scratch_path(spark, "rerun-audit")
    raw = FX.raw_bookings(spark, sf_dir)
    for part in (raw.where(F.col("accommodations.reservation") % 5 != 4), raw):
        MG.batch_migration(spark, part, spec, run_config(spark), target, audit)
    return target.read(spark).select(*X.BOOKING_COLUMNS)


def _since_birth(spark: SparkSession, sf_dir: str, duplicates: str) -> DataFrame:
    spec = _table_spec(spark, "birth")
    target, audit = CP.ParquetTarget(scratch_path(spark, "birth-copy")), scratch_path(spark, "birth-audit")
    TB.write(spark, spec, bookings(spark, sf_dir).where(F.col("transaction_id") % 3 == 0))
    MG.batch_migration(spark, FX.raw_bookings(spark, sf_dir), spec, run_config(spark), target, audit, n_batches=2,
                       batch_method="modulo", since_table_birth=True, duplicates=duplicates)
    return target.read(spark).select(*X.BOOKING_COLUMNS)


@register("sync_since_birth", O.SYNC_SINCE_BIRTH)
def sync_since_birth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy of a run on a table with an earlier commit: the run's first batch, then
    every insert after the table's first commit (rows that are both stand twice)."""
    return _since_birth(spark, sf_dir, "keep")


@register("sync_since_birth_once", O.SYNC_SINCE_BIRTH_ONCE)
def sync_since_birth_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, where keys of the first batch are not appended again."""
    return _since_birth(spark, sf_dir, "skip")


@register("sync_audit", O.SYNC_AUDIT)
def sync_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _migrated(spark, sf_dir)
    return CP.read_audit(spark, m["audit"]).select("snapshot_id", "batch_label", "record_count", "status")


# --- the scheduled normal run as a stream (X2 over Structured Streaming) ----------

@register("scheduled_ingest", O.q(O.cols("*")))
def scheduled_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _table_spec(spark, "stream")
    run_ingest_once(spark, raw_json_path(spark, sf_dir), BOOKING_SCHEMA, spec, run_config(spark),
                    scratch_path(spark, "stream-checkpoint"))
    return TB.read_table(spark, spec)
