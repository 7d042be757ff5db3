"""Batch slices, relational copies (JDBC on embedded Derby), audit, migration."""

import uuid

import pytest

from pyspark.sql import functions as F

from stayledger.operators import batches as B
from stayledger.operators import copy as CP
from stayledger.operators import table as TB
from stayledger.plans import migration as MG
from stayledger.queries import bookings, run_config
from stayledger.sources import fixtures as FX

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("method", ["hash", "modulo"])
def test_slices_partition_the_input(spark, method):
    df = spark.createDataFrame([(i,) for i in range(1003)] + [(None,)], "k bigint")
    slices = [B.batch_slice(df, "k", i, 5, method) for i in range(5)]
    sizes = [s.count() for s in slices]
    assert sum(sizes) == 1004 and min(sizes) >= 160
    assert sum(s.where(F.col("k").isNull()).count() for s in slices) == 1
    union = slices[0]
    for s in slices[1:]:
        union = union.unionByName(s)
    assert union.exceptAll(df).count() == 0 and df.exceptAll(union).count() == 0


def test_hash_batches_are_near_equal_whatever_the_keys(spark):
    df = spark.range(0, 50_000, 5).withColumnRenamed("id", "k")  # multiples of 5
    sizes = [r["count"] for r in B.with_batch_id(df, "k", 5).groupBy(B.BATCH).count().collect()]
    assert len(sizes) == 5 and min(sizes) > 1850 and max(sizes) < 2150
    with pytest.raises(ValueError):
        B.batch_id(spark.createDataFrame([("a",)], "k string"), "k", 5, "modulo")


def test_hash_slices_for_string_keys(spark):
    df = spark.createDataFrame([(f"id-{i}",) for i in range(200)] + [(None,)], "k string")
    sizes = [B.batch_slice(df, "k", i, 4).count() for i in range(4)]
    assert sum(sizes) == 201 and min(sizes) > 20


def derby(name=None):
    return CP.JdbcTarget(
        url=f"jdbc:derby:memory:{name or uuid.uuid4().hex[:8]};create=true",
        table="BOOKINGS_COPY",
        properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"},
    )


def test_jdbc_overwrite_then_append(spark):
    t = derby()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    t.write(df, "overwrite")
    t.write(df.limit(1), "overwrite")
    t.write(df.where("id = 2"), "append")
    assert sorted(tuple(r) for r in t.read(spark).collect()) == [(1, "a"), (2, "b")]


def test_audit_table(spark, scratch):
    path = scratch("audit")
    CP.ensure_audit_table(spark, path)
    CP.ensure_audit_table(spark, path)
    CP.record(spark, path, 7, "first", 12)
    rows = CP.read_audit(spark, path).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.snapshot_id, r.batch_label, r.record_count, r.status) == (7, "first", 12, "done")
    assert r.created_at is not None


def _expected(spark):
    return bookings(spark, SMALL)


def test_migration_copy_equals_state_on_fresh_table(spark, scratch):
    spec = TB.TableSpec(scratch("mig"), partition_transform="month")
    target, audit = derby(), scratch("audit")
    res = MG.batch_migration(spark, FX.raw_bookings(spark, SMALL), spec, run_config(spark), target, audit,
                             batch_method="modulo")
    state = TB.read_table(spark, spec)
    copy = target.read(spark).select(*state.columns)
    exp = _expected(spark)
    assert state.count() == exp.count() == copy.count()
    assert state.exceptAll(exp).count() == 0 and copy.exceptAll(state).count() == 0
    assert (res.first_commit, res.last_commit) == (1, 5)
    audit_rows = sorted((r.batch_label, r.snapshot_id, r.record_count)
                        for r in CP.read_audit(spark, audit).collect())
    n0 = exp.where(F.col("transaction_id") % 5 == 0).count()
    assert audit_rows == [("first", 1, n0), ("last", 5, exp.count() - n0)]
    assert res.preview.count() == 20


def same(a, b):
    b = b.select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def yearly(scratch, name):
    return TB.TableSpec(scratch(name), partition_transform="year")


def test_second_run_on_existing_table(spark, scratch):
    spec = yearly(scratch, "mig2")
    cfg, raw = run_config(spark), FX.raw_bookings(spark, SMALL)
    target, audit = CP.ParquetTarget(scratch("c")), scratch("a")
    MG.batch_migration(spark, raw, spec, cfg, target, audit, n_batches=2)
    # every row is an update now: the copy is still all of the table
    res = MG.batch_migration(spark, raw, spec, cfg, target, audit, n_batches=2)
    n = _expected(spark).count()
    assert (res.first_commit, res.last_commit, res.synced_rows) == (3, 4, n)
    assert same(target.read(spark), _expected(spark))
    labels = sorted((r.snapshot_id, r.batch_label) for r in CP.read_audit(spark, audit).collect())
    assert labels == [(1, "first"), (2, "last"), (4, "last")]


def test_copy_equals_table_after_a_failed_run_and_a_repeat(spark, scratch, monkeypatch):
    spec = yearly(scratch, "mig3")
    cfg, raw = run_config(spark), FX.raw_bookings(spark, SMALL)
    target, audit = CP.ParquetTarget(scratch("c")), scratch("a")
    append, calls = TB.append_new_keys, []

    def failing(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost the third batch")
        return append(*a, **k)
    monkeypatch.setattr(TB, "append_new_keys", failing)
    with pytest.raises(RuntimeError):
        MG.batch_migration(spark, raw, spec, cfg, target, audit, n_batches=3)
    monkeypatch.undo()
    assert [r.batch_label for r in CP.read_audit(spark, audit).collect()] == ["first"]  # not "last": redo
    MG.batch_migration(spark, raw, spec, cfg, target, audit, n_batches=3)
    assert same(target.read(spark), _expected(spark))
    assert same(TB.read_table(spark, spec), _expected(spark))


def test_copy_equals_table_after_a_run_with_other_rows(spark, scratch):
    spec = yearly(scratch, "mig4")
    cfg, raw = run_config(spark), FX.raw_bookings(spark, SMALL)
    target, audit = CP.ParquetTarget(scratch("c")), scratch("a")
    key = F.col("accommodations.reservation")
    MG.batch_migration(spark, raw.where(key % 3 != 0), spec, cfg, target, audit, n_batches=2)
    MG.batch_migration(spark, raw.where(key % 3 != 1), spec, cfg, target, audit, n_batches=2)
    assert same(target.read(spark), TB.read_table(spark, spec))
    assert same(target.read(spark), _expected(spark))


def test_a_cap_on_connections_keeps_the_scan_parallel(spark):
    df = spark.range(0, 6400, 1, 64).selectExpr("id", "id * 2 AS v")
    open_ = CP.JdbcTarget(url="jdbc:none", table="t")
    assert open_.rows_to_write(df).rdd.getNumPartitions() == 64
    capped = CP.JdbcTarget(url="jdbc:none", table="t", num_partitions=3).rows_to_write(df)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(3)" in plan and "Coalesce" not in plan


def test_capped_jdbc_write_counts_every_row(spark):
    t = CP.JdbcTarget(url=derby().url, table="CAPPED", properties=derby().properties, num_partitions=3)
    df = spark.range(300).repartition(20).selectExpr("id", "cast(id AS string) AS v")
    assert t.write(df, "overwrite") == 300
    assert t.read(spark).count() == 300
    assert t.write(df.where("id < 10"), "append") == 10
    assert t.read(spark).count() == 310


def test_batch_mode_skips_checks_unless_asked(spark, scratch):
    from stayledger.errors import DataQualityError
    cfg, raw = run_config(spark), FX.raw_bookings(spark, SMALL)
    dup = raw.unionByName(raw.where(F.col("accommodations.reservation") % 23 == 0))
    n_dup = raw.where(F.col("accommodations.reservation") % 23 == 0).count()
    spec = yearly(scratch, "dup")
    MG.batch_migration(spark, dup, spec, cfg, CP.ParquetTarget(scratch("c")), scratch("a"), n_batches=2)
    # one key's rows share a batch, so both copies are inserted (no checks, as in batch mode)
    assert TB.read_table(spark, spec).count() == raw.count() + n_dup
    strict = yearly(scratch, "dup2")
    with pytest.raises(DataQualityError, match="duplicate"):
        MG.batch_migration(spark, dup, strict, cfg, CP.ParquetTarget(scratch("c")), scratch("a"),
                           check_duplicates=True)


def test_sync_with_updates_copies_after_images(spark, scratch):
    spec = yearly(scratch, "upd")
    b = bookings(spark, SMALL)
    key = F.col("transaction_id")
    TB.write(spark, spec, b.where(key % 5 != 4))
    TB.write(spark, spec, b.where(key % 5 >= 3))
    target = CP.ParquetTarget(scratch("c"))
    res = MG.incremental_sync(spark, spec, target, scratch("a"), 1, 2, include_updates=True)
    assert res.synced_rows == b.where(key % 5 >= 3).count()
    assert same(target.read(spark), b.where(key % 5 >= 3))


# --- copies change in one step, and once ---------------------------------------

WIDE = "id bigint, v string, d double, at timestamp"


def test_failed_overwrite_keeps_the_old_rows(spark, scratch):
    df = spark.range(40).selectExpr("id", "cast(id AS string) AS v").repartition(4)
    broken = df.withColumn("v", F.when(F.col("id") == 33, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    for t in (derby(), CP.ParquetTarget(scratch("c"))):
        assert t.write(df, "overwrite") == 40
        with pytest.raises(Exception, match="lost"):
            t.write(broken, "overwrite")
        with pytest.raises(Exception, match="lost"):
            t.append_once(broken, "more")
        assert same(t.read(spark), df) and t.appended(spark, "more") is None
        assert t.append_once(df.where("id < 5"), "more") == 5
        assert t.read(spark).count() == 45
        assert t.write(df.where("id < 7"), "overwrite") == 7
        assert same(t.read(spark), df.where("id < 7")) and t.appended(spark, "more") is None


def test_overwrite_that_fails_in_the_database_keeps_the_old_rows(spark):
    t = derby()
    df = spark.range(10).selectExpr("id", "cast(id AS string) AS v")
    t.write(df, "overwrite")
    bad = CP.JdbcTarget(t.url, t.table, t.properties, rename="RENAME TABLE {old} TO {new} NOW")
    with pytest.raises(Exception):
        bad.write(df.where("id < 3"), "overwrite")
    assert same(t.read(spark), df)
    assert t.write(df.where("id < 3"), "overwrite") == 3 and t.read(spark).count() == 3


def test_repeated_append_adds_nothing(spark, scratch):
    rows = [(1, "a", 1.5, None), (1, "a", 1.5, None), (None, None, None, None), (2, "é\n'\"", -0.0, None)]
    df = spark.createDataFrame(rows, WIDE)
    for t in (derby(), CP.ParquetTarget(scratch("c"))):
        assert t.append_once(df, "first") == 4  # creates the copy; equal rows both stay
        assert t.append_once(df, "first") is None and t.appended(spark, "first") == 4
        assert t.append_once(df.limit(0), "none") == 0 and t.append_once(df, "none") is None
        assert t.append_once(df, "second") == 4
        assert same(t.read(spark), df.union(df))


def test_rows_loaded_twice_by_a_repeated_task_count_once(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    load = DataFrameWriter.jdbc

    def twice(self, url, table, mode=None, properties=None):
        load(self, url, table, mode=mode, properties=properties)
        if table.endswith("_STAGED"):
            load(self, url, table, mode="append", properties=properties)
    monkeypatch.setattr(DataFrameWriter, "jdbc", twice)
    t = derby()
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id bigint, v string")
    t.write(df, "overwrite")
    t.append_once(df, "more")
    assert same(t.read(spark), df.union(df))


@pytest.mark.parametrize("kind", ["jdbc", "parquet"])
def test_repeated_sync_finds_no_double_row(spark, scratch, kind):
    spec = yearly(scratch, "again")
    b = bookings(spark, SMALL)
    key = F.col("transaction_id")
    TB.write(spark, spec, b.where(key % 3 == 0))
    TB.write(spark, spec, b.where(key % 3 == 1))
    TB.write(spark, spec, b.where(key % 3 == 2))
    target = derby() if kind == "jdbc" else CP.ParquetTarget(scratch("c"))
    audit = scratch("a")
    CP.ensure_audit_table(spark, audit)
    target.write(b.where(key % 3 == 0), "overwrite")
    results = [MG.incremental_sync(spark, spec, target, audit, 1, 3) for _ in range(3)]
    assert len({r.synced_rows for r in results}) == 1 and results[0].synced_rows == b.where(key % 3 != 0).count()
    assert same(target.read(spark), b)
    assert CP.read_audit(spark, audit).count() == 1


def test_sync_repeated_after_its_audit_row_was_lost(spark, scratch, monkeypatch):
    spec = yearly(scratch, "lost")
    b = bookings(spark, SMALL)
    TB.write(spark, spec, b.where("transaction_id % 2 = 0"))
    TB.write(spark, spec, b.where("transaction_id % 2 = 1"))
    target, audit = derby(), scratch("a")
    CP.ensure_audit_table(spark, audit)

    def failing(*a, **k):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(CP, "record", failing)
    with pytest.raises(RuntimeError):
        MG.incremental_sync(spark, spec, target, audit, 1, 2)
    monkeypatch.undo()
    n = MG.incremental_sync(spark, spec, target, audit, 1, 2).synced_rows
    assert same(target.read(spark), b.where("transaction_id % 2 = 1"))
    assert [tuple(r)[:3] for r in CP.read_audit(spark, audit).collect()] == [(2, "last", n)]


def test_sync_since_birth(spark, scratch):
    cfg, raw, b = run_config(spark), FX.raw_bookings(spark, SMALL), bookings(spark, SMALL)
    for duplicates in ("keep", "skip"):
        spec = yearly(scratch, "birth")
        TB.write(spark, spec, b.where("transaction_id % 3 = 0"))
        target, audit = derby(), scratch("a")
        res = MG.batch_migration(spark, raw, spec, cfg, target, audit, n_batches=2, batch_method="modulo",
                                 since_table_birth=True, duplicates=duplicates)
        first, later = b.where("transaction_id % 2 = 0"), b.where("transaction_id % 3 <> 0")
        if duplicates == "skip":
            later = later.where("transaction_id % 2 <> 0")
        assert same(target.read(spark), first.union(later))
        assert (res.first_commit, res.last_commit, res.synced_rows) == (1, 3, later.count())
        audit_rows = sorted((r.batch_label, r.snapshot_id, r.record_count) for r in CP.read_audit(spark, audit).collect())
        assert audit_rows == [("first", 2, first.count()), ("last", 3, later.count())]
    with pytest.raises(ValueError, match="duplicates"):
        MG.sync_since_birth(spark, spec, target, audit, MG.LoadResult(2, 3, False), "merge")


def test_since_birth_keeps_null_keys(spark, scratch):
    spec = TB.TableSpec(scratch("nulls"), key="k", partition_column="p")
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a"), (2, "a")], "k bigint, p string")
    TB.write(spark, spec, spark.createDataFrame([(9, "a")], "k bigint, p string"))
    TB.write(spark, spec, df.where("k = 1 or k is null"))
    TB.write(spark, spec, df.where("k = 2"))
    target = CP.ParquetTarget(scratch("c"))
    MG.sync_since_birth(spark, spec, target, scratch("a"), MG.LoadResult(2, 3, False), "skip")
    assert sorted(r.k or 0 for r in target.read(spark).collect()) == [0, 0, 2]
