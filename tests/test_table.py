"""Versioned table: create, upsert (MERGE semantics), changelog, layout."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayledger.errors import MergeCardinalityError, TableWriteError
from stayledger.operators import table as TB

SCHEMA = "transaction_id bigint, check_in_date date, revenue double"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(d):
    return sorted((tuple(r) for r in d.collect()), key=repr)


@pytest.fixture
def spec(scratch):
    return TB.TableSpec(scratch("table"))


def test_upsert_merge_semantics(spark, spec):
    TB.create_table(spark, spec, df(spark, [(1, D1, 1.0), (2, D1, 2.0), (None, D2, 3.0)]))
    res = TB.upsert(spark, spec, df(spark, [
        (2, D2, 20.0),            # update, moves to another partition
        (3, D1, 30.0), (3, D1, 31.0),   # two new rows with one key: both inserted
        (None, D2, 4.0),          # a null key never matches
    ]))
    assert (res.inserted, res.updated, res.row_count) == (3, 1, 6)
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, [
        (1, D1, 1.0), (2, D2, 20.0), (None, D2, 3.0), (3, D1, 30.0), (3, D1, 31.0), (None, D2, 4.0)]))
    ch = TB.changes(spark, spec, 1, 2)
    got = sorted([(r._change_type, r.transaction_id, r.revenue, r._commit_snapshot_id, r._change_ordinal)
                  for r in ch.collect()], key=repr)
    assert got == sorted([("UPDATE_BEFORE", 2, 2.0, 2, 0), ("UPDATE_AFTER", 2, 20.0, 2, 0),
                          ("INSERT", 3, 30.0, 2, 0), ("INSERT", 3, 31.0, 2, 0),
                          ("INSERT", None, 4.0, 2, 0)], key=repr)
    assert rows(TB.read_table(spark, spec, commit_id=1)) == rows(
        df(spark, [(1, D1, 1.0), (2, D1, 2.0), (None, D2, 3.0)]))


def test_cardinality_violation_raises(spark, spec):
    TB.create_table(spark, spec, df(spark, [(1, D1, 1.0)]))
    with pytest.raises(MergeCardinalityError):
        TB.upsert(spark, spec, df(spark, [(1, D1, 2.0), (1, D2, 3.0)]))
    assert rows(TB.read_table(spark, spec)) == [(1, D1, 1.0)]


def test_duplicate_target_rows_are_each_updated(spark, spec):
    TB.create_table(spark, spec, df(spark, [(5, D1, 1.0), (5, D1, 2.0), (6, D2, 1.0)]))
    res = TB.upsert(spark, spec, df(spark, [(5, D2, 9.0)]))
    assert res.updated == 2 and res.inserted == 0
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, [(5, D2, 9.0), (5, D2, 9.0), (6, D2, 1.0)]))


def test_null_partition_round_trip(spark, spec):
    TB.create_table(spark, spec, df(spark, [(1, None, 1.0), (2, D1, 2.0)]))
    TB.upsert(spark, spec, df(spark, [(1, None, 5.0), (3, None, 6.0)]))
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, [(1, None, 5.0), (2, D1, 2.0), (3, None, 6.0)]))


def test_schema_mismatch_raises(spark, spec):
    TB.create_table(spark, spec, df(spark, [(1, D1, 1.0)]))
    bad = spark.createDataFrame([("1", D1, 1.0)], "transaction_id string, check_in_date date, revenue double")
    with pytest.raises(TableWriteError, match="transaction_id"):
        TB.upsert(spark, spec, bad)


def test_write_creates_then_upserts_and_twice_equals_once(spark, spec):
    base = df(spark, [(1, D1, 1.0), (2, D2, 2.0)])
    src = df(spark, [(2, D2, 3.0), (4, D1, 4.0)])
    assert TB.write(spark, spec, base).operation == "create"
    TB.write(spark, spec, src)
    once = rows(TB.read_table(spark, spec))
    again = TB.write(spark, spec, src)
    assert (again.inserted, again.updated) == (0, 2)
    assert rows(TB.read_table(spark, spec)) == once
    with pytest.raises(TableWriteError):
        TB.create_table(spark, spec, base)
    assert TB.first_last_commit(spark, spec).collect()[0].asDict() == {"first_commit": 1, "last_commit": 3}


def test_state_is_replay_of_changes(spark, spec):
    TB.write(spark, spec, df(spark, [(i, D1 if i % 2 else D2, float(i)) for i in range(10)]))
    TB.write(spark, spec, df(spark, [(i, D2, i + 0.5) for i in range(5, 15)]))
    TB.write(spark, spec, df(spark, [(i, D1, i + 0.25) for i in range(12, 20)]))
    state = spark.createDataFrame([], SCHEMA)
    for n in (1, 2, 3):
        ch = TB.changes(spark, spec, n - 1, n)
        before = ch.where(F.col("_change_type") == "UPDATE_BEFORE").drop(*TB.CHANGE_COLUMNS)
        after = TB.inserts(ch, include_updates=True)
        state = state.exceptAll(before).unionByName(after)
        assert rows(state) == rows(TB.read_table(spark, spec, commit_id=n))


def test_insert_only_commit_appends_a_segment(spark, spec):
    TB.write(spark, spec, df(spark, [(1, D1, 1.0)]))
    TB.write(spark, spec, df(spark, [(2, D1, 2.0)]))
    assert rows(TB.segments(spark, spec)) == [("v2024-01-01", 1), ("v2024-01-01", 2)]
    TB.write(spark, spec, df(spark, [(1, D1, 3.0)]))  # a match: the partition is rewritten
    assert rows(TB.segments(spark, spec)) == [("v2024-01-01", 3)]
    assert rows(TB.segments(spark, spec, 2)) == [("v2024-01-01", 1), ("v2024-01-01", 2)]
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, [(1, D1, 3.0), (2, D1, 2.0)]))


def test_batch_commit_rewrites_only_the_segments_of_its_keys(spark, spec):
    def even():
        return F.pmod(F.col("transaction_id"), F.lit(2)) == 0

    TB.write(spark, spec, df(spark, [(2, D1, 2.0), (4, D1, 4.0), (None, D1, 0.0)]))
    TB.append_new_keys(spark, spec, df(spark, [(1, D1, 1.0), (3, D1, 3.0), (5, D2, 5.0)]))
    moved = [(2, D2, 2.5), (6, D1, 6.0)]  # an update that changes its partition, a new key
    assert TB.write(spark, spec, df(spark, moved), key_where=even()).updated == 1
    # the segment of the odd keys stays; that of the even ones is replaced
    assert rows(TB.segments(spark, spec)) == [
        ("v2024-01-01", 2), ("v2024-01-01", 3), ("v2024-02-01", 2), ("v2024-02-01", 3)]
    third = [(4, D1, 4.0), (None, D1, 0.0), (1, D1, 1.0), (3, D1, 3.0), (5, D2, 5.0), *moved]
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, third))
    # a replaced segment stays gone, and a later batch may replace one that replaced another
    TB.write(spark, spec, df(spark, [(6, D1, 6.5)]), key_where=even())
    fourth = [r for r in third if r[0] != 6] + [(6, D1, 6.5)]
    assert rows(TB.segments(spark, spec)) == [
        ("v2024-01-01", 2), ("v2024-01-01", 4), ("v2024-02-01", 2), ("v2024-02-01", 3)]
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, fourth))
    TB.write(spark, spec, df(spark, [(1, D1, 1.5)]))  # no batch: the partition is rewritten whole
    assert rows(TB.segments(spark, spec)) == [("v2024-01-01", 5), ("v2024-02-01", 2), ("v2024-02-01", 3)]
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, [r for r in fourth if r[0] != 1] + [(1, D1, 1.5)]))
    for n, state in ((3, third), (4, fourth)):
        assert rows(TB.read_table(spark, spec, n)) == rows(df(spark, state))
    changed = TB.changes(spark, spec, 2, 3).groupBy("_change_type").count()
    assert rows(changed) == [("INSERT", 1), ("UPDATE_AFTER", 1), ("UPDATE_BEFORE", 1)]


def test_rerun_of_batches_writes_each_row_of_the_table_once(spark, spec):
    """Every batch of a second run meets its own keys only: what it keeps is its own, too."""
    first = [(i, D1, float(i)) for i in range(40)]

    def batch(i):
        return F.pmod(F.xxhash64("transaction_id"), F.lit(4)) == i

    TB.write(spark, spec, df(spark, first).where(batch(0)))
    for i in (1, 2, 3):
        TB.append_new_keys(spark, spec, df(spark, first).where(batch(i)))
    again = df(spark, [(i, D1, i + 0.5) for i in range(0, 60, 2)])
    for i in range(4):
        TB.write(spark, spec, again.where(batch(i)), key_where=batch(i))
    written = spark.read.parquet(spec.state_path).where(F.col("_v") > 4).groupBy("_slot").count()
    assert rows(written) == [("before", 20), ("insert", 10), ("kept", 20), ("update", 20)]
    want = [r for r in first if r[0] % 2] + [(i, D1, i + 0.5) for i in range(0, 60, 2)]
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, want))


def test_empty_source_is_a_no_op_commit(spark, spec):
    TB.write(spark, spec, df(spark, [(1, D1, 1.0)]))
    res = TB.write(spark, spec, df(spark, []))
    assert (res.commit_id, res.inserted, res.row_count) == (2, 0, 1)
    assert TB.changes(spark, spec, 1, 2).count() == 0


def test_month_partitioning_hides_derived_column(spark, scratch):
    spec = TB.TableSpec(scratch("month"), partition_transform="month")
    TB.write(spark, spec, df(spark, [(1, D1, 1.0), (2, dt.date(2024, 1, 20), 2.0)]))
    TB.write(spark, spec, df(spark, [(2, D2, 3.0)]))
    out = TB.read_table(spark, spec)
    assert out.columns == ["transaction_id", "check_in_date", "revenue"]
    assert rows(out) == rows(df(spark, [(1, D1, 1.0), (2, D2, 3.0)]))


def test_table_exists(spark, spec):
    assert not TB.table_exists(spark, spec)
    TB.write(spark, spec, df(spark, [(1, D1, 1.0)]))
    assert TB.table_exists(spark, spec)


def test_describe_and_sample(spark, spec):
    from stayledger.plans import verify as VF
    TB.write(spark, spec, df(spark, [(i, D1, float(i)) for i in range(30, 0, -1)]))
    assert [tuple(r) for r in VF.describe(spark, spec).collect()] == [
        ("transaction_id", "bigint"), ("check_in_date", "date"), ("revenue", "double")]
    got = VF.sample(spark, spec, 5, ["transaction_id"]).collect()
    assert [r.transaction_id for r in got] == [1, 2, 3, 4, 5]


def test_append_new_keys_equals_upsert_of_new_keys(spark, scratch):
    a, b = TB.TableSpec(scratch("a")), TB.TableSpec(scratch("b"))
    base = df(spark, [(1, D1, 1.0), (2, D2, 2.0)])
    new = df(spark, [(3, D1, 3.0), (4, None, 4.0), (None, D2, 5.0)])
    for spec in (a, b):
        TB.write(spark, spec, base)
    ra = TB.append_new_keys(spark, a, new)
    rb = TB.upsert(spark, b, new)
    assert (ra.inserted, ra.updated, ra.row_count) == (rb.inserted, rb.updated, rb.row_count)
    assert rows(TB.read_table(spark, a)) == rows(TB.read_table(spark, b))
    assert rows(TB.changes(spark, a, 1, 2)) == rows(TB.changes(spark, b, 1, 2))


def test_null_keys_never_reach_the_merge_shuffles(spark, spec):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = spark.range(60).select(
            F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("transaction_id"),
            F.lit(D1).alias("check_in_date"), F.col("id").cast("double").alias("revenue"))
        t.write.parquet(spec.path + "-rows")  # a stored key column, as a table has
        t = spark.read.parquet(spec.path + "-rows")
        src = t.where("transaction_id is null or transaction_id % 2 = 0")
        cols = ["transaction_id", "check_in_date", "revenue", TB.SLOT]
        lines = TB._merge_rows(t, src, "transaction_id", cols)._jdf.queryExecution() \
            .executedPlan().toString().split("\n")

        def depth(line):
            return len(line) - len(line.lstrip(" :+-"))
        # a ReusedExchange line names the exchange it reuses, which is checked where it stands
        shuffles = [i for i, line in enumerate(lines)
                    if "Exchange hashpartitioning(transaction_id" in line and "ReusedExchange" not in line]
        assert len(shuffles) >= 3  # both sides of the left join, the target keys of the anti join
        for i in shuffles:
            below = []
            for line in lines[i + 1:]:
                if depth(line) <= depth(lines[i]):
                    break
                below.append(line)
            assert any("isnotnull(transaction_id" in line for line in below), lines[i]
        TB.write(spark, spec, t)
        res = TB.write(spark, spec, src)
        assert res.inserted == 20 and res.updated == 20  # null keys never match
        assert TB.read_table(spark, spec).count() == 80
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_target_key_is_split_across_tasks(spark, spec):
    """A key held by a third of the target rows: every one of them gets its
    before and after image, and the shuffled join splits the hot partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 3000
        tgt = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 1000).alias("transaction_id"),
            F.lit(D1).alias("check_in_date"), F.col("id").cast("double").alias("revenue"))
        src = df(spark, [(7, D2, -1.0), (1001, D1, -2.0), (99999, D1, -3.0)])
        cols = ["transaction_id", "check_in_date", "revenue", TB.SLOT]
        merged = TB._merge_rows(tgt, src, "transaction_id", cols)
        got = merged.groupBy(TB.SLOT).count().collect()
        counts = {r[TB.SLOT]: r["count"] for r in got}
        assert counts == {"kept": n - n // 3 - 1, "before": n // 3 + 1, "update": n // 3 + 1, "insert": 1}
        hot = merged.where((F.col(TB.SLOT) == "update") & (F.col("transaction_id") == 7))
        assert hot.distinct().collect() == [(7, D2, -1.0, "update")]
        assert len(merged.collect()) == n + n // 3 + 2
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_many_commits_read_as_one_scan(spark, spec):
    TB.create_table(spark, spec, df(spark, [(0, D1, 0.0), (100, D2, 0.0)]))
    for i in range(1, 10):
        TB.append_new_keys(spark, spec, df(spark, [(i, D1 if i % 2 else D2, float(i))]))

    def scans(d):
        plan = d._jdf.queryExecution().executedPlan().toString()
        return sum("FileScan" in line and TB.SLOT in line for line in plan.split("\n"))
    state, log = TB.read_table(spark, spec), TB.changes(spark, spec, 2, 9)
    assert scans(state) == 1 and scans(log) == 1
    assert state.count() == 11
    assert sorted((r._commit_snapshot_id, r._change_ordinal, r.transaction_id) for r in log.collect()) == [
        (n, n - 3, n - 1) for n in range(3, 10)]
    # the changelog reads the range's folders only
    assert log.select(F.input_file_name()).distinct().count() == 7
    one = TB.commits(spark, spec).where("commit_id = 10").first()
    assert one.row_count == 11 and one.inserted == 1


def test_empty_string_and_null_partitions_stay_apart(spark, scratch):
    spec = TB.TableSpec(scratch("purpose"), key="k", partition_column="p")
    data = [(1, ""), (2, ""), (3, None), (4, "a"), (5, "n"), (6, "a=b/c"), (7, " ")]
    TB.create_table(spark, spec, spark.createDataFrame(data, "k bigint, p string"))
    assert rows(TB.read_table(spark, spec)) == sorted(data, key=repr)
    res = TB.upsert(spark, spec, spark.createDataFrame([(1, None), (3, ""), (8, "")], "k bigint, p string"))
    assert (res.inserted, res.updated) == (1, 2)
    want = [(1, None), (2, ""), (3, ""), (4, "a"), (5, "n"), (6, "a=b/c"), (7, " "), (8, "")]
    assert rows(TB.read_table(spark, spec)) == sorted(want, key=repr)
    before = TB.changes(spark, spec, 1, 2).where("_change_type = 'UPDATE_BEFORE'").select("k", "p")
    assert rows(before) == sorted([(1, ""), (3, None)], key=repr)


def test_upsert_aggregates_a_hot_target_key_before_the_shuffle(spark, scratch, monkeypatch):
    """A key held by a third of the target: the job that finds the matched keys
    aggregates it in the map tasks, so the shuffle sees one row per task."""
    spec = TB.TableSpec(scratch("hot"))
    n = 3000
    t = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 1000).alias("transaction_id"),
        F.lit(D1).alias("check_in_date"), F.col("id").cast("double").alias("revenue"))
    TB.create_table(spark, spec, t)
    from pyspark.sql import DataFrameWriter
    plans, write = [], DataFrameWriter.parquet

    def spy(self, path, *a, **k):
        if path.endswith("-keys"):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    res = TB.upsert(spark, spec, df(spark, [(7, D2, -1.0), (99999, D1, -3.0)]))
    assert (res.inserted, res.updated) == (1, n // 3)
    (plan,) = plans
    lines = plan.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(transaction_id" in line]
    assert shuffles
    for i in shuffles:  # right below every shuffle of keys stands an aggregate
        below = next(line for line in lines[i + 1:] if depth(line) > depth(lines[i]))
        assert "Aggregate" in below, (lines[i], below)
    assert any("partial_count" in line for line in lines)


def test_latest_commit_skips_a_half_written_commit_folder(spark, spec):
    import os
    TB.create_table(spark, spec, df(spark, [(1, D1, 1.0)]))
    TB.upsert(spark, spec, df(spark, [(2, D1, 2.0)]))
    # what a failed commit-row write leaves: the folder with only temporary files
    os.makedirs(TB._commit_dir(spec, 3).replace("file:", "") + "/_temporary/0", exist_ok=True)
    assert TB._listed_ids(spark, spec) == [1, 2, 3]
    assert TB._latest(spark, spec).commit_id == 2
    assert [r.commit_id for r in TB.commits(spark, spec).orderBy("commit_id").collect()] == [1, 2]
    res = TB.upsert(spark, spec, df(spark, [(3, D2, 3.0)]))  # the retry takes the folder over
    assert res.commit_id == 3 and TB._latest(spark, spec).commit_id == 3
    assert rows(TB.read_table(spark, spec)) == rows(df(spark, [(1, D1, 1.0), (2, D1, 2.0), (3, D2, 3.0)]))


def test_key_where_gives_the_same_commit(spark, scratch):
    base = [(k, D1 if k % 3 else D2, float(k)) for k in range(1, 21)] + [(None, D1, 0.0), (4, D2, 40.0)]
    src = [(k, D2, -float(k)) for k in (2, 4, 6, 30)] + [(None, D2, -1.0)]
    a, b = TB.TableSpec(scratch("kw")), TB.TableSpec(scratch("kw"))
    for spec in (a, b):
        TB.create_table(spark, spec, df(spark, base))
    ra = TB.upsert(spark, a, df(spark, src))
    rb = TB.upsert(spark, b, df(spark, src), key_where=F.pmod(F.col("transaction_id"), F.lit(2)) == 0)
    assert (ra.inserted, ra.updated, ra.row_count) == (rb.inserted, rb.updated, rb.row_count) == (2, 4, 24)
    assert rows(TB.read_table(spark, a)) == rows(TB.read_table(spark, b))
    assert rows(TB.changes(spark, a, 1, 2)) == rows(TB.changes(spark, b, 1, 2))


def test_hot_new_source_key_is_split_across_tasks(spark, spec):
    """A new key held by a third of the source rows (all inserts): with the
    matched keys and update rows stored, as ``upsert`` stages them, the anti
    join keeps the source on its left side and splits the hot partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 3000
        tgt = spark.range(n).select((F.col("id") + 1000).alias("transaction_id"),
                                    F.lit(D1).alias("check_in_date"),
                                    F.col("id").cast("double").alias("revenue"))
        src = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 10_000).alias("transaction_id"),
            F.lit(D2).alias("check_in_date"), F.col("id").cast("double").alias("revenue"))
        src = src.unionByName(df(spark, [(1001, D2, -1.0)]))  # one update
        src.write.parquet(spec.path + "-src")
        src = spark.read.parquet(spec.path + "-src")
        spark.createDataFrame([(1001,)], "transaction_id bigint").write.parquet(spec.path + "-keys")
        src.where("transaction_id = 1001").write.parquet(spec.path + "-upd")
        cols = ["transaction_id", "check_in_date", "revenue", TB.SLOT]
        merged = TB._merge_rows(tgt, src, "transaction_id", cols, None,
                                spark.read.parquet(spec.path + "-keys"), spark.read.parquet(spec.path + "-upd"))
        got = merged.collect()
        slots = {}
        for r in got:
            slots[r[TB.SLOT]] = slots.get(r[TB.SLOT], 0) + 1
        assert slots == {"kept": n - 1, "before": 1, "update": 1, "insert": n}
        assert sum(1 for r in got if r.transaction_id == 7) == n // 3
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
