"""Scheduled run as a stream: each start commits only newly landed files."""

import pytest
from pyspark.sql import functions as F

from stayledger.errors import DataExtractionError, DataQualityError
from stayledger.operators import table as TB
from stayledger.plans.normal_run import normal_run
from stayledger.queries import bookings, run_config
from stayledger.sources import fixtures as FX
from stayledger.sources.bookings import BOOKING_SCHEMA
from stayledger.streaming.ingest import run_ingest_once

SMALL = "/root/testdata/sf0.001"


def test_ingest_picks_up_new_files_only(spark, scratch):
    landing, ckpt = scratch("landing"), scratch("ckpt")
    spec = TB.TableSpec(scratch("stream"), partition_transform="month")
    raw = FX.raw_bookings(spark, SMALL)
    key = F.col("accommodations.reservation")
    raw.where(key % 2 == 0).write.json(f"{landing}/day=1")
    run_ingest_once(spark, landing, BOOKING_SCHEMA, spec, run_config(spark), ckpt)
    first = TB.read_table(spark, spec).count()
    raw.where(key % 2 == 1).write.json(f"{landing}/day=2")
    run_ingest_once(spark, landing, BOOKING_SCHEMA, spec, run_config(spark), ckpt)
    state = TB.read_table(spark, spec)
    exp = bookings(spark, SMALL)
    assert first == exp.where(F.col("transaction_id") % 2 == 0).count()
    assert state.count() == exp.count() and state.exceptAll(exp).count() == 0
    run_ingest_once(spark, landing, BOOKING_SCHEMA, spec, run_config(spark), ckpt)  # nothing new
    assert TB.commits(spark, spec).count() == 2


def test_replayed_micro_batch_commits_once(spark, scratch):
    from stayledger.streaming.ingest import batch_committer
    spec = TB.TableSpec(scratch("stream"), partition_transform="month")
    commit = batch_committer(spec, run_config(spark), scratch("ckpt"))
    raw = FX.raw_bookings(spark, SMALL)
    key = F.col("accommodations.reservation")
    commit(raw.where(key % 2 == 0), 0)
    commit(raw.where(key % 2 == 0), 0)  # handed over again after a restart
    commit(raw.where(key % 2 == 1), 1)
    log = TB.commits(spark, spec).orderBy("commit_id").collect()
    assert [r.commit_id for r in log] == [1, 2]
    assert [r.txn.rsplit("#", 1)[1] for r in log] == ["0", "1"]
    exp = bookings(spark, SMALL)
    assert TB.read_table(spark, spec).exceptAll(exp).count() == 0
    assert TB.read_table(spark, spec).count() == exp.count()


def test_write_with_a_committed_txn_is_skipped(spark, scratch):
    spec = TB.TableSpec(scratch("txn"))
    rows = spark.createDataFrame([(1, None, 1.0)], "transaction_id bigint, check_in_date date, revenue double")
    a = TB.write(spark, spec, rows, txn="job#1")
    b = TB.write(spark, spec, rows.selectExpr("transaction_id", "check_in_date", "revenue + 1 AS revenue"),
                 txn="job#1")
    assert a == b and TB.commits(spark, spec).count() == 1
    assert TB.read_table(spark, spec).collect()[0].revenue == 1.0
    assert TB.committed(spark, spec, "job#2") is None


def six_files(spark, path):
    """Six one-line files; the first and the last hold the same booking."""
    raw = FX.raw_bookings(spark, SMALL).limit(5).collect()
    schema = FX.raw_bookings(spark, SMALL).schema
    for i, row in enumerate([*raw, raw[0]]):
        spark.createDataFrame([row], schema).coalesce(1).write.json(f"{path}/day={i}")


def test_a_key_repeated_across_files_raises_in_both_runs(spark, scratch):
    landing = scratch("landing")
    six_files(spark, landing)
    files = f"{landing}/*"
    with pytest.raises(DataQualityError, match="duplicate_keys: 1"):
        normal_run(spark, files, TB.TableSpec(scratch("run")), run_config(spark))
    spec = TB.TableSpec(scratch("stream"))
    with pytest.raises(Exception, match="duplicate_keys: 1"):
        run_ingest_once(spark, landing, BOOKING_SCHEMA, spec, run_config(spark), scratch("ckpt"))
    assert not TB.table_exists(spark, spec)


@pytest.mark.parametrize("old, new", [('"reservation":1', '"reservation":"A12"'), ('"accommodation":2', '"accommodation":"77"'),
                                      ('{"id"', '{"id')])
def test_a_record_that_does_not_fit_the_declared_form_raises(spark, scratch, tmp_path, old, new):
    good = ('{"id":"1","accommodations":{"reservation":1},"accommodation_details":{"accommodation":2},'
            '"booker":{"address":{"country":"de"},"travel_purpose":"x"},'
            '"commission":{"estimate_commission_amount":{"booker_currency":1.5}},"currencies":{"booker":"EUR"},'
            '"start":"2024-01-01","end":"2024-01-02","label":"k-a","price":{"total":3.0},"status":"S"}')
    assert old in good
    (tmp_path / "in.jsonl").write_text(good.replace('"reservation":1', '"reservation":9') + "\n" + good.replace(old, new) + "\n")
    spec = TB.TableSpec(scratch("declared"))
    with pytest.raises(DataExtractionError, match="declared form"):
        normal_run(spark, str(tmp_path), spec, run_config(spark), schema=BOOKING_SCHEMA)
    with pytest.raises(Exception, match="declared form"):
        run_ingest_once(spark, str(tmp_path), BOOKING_SCHEMA, spec, run_config(spark), scratch("ckpt"))
    assert not TB.table_exists(spark, spec)
    (tmp_path / "in.jsonl").write_text(good + "\n")
    assert normal_run(spark, str(tmp_path), spec, run_config(spark), schema=BOOKING_SCHEMA).row_count == 1
