"""Normal run (X2): checks gate the commit, on the first run and on later ones."""

import pytest
from pyspark.sql import functions as F

from stayledger.errors import DataQualityError
from stayledger.operators import table as TB
from stayledger.plans.normal_run import normal_run
from stayledger.queries import bookings, run_config
from stayledger.sources import fixtures as FX
from stayledger.sources.bookings import write_bookings

SMALL = "/root/testdata/sf0.001"


def landed(spark, scratch, damaged=False):
    """Bookings as JSON lines; ``damaged`` adds a second copy of some bookings
    (duplicate keys). NaN is left out: written to JSON it becomes a string,
    which the structure check already rejects."""
    path = scratch("landing")
    raw = FX.raw_bookings(spark, SMALL)
    if damaged:
        raw = raw.unionByName(raw.where(F.col("accommodations.reservation") % 23 == 0))
    write_bookings(raw, path)
    return path


def same_rows(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_failed_checks_commit_nothing_then_a_good_run_creates(spark, scratch):
    spec = TB.TableSpec(scratch("run"), partition_transform="month")
    bad, good = landed(spark, scratch, damaged=True), landed(spark, scratch)
    with pytest.raises(DataQualityError, match="duplicate"):
        normal_run(spark, bad, spec, run_config(spark))
    assert not TB.table_exists(spark, spec)
    res = normal_run(spark, good, spec, run_config(spark))
    assert res.commit_id == 1 and res.operation == "create"
    assert same_rows(TB.read_table(spark, spec), bookings(spark, SMALL))


def test_later_run_with_bad_rows_leaves_the_table_as_it_was(spark, scratch):
    spec = TB.TableSpec(scratch("run"), partition_transform="month")
    good, bad = landed(spark, scratch), landed(spark, scratch, damaged=True)
    normal_run(spark, good, spec, run_config(spark))
    with pytest.raises(DataQualityError):
        normal_run(spark, bad, spec, run_config(spark))
    assert TB.commits(spark, spec).count() == 1
    res = normal_run(spark, good, spec, run_config(spark))  # run twice = same state
    exp = bookings(spark, SMALL)
    assert res.commit_id == 2 and res.inserted == 0 and res.updated == exp.count()
    assert same_rows(TB.read_table(spark, spec), exp)
    assert TB.changes(spark, spec, 1, 2).where(F.col("_change_type") == "INSERT").isEmpty()


def test_staging_is_removed_after_commits(spark, scratch):
    from stayledger.errors import MergeCardinalityError
    from stayledger.operators import copy as CP
    from stayledger.plans import migration as MG
    from stayledger.session import list_dirs
    spec = TB.TableSpec(scratch("run"), partition_transform="month")
    good = landed(spark, scratch)
    normal_run(spark, good, spec, run_config(spark))
    normal_run(spark, good, spec, run_config(spark))  # later run: staged, merged, unstaged
    b = bookings(spark, SMALL)
    TB.upsert(spark, spec, b.where(F.col("transaction_id") % 7 == 0))  # stage_source=True
    with pytest.raises(MergeCardinalityError):
        TB.upsert(spark, spec, b.unionByName(b))
    mig = TB.TableSpec(scratch("mig"), partition_transform="month")
    MG.batch_migration(spark, FX.raw_bookings(spark, SMALL), mig, run_config(spark),
                       CP.ParquetTarget(scratch("c")), scratch("a"))
    assert list_dirs(spark, f"{spec.path}/_staging") == []
    assert list_dirs(spark, f"{mig.path}/_staging") == []
    assert same_rows(TB.read_table(spark, spec), b)
