"""Rates by currency: the lookup, the join, the fifth value check, the normal run."""

import math

import pytest
from pyspark.sql import functions as F

from stayledger.errors import DataExtractionError, DataQualityError
from stayledger.operators import quality as Q
from stayledger.operators import table as TB
from stayledger.operators import transform as X
from stayledger.plans.normal_run import RunConfig, run_on_raw
from stayledger.sources import fixtures as FX
from stayledger.sources import lookups as LK

ROWS = [("EUR", 10.0), ("USD", 10.0), ("CHF", 10.0), ("eur", 10.0), (None, 10.0), ("EUR", None), ("GBP", math.nan), ("EUR", 1.005)]


def amounts(spark):
    return spark.createDataFrame([(i, c, r) for i, (c, r) in enumerate(ROWS)], "id int, currency string, revenue double")


def dollars(df, rates):
    return [r.revenue_usd for r in X.add_revenue_usd(df, rates).orderBy("id").collect()]


def test_each_row_has_the_rate_of_its_currency(spark):
    rates = LK.rate_lookup(spark, {"EUR": 2, "USD": 1.0, "GBP": 1.5})
    got = dollars(amounts(spark), rates)
    assert got[:6] == [20.0, 10.0, None, None, None, None] and math.isnan(got[6]) and got[7] == 2.01
    out = X.add_revenue_usd(amounts(spark), rates)
    assert out.columns == ["id", "currency", "revenue", "revenue_usd"] and out.count() == len(ROWS)


def test_one_rate_stays_the_default(spark):
    assert dollars(amounts(spark), 2.0)[:6] == [20.0, 20.0, 20.0, 20.0, 20.0, None]


def test_rates_from_a_frame_must_be_unique(spark):
    twice = spark.createDataFrame([("EUR", 1.0), ("EUR", 2.0), ("USD", 1.0)], "currency string, usd_rate double")
    with pytest.raises(Exception, match="repeated lookup key"):
        dollars(amounts(spark), twice)
    assert dollars(amounts(spark), twice.where("usd_rate < 2"))[:2] == [10.0, 10.0]


def test_clashing_columns_and_empty_rates(spark):
    df = amounts(spark).withColumn("usd_rate", F.lit(7.0))
    out = X.add_revenue_usd(df, LK.rate_lookup(spark, {"EUR": 3.0}))
    assert "usd_rate" in out.columns and out.where("id = 0").first().revenue_usd == 30.0
    assert set(dollars(amounts(spark), LK.rate_lookup(spark, {}))) == {None}


@pytest.mark.parametrize("rate", [0, -1.0, math.nan, math.inf, "1.1", None])
def test_bad_rates_raise(spark, rate):
    with pytest.raises(DataExtractionError, match="EUR"):
        LK.rate_lookup(spark, {"EUR": rate})


def test_rates_from_a_file(spark, tmp_path):
    path = tmp_path / "rates.json"
    path.write_text('{"EUR": 1.0837, "USD": 1, "JPY": 0.0067}')
    assert dict(map(tuple, LK.rate_lookup_from_file(spark, str(path)).collect())) == {"EUR": 1.0837, "USD": 1.0, "JPY": 0.0067}
    for bad in ('{"EUR": 0}', '{"EUR": "x"}', '{"EUR": null}', '{"EUR": 1, "EUR": 2}', '{"EUR": 1', "", "[1]", '{"EUR": "NaN"}'):
        path.write_text(bad)
        with pytest.raises(DataExtractionError):
            LK.rate_lookup_from_file(spark, str(path)).collect()


def test_missing_rates_are_the_fifth_check(spark):
    df = X.add_revenue_usd(amounts(spark), LK.rate_lookup(spark, {"EUR": 2.0, "USD": 1.0, "GBP": 1.5}))
    df = df.withColumnRenamed("id", "transaction_id")
    assert [r.transaction_id for r in Q.missing_rate_rows(df).orderBy("transaction_id").collect()] == [2, 3, 4]
    report = {r.check_name: (r.check_order, r.bad_count) for r in Q.quality_report(df, rates=True).collect()}
    assert report["missing_rate"] == (5, 3) and report["invalid_currency"] == (3, 1) and report["missing_revenue"] == (4, 2)
    assert "missing_rate" not in {r.check_name for r in Q.quality_report(df).collect()}


def test_normal_run_by_currency(spark, scratch):
    raw = FX.raw_bookings(spark, "/root/testdata/sf0.001")
    status, region = LK.status_lookup(spark), LK.region_lookup(spark, FX.FIXTURE_REGIONS)
    strict = RunConfig(LK.rate_lookup(spark, FX.USD_RATES), status, region)
    spec = TB.TableSpec(scratch("rates"), partition_transform="year")
    with pytest.raises(DataQualityError, match="has no rate"):
        run_on_raw(spark, raw, spec, strict)
    assert not TB.table_exists(spark, spec)
    run_on_raw(spark, raw, spec, RunConfig(strict.usd_rate, status, region, allow_missing_rates=True))
    got = TB.read_table(spark, spec)
    assert got.where("(revenue_usd is null) <> (currency = 'CHF')").count() == 0
    assert got.where("currency = 'USD' and revenue_usd <> round(revenue, 2)").count() == 0
    full = RunConfig(LK.rate_lookup(spark, FX.USD_RATES | {"CHF": 1.12}), status, region)
    run_on_raw(spark, raw, spec, full)
    assert TB.read_table(spark, spec).where("revenue_usd is null").count() == 0
