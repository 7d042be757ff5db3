"""Schema report (V1), value report (V2) and their exceptions."""

import pytest
from pyspark.sql import functions as F

from stayledger.errors import DataQualityError, SchemaValidationError
from stayledger.operators import quality as Q
from stayledger.sources import fixtures as FX
from stayledger.sources.bookings import read_bookings

GOOD = ('{"id": "1", "accommodations": {"reservation": 1}, "accommodation_details": '
        '{"accommodation": 2}, "booker": {"address": {"country": "de"}, "travel_purpose": "x"}, '
        '"commission": {"estimate_commission_amount": {"booker_currency": 1.5}}, '
        '"currencies": {"booker": "EUR"}, "start": "2024-01-01", "end": "2024-01-02", '
        '"label": "k-a", "price": {"total": 3.0}, "status": "S"}')


def scan(spark, tmp_path, lines):
    p = tmp_path / "in.jsonl"
    p.write_text("\n".join(lines) + "\n")
    return read_bookings(spark, str(p))


def test_good_input_passes(spark, tmp_path):
    df = scan(spark, tmp_path, [GOOD, "", GOOD.replace('"1"', '"2"')])
    assert df.count() == 2  # blank lines vanish
    Q.validate_schema(df)
    assert all(r.passed for r in Q.schema_report(df).collect())


def test_missing_and_renamed_columns(spark, tmp_path):
    df = scan(spark, tmp_path, [GOOD.replace('"id"', '"ID"').replace('"label": "k-a", ', "")])
    with pytest.raises(SchemaValidationError) as e:
        Q.validate_schema(df)
    assert (e.value.check, e.value.columns, e.value.count) == ("column_present", ("id", "label"), 2)


def test_integer_revenue_is_rejected(spark, tmp_path):
    df = scan(spark, tmp_path, [GOOD.replace("1.5", "2")])
    with pytest.raises(SchemaValidationError, match="is long, not double") as e:
        Q.validate_schema(df)
    assert e.value.check == "revenue_type"


def test_array_for_struct_is_rejected(spark, tmp_path):
    df = scan(spark, tmp_path, [GOOD.replace('"accommodations": {"reservation": 1}',
                                             '"accommodations": [{"reservation": 1}]')])
    with pytest.raises(SchemaValidationError, match="accommodations is array, not struct") as e:
        Q.validate_schema(df)
    assert (e.value.check, e.value.columns) == ("column_type", ("accommodations",))


def test_empty_input(spark):
    df = spark.createDataFrame([], "id string")
    with pytest.raises(SchemaValidationError, match="not_empty"):
        Q.validate_schema(df)


def test_bad_line_reaches_missing_revenue(spark, tmp_path):
    df = scan(spark, tmp_path, [GOOD, "{not json"])
    assert "_corrupt_record" in df.columns
    Q.validate_schema(df)  # structure is fine; the bad row has null leaves


def _rows(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, revenue double, revenue_usd double, "
                                       "currency string")


def test_duplicates_count_keys_and_null_is_one_group(spark):
    df = _rows(spark, [(None, 1.0, 1.0, "EUR"), (None, 1.0, 1.0, "EUR"), ("a", 1.0, 1.0, "EUR"),
                       ("a", 1.0, 1.0, "EUR"), ("a", 1.0, 1.0, "EUR"), ("b", 1.0, 1.0, "EUR")])
    rep = {r.check_name: r.bad_count for r in Q.quality_report(df).collect()}
    assert rep == {"duplicate_keys": 2, "negative_revenue": 0, "invalid_currency": 0,
                   "missing_revenue": 0}
    with pytest.raises(DataQualityError, match="duplicate_keys: 2"):
        Q.validate_quality(df)


def test_checks_in_order(spark):
    df = _rows(spark, [("1", float("nan"), float("nan"), "EUR"), ("2", -1.0, 1.0, "eur"),
                       ("3", None, None, None), ("4", float("inf"), float("inf"), "USD")])
    rep = {r.check_name: r.bad_count for r in Q.quality_report(df).collect()}
    assert rep == {"duplicate_keys": 0, "negative_revenue": 1, "invalid_currency": 1,
                   "missing_revenue": 2}
    with pytest.raises(DataQualityError, match="negative_revenue: 1"):
        Q.validate_quality(df)
    with pytest.raises(DataQualityError, match="invalid_currency"):
        Q.validate_quality(df.where(F.col("transaction_id") != "2").unionByName(
            _rows(spark, [("5", 1.0, 1.0, "EURO")])))
    with pytest.raises(DataQualityError, match="missing_revenue"):
        Q.validate_quality(df.where(F.col("transaction_id").isin("1", "4")))


def test_report_equals_separate_counts(spark):
    df = FX.nest(FX.damage(FX.flat_bookings(
        spark.read.parquet("/root/testdata/sf0.001/orders.parquet"),
        spark.read.parquet("/root/testdata/sf0.001/customer.parquet"))))
    from stayledger.queries import run_config
    from stayledger.operators.transform import transform
    cfg = run_config(spark)
    b = transform(df, cfg.usd_rate, cfg.status_lookup, cfg.region_lookup)
    rep = {r.check_name: r.bad_count for r in Q.quality_report(b).collect()}
    assert rep["duplicate_keys"] == Q.duplicate_keys(b).count()
    assert rep["negative_revenue"] == Q.negative_revenue_rows(b).count()
    assert rep["invalid_currency"] == Q.invalid_currency_rows(b).count()
    assert rep["missing_revenue"] == Q.missing_revenue_rows(b).count()
    assert all(v > 0 for v in rep.values())


def test_top_level_array_line_gives_several_rows(spark, tmp_path):
    df = scan(spark, tmp_path, [GOOD, "[" + GOOD.replace('"1"', '"2"') + ", " + GOOD.replace('"1"', '"3"') + "]"])
    assert sorted(r.id for r in df.select("id").collect()) == ["1", "2", "3"]


def test_empty_file_has_an_empty_schema(spark, tmp_path):
    p = tmp_path / "empty.jsonl"
    p.write_text("")
    df = read_bookings(spark, str(p))
    assert df.columns == []
    with pytest.raises(SchemaValidationError, match="not_empty"):
        Q.validate_schema(df)


def test_extra_raw_region_column_is_allowed(spark, tmp_path):
    df = scan(spark, tmp_path, [GOOD[:-1] + ', "region": "x"}'])
    Q.validate_schema(df)
    from stayledger.queries import run_config
    from stayledger.operators.transform import transform
    cfg = run_config(spark)
    out = transform(df, cfg.usd_rate, cfg.status_lookup, cfg.region_lookup).collect()[0]
    assert out.region == "Europe" and out.status == "approved"


def test_report_without_probe_for_fully_inferred_input(spark, tmp_path):
    df = scan(spark, tmp_path, [GOOD, GOOD.replace('"1"', '"2"')])
    key = lambda r: (r.check_order, r.column_name or "")
    assert sorted(Q.schema_report(df, True).collect(), key=key) == \
        sorted(Q.schema_report(df).collect(), key=key)
    Q.validate_schema(df, inferred_from_all_lines=True)


def test_empty_schema_still_probes(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "b").mkdir()
    empty = scan(spark, tmp_path / "e", [""])
    with pytest.raises(SchemaValidationError, match="not_empty"):
        Q.validate_schema(empty, inferred_from_all_lines=True)
    only_braces = scan(spark, tmp_path / "b", ["{}", "{}"])
    if only_braces.columns == [] and not only_braces.isEmpty():
        with pytest.raises(SchemaValidationError, match="column_present"):
            Q.validate_schema(only_braces, inferred_from_all_lines=True)
