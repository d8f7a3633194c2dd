"""Schema validation, fault scenarios, scoring requests."""

import pytest
from pyspark.sql import functions as F

from modelwatch.operators import checks
from modelwatch.operators.checks import validate, verdict
from modelwatch.plans.prepare import clean_customers
from modelwatch.schema import CUSTOMER_SPEC, REQUEST_SPEC
from tests.customers import COLUMNS, customer, landed


def failed(df, spec=CUSTOMER_SPEC):
    return {(r["key"], r["column"], r["check"]) for r in validate(df, spec).collect()}


def test_clean_batch_passes(spark):
    df = landed(spark, [customer(i) for i in range(100)])
    assert failed(df) == set()
    assert verdict(df, CUSTOMER_SPEC).first()["verdict"] == "PASS"


def test_six_corruptions_are_all_reported(spark):
    rows = [
        customer(0, tenure="-5"),
        customer(1, Contract="Lifetime"),
        customer(2, Churn="Maybe"),
        customer(3, MonthlyCharges="One Hundred"),
        *[customer(i) for i in range(4, 20)],
    ]
    columns = [c for c in COLUMNS if c != "gender"] + ["unexpected_column"]
    df = landed(spark, rows, columns)
    assert failed(df) == {
        ("0000-ABCDE", "tenure", "ge(0)"),
        ("0001-ABCDE", "Contract", "isin"),
        ("0002-ABCDE", "Churn", "isin"),
        ("0003-ABCDE", "MonthlyCharges", "dtype(float)"),
        (None, "gender", "column_in_dataframe"),
        (None, "unexpected_column", "column_in_schema"),
    }
    row = verdict(df, CUSTOMER_SPEC).first()
    assert (row["verdict"], row["failures"], row["column_failures"]) == ("FAIL", 4, 2)


@pytest.mark.parametrize(
    "value, ok", [(" ", True), ("", True), (None, True), ("12.5", True), (" 12.5 ", True), ("1e3", True), ("x", False), ("1.0d", False)]
)
def test_total_charges_blank_null_or_numeric(spark, value, ok):
    found = failed(landed(spark, [customer(1, TotalCharges=value)]))
    assert (found == set()) is ok


def test_missing_value_fails_only_the_null_check(spark):
    assert failed(landed(spark, [customer(1, tenure=None)])) == {("0001-ABCDE", "tenure", "not_nullable")}


def test_whole_number_charge_is_fine(spark):
    assert failed(landed(spark, [customer(1, MonthlyCharges="70")])) == set()


def test_invalid_number_and_dropped_column_scenarios(spark):
    assert failed(landed(spark, [customer(1, MonthlyCharges="INVALID_NUMBER")]))
    assert (None, "Contract", "column_in_dataframe") in failed(
        landed(spark, [customer(1)], [c for c in COLUMNS if c != "Contract"])
    )


def test_checks_work_on_typed_columns(spark):
    df = clean_customers(landed(spark, [customer(i) for i in range(30)])).drop("Churn")
    assert failed(df, CUSTOMER_SPEC.without("Churn")) == set()
    worse = df.withColumn("tenure", F.lit(-1))
    assert len(failed(worse, CUSTOMER_SPEC.without("Churn"))) == 30


def request(spark, *rows):
    columns = [c for c in COLUMNS if c != "Churn"]
    return landed(spark, [dict(r, TotalCharges=r["TotalCharges"] or None) for r in rows], columns)


@pytest.mark.parametrize(
    "changes, fields",
    [
        ({}, set()),
        ({"gender": "ABC"}, {"gender"}),
        ({"gender": None}, {"gender"}),
        ({"tenure": "-5"}, {"tenure"}),
        ({"tenure": "ten"}, {"tenure"}),
        ({"MonthlyCharges": None}, {"MonthlyCharges"}),
        ({"TotalCharges": None}, {"TotalCharges"}),
        ({"tenure": "-1000000", "MonthlyCharges": "-999999"}, {"tenure", "MonthlyCharges"}),
        ({"tenure": "100", "MonthlyCharges": "10000.0", "TotalCharges": "1000000.0"}, set()),
        ({"TotalCharges": "any text"}, set()),
    ],
)
def test_request_errors(spark, changes, fields):
    checked = checks.with_errors(request(spark, customer(1, **changes)), REQUEST_SPEC).first()
    assert {e["field"] for e in checked["errors"]} == fields


def test_batch_is_all_or_nothing_with_field_paths(spark):
    rows = [
        dict(customer(1, gender="ABC"), batch="a", i="0"),
        dict(customer(2, tenure="-5"), batch="a", i="1"),
        dict(customer(3), batch="b", i="0"),
        dict(customer(4), batch="b", i="1"),
    ]
    columns = [c for c in COLUMNS if c != "Churn"] + ["batch", "i"]
    df = landed(spark, rows, columns)
    errors = {(r["batch"], r["field"]) for r in checks.batch_errors(df, REQUEST_SPEC, "batch", "i").collect()}
    assert errors == {("a", "customers.0.gender"), ("a", "customers.1.tenure")}
    announced = spark.createDataFrame([("a",), ("b",), ("empty",)], "batch string")
    verdicts = checks.batch_verdicts(announced, df, REQUEST_SPEC, "batch", "i").collect()
    assert {r["batch"]: r["status"] for r in verdicts} == {"a": "rejected", "b": "accepted", "empty": "rejected"}
    accepted = checks.accepted_records(df, REQUEST_SPEC, "batch", "i").collect()
    assert {r["customerID"] for r in accepted} == {"0003-ABCDE", "0004-ABCDE"}


def test_missing_field_is_required(spark):
    df = request(spark, customer(1)).drop("MonthlyCharges")
    assert [e["field"] for e in checks.with_errors(df, REQUEST_SPEC).first()["errors"]] == ["MonthlyCharges"]


def test_same_schema(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    assert checks.same_schema(a, b) == []
    assert checks.same_schema(a, b, same_rows=True) == ["row counts differ"]
    assert checks.same_schema(a, b.select("b", "a"))


def test_encoded_check_finds_missing_values_and_widths(spark):
    good = spark.createDataFrame([([1.0, 2.0], 1), ([0.0, 1.0], 0)], "x array<double>, y int")
    nan = spark.createDataFrame([([1.0, float("nan")], 1), ([None, 1.0], 0)], "x array<double>, y int")
    wide = spark.createDataFrame([([1.0, 2.0, 3.0], None)], "x array<double>, y int")
    assert checks.check_encoded(good, good, "x", "y").first()["validation_status"] == "PASSED"
    row = checks.check_encoded(nan, wide, "x", "y").first()
    assert row["train_missing"] == 2 and row["test_unlabelled"] == 1
    assert row["errors"] == "missing values in train features; feature widths differ; test rows without label"
    assert row["validation_status"] == "FAILED"


def test_require_schema_names_the_failure(spark):
    with pytest.raises(ValueError, match="Contract: isin 'Lifetime'"):
        checks.require_schema(landed(spark, [customer(1, Contract="Lifetime")]), CUSTOMER_SPEC)


def test_broken_record_without_batch_is_rejected(spark):
    rows = [dict(customer(1, tenure="-5"), i="0"), dict(customer(2), i="1"), dict(customer(3), batch="a", i="0")]
    columns = [c for c in COLUMNS if c != "Churn"] + ["batch", "i"]
    df = landed(spark, [{"batch": "", **r} for r in rows], columns).withColumn("batch", F.nullif("batch", F.lit("")))
    assert [r["customerID"] for r in checks.accepted_records(df, REQUEST_SPEC, "batch", "i").collect()] == ["0003-ABCDE"]
