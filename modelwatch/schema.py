"""Declared table schemas: column rules, the customer table, log, lineage, registry."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnRule:
    """What one column must satisfy. ``kind``: string, int, float or numeric_text."""

    name: str
    kind: str = "string"
    allowed: tuple = ()
    lo: float | None = None
    hi: float | None = None
    nullable: bool = False


@dataclass(frozen=True)
class TableSpec:
    """A strict table: these columns, no others."""

    name: str
    key: str
    rules: tuple[ColumnRule, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [rule.name for rule in self.rules]

    def without(self, *names: str) -> "TableSpec":
        return TableSpec(self.name, self.key, tuple(r for r in self.rules if r.name not in names))

    def landing_schema(self) -> T.StructType:
        """Everything lands as text; typing is a check, not an inference."""
        fields = [T.StructField(c, T.StringType()) for c in self.columns]
        return T.StructType(fields + [T.StructField("_corrupt_record", T.StringType())])


# The closed domains of the customer table.
YES_NO = ("Yes", "No")
WITH_PHONE = ("Yes", "No", "No phone service")
WITH_INTERNET = ("Yes", "No", "No internet service")
CONTRACTS = ("Month-to-month", "One year", "Two year")
INTERNET = ("DSL", "Fiber optic", "No")
PAYMENTS = ("Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)")
INTERNET_ADDONS = (
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
)
SERVICE_COLUMNS = ("PhoneService", "MultipleLines", "InternetService") + INTERNET_ADDONS
INACTIVE_SERVICE = ("No", "No internet service", "No phone service")
TENURE_EDGES = (12, 24, 48)
TENURE_LABELS = ("0-1yr", "1-2yr", "2-4yr", "4yr+")

CUSTOMER_SPEC = TableSpec(
    name="customer_raw",
    key="customerID",
    rules=(
        ColumnRule("customerID"),
        ColumnRule("gender", allowed=("Male", "Female")),
        ColumnRule("SeniorCitizen", "int", allowed=(0, 1)),
        ColumnRule("Partner", allowed=YES_NO),
        ColumnRule("Dependents", allowed=YES_NO),
        ColumnRule("tenure", "int", lo=0),
        ColumnRule("PhoneService", allowed=YES_NO),
        ColumnRule("MultipleLines", allowed=WITH_PHONE),
        ColumnRule("InternetService", allowed=INTERNET),
        *(ColumnRule(c, allowed=WITH_INTERNET) for c in INTERNET_ADDONS),
        ColumnRule("Contract", allowed=CONTRACTS),
        ColumnRule("PaperlessBilling", allowed=YES_NO),
        ColumnRule("PaymentMethod", allowed=PAYMENTS),
        ColumnRule("MonthlyCharges", "float", lo=0),
        ColumnRule("TotalCharges", "numeric_text", nullable=True),
        ColumnRule("Churn", allowed=YES_NO),
    ),
)

# A scoring request: no label, and TotalCharges is any text that is present.
REQUEST_SPEC = TableSpec(
    name="request",
    key="customerID",
    rules=tuple(
        ColumnRule("TotalCharges") if rule.name == "TotalCharges" else rule
        for rule in CUSTOMER_SPEC.rules
        if rule.name != "Churn"
    ),
)

NUMERIC_FEATURES = ("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges")
CATEGORICAL_FEATURES = tuple(
    r.name for r in CUSTOMER_SPEC.rules if r.name not in NUMERIC_FEATURES + ("customerID", "Churn")
)

CLEAN_TYPES = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double", "TotalCharges": "double"}


def feature_struct() -> T.StructType:
    """The logged ``input`` object: the 19 features with their clean types."""
    types = {"int": T.IntegerType(), "double": T.DoubleType()}
    return T.StructType(
        [
            T.StructField(r.name, types.get(CLEAN_TYPES.get(r.name), T.StringType()))
            for r in CUSTOMER_SPEC.rules
            if r.name not in ("customerID", "Churn")
        ]
    )


def log_schema(input_type: T.DataType | None = None) -> T.StructType:
    """One inference event. The input object depends on the model, so it is a parameter."""
    return T.StructType(
        [
            T.StructField("request_id", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
            T.StructField("input", input_type or feature_struct()),
            T.StructField("prediction", T.IntegerType()),
            T.StructField("churn_probability", T.DoubleType()),
            T.StructField("latency_ms", T.DoubleType()),
            T.StructField("status", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("model_name", T.StringType()),
            T.StructField("model_version", T.StringType()),
            T.StructField("run_id", T.StringType()),
        ]
    )


LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("dataset_version", T.StringType()),
        T.StructField("archive_file", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("new_data_hash", T.StringType()),
        T.StructField("previous_rows", T.LongType()),
        T.StructField("new_rows", T.LongType()),
        T.StructField("current_rows", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
