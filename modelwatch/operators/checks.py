"""Table validation: every row check in one scan, all failures in long form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwatch.functions.scalars import INTEGER_PATTERN, NUMBER_PATTERN
from modelwatch.operators.joins import membership
from modelwatch.operators.ordered import exact_quantiles
from modelwatch.schema import ColumnRule, TableSpec

FAILURE = "struct<schema_context:string,column:string,check:string,failure_case:string>"


def _number(value: Column, declared: str | None) -> Column:
    """The value as a double, however it was landed."""
    if declared in ("string", None):
        text = F.trim(value)
        return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return value.cast("double")


def rule_checks(rule: ColumnRule, declared: str | None = "string") -> list[tuple[str, Column]]:
    """(check name, is it broken) for every check of the rule.

    A missing value fails only the null check; a value of the wrong type fails the
    type check, and the checks that need that type do not apply to it.
    """
    value = F.col(rule.name)
    text = F.trim(value.cast("string"))
    number = _number(value, declared)
    checks: list[tuple[str, Column]] = []
    if not rule.nullable:
        checks.append(("not_nullable", value.isNull()))
    if rule.kind == "int":
        checks.append(("dtype(int)", ~text.rlike(INTEGER_PATTERN)))
    elif rule.kind == "float":
        checks.append(("dtype(float)", number.isNull() & value.isNotNull()))
    elif rule.kind == "numeric_text":
        checks.append(("blank_or_numeric", (text != "") & number.isNull() & value.isNotNull()))
    if rule.allowed:
        if rule.kind == "int":
            checks.append(("isin", text.rlike(INTEGER_PATTERN) & ~number.isin(*[float(a) for a in rule.allowed])))
        else:
            checks.append(("isin", ~value.cast("string").isin(*rule.allowed)))
    if rule.lo is not None:
        checks.append((f"ge({rule.lo:g})", number < rule.lo))
    if rule.hi is not None:
        checks.append((f"le({rule.hi:g})", number > rule.hi))
    return [(name, F.coalesce(broken, F.lit(False))) for name, broken in checks]


def column_failures(columns: Sequence[str], spec: TableSpec) -> list[tuple[str, str, str, str]]:
    """Strict column set: missing and unexpected names. Metadata only."""
    landed = [c for c in columns if c != "_corrupt_record"]
    missing = [("DataFrameSchema", c, "column_in_dataframe", c) for c in spec.columns if c not in landed]
    extra = [("DataFrameSchema", c, "column_in_schema", c) for c in landed if c not in spec.columns]
    return missing + extra


def _present_rules(df: DataFrame, spec: TableSpec) -> list[ColumnRule]:
    return [r for r in spec.rules if r.name in df.columns]


def _all_checks(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, Column]]:
    types = dict(df.dtypes)
    return [(r.name, check, broken) for r in _present_rules(df, spec) for check, broken in rule_checks(r, types[r.name])]


def any_failure(df: DataFrame, spec: TableSpec) -> Column:
    """Does the row break any check? A plain predicate: clean rows cost nothing more."""
    return reduce(lambda a, b: a | b, [broken for _, _, broken in _all_checks(df, spec)], F.lit(False))


def failure_list(df: DataFrame, spec: TableSpec) -> Column:
    """The array of checks a row breaks."""
    found = [
        F.when(
            broken,
            F.struct(
                F.lit("Column").alias("schema_context"),
                F.lit(column).alias("column"),
                F.lit(check).alias("check"),
                F.col(column).cast("string").alias("failure_case"),
            ),
        )
        for column, check, broken in _all_checks(df, spec)
    ]
    return F.array_compact(F.array(*found)).cast(f"array<{FAILURE}>")


def validate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All failures in long form: key, schema_context, column, check, failure_case.

    Column-set failures have no row and so a NULL key.
    """
    key = F.col(spec.key).cast("string") if spec.key in df.columns else F.lit(None).cast("string")
    rows = (
        df.where(any_failure(df, spec))
        .select(key.alias("key"), F.explode(failure_list(df, spec)).alias("f"))
        .select("key", "f.*")
    )
    absent = column_failures(df.columns, spec)
    if not absent:
        return rows
    schema = "schema_context string, column string, check string, failure_case string"
    table = df.sparkSession.createDataFrame(absent, schema)
    return table.select(F.lit(None).cast("string").alias("key"), "*").unionByName(rows)


def verdict(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: rows checked, rows and checks failed, column failures, PASS or FAIL."""
    absent = len(column_failures(df.columns, spec))
    broken = [b.cast("int") for _, _, b in _all_checks(df, spec)]
    per_row = df.select(reduce(lambda a, b: a + b, broken, F.lit(0)).alias("n"))
    counted = per_row.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures"),
        F.count_if(F.col("n") > 0).alias("failed_rows"),
    )
    return counted.select(
        "rows",
        "failed_rows",
        "failures",
        F.lit(absent).alias("column_failures"),
        F.when((F.col("failures") == 0) & F.lit(absent == 0), "PASS").otherwise("FAIL").alias("verdict"),
    )


def failures_per_check(df: DataFrame, spec: TableSpec) -> DataFrame:
    return validate(df, spec).groupBy("column", "check").agg(F.count(F.lit(1)).alias("n"))


def all_null_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: non-null values, and whether there are none."""
    counts = df.agg(*[F.count(c).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column", "non_null").select(
        "column", "non_null", (F.col("non_null") == 0).alias("all_null")
    )


def same_schema(a: DataFrame, b: DataFrame, *, same_rows: bool = False) -> list[str]:
    """Differences in column names and order; equal row counts only when asked for."""
    errors = [] if a.columns == b.columns else [f"columns differ: {a.columns} and {b.columns}"]
    if same_rows and a.count() != b.count():
        errors.append("row counts differ")
    return errors


def check_encoded(train: DataFrame, test: DataFrame, features: str, label: str) -> DataFrame:
    """One row over both encoded sides: widths, missing values, label counts, verdict.

    ``features`` is an ``array<double>`` column.
    """
    missing = F.filter(features, lambda x: x.isNull() | F.isnan(x))
    both = train.select(F.lit("train").alias("side"), features, label).unionByName(
        test.select(F.lit("test").alias("side"), features, label)
    )

    def on(side: str, agg: Column, name: str) -> Column:
        return agg.alias(f"{side}_{name}")

    aggs = []
    for side in ("train", "test"):
        here = F.col("side") == side
        width = F.when(here, F.size(features))
        aggs += [
            on(side, F.count_if(here), "rows"),
            on(side, F.min(width), "min_width"),
            on(side, F.max(width), "max_width"),
            on(side, F.coalesce(F.sum(F.when(here, F.size(missing))), F.lit(0)).cast("bigint"), "missing"),
            on(side, F.count_if(here & F.col(label).isNull()), "unlabelled"),
        ]
    row = both.agg(*aggs)
    found = [
        F.when(F.col("train_missing") > 0, F.lit("missing values in train features")),
        F.when(F.col("test_missing") > 0, F.lit("missing values in test features")),
        F.when(
            ~(
                (F.col("train_min_width") == F.col("train_max_width"))
                & (F.col("train_max_width") == F.col("test_min_width"))
                & (F.col("test_min_width") == F.col("test_max_width"))
            ),
            F.lit("feature widths differ"),
        ),
        F.when(F.col("train_unlabelled") > 0, F.lit("train rows without label")),
        F.when(F.col("test_unlabelled") > 0, F.lit("test rows without label")),
    ]
    errors = F.array_join(F.array_compact(F.array(*found)), "; ")
    return row.select(
        "*", errors.alias("errors"), F.when(errors == "", "PASSED").otherwise("FAILED").alias("validation_status")
    )


# --- scoring requests -------------------------------------------------------

MESSAGES = {
    "not_nullable": "field required",
    "dtype(int)": "not a valid integer",
    "dtype(float)": "not a valid number",
    "isin": "not one of the permitted values",
}


def _missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    return [c for c in spec.columns if c not in df.columns]


def error_list(df: DataFrame, spec: TableSpec, path: Column | None = None) -> Column:
    """Array of (field path, message): every error of the record."""
    texts = F.create_map(*[F.lit(x) for item in MESSAGES.items() for x in item])

    def as_error(f: Column) -> Column:
        field = f["column"] if path is None else F.concat_ws(".", path, f["column"])
        return F.struct(field.alias("field"), F.coalesce(F.try_element_at(texts, f["check"]), f["check"]).alias("message"))

    errors = F.transform(failure_list(df, spec), as_error)
    missing = _missing_columns(df, spec)
    if missing:
        where = [F.lit(c) if path is None else F.concat_ws(".", path, F.lit(c)) for c in missing]
        always = F.array(*[F.struct(w.alias("field"), F.lit("field required").alias("message")) for w in where])
        errors = F.concat(always, errors)
    return errors


def with_errors(df: DataFrame, spec: TableSpec, path: Column | None = None) -> DataFrame:
    return df.withColumn("errors", error_list(df, spec, path))


def quarantine(df: DataFrame, spec: TableSpec, path: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their errors)."""
    bad = any_failure(df, spec) | F.lit(bool(_missing_columns(df, spec)))
    return df.where(~bad), with_errors(df.where(bad), spec, path)


def request_path(index: str) -> Column:
    """Field path prefix of a record in a batch request: customers.<index>."""
    return F.concat_ws(".", F.lit("customers"), F.col(index).cast("string"))


def batch_errors(df: DataFrame, spec: TableSpec, batch: str, index: str) -> DataFrame:
    """All errors of all batches: batch, field, message."""
    _, bad = quarantine(df, spec, request_path(index))
    return bad.select(batch, F.explode("errors").alias("e")).select(batch, "e.field", "e.message")


def batch_verdicts(batches: DataFrame, df: DataFrame, spec: TableSpec, batch: str, index: str) -> DataFrame:
    """One row per announced batch. One bad record rejects the batch; so does having none."""
    broken = [b.cast("int") for _, _, b in _all_checks(df, spec)]
    n_errors = reduce(lambda a, b: a + b, broken, F.lit(len(_missing_columns(df, spec))))
    checked = df.select(batch, F.lit(1).alias("record"), n_errors.alias("n_errors"))
    announced = batches.select(batch, F.lit(0).alias("record"), F.lit(0).alias("n_errors"))
    totals = (
        announced.unionByName(checked)
        .groupBy(batch)
        .agg(
            F.sum("record").cast("bigint").alias("records"),
            F.sum("n_errors").cast("bigint").alias("errors"),
            F.min("record").alias("_announced"),
        )
        .where(F.col("_announced") == 0)
        .drop("_announced")
    )
    return totals.withColumn(
        "status", F.when((F.col("records") > 0) & (F.col("errors") == 0), "accepted").otherwise("rejected")
    )


def accepted_records(df: DataFrame, spec: TableSpec, batch: str, index: str) -> DataFrame:
    """Records of batches without any error. Records without batch id are one batch of their own."""
    _, bad = quarantine(df, spec, request_path(index))
    name = F.coalesce(F.concat(F.lit("="), F.col(batch).cast("string")), F.lit("")).alias("_batch")
    kept = membership(df.select("*", name), bad.select(name), "_batch", keep_members=False)
    return kept.select(*df.columns)


# --- data exploration checks ------------------------------------------------


def blank_profile(df: DataFrame, column: str, companion: str) -> DataFrame:
    """Blank or unparsable values of a text column by value of a companion column."""
    text = F.trim(F.col(column).cast("string"))
    blank = F.coalesce(text == "", F.lit(False))
    bad = F.col(column).isNull() | blank | ~text.rlike(NUMBER_PATTERN)
    return (
        df.where(bad)
        .groupBy(companion)
        .agg(F.count_if(blank).alias("blank"), F.count_if(~blank).alias("not_numeric"))
    )


def implication_check(df: DataFrame, cols: Sequence[str], value: str, flag: Column) -> DataFrame:
    """Per column: how often it holds ``value``, how often ``flag`` holds, and both; do they coincide?"""
    on = F.coalesce(flag, F.lit(False))
    aggs = []
    for c in cols:
        hit = F.coalesce(F.col(c) == value, F.lit(False))
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(hit).alias("value_rows"),
                F.count_if(on).alias("flag_rows"),
                F.count_if(hit & on).alias("both_rows"),
            )
        )
    rows = df.agg(F.array(*aggs).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
    same = (F.col("value_rows") == F.col("both_rows")) & (F.col("flag_rows") == F.col("both_rows"))
    return rows.withColumn("equivalent", same)


def consistency_profile(df: DataFrame, total: str, months: str, monthly: str) -> DataFrame:
    """Describe |total / months - monthly| over rows with months > 0."""
    gap = F.abs(F.col(total) / F.col(months) - F.col(monthly))
    gaps = df.where(F.col(months) > 0).select(gap.alias("gap"))
    stats = gaps.agg(
        F.count("gap").alias("count"),
        F.avg("gap").alias("mean"),
        F.stddev_samp("gap").alias("std"),
        F.min("gap").alias("min"),
        F.max("gap").alias("max"),
    )
    quarts = exact_quantiles(gaps, ["gap"], [0.25, 0.5, 0.75]).select(
        F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75")
    )
    picked = quarts.agg(F.struct(*[F.max(c).alias(c) for c in quarts.columns])).scalar()
    return stats.select("*", *[picked.getField(c).alias(c) for c in ("q25", "q50", "q75")])


def require_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The frame itself, or an error naming the first failures."""
    failed = validate(df, spec).limit(5).collect()
    if failed:
        shown = "; ".join(f"{r['column']}: {r['check']} {r['failure_case']!r}" for r in failed)
        raise ValueError(f"schema validation failed: {shown}")
    return df
