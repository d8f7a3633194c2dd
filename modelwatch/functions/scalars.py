"""Column expressions for cleaning and feature work. No Python code runs per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text accepted as a number (rules out suffixes such as 1.0d, inf, nan).
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def parse_int(c: Column | str) -> Column:
    """Text to bigint; anything but an optionally signed run of digits becomes NULL."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("bigint"))


def nan_to_null(c: Column | str) -> Column:
    """NaN means missing."""
    return F.when(~F.isnan(col(c)), col(c))


def is_blank(c: Column | str) -> Column:
    return F.trim(col(c)) == ""


def encode_label(
    c: Column | str,
    positives: Sequence[str] = ("yes",),
    negatives: Sequence[str] = (),
    *,
    strict: bool = False,
) -> Column:
    """1 for a positive text. Otherwise 0, or with ``strict`` 0 only for a listed negative, else NULL.

    The lenient form trims and lower-cases; the strict form is an exact lookup.
    """
    if strict:
        return F.when(col(c).isin(*positives), 1).when(col(c).isin(*negatives), 0)
    text = F.lower(F.trim(col(c).cast("string")))
    return F.when(text.isin(*positives), 1).otherwise(0)


def fill_zero(c: Column | str) -> Column:
    return F.coalesce(nan_to_null(col(c).cast("double")), F.lit(0.0))


def map_values(c: Column | str, mapping: dict) -> Column:
    """Lookup; a value outside the mapping becomes NULL."""
    out = F.lit(None)
    for key, value in mapping.items():
        out = F.when(col(c) == F.lit(key), F.lit(value)).otherwise(out)
    return out


def bucketize(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed buckets: first edge that is not below the value, else the last label.

    A missing value compares false with every edge and so gets the last label.
    """
    chain = None
    for edge, label in zip(edges, labels):
        chain = F.when(col(c) <= edge, label) if chain is None else chain.when(col(c) <= edge, label)
    return chain.otherwise(labels[-1])


def count_active(cols: Sequence[str], inactive: Sequence[str]) -> Column:
    """How many of ``cols`` hold something other than an inactive value; NULL counts as active."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(~F.col(c).isin(*inactive), F.lit(True)).cast("int")
    return total


def derived_total(monthly: Column | str, months: Column | str) -> Column:
    """Monthly charge times months, rounded half to even at 2 places."""
    return F.bround(col(monthly) * col(months), 2)


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to [lo, hi]; NULL stays NULL."""
    out = col(c)
    if lo is not None:
        out = F.greatest(F.lit(lo), out)
    if hi is not None:
        out = F.least(F.lit(hi), out)
    return F.when(col(c).isNotNull(), out)


def clip_to_int(c: Column | str, lo: float, hi: float) -> Column:
    return F.bround(clip(c, lo, hi)).cast("int")


def to_class(probability: Column | str, threshold: float = 0.5) -> Column:
    return (col(probability) >= F.lit(threshold)).cast("int")


def drop_identity(df: DataFrame, key: str, label: str | None = None) -> DataFrame:
    """Feature columns only; absent names are ignored."""
    return df.drop(key, *([label] if label else []))


def any_cell_equals(df: DataFrame, text: str) -> DataFrame:
    """One row: does any cell, trimmed and upper-cased, equal ``text``?"""
    hit = F.lit(False)
    for c in df.columns:
        hit = hit | F.coalesce(F.upper(F.trim(F.col(c).cast("string"))) == text.upper(), F.lit(False))
    return df.agg(F.coalesce(F.bool_or(hit), F.lit(False)).alias("found"))


def ordered_names(name: Column | str, order: Column | str, keep: Column | None = None) -> Column:
    """Aggregate: names joined by a comma in report order. For report tables only."""
    item = F.struct(col(order).alias("o"), col(name).alias("n"))
    if keep is not None:
        item = F.when(keep, item)
    return F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda s: s["n"]), ", ")


def version_number(file_name: Column | str, stem: str) -> Column:
    """The number in ``<stem>_vNN.<ext>``; NULL when the name has another form."""
    text = F.regexp_extract(col(file_name), rf"(?:^|/){stem}_v([0-9]+)\.[^/]+$", 1)
    return F.when(text != "", text.cast("int"))


def version_tag(number: Column | str) -> Column:
    return F.format_string("v%02d", col(number))


def next_version(files: DataFrame, column: str, stem: str) -> DataFrame:
    """One row: the highest version among the file names and the next tag."""
    highest = F.coalesce(F.max(version_number(column, stem)), F.lit(0))
    return files.agg(highest.alias("highest")).select(
        "highest", version_tag(F.col("highest") + 1).alias("next_tag")
    )


def parse_timestamp(c: Column | str) -> Column:
    """ISO text with offset to a UTC instant."""
    return F.try_to_timestamp(col(c).cast("string"))


def flatten_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Replace a JSON text column by its fields."""
    return df.withColumn("_obj", F.from_json(column, schema)).select(
        *[c for c in df.columns if c != column], "_obj.*"
    )


def strip_key(payload: Column | str, key: str) -> Column:
    """The payload object without its id."""
    return col(payload).dropFields(key)


def columns_by_role(schema: T.StructType, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names by type."""
    fields = [f for f in schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    categorical = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, categorical


def resolve_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate present, ignoring case and surrounding blanks."""
    lookup = {str(c).strip().casefold(): c for c in columns}
    return next((lookup[c.casefold()] for c in candidates if c.casefold() in lookup), None)
