"""From landed text to encoded train and test sides, and retraining on more data."""

from __future__ import annotations

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame

from modelwatch.functions.scalars import bucketize, count_active, encode_label, map_values, parse_int, parse_number
from modelwatch.operators.encoding import FeatureEncoder, FeatureEncoderModel
from modelwatch.operators.joins import mark_members
from modelwatch.operators.membership import append_batch
from modelwatch.operators.metrics import evaluate
from modelwatch.operators.training import fit_model, score
from modelwatch.schema import CLEAN_TYPES, INACTIVE_SERVICE, SERVICE_COLUMNS, TENURE_EDGES, TENURE_LABELS


def clean_customers(landed: DataFrame, label: str = "Churn") -> DataFrame:
    """Landed text to clean types; the label, if present, to 0/1."""
    out = landed.drop("_corrupt_record")
    for c, kind in CLEAN_TYPES.items():
        if c in out.columns:
            out = out.withColumn(c, parse_int(c).cast("int") if kind == "int" else parse_number(c))
    if label in out.columns:
        out = out.withColumn(label, encode_label(label))
    return out


def engineer(clean: DataFrame) -> DataFrame:
    """Tenure bucket, number of active services, and the senior flag as Yes/No."""
    return clean.select(
        *[c for c in clean.columns if c != "SeniorCitizen"],
        map_values("SeniorCitizen", {0: "No", 1: "Yes"}).alias("SeniorCitizen"),
        bucketize("tenure", TENURE_EDGES, TENURE_LABELS).alias("TenureBucket"),
        count_active(SERVICE_COLUMNS, INACTIVE_SERVICE).alias("TotalServices"),
    )


def encode_sides(
    df: DataFrame, ids: DataFrame, key: str, encoder: FeatureEncoder
) -> tuple[FeatureEncoderModel, DataFrame, DataFrame]:
    """(fitted encoder, encoded train, encoded test); the encoder sees the training side only.

    One join marks the side of every row, and one plan encodes both sides.
    """
    marked = mark_members(df, ids, key, "_held_out")
    model = encoder.fit(marked.where("not _held_out"))
    encoded = model.transform(marked)
    return model, encoded.where("not _held_out").drop("_held_out"), encoded.where("_held_out").drop("_held_out")


def retrain(
    original: DataFrame,
    batch: DataFrame,
    holdout: DataFrame,
    key: str,
    label: str,
    encoder: Estimator,
    learner: Estimator,
) -> tuple[PipelineModel, DataFrame]:
    """Refit encoder and learner on original plus batch; evaluate on the frozen holdout.

    A batch drawn from the original rows counts those customers twice: the union is a bag.
    """
    model = fit_model(append_batch(original, batch), key, label, encoder, learner)
    scored = score(model, holdout)
    return model, evaluate(scored, label, "prediction", "churn_probability")
