"""Saving and loading a fitted model together with its metadata."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from modelwatch.sources.tables import path_exists

META_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
    ]
)


def save_bundle(
    spark: SparkSession, model: PipelineModel, path: str, *, name: str, version: str, run_id: str, threshold: float = 0.5
) -> None:
    """Model and encoder are stages of one pipeline; the metadata is written last."""
    model.write().overwrite().save(f"{path}/model")
    meta = spark.createDataFrame([(name, version, run_id, threshold)], META_SCHEMA)
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """The fitted pipeline and its metadata; any missing part is an error."""
    for part in ("model", "metadata"):
        if not path_exists(spark, f"{path}/{part}"):
            raise FileNotFoundError(f"{path}/{part}")
    meta = spark.read.schema(META_SCHEMA).json(f"{path}/metadata").first()
    if meta is None:
        raise ValueError(f"{path}/metadata holds no record")
    return PipelineModel.load(f"{path}/model"), meta.asDict()


def score_with_bundle(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    from modelwatch.operators.training import score

    model, meta = load_bundle(spark, path)
    return score(model, df, threshold=meta["threshold"])
