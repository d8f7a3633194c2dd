"""Feature preparation: constant fill, population scaling, one-hot and ordinal codes.

``FeatureEncoder`` is a ``pyspark.ml`` estimator, so it fits inside pipelines and
cross-validation and is saved with them. Up to ``LITERAL_LEVELS`` levels the
fitted state is one small record per column and applying it is a column
expression. Beyond that the levels are a table of their own: numbered by a range
shuffle, joined to the rows, saved as a folder beside the state, never gathered
on the driver; the one-hot block is a sparse vector then.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwatch.functions.scalars import fill_zero
from modelwatch.operators.ordered import with_position
from modelwatch.session import stage_table

#: So many levels, of all columns together, may become part of an expression.
LITERAL_LEVELS = 10_000
LEVELS_SCHEMA = "column string, level string, place bigint"


def numeric_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: mean and divisor after filling with 0. Zero variance divides by 1."""
    aggs = [
        F.struct(F.avg(fill_zero(c)).alias("mean"), F.stddev_pop(fill_zero(c)).alias("std")).alias(c) for c in cols
    ]
    row = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.mean").alias("mean"), F.col(f"`{c}`.std").alias("std")) for c in cols]
    tall = row.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    divisor = F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0))
    return tall.select("column", "mean", divisor.alias("divisor"))


def category_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null levels per column."""
    slim = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return slim.unpivot([], list(cols), "column", "level").where(F.col("level").isNotNull()).distinct()


def collect_levels(df: DataFrame, cols: Sequence[str], most: int | None = None) -> dict[str, list[str]] | None:
    """Sorted levels per column, as a model's state; None if there are more than ``most`` of them."""
    levels: dict[str, list[str]] = {c: [] for c in cols}
    rows = category_levels(df, cols) if cols else None
    if most is not None and rows is not None:
        rows = rows.limit(most + 1)
    found = list(rows.toLocalIterator()) if rows is not None else []
    if most is not None and len(found) > most:
        return None
    for r in found:
        levels[r["column"]].append(r["level"])
    return {c: sorted(v) for c, v in levels.items()}


def indexed_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, level, place): the sorted levels of every column, numbered from 1 on by a range shuffle."""
    placed = with_position(category_levels(df, cols), ["column", "level"])
    starts = placed.groupBy("column").agg(F.min("position").alias("start"))  # one row a column
    return stage_table(
        placed.join(F.broadcast(starts), "column").select("column", "level", (F.col("position") - F.col("start") + 1).alias("place")), "levels"
    )


def level_counts(levels: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    counts = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: counts.get(c, 0) for c in cols}


def join_places(df: DataFrame, levels: DataFrame, cols: Sequence[str], out: str = "_place_{}") -> DataFrame:
    """Adds each column's place among its levels: 0 for an unseen level, NULL for a missing one.

    A left join per column on the level; adaptive execution broadcasts a small dictionary and splits a hot level.
    """
    for i, c in enumerate(cols):
        own = levels.where(F.col("column") == c).select(F.col("level").alias("_level"), F.col("place").alias(f"_found_{i}"))
        text = F.col(c).cast("string")
        df = df.join(own, text == F.col("_level"), "left").drop("_level")
        df = df.withColumn(out.format(c), F.when(text.isNotNull(), F.coalesce(f"_found_{i}", F.lit(0)))).drop(f"_found_{i}")
    return df


def scaled(c: str, mean: float, divisor: float) -> Column:
    return (fill_zero(c) - F.lit(mean)) / F.lit(divisor)


def level_place(c: str, levels: Sequence[str]) -> Column:
    """Place among the levels from 1 on, 0 for an unseen and NULL for a missing one; one expression for any number of levels."""
    known = F.from_json(F.lit(json.dumps(list(levels))), "array<string>")
    return F.array_position(known, F.col(c).cast("string"))


def one_hot(c: str, levels: Sequence[str]) -> Column:
    """Array of indicators for every level but the first; an unseen or missing level gives all zeros."""
    if len(levels) < 2:
        return F.array().cast("array<double>")
    place = F.coalesce(level_place(c, levels), F.lit(0))
    return F.transform(F.sequence(F.lit(2), F.lit(len(levels))), lambda i: (i == place).cast("double"))


def ordinal(c: str, levels: Sequence[str]) -> Column:
    """Position among the sorted levels; an unseen level is an error."""
    return ordinal_of(c, level_place(c, levels))


def ordinal_of(c: str, place: Column) -> Column:
    text = F.concat(F.lit(f"unknown level in {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
    return F.when(place > 0, (place - 1).cast("double")).otherwise(F.raise_error(text).cast("double"))


class _EncoderParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "filled and scaled columns", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "one-hot columns", TypeConverters.toListString)
    ordinalCols = Param(Params._dummy(), "ordinalCols", "ordinal columns", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column to add", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted means, divisors and levels as JSON", TypeConverters.toString)


class FeatureEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits means, divisors and category levels on the training rows."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, ordinalCols=None, outputCol=None):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], ordinalCols=[], outputCol="features", state="")
        self._set(**self._input_kwargs)

    def input_columns(self) -> list[str]:
        return [c for p in (self.numericCols, self.categoricalCols, self.ordinalCols) for c in self.getOrDefault(p)]

    def _fit(self, dataset: DataFrame) -> "FeatureEncoderModel":
        numeric = self.getOrDefault(self.numericCols)
        coded = list(dict.fromkeys(self.getOrDefault(self.categoricalCols) + self.getOrDefault(self.ordinalCols)))
        stats = numeric_stats(dataset, numeric).collect() if numeric else []
        state = {"scale": {r["column"]: [r["mean"], r["divisor"]] for r in stats}}
        levels, table = collect_levels(dataset, coded, LITERAL_LEVELS), None
        if levels is None:
            table = indexed_levels(dataset, coded)
            state["counts"] = level_counts(table, coded)
        else:
            state["levels"] = levels
        model = self._copyValues(FeatureEncoderModel()._set(state=json.dumps(state)))
        model.level_table = table
        return model


class _ModelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.level_table is not None:
            self.instance.level_table.write.parquet(f"{path}/levels")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str) -> "FeatureEncoderModel":
        model = super().load(path)
        if "counts" in model._state():
            model.level_table = SparkSession.active().read.schema(LEVELS_SCHEMA).parquet(f"{path}/levels")
        return model


class FeatureEncoderModel(Model, _EncoderParams, MLReadable, MLWritable):
    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], ordinalCols=[], outputCol="features", state="")
        #: (column, level, place), if there are too many levels for the state.
        self.level_table: DataFrame | None = None

    def write(self) -> _ModelWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> _ModelReader:
        return _ModelReader(cls)

    def _state(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def feature_names(self) -> list[str]:
        """Names of all features, brought to the driver; ``feature_table`` leaves them where they are."""
        if self.level_table is not None:
            rows = self.feature_table().orderBy("position").toLocalIterator()
            return [r["feature"] for r in rows]
        levels = self._state()["levels"]
        names = list(self.getOrDefault(self.numericCols))
        for c in self.getOrDefault(self.categoricalCols):
            names += [f"{c}_{level}" for level in levels[c][1:]]
        return names + list(self.getOrDefault(self.ordinalCols))

    def feature_table(self) -> DataFrame:
        """(position, feature), positions from 0 on."""
        spark = SparkSession.active()
        if self.level_table is None:
            return spark.createDataFrame(list(enumerate(self.feature_names())), "position bigint, feature string")
        counts, at, parts = self._state()["counts"], 0, []
        for c in self.getOrDefault(self.numericCols):
            parts.append((at, c))
            at += 1
        hot = []
        for c in self.getOrDefault(self.categoricalCols):
            own = self.level_table.where((F.col("column") == c) & (F.col("place") > 1))
            hot.append(own.select((F.col("place") + (at - 2)).alias("position"), F.concat(F.lit(f"{c}_"), F.col("level")).alias("feature")))
            at += max(0, counts[c] - 1)
        parts += [(at + i, c) for i, c in enumerate(self.getOrDefault(self.ordinalCols))]
        out = spark.createDataFrame(parts, "position bigint, feature string")
        for part in hot:
            out = out.unionByName(part)
        return out

    def encoded(self) -> Column:
        """Numeric block, then one-hot block, then ordinal block, as ``array<double>``."""
        state = self._state()
        if "levels" not in state:
            raise ValueError("the levels are a table: use transform")
        none = F.array().cast("array<double>")
        numeric = [scaled(c, *state["scale"][c]) for c in self.getOrDefault(self.numericCols)]
        places = [ordinal(c, state["levels"][c]) for c in self.getOrDefault(self.ordinalCols)]
        hot = [one_hot(c, state["levels"][c]) for c in self.getOrDefault(self.categoricalCols)]
        return F.concat(F.array(*numeric) if numeric else none, *hot, F.array(*places) if places else none)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.level_table is None:
            return dataset.withColumn(self.getOrDefault(self.outputCol), array_to_vector(self.encoded()))
        return self._joined(dataset)

    def _joined(self, dataset: DataFrame) -> DataFrame:
        """The same blocks over the table of levels; the one-hot part stays sparse."""
        state, output = self._state(), self.getOrDefault(self.outputCol)
        categorical, ordinals = self.getOrDefault(self.categoricalCols), self.getOrDefault(self.ordinalCols)
        out = join_places(dataset, self.level_table, list(dict.fromkeys(categorical + ordinals)))
        blocks, added = [], [f"_place_{c}" for c in dict.fromkeys(categorical + ordinals)]

        def block(name: str, values: Column) -> None:
            nonlocal out
            out = out.withColumn(name, values)
            blocks.append(name)
            added.append(name)

        for i, c in enumerate(self.getOrDefault(self.numericCols)):
            block(f"_scaled_{i}", scaled(c, *state["scale"][c]))
        for i, c in enumerate(categorical):
            n = state["counts"][c]
            if n < 2:
                continue
            # The last index is the one without an entry: it is for the first level, and for unseen and missing ones.
            index = F.when(F.col(f"_place_{c}") > 1, F.col(f"_place_{c}") - 2).otherwise(n - 1).cast("double")
            sized = index.alias(f"_index_{i}", metadata={"ml_attr": {"type": "nominal", "num_vals": n}})
            out = out.select("*", sized)
            hot = OneHotEncoder(inputCols=[f"_index_{i}"], outputCols=[f"_hot_{i}"], dropLast=True)
            out = hot.fit(out).transform(out)  # the size is in the column's metadata: no pass
            blocks.append(f"_hot_{i}")
            added += [f"_index_{i}", f"_hot_{i}"]
        for i, c in enumerate(ordinals):
            block(f"_ordinal_{i}", ordinal_of(c, F.col(f"_place_{c}")))
        if not blocks:
            return out.withColumn(output, array_to_vector(F.array().cast("array<double>"))).drop(*added)
        return VectorAssembler(inputCols=blocks, outputCol=output, handleInvalid="keep").transform(out).drop(*added)
