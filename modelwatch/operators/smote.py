"""Minority oversampling by interpolation towards near minority neighbours."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwatch.operators.neighbours import BLOCK_POINTS, blocked_points, exact_neighbours, hashed_neighbours
from modelwatch.operators.ordered import running_totals

COPY_CHUNK = 100_000
#: Up to so many dimensions the projection bound of the exact search prunes.
FEW_DIMENSIONS = 12


def smote(
    df: DataFrame,
    label: str,
    features: str,
    k: int = 5,
    seed: int = 42,
    minority: int = 1,
    block_points: int = BLOCK_POINTS,
    key: str | None = None,
    search: str = "auto",
) -> DataFrame:
    """(key, features, label, synthetic): all rows plus as many synthetic minority rows as balance the classes.

    Every minority row is the base of equally many synthetic rows, up to one. A
    synthetic row lies between its base and one of the base's k neighbours,
    found by ``search``: 'exact', 'hashed' (at least 95 % of the true ones), or
    'auto', which is exact in few dimensions.

    With ``key`` the rows keep their keys, and synthetic ones get keys of their
    own: -1, -2, ... if the key is a number (whose given values must not be
    negative), else 'synthetic-1', ...
    """
    sizes = df.agg(
        F.count_if(F.col(label) == minority).alias("few"),
        F.count_if(F.col(label) != minority).alias("many"),
        F.max(F.size(F.col(features).cast("array<double>"))).alias("dimensions"),
    ).first()
    few, wanted = sizes["few"], sizes["many"] - sizes["few"]
    vector = F.col(features).cast("array<double>").alias(features)
    kept = [F.col(key)] if key else []
    rows = df.select(*kept, vector, F.col(label).cast("int").alias(label), F.lit(False).alias("synthetic"))
    if wanted <= 0:
        return rows
    if few <= k:
        raise ValueError(f"{few} minority rows, but {k} neighbours are asked for")
    if search not in ("auto", "exact", "hashed"):
        raise ValueError(f"unknown search: {search}")
    hashed = search == "hashed" or search == "auto" and sizes["dimensions"] > FEW_DIMENSIONS
    blocks = blocked_points(df.where(F.col(label) == minority), features, block_points)
    near = hashed_neighbours(blocks, k, seed=seed) if hashed else exact_neighbours(blocks, k)
    targets = blocks.select(F.col("id").alias("nid"), F.col("x").alias("nx"))
    # At most k entries per point.
    lists = (
        near.join(targets, "nid")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("start", "copies", "nx"))).alias("near"))
    )
    numbered = running_totals(blocks.select("id", "x", "copies", F.col("block").alias("_block")), "id", ["copies"])
    base, extra = wanted // few, wanted % few

    def spread(c: Column) -> Column:
        return F.floor(c.cast("decimal(38,0)") * extra / few)

    earlier = F.col("cum_copies") - F.col("copies")
    share = F.col("copies") * base + spread(F.col("cum_copies")) - spread(earlier)
    made_before = earlier * base + spread(earlier)
    numbered = numbered.withColumns({"share": share.cast("bigint"), "_number": made_before.cast("bigint")})
    allotted = numbered.where("share > 0").join(lists, "id")
    # A point with very many copies is worked off in pieces by many tasks.
    zero, piece = F.lit(0).cast("bigint"), F.lit(COPY_CHUNK).cast("bigint")
    pieces = allotted.withColumn("_from", F.explode(F.sequence(zero, F.col("share") - 1, piece)))
    pieces = pieces.repartition("id", "_from")
    until = F.least(F.col("_from") + COPY_CHUNK, F.col("share")) - 1
    each = pieces.withColumn("s", F.explode(F.sequence("_from", until)))
    pick = F.pmod(F.xxhash64("id", "s", F.lit(seed)), F.lit(k))
    step = F.pmod(F.xxhash64("s", "id", F.lit(seed + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = F.filter("near", lambda n: (n["start"] <= F.col("_pick")) & (F.col("_pick") < n["start"] + n["copies"]))
    number = F.col("_number") + F.col("s") + 1
    made = each.select("x", "near", number.alias("_number"), pick.alias("_pick"), step.alias("_step")).withColumn("nx", chosen[0]["nx"])
    between = F.zip_with("x", "nx", lambda a, b: a + F.col("_step") * (b - a))
    if key:
        numeric = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint") or dict(df.dtypes)[key].startswith("decimal")
        name = -F.col("_number") if numeric else F.concat(F.lit("synthetic-"), F.col("_number").cast("string"))
        kept = [name.cast(df.schema[key].dataType).alias(key)]
    synthetic = made.select(*kept, between.alias(features), F.lit(minority).alias(label), F.lit(True).alias("synthetic"))
    return rows.unionByName(synthetic)


def oversampled(df: DataFrame, key: str, label: str, features: str = "features", **options) -> DataFrame:
    """(key, label, features) with both classes equally large; fits ``prepare=`` of cross-validation: training rows in and out.

    ``features`` may be a vector or an array, and comes back as a vector.
    """
    values = vector_to_array(features) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features)
    out = smote(df.select(key, label, values.alias(features)), label, features, key=key, **options)
    return out.select(key, label, array_to_vector(F.col(features)).alias(features))
