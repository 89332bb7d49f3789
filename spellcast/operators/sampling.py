"""Exact, reproducible sampling by key hash, and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
_BUCKET_BITS = 16


def _hash(key: list[str], seed: int) -> Column:
    return F.xxhash64(*key, F.lit(seed))


def mark_by_hash(
    df: DataFrame, key: list[str], group: Column, sizes: dict[int, int], seed: int = SEED, name: str = "taken"
) -> DataFrame:
    """Flag the ``sizes[g]`` rows of smallest key hash per group ``g``; groups without a size
    are flagged whole.

    The hash is uniform over unique keys, so its top bits cut each group into 65536 even
    buckets. Their counts tell which buckets are wholly in; only the one bucket the limit
    falls into is ranked row by row.
    """
    hashed = df.withColumn("_h", _hash(key, seed)).withColumn("_g", group)
    hashed = hashed.withColumn("_b", F.shiftrightunsigned("_h", 64 - _BUCKET_BITS).cast("int"))
    limit = F.lit(None).cast("long")
    for g, n in sizes.items():
        limit = F.when(F.col("_g") == g, F.lit(n)).otherwise(limit)
    upto = Window.partitionBy("_g").orderBy("_b")
    counts = (
        hashed.groupBy("_g", "_b")
        .agg(F.count("*").alias("_n"))
        .select("_g", "_b", "_n", F.sum("_n").over(upto).alias("_upto"))
        .select(
            F.col("_g").alias("_cg"), F.col("_b").alias("_cb"),
            (limit - (F.col("_upto") - F.col("_n"))).alias("_room"), "_n",
        )
    )
    # At most 65536 rows per group, whatever the size of the data.
    same = F.col("_g").eqNullSafe(F.col("_cg")) & (F.col("_b") == F.col("_cb"))
    placed = hashed.join(F.broadcast(counts), same)
    room, n = F.col("_room"), F.col("_n")
    cut = F.coalesce((room > 0) & (room < n), F.lit(False))
    sure = placed.where(~cut).withColumn(name, room.isNull() | (room >= n))
    w = Window.partitionBy("_g", "_b").orderBy("_h", *key)
    edge = placed.where(cut).withColumn("_r", F.row_number().over(w)).withColumn(name, F.col("_r") <= room)
    return sure.select(*df.columns, name).unionByName(edge.select(*df.columns, name))


def take_by_hash(df: DataFrame, key: list[str], group: Column, sizes: dict[int, int], seed: int = SEED) -> DataFrame:
    """The rows that ``mark_by_hash`` flags."""
    return mark_by_hash(df, key, group, sizes, seed, "_taken").where("_taken").drop("_taken")


def class_counts(df: DataFrame, target: str) -> tuple[int, int]:
    """Negatives and positives."""
    r = df.agg(F.sum((F.col(target) == 0).cast("int")), F.sum((F.col(target) == 1).cast("int"))).first()
    return int(r[0] or 0), int(r[1] or 0)


def undersample(df: DataFrame, key: list[str], target: str, ratio: float = 200, seed: int = SEED) -> DataFrame:
    """All positives and ``ratio`` negatives per positive (all negatives if there are fewer)."""
    _, pos = class_counts(df, target)
    return take_by_hash(df, key, F.col(target), {0: int(pos * ratio)}, seed)


def stratified_split(
    df: DataFrame, key: list[str], target: str, test_size: float = 0.2, seed: int = SEED, name: str = "is_test"
) -> DataFrame:
    """Flag test rows with the same share of each class, exact up to one row per class."""
    neg, pos = class_counts(df, target)
    sizes = {0: round(neg * test_size), 1: round(pos * test_size)}
    return mark_by_hash(df, key, F.col(target), sizes, seed, name)


def imbalance_ratio(df: DataFrame, target: str) -> float:
    """Negatives per positive; 1 without positives."""
    neg, pos = class_counts(df, target)
    return neg / pos if pos else 1.0


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Rows, balanced weight ``n / (2 n_c)`` and positive scale per class."""
    counts = df.groupBy(F.col(target).alias("target")).agg(F.count("*").alias("n"))
    w = Window.partitionBy()  # two rows
    total = F.sum("n").over(w)
    pos = F.sum(F.when(F.col("target") == 1, F.col("n")).otherwise(0)).over(w)
    scale = F.when(pos > 0, (total - pos) / F.nullif(pos, F.lit(0))).otherwise(F.lit(1.0))
    return counts.select(
        "target", "n",
        (total / (F.col("n") * F.lit(2.0))).alias("balanced_weight"),
        F.when(F.col("target") == 1, scale).otherwise(F.lit(1.0)).alias("scale_weight"),
    )


def with_weights(df: DataFrame, target: str, kind: str = "balanced", name: str = "weight") -> DataFrame:
    """Add a row weight: ``balanced`` or ``scale`` (positives only)."""
    neg, pos = class_counts(df, target)
    if kind == "balanced":
        w = {c: (neg + pos) / (2.0 * n) if n else 1.0 for c, n in ((0, neg), (1, pos))}
    else:
        w = {0: 1.0, 1: neg / pos if pos else 1.0}
    return df.withColumn(name, F.when(F.col(target) == 1, w[1]).otherwise(w[0]))


def explanation_sample(df: DataFrame, key: list[str], n: int = 500, seed: int = SEED) -> DataFrame:
    """At most ``n`` rows, the smallest hashes: a bounded sample for explanation tables."""
    return df.withColumn("_h", _hash(key, seed)).orderBy("_h", *key).limit(n).drop("_h")
