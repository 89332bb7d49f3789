"""Global row numbers, running totals and exact quantiles without a one-task window over data.

A window without PARTITION BY sends every row to one task. Here rows are range-partitioned
on the order columns and checkpointed, so that partition membership is fixed; each
partition counts for itself, and the totals of the earlier partitions (one row per
partition) are added. Ties spread over partitions because the order ends in a unique key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spellcast.session import checkpointed

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row position below


def with_row_number(df: DataFrame, order: list[Column | str], name: str = "row_number") -> DataFrame:
    """Number the rows 1..n in a total order (end ``order`` with a unique key)."""
    placed = checkpointed(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _POSITION_BITS)
    position = F.col("_at").bitwiseAND((1 << _POSITION_BITS) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # One row per partition, so the broadcast is bounded by the number of partitions.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + position + 1)
        .drop("_part", "_before", "_at")
    )


def with_running_totals(
    df: DataFrame, by: list[str], order: list[Column | str], totals: dict[str, str]
) -> DataFrame:
    """Add inclusive running sums (``{output: input}``) within ``by``, in ``order``.

    A group may span any number of partitions. Rows with equal order columns share the
    totals of their last row.
    """
    placed = checkpointed(
        df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id())
    )
    sums = placed.groupBy("_part", *by).agg(*[F.sum(src).alias(f"_s_{out}") for out, src in totals.items()])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_part", *by, *[F.coalesce(F.sum(f"_s_{out}").over(earlier), F.lit(0)).alias(f"_o_{out}") for out in totals]
    )
    inside = Window.partitionBy("_part", *by).orderBy(*order)
    summed = placed.select("*", *[F.sum(src).over(inside).alias(f"_i_{out}") for out, src in totals.items()])
    return summed.join(offsets, ["_part", *by]).select(
        *df.columns, *[(F.col(f"_i_{out}") + F.col(f"_o_{out}")).alias(out) for out in totals]
    )


def bucket_of(row_number: Column, total: Column, n_bins: Column) -> Column:
    """Equal-count bucket 1..n of a row number; the first ``total % n`` buckets get one more."""
    small = F.floor(total / n_bins)
    large = total % n_bins
    cut = large * (small + 1)
    return F.when(row_number <= cut, F.ceil(row_number / (small + 1))).otherwise(
        large + F.ceil((row_number - cut) / F.when(small == 0, 1).otherwise(small))
    ).cast("int")


#: Size of the sketches, and how far a rank of theirs may be off as a share of the values (several
#: times their expected error; ranks outside are noticed and found by sorting).
SKETCH_K, SKETCH_ERROR = 4096, 0.003
#: Equal steps of the ranks whose values are read from a sketch.
GRID = 400
#: Values between the fences of a rank from which they are drawn closer by another pass.
CLOSE_VALUES = 2_000_000


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles of ``value`` per group, one column per ``probs`` entry.

    Exact selection without a sort of the data: sketches of the groups put fences around each rank;
    a second pass counts the values below them and keeps those between, equal ones as one row, of
    which the ranks are picked. While more than ``CLOSE_VALUES`` may lie between, a pass sketches
    only these and draws the fences closer. NULL and NaN are no values.
    """
    v, key = F.col("_v"), [*by, "_name"]
    known = df.select(*by, F.col(value).cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    sketch = F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("_sketch")
    ranks = F.array(*[F.struct(F.lit(n).alias("_name"), ((F.col("_n") - 1) * F.lit(float(p))).alias("_at")) for n, p in probs.items()])
    start = known.groupBy(*by).agg(sketch, F.count("*").alias("_n"))
    fences = checkpointed(_fences(start.select("*", F.lit(0).alias("_below"), F.inline(ranks)), key))
    while (widest := fences.agg(F.max("_width")).first()[0] or 0) > CLOSE_VALUES:
        # One row per group and rank.
        near = known.join(F.broadcast(fences), by).where(v <= F.col("_hi"))
        between = F.when(v >= F.col("_lo"), v)
        again = near.groupBy(*key, "_at").agg(
            F.kll_sketch_agg_double(between, F.lit(SKETCH_K)).alias("_sketch"), F.count(between).alias("_n"),
            F.count(F.when(v < F.col("_lo"), 1)).alias("_below"),
        )
        closer = checkpointed(_fences(again, key))
        if (closer.agg(F.max("_width")).first()[0] or 0) > widest / 2:
            break  # equal values, which are one row each in the end
        fences = closer
    near = known.join(F.broadcast(fences), by).where(v <= F.col("_hi"))
    counted = near.groupBy(*key, "_at", F.when(v >= F.col("_lo"), v).alias("_v")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*key).orderBy(F.asc_nulls_first("_v")))
    ranked = counted.withColumn("_upto", upto)

    def holds(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), v))

    picked = ranked.groupBy(*key, "_at").agg(holds(F.floor("_at")).alias("_a"), holds(F.ceil("_at")).alias("_b"))
    exact = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_at") - F.floor("_at"))
    wide = checkpointed(picked.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == n, exact)).alias(n) for n in probs]))
    missed = wide.where(" or ".join(f"`{n}` is null" for n in probs)).select(*by)
    if missed.isEmpty():
        return wide
    # A rank outside its fences, which a sketch leaves possible: these groups are sorted.
    return wide.join(missed, by, "left_anti").unionByName(sorted_quantiles(known.join(F.broadcast(missed), by), by, "_v", probs))


def _fences(sketched: DataFrame, key: list[str]) -> DataFrame:
    """Values around each rank ``_at`` from sketches of the ``_n`` values after the first ``_below``."""
    n, at = F.col("_n"), F.col("_at") - F.col("_below")
    first = F.greatest(F.least(F.floor((at / n - SKETCH_ERROR) * GRID), F.lit(GRID)), F.lit(0)).cast("int")
    last = F.least(F.greatest(F.ceil(((at + 1) / n + SKETCH_ERROR) * GRID), F.lit(0)), F.lit(GRID)).cast("int")
    values = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
    placed = sketched.where(n > 0).select(*key, "_at", values.alias("_values"), first.alias("_first"), last.alias("_last"), "_n")
    return placed.select(
        *key, "_at", F.get("_values", "_first").alias("_lo"), F.get("_values", "_last").alias("_hi"),
        ((F.col("_last") - F.col("_first")) * F.col("_n") / GRID).alias("_width"),
    )


def sorted_quantiles(
    df: DataFrame, by: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """The same by a sort over all values; no group's values have to fit into one task.

    The values are counted first, so equal values cost one row, and the ranks come from
    running totals.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    return weighted_quantiles(with_running_totals(counted, by, [value], {"_upto": "_n"}), by, value, probs)


def weighted_quantiles(ranked: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Quantiles of counted values: ``_n`` copies of ``value`` that end at rank ``_upto``."""
    totals = ranked.groupBy(*by).agg(F.max("_upto").alias("_total"))
    # One row per group (column and data set), so the broadcast is bounded by the columns checked.
    joined = ranked.join(F.broadcast(totals), by)
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1
    picks = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (rank >= first) & (rank <= last)
            picks.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{name}_{side}"))
    picked = joined.groupBy(*by).agg(F.max("_total").alias("_total"), *picks)
    cols = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        cols.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return picked.select(*by, *cols)
