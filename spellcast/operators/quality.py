"""Consistency and drift checks between a reference and a compared set.

Both sets are one DataFrame with a ``dataset`` column (``train`` and ``cmp``), so each check
is one scan: wide conditional aggregates for per-column statistics, and one long
(column, value) count for everything about value shares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spellcast.operators.ranking import exact_quantiles

TRAIN, CMP = "train", "cmp"
# Thresholds of the checks (shares in 0..1, points in 0..100).
ZERO_NULL_PCT, MOST_NULL_PCT, NULL_POINTS = 0.05, 70.0, 10.0
LONG_TAIL_HEAD, LENGTH_HEAD, SHARE_TOLERANCE = 0.03, 0.05, 0.1
OUTLIER_POINTS, FENCE = 10.0, 1.5
SHIFT_TOLERANCE = 0.1
CATEGORY_LIMIT = 50


def stack_splits(splits: dict[str, DataFrame], tag: str = "dataset") -> DataFrame:
    """Named splits as one DataFrame; columns missing in a split are NULL."""
    out = None
    for name, df in splits.items():
        part = df.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _is_numeric(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def numeric_columns(df: DataFrame, ignore: tuple[str, ...] = ("dataset",)) -> list[str]:
    return [f.name for f in df.schema if _is_numeric(f.dataType) and f.name not in ignore]


def other_columns(df: DataFrame, ignore: tuple[str, ...] = ("dataset",)) -> list[str]:
    return [f.name for f in df.schema if not _is_numeric(f.dataType) and f.name not in ignore]


def _of(dataset: str) -> Column:
    return F.col("dataset") == dataset


def long_form(df: DataFrame, cols: list[str], value) -> DataFrame:
    """One row per cell: ``dataset``, ``column_name``, ``value``."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), value(F.col(c)).alias("value")) for c in cols])
    return df.select("dataset", F.inline(cells))


def _from_wide(df: DataFrame, stats: dict[str, dict[str, Column]]) -> DataFrame:
    """Aggregate ``{column: {stat: aggregate}}`` in one pass and turn it into rows."""
    flat = df.agg(*[agg.alias(f"{c}|{s}") for c, by in stats.items() for s, agg in by.items()])
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}|{s}`").alias(s) for s in by])
        for c, by in stats.items()
    ]
    return flat.select(F.inline(F.array(*rows)))


# --- structure ----------------------------------------------------------------------------


def schema_and_types(train: DataFrame, cmp: DataFrame) -> DataFrame:
    """Every column of either set: presence, type and non-null values in each."""
    types_a, types_b = dict(train.dtypes), dict(cmp.dtypes)
    names = list(types_a) + [c for c in types_b if c not in types_a]

    def counts(df: DataFrame, have: dict[str, str], out: str) -> DataFrame:
        flat = df.agg(*[F.count(c).alias(c) for c in have])
        return flat.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(out)) for c in have]))
        )

    joined = counts(train, types_a, "train_values").join(
        counts(cmp, types_b, "cmp_values"), "column_name", "full_outer"
    )

    def lookup(have: dict[str, str]) -> Column:
        out = F.lit(None).cast("string")
        for c in names:
            if c in have:
                out = F.when(F.col("column_name") == c, have[c]).otherwise(out)
        return out

    a, b = lookup(types_a), lookup(types_b)
    return joined.select(
        "column_name", a.alias("train_type"), b.alias("cmp_type"), "train_values", "cmp_values",
        (a.isNotNull() & b.isNotNull()).alias("schema_passed"),
        F.when(a.isNotNull() & b.isNotNull(), a == b).alias("type_passed"),
    )


def duplicate_check(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key, per dataset; all columns without a subset.

    A missing subset column fails the check.
    """
    cols = subset or [c for c in df.columns if c != "dataset"]
    if [c for c in cols if c not in df.columns]:
        return df.groupBy("dataset").agg(
            F.count("*").alias("n_rows"),
            F.lit(None).cast("long").alias("duplicates"),
            F.lit(None).cast("double").alias("duplicate_pct"),
            F.lit(False).alias("passed"),
        )
    grouped = df.groupBy("dataset", *cols).agg(F.count("*").alias("_n"))
    return grouped.groupBy("dataset").agg(
        F.sum("_n").alias("n_rows"),
        F.sum(F.col("_n") - 1).alias("duplicates"),
        (F.sum(F.col("_n") - 1) * 100.0 / F.sum("_n")).alias("duplicate_pct"),
        (F.sum(F.col("_n") - 1) == 0).alias("passed"),
    )


# --- missing values -----------------------------------------------------------------------


def missing_check(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null shares of both sets in points, the rule that applies, and the verdict."""

    def pct(c, d):
        return F.avg(F.when(_of(d), F.col(c).isNull().cast("int"))) * 100.0

    wide = _from_wide(df, {c: {"train_pct": pct(c, TRAIN), "cmp_pct": pct(c, CMP)} for c in cols})
    a, b = F.col("train_pct"), F.col("cmp_pct")
    rule = F.when(a < ZERO_NULL_PCT, "none").when(a < MOST_NULL_PCT, "within").otherwise("unchecked")
    passed = (
        F.when(rule == "none", b <= ZERO_NULL_PCT)
        .when(rule == "within", b.between(a - NULL_POINTS, a + NULL_POINTS))
        .otherwise(True)
    )
    return wide.withColumns({"rule": rule, "passed": passed})


# --- value shares -------------------------------------------------------------------------


def value_shares(long: DataFrame) -> DataFrame:
    """Share of each value per column in both sets (NULL values left out)."""
    counts = (
        long.where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(
            F.count(F.when(_of(TRAIN), 1)).alias("train_n"),
            F.count(F.when(_of(CMP), 1)).alias("cmp_n"),
        )
    )
    totals = counts.groupBy("column_name").agg(F.sum("train_n").alias("_a"), F.sum("cmp_n").alias("_b"))

    def share(n, total):
        return F.coalesce(F.col(n) / F.nullif(F.col(total).cast("double"), F.lit(0.0)), F.lit(0.0))

    # One row per checked column; the values need no shuffle on the column's name.
    return counts.join(F.broadcast(totals), "column_name").select(
        "column_name", "value", "train_n", "cmp_n",
        share("train_n", "_a").alias("train_share"), share("cmp_n", "_b").alias("cmp_share"),
    )


def _head_and_tail(shares: DataFrame, head: float) -> DataFrame:
    """Head values compared one by one, tail values in total; new values are reported only."""
    a, b = F.col("train_share"), F.col("cmp_share")
    is_head, is_tail = a > head, (F.col("train_n") > 0) & (a <= head)

    def total(on, share):
        return F.sum(F.when(on, share).otherwise(0.0))

    out = shares.groupBy("column_name").agg(
        F.coalesce(F.max(F.when(is_head, F.abs(a - b))), F.lit(0.0)).alias("head_max_diff"),
        F.abs(total(is_tail, a) - total(is_tail, b)).alias("tail_diff"),
        total(F.col("train_n") == 0, b).alias("new_share"),
    )
    ok = (F.col("head_max_diff") <= SHARE_TOLERANCE) & (F.col("tail_diff") <= SHARE_TOLERANCE)
    return out.withColumn("passed", ok)


def long_tail_check(df: DataFrame, cols: list[str]) -> DataFrame:
    return _head_and_tail(value_shares(long_form(df, cols, lambda c: c.cast("string"))), LONG_TAIL_HEAD)


def length_check(df: DataFrame, cols: list[str]) -> DataFrame:
    """The same over text lengths; NULL counts as the text ``nan``."""
    lengths = long_form(df, cols, lambda c: F.length(F.coalesce(c.cast("string"), F.lit("nan"))))
    return _head_and_tail(value_shares(lengths), LENGTH_HEAD)


def _normal_text(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c.cast("string"), F.lit("nan")), F.lit(" \t\n\r\f\v")))


def unique_check(df: DataFrame, cols: list[str]) -> DataFrame:
    """Largest share difference over all values of either set, compared trimmed and upper-cased."""
    shares = value_shares(long_form(df, cols, _normal_text))
    diff = F.abs(F.col("train_share") - F.col("cmp_share"))
    out = shares.groupBy("column_name").agg(
        F.count("*").alias("values"),
        F.max(diff).alias("max_diff"),
        F.count(F.when(diff > SHARE_TOLERANCE, 1)).alias("shifted"),
    )
    return out.withColumn("passed", F.col("shifted") == 0)


def top_values(df: DataFrame, cols: list[str], top: int = 10) -> DataFrame:
    """The most frequent values of each column and dataset with their shares."""
    shares = value_shares(long_form(df, cols, _normal_text))
    both = F.array(
        F.struct(F.lit(TRAIN).alias("dataset"), F.col("train_n").alias("n"), F.col("train_share").alias("share")),
        F.struct(F.lit(CMP).alias("dataset"), F.col("cmp_n").alias("n"), F.col("cmp_share").alias("share")),
    )
    w = Window.partitionBy("column_name", "dataset").orderBy(F.desc("n"), "value")
    return (
        shares.select("column_name", "value", F.inline(both))
        .where(F.col("n") > 0)
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= top)
    )


def column_routing(df: DataFrame, not_considered: tuple[str, ...] = (), limit: int = CATEGORY_LIMIT) -> DataFrame:
    """Which checks a column takes: numeric, category (few values) or long tail."""
    train = df.where(_of(TRAIN))
    texts = [c for c in other_columns(df) if c not in not_considered]
    shares = long_form(train, texts, lambda c: c.cast("string")).groupBy("column_name", "value").agg(F.lit(1))
    distinct = shares.groupBy("column_name").agg(F.count("value").alias("distinct_values"))
    routed = distinct.withColumn(
        "route", F.when(F.col("distinct_values") < limit, "category").otherwise("long_tail")
    )
    nums = numeric_columns(df)
    numeric = train.agg(*[F.count(c).alias(c) for c in nums]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name")) for c in nums]))
    ).select("column_name", F.lit(None).cast("long").alias("distinct_values"), F.lit("numeric").alias("route"))
    return routed.unionByName(numeric)


# --- numeric distributions ----------------------------------------------------------------


def _long_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    return long_form(df, cols, lambda c: c.cast("double"))


def outlier_check(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null / below / within / above shares against fences around the training P10 and P90."""
    train = _long_numbers(df.where(_of(TRAIN)), cols)
    bounds = exact_quantiles(train, ["column_name"], "value", {"p10": 0.1, "p90": 0.9})
    fences = {r.column_name: (r.p10, r.p90) for r in bounds.collect()}  # one row per column
    names = ("nulls", "below", "within", "above")
    stats: dict[str, dict[str, Column]] = {}
    for c in cols:
        p10, p90 = fences.get(c, (None, None))
        spread = None if p10 is None else FENCE * (p90 - p10)
        lo = F.lit(None if p10 is None else p10 - spread).cast("double")
        hi = F.lit(None if p10 is None else p90 + spread).cast("double")
        x = F.col(c).cast("double")
        tests = (x.isNull(), x < lo, (x >= lo) & (x <= hi), x > hi)
        stats[c] = {
            f"{d}_{n}": F.avg(F.when(_of(d), F.coalesce(t, F.lit(False)).cast("int"))) * 100.0
            for d in (TRAIN, CMP)
            for n, t in zip(names, tests)
        } | {"lower": F.max(lo), "upper": F.max(hi)}
    wide = _from_wide(df, stats)
    worst = F.greatest(*[F.abs(F.col(f"{TRAIN}_{n}") - F.col(f"{CMP}_{n}")) for n in names])
    return wide.withColumn("passed", F.coalesce(worst <= OUTLIER_POINTS, F.lit(True)))


def distribution_check(df: DataFrame, cols: list[str], key_features: tuple[str, ...] = ()) -> DataFrame:
    """Relative shift of mean and median against the training value, larger than 10 %."""
    long = _long_numbers(df, cols)
    means = long.groupBy("dataset", "column_name").agg(F.avg("value").alias("mean"))
    medians = exact_quantiles(long, ["dataset", "column_name"], "value", {"median": 0.5})
    both = means.join(medians, ["dataset", "column_name"], "left").select(
        "dataset", "column_name",
        F.inline(
            F.array(
                F.struct(F.lit("Mean").alias("statistic"), F.col("mean").alias("v")),
                F.struct(F.lit("Median").alias("statistic"), F.col("median").alias("v")),
            )
        ),
    )
    paired = both.groupBy("column_name", "statistic").agg(
        F.max(F.when(_of(TRAIN), F.col("v"))).alias("train_value"),
        F.max(F.when(_of(CMP), F.col("v"))).alias("cmp_value"),
    )
    a, b = F.col("train_value"), F.col("cmp_value")
    change = (b - a) / F.nullif(a, F.lit(0.0))
    return paired.withColumns(
        {
            "key_feature": F.col("column_name").isin(*key_features) if key_features else F.lit(False),
            "percent_diff": change * 100.0,
            "passed": F.coalesce(F.abs(change) <= SHIFT_TOLERANCE, F.lit(True)),
        }
    )


def drift_table(distribution: DataFrame) -> DataFrame:
    """Failed mean / median rows, key features first, by descending difference."""
    return distribution.where(~F.col("passed")).orderBy(
        F.desc("key_feature"), F.desc("percent_diff"), "column_name", "statistic"
    )


# --- all checks ---------------------------------------------------------------------------

# Check name -> does a failure only warn?
CHECKS = {
    "Schema Check": False,
    "Data Type Check": False,
    "Duplicate Check": True,
    "Missing Value Check": True,
    "Long Tail Check": True,
    "Length Distribution Check": True,
    "Outlier Check": True,
    "Unique Value Check": True,
    "Data Distribution Check": True,
}


def run_all_checks(
    train: DataFrame, cmp: DataFrame, key: list[str], numeric: list[str], categories: list[str], long_tail: list[str]
) -> DataFrame:
    """Status per check: number of columns (or datasets) checked and failed.

    Columns that one set lacks or has in another type fail the structural checks and are left out
    of the others, which compare values.
    """
    other = {f.name: f.dataType for f in cmp.schema}
    comparable = [f.name for f in train.schema if other.get(f.name) == f.dataType]
    numeric, categories, long_tail = ([c for c in cols if c in comparable] for cols in (numeric, categories, long_tail))
    df = stack_splits({TRAIN: train.select(comparable), CMP: cmp.select(comparable)})
    structure = schema_and_types(train, cmp)
    none = structure.limit(0).select(F.col("schema_passed").alias("passed"))
    parts = {
        "Schema Check": structure.select(F.col("schema_passed").alias("passed")),
        "Data Type Check": structure.where(F.col("type_passed").isNotNull()).select(
            F.col("type_passed").alias("passed")
        ),
        "Duplicate Check": duplicate_check(df, key),
        "Missing Value Check": missing_check(df, numeric + categories + long_tail) if numeric + categories + long_tail else none,
        "Long Tail Check": long_tail_check(df, long_tail) if long_tail else none,
        "Length Distribution Check": length_check(df, long_tail) if long_tail else none,
        "Outlier Check": outlier_check(df, numeric) if numeric else none,
        "Unique Value Check": unique_check(df, categories) if categories else none,
        "Data Distribution Check": distribution_check(df, numeric) if numeric else none,
    }
    out = None
    for name, checks in parts.items():
        row = checks.agg(
            F.count("*").alias("checked"), F.count(F.when(~F.col("passed"), 1)).alias("failed")
        ).select(
            F.lit(name).alias("check_name"), "checked", "failed",
            F.when(F.col("failed") == 0, "PASS").otherwise("WARNING" if CHECKS[name] else "FAIL").alias("status"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def verdict(checks: DataFrame) -> DataFrame:
    """FAIL on structure; PASS with WARNING on any other failure but lengths; else PASS."""
    structural = F.col("check_name").isin("Schema Check", "Data Type Check")
    counted = F.col("check_name") != "Length Distribution Check"
    failed = F.col("failed") > 0
    return checks.agg(
        F.count(F.when(failed, 1)).alias("failed_checks"),
        F.when(F.bool_or(structural & failed), "FAIL")
        .when(F.bool_or(counted & failed), "PASS with WARNING")
        .otherwise("PASS")
        .alias("overall_status"),
    )


# --- profile ------------------------------------------------------------------------------


def profile(df: DataFrame, numeric: list[str], others: list[str]) -> DataFrame:
    """Per dataset and column: counts, nulls, distinct values, the most frequent text (the first of
    equals), range, moments and quantiles."""
    text = long_form(df, numeric + others, lambda c: c.cast("string"))
    counts = text.groupBy("dataset", "column_name", "value").agg(F.count("*").alias("n"))
    common = counts.groupBy("dataset", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0).cast("long")).alias("nulls"),
        F.count("value").alias("distinct_values"),
        F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("top_count"),
        F.min_by("value", F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), "value"))).alias("top_value"),
    ).withColumn("top_value", F.when(F.col("column_name").isin(*others) if others else F.lit(False), F.col("top_value")))
    numbers = _long_numbers(df, numeric)
    moments = numbers.groupBy("dataset", "column_name").agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
    )
    quantiles = exact_quantiles(
        numbers, ["dataset", "column_name"], "value",
        {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95},
    )
    on = ["dataset", "column_name"]
    return common.join(moments, on, "left").join(quantiles, on, "left")
