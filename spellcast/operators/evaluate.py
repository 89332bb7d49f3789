"""Evaluation of scored rows: bucket tables, cutoffs, ranking metrics, segments.

Scored rows are first reduced to one row per distinct score (``score_table``): count,
positives and their running totals. Ranking metrics and every cutoff-based table are
computed from it; only equal-count buckets, which may cut through tied scores, look at
single rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spellcast.functions.features import AGE_LABELS, age_label
from spellcast.operators.ranking import bucket_of, with_row_number, with_running_totals

N_BINS = (10, 20, 50, 100)
TOP_UPPER = 10.0  # fixed value: open upper bound of the top bucket
SEGMENTS = {"overall": None, "circle_backs": 0, "undecideds": 1}


# --- splits -------------------------------------------------------------------------------


def date_split(df: DataFrame, date_col: str, train_end: dt.date, val_end: dt.date) -> DataFrame:
    """Tag rows ``train`` before ``train_end``, ``val`` before ``val_end``, else ``oos``."""
    d = F.col(date_col)
    split = F.when(d < F.lit(train_end), "train").when(d < F.lit(val_end), "val").when(d.isNotNull(), "oos")
    return df.withColumn("split", split)


def split_summary(df: DataFrame, date_col: str) -> DataFrame:
    """Rows, date range and share per split, and whether it starts after the one before ends."""
    stats = df.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date")
    )
    rank = F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2)
    w = Window.orderBy("rank")  # three rows
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        stats.withColumn("rank", rank)
        .withColumn("share_pct", F.col("n_rows") * 100.0 / F.sum("n_rows").over(everything))
        .withColumn(
            "boundary_ok",
            F.coalesce(F.lag("last_date").over(w) < F.col("first_date"), F.lit(True)),
        )
        .drop("rank")
    )


# --- statistics of a bucket ---------------------------------------------------------------


def _rate_pct(pos: Column, n: Column) -> Column:
    return F.when(n > 0, pos * 100.0 / n).otherwise(F.lit(0.0))


def score_table(scored: DataFrame, by: list[str], prob: str = "prob", target: str = "target") -> DataFrame:
    """One row per group and distinct score, best first, with inclusive running totals."""
    counted = scored.groupBy(*by, F.col(prob).alias("prob")).agg(
        F.count("*").alias("n"), F.sum(F.coalesce(F.col(target), F.lit(0))).alias("pos")
    )
    return with_running_totals(counted, by, [F.desc("prob")], {"n_above": "n", "pos_above": "pos"})


def score_stats(scores: DataFrame, by: list[str]) -> DataFrame:
    """Count, positives, min, max, mean, median and sample deviation of counted scores.

    Groups must be contiguous in the table's score order (score intervals are).
    """
    n, p = F.col("n"), F.col("prob")
    basic = scores.groupBy(*by).agg(
        F.sum("n").alias("counts"),
        F.sum("pos").alias("positives"),
        F.min("prob").alias("min_prob"),
        F.max("prob").alias("max_prob"),
        (F.sum(n * p) / F.sum("n")).alias("mean_prob"),
        F.min(F.col("n_above") - n).alias("_before"),
    )
    count, last = F.col("counts"), F.col("n_above") - F.col("_before")

    def holds(rank: Column) -> Column:
        return F.max(F.when((rank > last - n) & (rank <= last), p))

    middle = (
        # One row per bucket, so the scores need no shuffle on the bucket.
        scores.join(F.broadcast(basic.select(*by, "counts", "mean_prob", "_before")), by)
        .groupBy(*by)
        .agg(
            F.sum(n * F.pow(p - F.col("mean_prob"), 2)).alias("_squares"),
            ((holds(F.floor((count + 1) / 2)) + holds(F.ceil((count + 1) / 2))) / 2).alias("median_prob"),
        )
    )
    spread = F.sqrt(F.col("_squares") / F.nullif(count - 1, F.lit(0)))
    return basic.join(middle, by).withColumn("std_prob", spread).drop("_before", "_squares")


# --- bucket tables and cutoffs ------------------------------------------------------------


def quantile_table(
    scored: DataFrame, key: list[str], n_bins: tuple[int, ...] = N_BINS, prob: str = "prob", target: str = "target"
) -> DataFrame:
    """Equal-count buckets by descending score, for several bucket numbers in one pass."""
    rows = with_row_number(
        scored.select(*key, F.col(prob).alias("prob"), F.coalesce(F.col(target), F.lit(0)).alias("target")),
        [F.desc("prob"), *key],
    )
    n_rows, n_pos = rows.agg(F.count("*"), F.sum("target")).first()  # two numbers
    total, positives = F.lit(n_rows).cast("long"), F.lit(n_pos or 0).cast("long")
    spread = rows.withColumn("n_bins", F.explode(F.array(*[F.lit(n) for n in n_bins]))).withColumn(
        "bucket", bucket_of(F.col("row_number"), total, F.col("n_bins"))
    )
    small, large = F.floor(total / F.col("n_bins")), total % F.col("n_bins")
    size = small + (F.col("bucket") <= large).cast("int")
    before = (F.col("bucket") - 1) * small + F.least(F.col("bucket") - 1, large)
    middle = F.col("row_number") - before
    in_middle = (middle == F.floor((size + 1) / 2)) | (middle == F.ceil((size + 1) / 2))
    return (
        spread.groupBy("n_bins", "bucket")
        .agg(
            F.count("*").alias("counts"),
            F.sum("target").alias("positives"),
            F.min("prob").alias("min_prob"),
            F.max("prob").alias("max_prob"),
            F.avg("prob").alias("mean_prob"),
            F.avg(F.when(in_middle, F.col("prob"))).alias("median_prob"),
            F.stddev_samp("prob").alias("std_prob"),
        )
        .withColumn("target_rate_pct", _rate_pct(F.col("positives"), F.col("counts")))
        .withColumn("overall_target_pct", _rate_pct(F.col("positives"), positives))
    )


def cutoffs(table: DataFrame) -> DataFrame:
    """Lower-inclusive, upper-exclusive score bounds per bucket of a quantile table.

    The top bucket is open above and the last one reaches down to 0. At most one row per
    bucket, so the windows are small.
    """
    w = Window.partitionBy("n_bins").orderBy("bucket")
    last = F.lead("bucket").over(w).isNull() & (F.col("n_bins") > 2)
    return table.select(
        "n_bins", "bucket",
        F.when(last, F.lit(0.0)).otherwise(F.col("min_prob")).alias("lower"),
        F.coalesce(F.lag("min_prob").over(w), F.lit(TOP_UPPER)).alias("upper"),
    )


def cutoff_list(bounds: DataFrame) -> dict[int, list[tuple[int, float, float]]]:
    """The bounds as Python numbers: ``sum(n_bins)`` rows, the size of the stored artifact."""
    out: dict[int, list[tuple[int, float, float]]] = {}
    for r in bounds.orderBy("n_bins", "bucket").collect():
        out.setdefault(r.n_bins, []).append((r.bucket, r.lower, r.upper))
    return out


def bucket_by_cutoffs(prob: Column, bounds: list[tuple[int, float, float]]) -> Column:
    """Bucket of a score by fixed bounds (best bucket first); NULL outside all of them.

    The bucket is one more than the number of lower bounds above the score.
    """
    lowers = F.array(*[F.lit(float(lower)) for _, lower, _ in bounds])
    inside = (prob >= F.lit(float(bounds[-1][1]))) & (prob < F.lit(float(bounds[0][2])))
    return F.when(inside, F.size(F.filter(lowers, lambda x: x > prob)) + 1)


def _empty_buckets(scores: DataFrame, by: list[str], bins: dict[int, list]) -> DataFrame:
    """Every bucket of every group, so that empty ones show up with 0."""
    every = F.array(*[F.struct(F.lit(n).alias("n_bins"), F.lit(b[0]).alias("bucket")) for n in bins for b in bins[n]])
    return scores.select(*by).distinct().select(*by, F.inline(every))


def apply_cutoffs(scores: DataFrame, bins: dict[int, list], by: list[str]) -> DataFrame:
    """Bucket table of each group by the given (training) cutoffs, from a score table."""
    tagged = scores.select(
        *by, "prob", "n", "pos", "n_above",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("n_bins"), bucket_by_cutoffs(F.col("prob"), b).alias("bucket"))
                    for n, b in bins.items()
                ]
            )
        ),
    ).where(F.col("bucket").isNotNull())
    stats = score_stats(tagged, [*by, "n_bins", "bucket"])
    totals = scores.groupBy(*by).agg(F.sum("pos").alias("_all"))
    zero = F.lit(0).cast("long")
    return (
        _empty_buckets(scores, by, bins)
        .join(stats, [*by, "n_bins", "bucket"], "left")
        .join(totals, by)
        .withColumn("counts", F.coalesce("counts", zero))
        .withColumn("positives", F.coalesce("positives", zero))
        .withColumn("target_rate_pct", _rate_pct(F.col("positives"), F.col("counts")))
        .withColumn("overall_target_pct", _rate_pct(F.col("positives"), F.col("_all")))
        .drop("_all")
    )


def by_segment(scored: DataFrame, flag: str = "firstaction_bool") -> DataFrame:
    """Each row under ``overall`` and under its own segment."""
    own = F.when(F.col(flag) == 0, "circle_backs").when(F.col(flag) == 1, "undecideds")
    return scored.withColumn("segment", F.explode(F.array_compact(F.array(F.lit("overall"), own))))


def age_table(scored: DataFrame, by: list[str], age: str = "account_age") -> DataFrame:
    """Bucket table by account-age band with lift, every band present."""
    banded = scored.withColumn("age_bin", age_label(F.col(age)))
    counted = banded.groupBy(*by, "age_bin", "prob").agg(
        F.count("*").alias("n"), F.sum("target").alias("pos")
    )
    scores = with_running_totals(counted, [*by, "age_bin"], [F.desc("prob")], {"n_above": "n", "pos_above": "pos"})
    stats = score_stats(scores.where(F.col("age_bin").isNotNull()), [*by, "age_bin"])
    totals = counted.groupBy(*by).agg(F.sum("n").alias("_rows"), F.sum("pos").alias("_all"))
    every = F.array(*[F.lit(x) for x in AGE_LABELS])
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    empty_as_zero = {
        c: F.coalesce(F.col(c), F.when(F.col("counts") == 0, none))
        for c in ("min_prob", "max_prob", "mean_prob", "median_prob", "std_prob")
    }
    base = F.when(F.col("_rows") > 0, F.col("_all") * 100.0 / F.col("_rows"))
    return (
        totals.withColumn("age_bin", F.explode(every))
        .join(stats, [*by, "age_bin"], "left")
        .withColumn("counts", F.coalesce("counts", zero))
        .withColumn("positives", F.coalesce("positives", zero))
        .withColumns(empty_as_zero)
        .withColumn("target_rate_pct", _rate_pct(F.col("positives"), F.col("counts")))
        .withColumn("overall_target_pct", _rate_pct(F.col("positives"), F.col("_all")))
        .withColumn("lift", F.when(base > 0, F.col("target_rate_pct") / base).otherwise(none))
        .drop("_rows", "_all")
    )


def with_equal_count(applied: DataFrame, table: DataFrame, group: dict[str, str]) -> DataFrame:
    """``applied`` with the rows of one group (the training split) taken from its own equal-count ``table``.

    Tied scores at a bound make the two differ: cutoffs keep ties together, equal counts do not.
    """
    is_group = F.lit(True)
    for column, value in group.items():
        is_group = is_group & (F.col(column) == value)
    own = table.select(*(F.lit(v).alias(c) for c, v in group.items()), "*")
    return applied.where(~is_group).unionByName(own)


def top_capture(table: DataFrame, by: list[str], n_bins: int = 20, top: int = 3) -> DataFrame:
    """Share of the positives in the best ``top`` of ``n_bins`` buckets (3 of 20: the top 15 %)."""
    return (
        table.where((F.col("n_bins") == n_bins) & (F.col("bucket") <= top))
        .groupBy(*by)
        .agg(F.sum("overall_target_pct").alias("top_capture_pct"))
    )


# --- ranking and threshold metrics --------------------------------------------------------


def auc_ap(scores: DataFrame, by: list[str]) -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision from a score table."""
    neg = F.col("n") - F.col("pos")
    parts = scores.groupBy(*by).agg(
        F.sum("pos").alias("_p"),
        F.sum(neg).alias("_n"),
        F.sum(neg * (F.col("pos_above") - F.col("pos") / F.lit(2.0))).alias("_wins"),
        F.sum(F.col("pos") * F.col("pos_above") / F.col("n_above")).alias("_precision"),
    )
    return parts.select(
        *by,
        F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_wins") / F.nullif(F.col("_p") * F.col("_n"), F.lit(0))).alias("roc_auc"),
        F.when(F.col("_p") > 0, F.col("_precision") / F.nullif(F.col("_p"), F.lit(0))).alias("average_precision"),
    )


def confusion(scored: DataFrame, by: list[str], threshold: float = 0.5) -> DataFrame:
    """Counts per actual and predicted class, all four present."""
    cells = F.array(
        *[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted")) for a in (0, 1) for p in (0, 1)]
    )
    counts = (
        scored.withColumn("predicted", (F.col("prob") >= threshold).cast("int"))
        .groupBy(*by, F.col("target").alias("actual"), "predicted")
        .agg(F.count("*").alias("n"))
    )
    every = counts.select(*by).distinct().select(*by, F.inline(cells))
    return every.join(counts, [*by, "actual", "predicted"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("long"))
    )


def _safe(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / F.nullif(den, F.lit(0))).otherwise(F.lit(0.0))


def _cells(matrix: DataFrame, by: list[str]) -> DataFrame:
    def cell(a, p):
        return F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n")).otherwise(0))

    return matrix.groupBy(*by).agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )


def threshold_metrics(matrix: DataFrame, by: list[str]) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; 0 for a zero division."""
    c = _cells(matrix, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        *by,
        _safe(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _safe(tp, tp + fp).alias("precision"),
        _safe(tp, tp + fn).alias("recall"),
        _safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(matrix: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    c = _cells(matrix, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    per_class = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                _safe(hit, hit + false_alarm).alias("precision"),
                _safe(hit, hit + miss).alias("recall"),
                _safe(2 * hit, 2 * hit + false_alarm + miss).alias("f1"),
                (hit + miss).alias("support"),
            )
            for label, hit, false_alarm, miss in (("0", tn, fn, fp), ("1", tp, fp, fn))
        ]
    )
    classes = c.select(*by, F.inline(per_class))
    metrics = ("precision", "recall", "f1")

    def average(label, weight):
        total = F.sum(weight)
        return classes.groupBy(*by).agg(
            *[(F.sum(F.col(m) * weight) / total).alias(m) for m in metrics], F.sum("support").alias("support")
        ).select(*by, F.lit(label).alias("label"), *metrics, "support")

    return classes.unionByName(average("macro avg", F.lit(1.0))).unionByName(
        average("weighted avg", F.col("support").cast("double"))
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Rank models by OOS top capture, then OOS AUC; one row per model and dataset.

    ``metrics``: model, dataset, roc_auc, accuracy, precision, recall, f1, top_capture_pct.
    One row per model is ranked.
    """
    w = Window.orderBy(F.desc("top_capture_pct"), F.desc("roc_auc"), "model")
    ranks = metrics.where(F.col("dataset") == "oos").select("model", F.row_number().over(w).alias("model_rank"))
    return metrics.join(ranks, "model")
