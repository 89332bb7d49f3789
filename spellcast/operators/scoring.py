"""Scoring: tiers, deciles, call order, drivers and the output table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spellcast.functions.features import require_columns
from spellcast.operators.ranking import with_row_number

TIERS = ["Very High", "High", "Medium", "Low", "Very Low"]
# Published tier and decile cutoffs of the two model versions.
TIER_CUTOFFS = {
    "june": {"Very_High": 0.9265154600143433, "High": 0.837108314037323, "Medium": 0.6145570874214172,
             "Low": 0.1990978866815567},
    "august": {"Very_High": 0.9083800315856934, "High": 0.8074964880943298, "Medium": 0.6120331883430481,
               "Low": 0.2822922468185425},
}
DECILE_CUTOFFS = {
    "june": {"d10_min": 0.837108314037323, "d9_min": 0.7237868189811707, "d8_min": 0.5499414205551147,
             "d7_min": 0.260936975479126, "d6_min": 0.12891486287117004, "d5_min": 0.08646047115325928,
             "d4_min": 0.04218757525086403, "d3_min": 0.016799243167042732, "d2_min": 0.003420546418055892},
    "august": {"d10_min": 0.8074965596199037, "d9_min": 0.7013646960258484, "d8_min": 0.5664723455905911,
               "d7_min": 0.37565165758132935, "d6_min": 0.18801242113113403, "d5_min": 0.11993496119976044,
               "d4_min": 0.07894247770309448, "d3_min": 0.06678836792707443, "d2_min": 0.03930756449699402},
}
TOP_DRIVERS = 5
DRIVER_THRESHOLD = 0.005


def known_score(prob: Column) -> Column:
    """The score, NULL for NaN, which Spark would order above every number."""
    return F.when(~F.isnan(prob), prob)


def tier(prob: Column, cutoffs: dict[str, float]) -> Column:
    """Five tiers by lower-inclusive cutoffs; a row without a score (NULL or NaN) is in the last."""
    prob = known_score(prob)
    out = F.when(prob >= cutoffs["Very_High"], TIERS[0])
    for name, label in (("High", TIERS[1]), ("Medium", TIERS[2]), ("Low", TIERS[3])):
        out = out.when(prob >= cutoffs[name], label)
    return out.otherwise(TIERS[4])


def decile(prob: Column, cutoffs: dict[str, float]) -> Column:
    """Decile 1 (best) to 10 by nine lower-inclusive thresholds; rows without a score are in the last."""
    prob = known_score(prob)
    out = F.when(prob >= cutoffs["d10_min"], 1)
    for i in range(9, 1, -1):
        out = out.when(prob >= cutoffs[f"d{i}_min"], 11 - i)
    return out.otherwise(10)


def tier_rank(category: Column) -> Column:
    out = F.when(category == TIERS[0], 0)
    for i, label in enumerate(TIERS[1:], 1):
        out = out.when(category == label, i)
    return out


def call_order(scored: DataFrame, key: list[str], category: str = "opt_in_category", prob: str = "opt_in_probability") -> DataFrame:
    """Number the rows by tier, then descending score, over all rows and within the tier.

    Only tier, score and key are sorted and numbered; the numbers are then joined to the rows by
    the unique key (NULL equals NULL). ``scored`` is read twice, so pass rows that are stored when
    they are dear to compute. One global numbering serves both orders: the rank in a tier is the
    global rank less the rows of the tiers before it (five rows). Rows without a score come last
    in their tier.
    """
    narrow = scored.select(F.col(category).alias("_tier"), known_score(F.col(prob)).alias("_score"), *(F.col(k).alias(f"_{k}") for k in key))
    own = [f"_{k}" for k in key]
    numbered = with_row_number(narrow, [tier_rank(F.col("_tier")), F.col("_score").desc_nulls_last(), *own], "call_target_order")
    firsts = numbered.groupBy(F.col("_tier").alias("_of")).agg(F.min("call_target_order").alias("_first"))
    ranks = numbered.join(F.broadcast(firsts), F.col("_tier").eqNullSafe(F.col("_of"))).select(
        *own, "call_target_order", (F.col("call_target_order") - F.col("_first") + 1).alias("opt_in_order_within_category")
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(key, own)])
    return scored.join(ranks, same).drop(*own)


def campaign_flag(category: Column) -> Column:
    """1 for the top tier."""
    return F.when(category == TIERS[0], 1).otherwise(0)


def tier_distribution(scored: DataFrame, category: str = "opt_in_category") -> DataFrame:
    """Share of rows per tier in tier order, 0 for absent tiers."""
    counts = scored.groupBy(category).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    labels = total.select(
        "total", F.posexplode(F.array(*[F.lit(t) for t in TIERS])).alias("tier_order", category)
    )
    return labels.join(counts, category, "left").select(
        category, "tier_order",
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        F.coalesce(F.col("n") * 100.0 / F.col("total"), F.lit(0.0)).alias("share_pct"),
    )


def score_decile_table(scored: DataFrame, cutoffs: dict[str, float], prob: str = "prob", target: str = "target") -> DataFrame:
    """Deciles 1..10 by fixed thresholds with rate, capture and lift, empty ones included."""
    counts = (
        scored.withColumn("decile", decile(F.col(prob), cutoffs))
        .groupBy("decile")
        .agg(
            F.count("*").alias("counts"), F.sum(target).alias("positives"),
            F.round(F.min(prob), 6).alias("min_prob"), F.round(F.max(prob), 6).alias("max_prob"),
        )
    )
    total = counts.agg(F.sum("counts").alias("_rows"), F.sum("positives").alias("_all"))
    every = total.withColumn("decile", F.explode(F.sequence(F.lit(1), F.lit(10))))
    zero = F.lit(0).cast("long")
    rate = F.when(F.col("counts") > 0, F.col("positives") * 100.0 / F.col("counts")).otherwise(0.0)
    captured = F.when(F.col("_all") > 0, F.col("positives") * 100.0 / F.col("_all")).otherwise(0.0)
    base = F.when(F.col("_rows") > 0, F.col("_all") * 1.0 / F.col("_rows"))
    lift = F.when(base > 0, (rate / 100) / F.when(base > 0, base)).otherwise(0.0)
    return (
        every.join(counts, "decile", "left")
        .withColumn("counts", F.coalesce("counts", zero))
        .withColumn("positives", F.coalesce("positives", zero))
        .select(
            "decile", "counts", "positives",
            F.round(rate, 4).alias("target_rate_pct"),
            F.round(captured, 4).alias("overall_target_pct"),
            F.round(lift, 4).alias("lift"),
            "min_prob", "max_prob",
        )
    )


def linear_contributions(df: DataFrame, coefficients: dict[str, float], means: dict[str, float]) -> DataFrame:
    """``contributions``: per feature ``coefficient * (value - mean)`` with its value.

    Pure column arithmetic; exact for a linear model on its margin.
    """
    items = [
        F.struct(
            F.lit(name).alias("feature"),
            (F.lit(float(w)) * (F.col(name).cast("double") - F.lit(float(means[name])))).alias("contribution"),
            F.col(name).cast("double").alias("value"),
        )
        for name, w in coefficients.items()
    ]
    return df.withColumn("contributions", F.array(*items))


def top_drivers(
    df: DataFrame, descriptions: dict[str, str] | None = None, top_n: int = TOP_DRIVERS, threshold: float = DRIVER_THRESHOLD
) -> DataFrame:
    """The ``top_n`` largest contributions by magnitude, at least ``threshold``, as columns.

    Ties order by feature name; missing ranks are NULL.
    """
    strong = F.filter("contributions", lambda x: F.abs(x["contribution"]) >= threshold)
    keyed = F.transform(
        strong,
        lambda x: F.struct(
            (-F.abs(x["contribution"])).alias("rank"), x["feature"].alias("feature"), x["value"].alias("value")
        ),
    )
    best = F.slice(F.array_sort(keyed), 1, top_n)
    out = df.withColumn("_best", best)
    for i in range(top_n):
        item = F.try_element_at("_best", F.lit(i + 1))
        name = item["feature"]
        for feature, text in (descriptions or {}).items():
            name = F.when(item["feature"] == feature, text).otherwise(name)
        out = out.withColumns({f"optindriver_{i + 1}": name, f"optindriver_{i + 1}_value": item["value"]})
    return out.drop("_best", "contributions")


ADDED_COLUMNS = [
    "opt_in_probability", "opt_in_category", "opt_in_order_within_category", "call_target_order",
    *[c for i in range(1, TOP_DRIVERS + 1) for c in (f"optindriver_{i}", f"optindriver_{i}_value")],
]


def output_select(df: DataFrame, ids: list[str], features: list[str]) -> DataFrame:
    """Ids, model features and the added columns that exist, names in upper case."""
    require_columns(df, ids, "scored output")
    require_columns(df, features, "scored output")
    cols = ids + [f for f in features if f not in ids] + [c for c in ADDED_COLUMNS if c in df.columns]
    return df.select(*[F.col(c).alias(c.upper()) for c in cols])


# --- tier fitting and reference tables ----------------------------------------------------

# Cumulative share of the training rows down to each tier's cutoff.
TIER_SHARES = {"Very_High": 0.02, "High": 0.10, "Medium": 0.27, "Low": 0.44}


def tier_cutoffs_fit(scored: DataFrame, key: list[str], shares: dict[str, float] = TIER_SHARES, prob: str = "prob") -> DataFrame:
    """Score at each tier's rank position on the training rows."""
    ranked = with_row_number(scored.select(*key, F.col(prob).alias("prob")), [F.desc("prob"), *key])
    total = ranked.agg(F.count("*").alias("total"))
    positions = total.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("tier"),
                        F.greatest(F.floor(F.col("total") * F.lit(share)), F.lit(1)).alias("row_number"),
                    )
                    for name, share in shares.items()
                ]
            )
        )
    )
    # Four positions, known before any data is read.
    return ranked.join(F.broadcast(positions), "row_number").select("tier", "row_number", F.col("prob").alias("cutoff"))


def tier_table(scored: DataFrame, category: str = "opt_in_category", target: str = "target") -> DataFrame:
    """Share, rate, capture and lift per tier, with the cumulative outreach list over top tiers."""
    counts = scored.groupBy(category).agg(F.count("*").alias("n"), F.sum(target).alias("positives"))
    w = Window.orderBy(tier_rank(F.col(category)))  # five rows
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    all_n, all_pos = F.sum("n").over(whole), F.nullif(F.sum("positives").over(whole), F.lit(0))
    return counts.select(
        category, "n", "positives",
        (F.col("n") * 100.0 / all_n).alias("share_pct"),
        (F.col("positives") * 100.0 / F.col("n")).alias("rate_pct"),
        (F.col("positives") * 100.0 / all_pos).alias("capture_pct"),
        ((F.col("positives") / F.col("n")) / (all_pos / all_n)).alias("lift"),
        F.sum("n").over(running).alias("list_size"),
        (F.sum("positives").over(running) * 100.0 / all_pos).alias("list_capture_pct"),
    )


def outreach_scenarios(tiers: DataFrame, category: str = "opt_in_category") -> DataFrame:
    """Cumulative list size and capture for calling the best one, two and three tiers."""
    return tiers.where(F.col(category).isin(*TIERS[:3])).select(
        (tier_rank(F.col(category)) + 1).alias("scenario"), "list_size", "list_capture_pct"
    )


def segment_reference(table: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per segment: size, base rate and the first decile's count, rate, lift and capture.

    ``table`` is a cutoff table by segment, ``sizes`` has rows and positives per segment.
    """
    first = table.where((F.col("n_bins") == 10) & (F.col("bucket") == 1))
    base = F.col("segment_positives") * 100.0 / F.col("segment_rows")
    return first.join(sizes, "segment").select(
        "segment", "segment_rows", base.alias("base_rate_pct"),
        F.col("counts").alias("decile1_count"),
        F.col("target_rate_pct").alias("decile1_rate_pct"),
        F.when(base > 0, F.col("target_rate_pct") / F.when(base > 0, base)).alias("decile1_lift"),
        F.col("overall_target_pct").alias("decile1_capture_pct"),
    )


def champion_compare(champion: DataFrame, previous: DataFrame) -> DataFrame:
    """First-decile lift by segment of two models and their quotient."""
    a = champion.select("segment", F.col("decile1_lift").alias("champion_lift"))
    b = previous.select("segment", F.col("decile1_lift").alias("previous_lift"))
    gain = F.when(F.col("previous_lift") != 0, F.col("champion_lift") / F.nullif("previous_lift", F.lit(0.0)))
    return a.join(b, "segment", "full_outer").withColumn("lift_gain", gain)
