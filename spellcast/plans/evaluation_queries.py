"""Queries over scored rows: splits, bucket tables, metrics, tiers, order and drivers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spellcast.operators import evaluate as ev
from spellcast.operators import scoring as sc
from spellcast.plans.registry import query
from spellcast.session import checkpointed
from spellcast.sources.fixtures import Fixtures

TRAIN_END, VAL_END = dt.date(1999, 1, 1), dt.date(2000, 1, 1)
COEFFICIENTS = {"account_age": 0.0004, "amount": -0.000002, "firstaction_bool": 0.8, "day_of_year": 0.003}
DESCRIPTIONS = {"account_age": "Age of the account in days", "amount": "Amount of the last order"}


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every floating column; sums differ in their last digits between engines."""
    return df.select(*[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def scored(spark, sf_dir) -> DataFrame:
    return ev.date_split(Fixtures(spark, sf_dir).view("scored"), "event_date", TRAIN_END, VAL_END)


def scored_models(spark, sf_dir) -> DataFrame:
    """The scored rows under two models, the second a coarser score."""
    mixed = F.col("prob") * 0.6 + F.pmod(F.col("row_id") * 31, F.lit(97)) / 97.0 * 0.4
    second = F.floor(mixed * 997.0) / 997.0
    models = F.array(
        F.struct(F.lit("champion").alias("model"), F.col("prob").alias("p")),
        F.struct(F.lit("previous").alias("model"), second.alias("p")),
    )
    df = scored(spark, sf_dir)
    return df.select("*", F.inline(models)).drop("prob").withColumnRenamed("p", "prob")


def train_table(df: DataFrame, n_bins=ev.N_BINS) -> DataFrame:
    """Equal-count buckets of the training split."""
    return ev.quantile_table(df.where(F.col("split") == "train"), ["row_id"], n_bins)


def train_cutoffs(df: DataFrame, n_bins=ev.N_BINS):
    """Cutoffs fitted on the training split."""
    return ev.cutoff_list(ev.cutoffs(train_table(df, n_bins)))


def panels(df: DataFrame, scores: DataFrame, group: dict[str, str], by: list[str], n_bins=ev.N_BINS) -> DataFrame:
    """Bucket tables of one model: its training ``group`` by equal counts, all else by the cutoffs of these."""
    table = checkpointed(train_table(df, n_bins))
    return ev.with_equal_count(ev.apply_cutoffs(scores, ev.cutoff_list(ev.cutoffs(table)), by), table, group)


@query
def date_split(spark, sf_dir):
    return scored(spark, sf_dir).select("row_id", "event_date", "split")


@query
def split_summary(spark, sf_dir):
    return rounded(ev.split_summary(scored(spark, sf_dir), "event_date"))


@query
def quantile_table(spark, sf_dir):
    train = scored(spark, sf_dir).where(F.col("split") == "train")
    return rounded(ev.quantile_table(train, ["row_id"]))


@query
def cutoffs(spark, sf_dir):
    train = scored(spark, sf_dir).where(F.col("split") == "train")
    return ev.cutoffs(ev.quantile_table(train, ["row_id"]))


@query
def apply_cutoffs(spark, sf_dir):
    """Validation and OOS bucket tables by the training cutoffs."""
    df = scored(spark, sf_dir)
    scores = ev.score_table(df.where(F.col("split") != "train"), ["split"])
    return rounded(ev.apply_cutoffs(scores, train_cutoffs(df), ["split"]))


@query
def segment_deciles(spark, sf_dir):
    df = scored(spark, sf_dir)
    scores = ev.score_table(ev.by_segment(df), ["split", "segment"])
    return rounded(ev.apply_cutoffs(scores, train_cutoffs(df, (10, 20)), ["split", "segment"]))


@query
def age_table(spark, sf_dir):
    return rounded(ev.age_table(ev.by_segment(scored(spark, sf_dir)), ["split", "segment"]))


@query
def top15_capture(spark, sf_dir):
    df = scored(spark, sf_dir)
    scores = ev.score_table(df, ["split"])
    return rounded(ev.top_capture(panels(df, scores, {"split": "train"}, ["split"], (20,)), ["split"]))


@query
def auc_ap(spark, sf_dir):
    return rounded(ev.auc_ap(ev.score_table(scored_models(spark, sf_dir), ["model", "split"]), ["model", "split"]))


@query
def confusion(spark, sf_dir):
    return ev.confusion(scored_models(spark, sf_dir), ["model", "split"])


@query
def class_report(spark, sf_dir):
    matrix = ev.confusion(scored_models(spark, sf_dir), ["model", "split"])
    return rounded(ev.class_report(matrix, ["model", "split"]))


def model_metrics(df: DataFrame) -> DataFrame:
    """One row per model and dataset: AUC, threshold metrics and top capture."""
    by = ["model", "split"]
    scores = ev.score_table(df, by)
    captures = None
    for model in ("champion", "previous"):
        group = {"model": model, "split": "train"}
        own = F.col("model") == model
        part = ev.top_capture(panels(df.where(own), scores.where(own), group, by, (20,)), by)
        captures = part if captures is None else captures.unionByName(part)
    return (
        ev.auc_ap(scores, by)
        .join(ev.threshold_metrics(ev.confusion(df, by), by), by)
        .join(captures, by)
        .withColumnRenamed("split", "dataset")
    )


@query
def leaderboard(spark, sf_dir):
    return rounded(ev.leaderboard(model_metrics(scored_models(spark, sf_dir))))


@query
def results_long(spark, sf_dir):
    """Every bucket table of both models in long form, the content of the result workbook."""
    df = scored_models(spark, sf_dir)
    by = ["model", "split", "segment"]
    scores = checkpointed(ev.score_table(ev.by_segment(df), by))
    out = None
    for model in ("champion", "previous"):
        group = {"model": model, "split": "train", "segment": "overall"}
        own = F.col("model") == model
        part = panels(df.where(own), scores.where(own), group, by)
        out = part if out is None else out.unionByName(part)
    return rounded(out.withColumnRenamed("split", "dataset"))


# --- scoring ------------------------------------------------------------------------------


def tiered(spark, sf_dir) -> DataFrame:
    df = scored(spark, sf_dir)
    return df.withColumn("opt_in_category", sc.tier(F.col("prob"), sc.TIER_CUTOFFS["august"])).withColumnRenamed(
        "prob", "opt_in_probability"
    )


@query
def tier_assign(spark, sf_dir):
    df = tiered(spark, sf_dir)
    return df.select(
        "row_id", "opt_in_category",
        sc.tier(F.col("opt_in_probability"), sc.TIER_CUTOFFS["june"]).alias("june_category"),
        sc.campaign_flag(F.col("opt_in_category")).alias("campaign_flag"),
    )


@query
def decile_assign(spark, sf_dir):
    df = scored(spark, sf_dir)
    return df.select(
        "row_id", *[sc.decile(F.col("prob"), c).alias(f"decile_{v}") for v, c in sc.DECILE_CUTOFFS.items()]
    )


@query
def call_order(spark, sf_dir):
    df = sc.call_order(tiered(spark, sf_dir), ["row_id"])
    return df.select("row_id", "opt_in_category", "opt_in_probability", "call_target_order", "opt_in_order_within_category")


@query
def tier_distribution(spark, sf_dir):
    return rounded(sc.tier_distribution(tiered(spark, sf_dir)))


@query
def score_decile_table(spark, sf_dir):
    return sc.score_decile_table(scored(spark, sf_dir), sc.DECILE_CUTOFFS["august"])


def contributions(spark, sf_dir) -> DataFrame:
    """Linear contributions around the feature means, with the row id."""
    df = scored(spark, sf_dir).withColumn("day_of_year", F.dayofyear("event_date"))
    # One row of means, the size of the model's feature list.
    means = df.agg(*[F.round(F.avg(c), 6).alias(c) for c in COEFFICIENTS]).first().asDict()
    return sc.linear_contributions(df, COEFFICIENTS, means)


@query
def linear_contributions(spark, sf_dir):
    return contributions(spark, sf_dir).select("row_id", F.inline("contributions"))


@query
def top_drivers(spark, sf_dir):
    df = sc.top_drivers(contributions(spark, sf_dir), DESCRIPTIONS, top_n=3, threshold=0.3)
    return df.select("row_id", *[c for i in (1, 2, 3) for c in (f"optindriver_{i}", f"optindriver_{i}_value")])


@query
def output_select(spark, sf_dir):
    """The scored output table: ids, features, score, tier, both orders and drivers."""
    df = sc.top_drivers(contributions(spark, sf_dir), DESCRIPTIONS).withColumn(
        "opt_in_category", sc.tier(F.col("prob"), sc.TIER_CUTOFFS["august"])
    ).withColumnRenamed("prob", "opt_in_probability")
    return sc.output_select(sc.call_order(df, ["row_id"]), ["row_id", "event_date"], list(COEFFICIENTS))


# --- tier fitting and reference tables ----------------------------------------------------


@query
def tier_cutoffs_fit(spark, sf_dir):
    return sc.tier_cutoffs_fit(scored(spark, sf_dir).where(F.col("split") == "train"), ["row_id"])


@query
def tier_table(spark, sf_dir):
    return rounded(sc.tier_table(tiered(spark, sf_dir)))


@query
def outreach_scenarios(spark, sf_dir):
    return rounded(sc.outreach_scenarios(sc.tier_table(tiered(spark, sf_dir))))


def reference_of(df: DataFrame) -> DataFrame:
    """OOS decile-1 reference of one model's rows."""
    oos = ev.by_segment(df.where(F.col("split") == "oos"))
    table = ev.apply_cutoffs(ev.score_table(oos, ["segment"]), train_cutoffs(df, (10,)), ["segment"])
    sizes = oos.groupBy("segment").agg(
        F.count("*").alias("segment_rows"), F.sum("target").alias("segment_positives")
    )
    return sc.segment_reference(table, sizes)


@query
def segment_reference(spark, sf_dir):
    return rounded(reference_of(scored(spark, sf_dir)))


@query
def champion_compare(spark, sf_dir):
    df = scored_models(spark, sf_dir)
    a, b = (reference_of(df.where(F.col("model") == m)) for m in ("champion", "previous"))
    return rounded(sc.champion_compare(a, b))
