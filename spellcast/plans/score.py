"""Batch scoring: scan, prepare, encode, score, rank, explain, assemble."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spellcast.config import ROW_KEY, Settings
from spellcast.functions import features as fx
from spellcast.operators import binning, contributions, levels, scoring, train
from spellcast.plans import retrain
from spellcast.session import checkpointed
from spellcast.sources import io


def prepare(rows: DataFrame, levels: dict[str, list[str | None]], time_col: str = "duration") -> DataFrame:
    """Lean features and a widened one-hot encoding; other columns pass through."""
    return binning.one_hot(fx.scoring_features(rows, time_col), levels)


def prepare_retrained(
    rows: DataFrame, s: Settings, binners: dict[str, binning.Binner], encoder: levels.LevelEncoder,
    time_col: str = "duration",
) -> DataFrame:
    """New rows for a retrained model: the features of the training run, its stored bins and levels.

    Rows whose payer-sponsored flag is unknown are scored, though not trained on.
    """
    df = fx.engineer(fx.fill_and_filter(rows, time_col, null_policy="tolerant"), s.focus_payer, time_col)
    for b in binners.values():
        fx.require_columns(df, [b.col], "rows to bin")
        df = b.transform(df)
    fx.require_columns(df, list(encoder.sizes), "rows to encode")
    return encoder.transform(df)


def score(
    prepared: DataFrame, model: PipelineModel, features: list[str], tier_cutoffs: dict[str, float],
    decile_cutoffs: dict[str, float],
) -> DataFrame:
    """Probability, tier and decile of every row; missing model features are an error."""
    fx.require_columns(prepared, features, "prepared rows")
    scored = train.predict(model, prepared, "opt_in_probability")
    p = F.col("opt_in_probability")
    return scored.withColumns(
        {"opt_in_category": scoring.tier(p, tier_cutoffs), "decile": scoring.decile(p, decile_cutoffs)}
    )


def drivers(
    scored: DataFrame, model: PipelineModel, features: list[str], encoder: levels.LevelEncoder,
    descriptions: dict[str, str] | None = None,
) -> DataFrame:
    """Top drivers of every row, by the model's kind: linear terms or Shapley contributions of trees.

    Models with neither coefficients nor trees get none.
    """
    clf = model.stages[-1]
    if hasattr(clf, "coefficients"):
        explained = contributions.linear_contributions(scored, model, features, encoder)
    elif hasattr(clf, "featureImportances"):
        explained = contributions.tree_contributions(scored, model, features, encoder)
    else:
        explained = scored.withColumn("contributions", F.lit(None).cast("array<struct<feature:string,contribution:double,value:double>>"))
    return scoring.top_drivers(explained, descriptions)


def output(scored: DataFrame, features: list[str], ids: list[str] = ROW_KEY) -> DataFrame:
    """The output table: ids, features, probability, tier, both orders, drivers."""
    return scoring.output_select(scoring.call_order(scored, ids), ids, features)


@dataclass(frozen=True)
class Scored:
    """What a scoring run made: its rows, where they went, how many, and the tier shares."""

    rows: DataFrame
    table: str | None
    n: int
    tiers: DataFrame


def run(
    spark: SparkSession, rows: DataFrame, s: Settings, catalog: io.Catalog, model_name: str, stamp: str,
    tier_cutoffs: dict[str, float], decile_cutoffs: dict[str, float], table: str | None = None,
    descriptions: dict[str, str] | None = None, time_col: str = "duration", base: str | None = None,
) -> Scored:
    """Score ``rows`` (``io.scan_since`` of the training table's kind) with a stored retraining run.

    Loads the run's model, bins and levels, prepares the rows as in training, and writes one row a
    snapshot: ids, model features (encoded columns by their own names), probability, tier, orders
    and drivers. The model sees every row once, as the scored rows are written before they are ordered.
    """
    models = catalog.path("models")
    model, features = io.load_model(spark, f"{models}/{catalog.project}__{model_name}__{stamp}")
    binners, encoder = retrain.load_encoders(spark, f"{models}/{catalog.project}__encoders__{stamp}")
    named = rows.toDF(*[c.lower() for c in rows.columns])
    prepared = prepare_retrained(named, s, binners, encoder, time_col)
    explained = drivers(score(prepared, model, features, tier_cutoffs, decile_cutoffs), model, features, encoder, descriptions)
    shown = [f for f in features if f not in encoder.vectors] + list(encoder.sizes)
    kept = ROW_KEY + [f for f in shown if f not in ROW_KEY] + [c for c in explained.columns if c in scoring.ADDED_COLUMNS]
    scored = checkpointed(explained.select(*kept))
    out = output(scored, shown)
    if table is not None:
        io.write_output(out, table, base)
        out = spark.table(table)
    return Scored(out, table, scored.count(), scoring.tier_distribution(scored))
