"""The retraining run: split, check, engineer, bin, encode, fit, evaluate."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spellcast.config import ROW_KEY, Settings
from spellcast.functions import features as fx
from spellcast.operators import binning, levels, quality, sampling, train
from spellcast.operators import evaluate as ev
from spellcast.session import checkpointed
from spellcast.sources import io


@dataclass(frozen=True)
class RetrainConfig:
    train_end: dt.date
    val_end: dt.date
    target: str = "opt_in_ach"
    time_col: str = "duration"
    date_col: str = "date_end"
    undersample_ratio: float | None = 200
    models: tuple[str, ...] = ("RandomForestClassifier", "GBTClassifier", "LogisticRegression")
    overrides: dict[str, dict] = field(default_factory=dict)
    n_bins: tuple[int, ...] = ev.N_BINS
    min_bin_rows: int = binning.MIN_BIN_ROWS
    # Columns binned by target rate, with the number of bins.
    binned: tuple[tuple[str, int], ...] = (("state", 4), ("taxonomygeneral", 4), ("state_tax_interact", 5))
    not_considered: tuple[str, ...] = ("tpid", "last_optout_note", "last_optout_note_last_year")


@dataclass
class RetrainResult:
    splits: DataFrame
    checks: dict[str, DataFrame]
    encoded: DataFrame
    binners: dict[str, binning.Binner]
    encoder: levels.LevelEncoder
    features: list[str]
    fitted: dict[str, train.Fitted]
    scored: DataFrame
    tables: DataFrame
    age: DataFrame
    leaderboard: DataFrame
    metadata: dict


def unique_rows(rows: DataFrame, key: list[str] = ROW_KEY) -> DataFrame:
    """``rows`` without exact repeats; different rows of one key are an error.

    Keys are counted first, on narrow rows; whole rows are only compared where a key repeats.
    """
    repeated = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return rows
    once = rows.dropDuplicates()
    left = once.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").first()
    if left is not None:
        raise ValueError(f"different rows with the key {left.asDict()}")
    return once


def prepare(rows: DataFrame, s: Settings, cfg: RetrainConfig) -> DataFrame:
    """Filter, fill, engineer and split the training table.

    Rows whose payer-sponsored flag is unknown are not trained on; scoring keeps them
    (``score.prepare_retrained``).
    """
    rows = unique_rows(rows)
    df = fx.engineer(fx.fill_and_filter(rows, cfg.time_col), s.focus_payer, cfg.time_col)
    fx.require_columns(df, [cfg.date_col, cfg.target], "training table")
    return ev.date_split(df, cfg.date_col, cfg.train_end, cfg.val_end)


def drift_checks(df: DataFrame, cfg: RetrainConfig) -> dict[str, DataFrame]:
    """All checks of training against validation and against OOS."""
    out = {}
    wide = df.drop(*cfg.not_considered)
    sets = {n: wide.where(F.col("split") == n).drop("split") for n in ("train", "val", "oos")}
    tagged = sets["train"].withColumn("dataset", F.lit(quality.TRAIN))
    routes = quality.column_routing(tagged, ("providercreatedon", "date_start", "date_end")).collect()
    by = {r: [x.column_name for x in routes if x.route == r] for r in ("numeric", "category", "long_tail")}
    for other in ("val", "oos"):
        out[other] = quality.run_all_checks(
            sets["train"], sets[other], ROW_KEY, by["numeric"], by["category"], by["long_tail"]
        )
    return out


def fit_encoders(df: DataFrame, cfg: RetrainConfig):
    """Fit binners and level dictionaries on the training split and apply them to all rows."""
    training = df.where(F.col("split") == "train")
    binners = {}
    for col, n in cfg.binned:
        if fx.has(df, col):
            binners[col] = binning.fit_binner(training, col, cfg.target, n, cfg.min_bin_rows)
            df = binners[col].transform(df)
    keep = ROW_KEY + ["split", cfg.target, cfg.time_col]
    selected = fx.select_available(df, keep + [f for f in fx.SELECTED_FEATURES if f not in keep])
    cats = binning.categorical_columns(selected, keep)
    encoder = levels.fit_encoder(selected.where(F.col("split") == "train"), cats)
    encoded = encoder.transform(selected)
    ids = set(ROW_KEY) | {"split", cfg.target, *cats}
    numbers = [c for c in selected.columns if c not in ids]
    return binners, encoder, encoded, numbers + encoder.vectors


def evaluate(df: DataFrame, fitted: dict[str, train.Fitted], cfg: RetrainConfig):
    """Score all splits with every model; bucket tables, age tables and the leaderboard."""
    key = ROW_KEY
    parts = []
    for name, f in fitted.items():
        if f.model is not None:
            scored = train.predict(f.model, df).withColumn("target", F.col(cfg.target))
            parts.append(
                scored.select(
                    F.lit(name).alias("model"), *key, "split", "target", "prob", "firstaction_bool", "account_age"
                )
            )
    if not parts:
        raise RuntimeError(f"no model was fitted: { {n: f.error for n, f in fitted.items()} }")
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    scored = checkpointed(scored)
    by = ["model", "split", "segment"]
    scores = checkpointed(ev.score_table(ev.by_segment(scored), by))
    tables = None
    for name in fitted:
        own = scored.where((F.col("model") == name) & (F.col("split") == "train"))
        if own.isEmpty():
            continue
        table = checkpointed(ev.quantile_table(own, key, cfg.n_bins))
        bins = ev.cutoff_list(ev.cutoffs(table))
        part = ev.apply_cutoffs(scores.where(F.col("model") == name), bins, by)
        part = ev.with_equal_count(part, table, {"model": name, "split": "train", "segment": "overall"})
        tables = part if tables is None else tables.unionByName(part)
    tables = checkpointed(tables)
    overall = scores.where(F.col("segment") == "overall").drop("segment")
    pair = ["model", "split"]
    captures = ev.top_capture(tables.where(F.col("segment") == "overall"), pair)
    metrics = (
        ev.auc_ap(overall, pair)
        .join(ev.threshold_metrics(ev.confusion(scored, pair), pair), pair)
        .join(captures, pair)
        .withColumnRenamed("split", "dataset")
    )
    age = ev.age_table(ev.by_segment(scored), by)
    return scored, tables, age, ev.leaderboard(metrics)


def retrain(rows: DataFrame, s: Settings, cfg: RetrainConfig, with_checks: bool = True) -> RetrainResult:
    df = checkpointed(prepare(rows, s, cfg))
    checks = drift_checks(df, cfg) if with_checks else {}
    binners, encoder, encoded, features = fit_encoders(df, cfg)
    encoded = checkpointed(encoded)
    training = encoded.where(F.col("split") == "train")
    if cfg.undersample_ratio is not None:
        training = sampling.undersample(training, ROW_KEY, cfg.target, cfg.undersample_ratio)
    training = checkpointed(training)
    fitted = train.fit_all(
        list(cfg.models), training, features, cfg.target, ROW_KEY,
        encoded.where(F.col("split") == "val"), cfg.overrides, encoder,
    )
    scored, tables, age, board = evaluate(encoded, fitted, cfg)
    metadata = train.selection_metadata(
        "project", features, cfg.target, list(cfg.models),
        sampling.imbalance_ratio(training, cfg.target), cfg.undersample_ratio, io.run_stamp(),
        {name: f.error for name, f in fitted.items() if f.error},
    )
    return RetrainResult(
        ev.split_summary(df, cfg.date_col), checks, encoded, binners, encoder, features, fitted, scored, tables, age, board, metadata
    )


def store_encoders(spark: SparkSession, binners: dict[str, binning.Binner], encoder: levels.LevelEncoder, path: str) -> None:
    """Write the fitted binners and dictionary: rate maps and levels as tables, the rest as documents."""
    for col, b in binners.items():
        b.rates.select(col, "rate").write.mode("overwrite").parquet(f"{path}/rates/{col}")
    fitted = {c: {"mean": b.mean, "thresholds": b.thresholds, "bin_of_leaf": b.bin_of_leaf} for c, b in binners.items()}
    io.write_json(spark, {"binners": fitted}, f"{path}/settings")
    encoder.store(f"{path}/levels")


def load_encoders(spark: SparkSession, path: str) -> tuple[dict[str, binning.Binner], levels.LevelEncoder]:
    """The binners and the dictionary that ``store_encoders`` wrote."""
    settings = io.read_json(spark, f"{path}/settings")
    binners = {
        col: binning.Binner(col, b["mean"], spark.read.parquet(f"{path}/rates/{col}"), tuple(b["thresholds"]), tuple(b["bin_of_leaf"]))
        for col, b in settings["binners"].items()
    }
    return binners, levels.load_encoder(spark, f"{path}/levels")


def store(spark: SparkSession, result: RetrainResult, catalog: io.Catalog, stamp: str) -> None:
    """Write splits, models, encoders, checks, logs, importances, result tables and metadata of a run."""
    for split in ("train", "val", "oos"):
        io.write_run(result.encoded.where(F.col("split") == split), catalog.path(f"preprocessed_{split}"), stamp, sort_by=["date_end"])
    store_encoders(spark, result.binners, result.encoder, f"{catalog.path('models')}/{catalog.project}__encoders__{stamp}")
    results = catalog.path("results")
    for other, checks in result.checks.items():
        io.write_run(checks, f"{results}/checks_{other}", stamp)
    done = [f for f in result.fitted.values() if f.model is not None]
    for f in done:
        io.write_run(train.tuning_log(spark, f), f"{results}/tuning_log/{f.name}", stamp)
        io.write_run(train.feature_importance(spark, f, result.encoder), f"{results}/feature_importance/{f.name}", stamp)
    for name, f in result.fitted.items():
        if f.model is not None:
            path = f"{catalog.path('models')}/{catalog.project}__{name}__{stamp}"
            io.save_model(spark, f.model, f.features, path)
    for name, df in (("tables", result.tables), ("age", result.age), ("leaderboard", result.leaderboard)):
        io.write_run(df, f"{catalog.path('results')}/{name}", stamp)
    io.write_json(spark, result.metadata, f"{catalog.path('models')}/{catalog.project}__selection_metadata__{stamp}")
