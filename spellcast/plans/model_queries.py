"""Queries over binning, encoding, sampling, training, selection and artifacts."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spellcast.operators import binning, contributions, levels, sampling, scoring, selection, train
from spellcast.operators import evaluate as ev
from spellcast.plans.evaluation_queries import TRAIN_END, VAL_END, rounded
from spellcast.plans.registry import query
from spellcast.session import stored
from spellcast.sources import io
from spellcast.sources.fixtures import Fixtures

FEATURES = ["amount", "balance", "cycle", "segment_bin", "state_bin"]


def binned(spark, sf_dir):
    # Columns of customers look small enough to be broadcast up to millions of rows.
    df = Fixtures(spark, sf_dir).view("binned", merged=("customer",))
    return ev.date_split(df, "event_date", TRAIN_END, VAL_END)


def is_train():
    return F.col("split") == "train"


@query
def target_encode(spark, sf_dir):
    """Smoothed rates fitted on the training split, applied to every row."""
    df = binned(spark, sf_dir)
    training = df.where(is_train())
    mean = binning.global_rate(training, "target")
    rates = binning.target_rates(training, "state", "target", mean=mean)
    return rounded(binning.encode(df, rates, "state", mean, "state_rate").select("row_id", "state", "state_rate"))


@query
def tree_bins(spark, sf_dir):
    """Bin of every row by supervised binning of two columns, with its rows and event rate."""
    df = binned(spark, sf_dir)
    training = df.where(is_train())
    for col, bins in (("state", 4), ("taxonomygeneral", 4)):
        df = binning.fit_binner(training, col, "target", bins, min_rows=200).transform(df)
    return df.groupBy("state", "taxonomygeneral", "state_bin", "taxonomygeneral_bin").agg(
        F.count("*").alias("n"), F.sum("target").alias("positives")
    )


@query
def one_hot(spark, sf_dir):
    df = binned(spark, sf_dir).select("row_id", "segment", "taxonomygeneral")
    return binning.one_hot(df, binning.fit_levels(df, ["segment", "taxonomygeneral"]))


@query
def one_hot_table(spark, sf_dir):
    """Rows and encoded positions per level of two columns."""
    cols = ["segment", "taxonomygeneral"]
    df = binned(spark, sf_dir).select(*cols)
    coded = levels.fit_encoder(df, cols).transform(df)
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level"), F.array_position(vector_to_array(f"{c}_onehot"), 1.0).alias("position"))
        for c in cols
    ]
    return coded.select(F.inline(F.array(*cells))).groupBy("column_name", "level", "position").agg(F.count("*").alias("n"))


@query
def level_dictionary(spark, sf_dir):
    """Levels, rows and positions of three columns, one of them with a level for every few rows."""
    df = binned(spark, sf_dir).withColumn("cell", F.nullif(F.concat_ws("-", "state", "cycle"), F.lit("CHINA-7")))
    return levels.fit_dictionary(df, ["segment", "taxonomygeneral", "cell"])


@query
def level_positions(spark, sf_dir):
    """The position of every row's level, fitted on the training split; unseen levels come last."""
    df = binned(spark, sf_dir).withColumn("cell", F.concat_ws("-", "state", "cycle", "segment"))
    encoder = levels.fit_encoder(df.where(is_train() & (F.col("cycle") > 3)), ["cell"])
    return encoder.transform(df).select("row_id", F.col("cell_index").cast("long").alias("position"))


@query
def undersample(spark, sf_dir):
    """Training rows at two negatives per positive."""
    df = binned(spark, sf_dir).where(is_train())
    return sampling.undersample(df, ["row_id"], "target", ratio=2).select("row_id", "target")


@query
def undersample_counts(spark, sf_dir):
    """Rows per class before and after undersampling; the rest of the splits is untouched."""
    df = binned(spark, sf_dir)
    kept = sampling.undersample(df.where(is_train()), ["row_id"], "target", ratio=2)
    after = kept.unionByName(df.where(~is_train()))
    before = df.groupBy("split", "target").agg(F.count("*").alias("n_before"))
    return before.join(after.groupBy("split", "target").agg(F.count("*").alias("n_after")), ["split", "target"])


@query
def class_weights(spark, sf_dir):
    return rounded(sampling.class_weights(binned(spark, sf_dir).where(is_train()), "target"))


def model_rows(spark, sf_dir):
    """Rows with binned categories, fitted on the training split. The joins of the view are made once, as many fits read them."""
    df = stored(binned(spark, sf_dir).select("row_id", "split", "target", "amount", "balance", "cycle", "segment", "state"))
    training = df.where(is_train())
    for col in ("segment", "state"):
        df = binning.fit_binner(training, col, "target", min_rows=200).transform(df)
    return df


def fit_one(spark, sf_dir, name, overrides=None):
    df = model_rows(spark, sf_dir)
    kept = sampling.undersample(df.where(is_train()), ["row_id"], "target", ratio=2)
    val = df.where(F.col("split") == "val")
    return df, train.tune(name, kept, FEATURES, "target", ["row_id"], val, overrides)


@query
def fit_and_score(spark, sf_dir):
    """A logistic model fitted on undersampled training rows, scored on every row."""
    df, fitted = fit_one(spark, sf_dir, "LogisticRegression", {"C": [1.0]})
    return train.predict(fitted.model, df).select("row_id", "split", "target", F.round("prob", 6).alias("prob"))


@query
def tuning_log(spark, sf_dir):
    _, fitted = fit_one(
        spark, sf_dir, "DecisionTreeClassifier", {"maxDepth": [3, 5], "minInstancesPerNode": [100, 500]}
    )
    return train.tuning_log(spark, fitted, head=5)


@query
def feature_importance(spark, sf_dir):
    _, fitted = fit_one(spark, sf_dir, "GBTClassifier", {"maxIter": [10]})
    return train.feature_importance(spark, fitted)


@query
def correlation_select(spark, sf_dir):
    features = ["amount", "amount_twin", "balance", "cycle"]
    return rounded(selection.correlation_select(binned(spark, sf_dir), features, "target"), 6)


@query
def correlation_with_gaps(spark, sf_dir):
    """The same over columns with missing values, each pair over the rows that have both."""
    df = binned(spark, sf_dir)
    gaps = {
        "amount_gaps": F.when(F.col("row_id") % 3 != 0, F.col("amount")),
        "twin_gaps": F.when(F.col("row_id") % 5 < 3, F.col("amount_twin")),
        "balance_gaps": F.when((F.col("row_id") % 7 == 0) | (F.col("cycle") > 60), F.col("balance")),
    }
    features = ["balance", *gaps, "cycle"]
    return rounded(selection.correlation_select(df.withColumns(gaps), features, "target"), 6)


@query
def latest_version(spark, sf_dir):
    """The artifact changed last."""
    return io.newest(Fixtures(spark, sf_dir).view("artifacts"))


@query
def latest_per_model(spark, sf_dir):
    return io.latest_per_model(Fixtures(spark, sf_dir).view("artifacts"), "project")


@query
def tree_drivers(spark, sf_dir):
    """Top drivers of a boosted model by Shapley contributions, for every row."""
    df, fitted = fit_one(spark, sf_dir, "GBTClassifier")
    explained = contributions.tree_contributions(df, fitted.model, FEATURES)
    out = scoring.top_drivers(explained, top_n=3)
    return out.select("row_id", *[c for i in (1, 2, 3) for c in (f"optindriver_{i}", f"optindriver_{i}_value")])
