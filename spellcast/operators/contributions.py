"""Contributions of features to single scores: linear terms, and Shapley values of tree models.

The fitted model is a small artifact. Each row's contributions depend on that row alone, so rows
stay where they are: no shuffle, no driver. A level of an encoded column is a feature of its own,
``<column>_<level>``, with value 1 in rows that have it and 0 elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spellcast.operators import levels, scoring, train


@dataclass(frozen=True)
class Leaf:
    """A leaf's value and, per feature on its path, the value interval and training share."""

    value: float
    path: tuple[tuple[int, float, float, float], ...]  # feature, lower (exclusive), upper, share


def _leaves(node, weight: float, class_one: bool, path: dict[int, tuple[float, float, float]], out: list[Leaf]) -> None:
    if node.subtreeDepth() == 0:
        value = node.prediction()
        if class_one:
            stats = list(node.impurityStats().stats())
            value = stats[1] / sum(stats) if sum(stats) else 0.0
        out.append(Leaf(weight * value, tuple((f, *bounds) for f, bounds in path.items())))
        return
    feature, threshold = node.split().featureIndex(), node.split().threshold()
    total = node.impurityStats().count()
    lo, hi, share = path.get(feature, (-np.inf, np.inf, 1.0))
    for child, bounds in (
        (node.leftChild(), (lo, min(hi, threshold))),
        (node.rightChild(), (max(lo, threshold), hi)),
    ):
        part = child.impurityStats().count() / total if total else 0.0
        _leaves(child, weight, class_one, path | {feature: (*bounds, share * part)}, out)


def tree_leaves(model: PipelineModel) -> list[Leaf]:
    """Leaves of a fitted tree, forest or boosted model, weighted as in its output.

    Trees and forests give the positive probability, boosting its margin.
    """
    clf = model.stages[-1]
    trees = list(clf.trees) if hasattr(clf, "trees") else [clf]
    boosted = type(clf).__name__.startswith("GBT")
    weights = list(clf.treeWeights) if boosted else [1.0 / len(trees)] * len(trees)
    out: list[Leaf] = []
    for tree, w in zip(trees, weights):
        _leaves(tree._java_obj.rootNode(), w, not boosted, {}, out)
    return out


def shapley_function(leaves: list[Leaf]):
    """A pandas UDF: struct of feature values -> array of contributions.

    A leaf pays its value times, per path feature, 1 or 0 (feature known: inside the
    interval?) or the training share (unknown). For such a product the Shapley sum over
    coalitions is a polynomial in their size. Only plain tuples and library modules go to
    the workers.
    """
    plain = [(leaf.value, leaf.path) for leaf in leaves]

    @F.pandas_udf("array<double>")
    def explain(block: pd.DataFrame) -> pd.Series:
        x = block.to_numpy(dtype=float)
        phi = np.zeros(x.shape)
        for value, path in plain:
            m = len(path)
            # A missing value is NaN, which the model sends right at every split.
            known = [(~(x[:, f] <= lo) & ((x[:, f] <= hi) | np.isinf(hi))).astype(float) for f, lo, hi, _ in path]
            sizes = np.array([factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)])
            for i, (feature, _, _, share) in enumerate(path):
                by_size = np.zeros((m, len(x)))
                by_size[0] = 1.0
                for j, (_, _, _, other) in enumerate(path):
                    if j != i:
                        grown = by_size * other
                        grown[1:] += by_size[:-1] * known[j]
                        by_size = grown
                phi[:, feature] += value * (known[i] - share) * (sizes @ by_size)
        return pd.Series(list(phi))

    return explain


def _position_columns(encoder: levels.LevelEncoder, features: list[str], used: set[int]) -> dict[int, Column]:
    """The value of each used position of a model's vector, from a row's plain and index columns."""
    out, at = {}, 0
    for f, width in encoder.widths(features):
        if f not in encoder.vectors:
            out[at] = F.col(f).cast("double")
        else:
            index = F.col(f"{f[: -len(levels.VECTOR)]}{levels.INDEX}")
            out |= {at + k: (index == float(k)).cast("double") for k in range(width) if at + k in used}
        at += width
    return {i: c for i, c in out.items() if i in used}


def tree_contributions(df: DataFrame, model: PipelineModel, features: list[str], encoder: levels.LevelEncoder | None = None) -> DataFrame:
    """Add ``contributions`` (feature, contribution, value) for a tree model.

    Of an encoded column only the levels that the trees split on are features here; their number
    is bounded by that of the model's nodes.
    """
    encoder = encoder or levels.LevelEncoder({}, df.sparkSession.createDataFrame([], "column_name string, level string, n long, position long"))
    leaves = tree_leaves(model)
    plain = {i for i, (f, _) in enumerate(encoder.widths(features)) if f not in encoder.vectors}
    used = sorted({f for leaf in leaves for f, *_ in leaf.path} | plain)
    columns = _position_columns(encoder, features, set(used))
    place = {f: i for i, f in enumerate(used)}
    explain = shapley_function([Leaf(leaf.value, tuple((place[f], *rest) for f, *rest in leaf.path)) for leaf in leaves])
    names = _position_names(encoder, features, used)
    inputs = F.struct(*[columns[f].alias(f"_x{i}") for f, i in place.items()])
    phi = df.withColumn("_phi", explain(inputs))
    items = [
        F.struct(F.lit(names[f]).alias("feature"), F.get("_phi", i).alias("contribution"), columns[f].alias("value"))
        for f, i in place.items()
    ]
    return phi.withColumn("contributions", F.array(*items)).drop("_phi")


def _position_names(encoder: levels.LevelEncoder, features: list[str], used: list[int]) -> dict[int, str]:
    """Names of the given positions; those of levels are looked up in the dictionary."""
    names, wanted, at = {}, [], 0
    for f, width in encoder.widths(features):
        if f not in encoder.vectors:
            names[at] = f
        else:
            wanted += [(p, f[: -len(levels.VECTOR)], p - at) for p in used if at <= p < at + width]
        at += width
    if wanted:
        table = encoder.dictionary.sparkSession.createDataFrame(wanted, "at long, column_name string, position long")
        found = table.join(encoder.dictionary, ["column_name", "position"], "left")
        names |= {r["at"]: f"{r.column_name}_{'nan' if r.level is None else r.level}" for r in found.collect()}
    return names


def linear_contributions(
    df: DataFrame, model: PipelineModel, features: list[str], encoder: levels.LevelEncoder, top_n: int = scoring.TOP_DRIVERS
) -> DataFrame:
    """Add ``contributions`` of a linear model: coefficient times the value's distance from its training mean.

    Of an encoded column a row gets its own level and those absent levels that can be among the
    ``top_n`` of any row: these are the same for all rows but for the row's own level, so
    ``top_n + 1`` of a column are enough.
    """
    scaled, weights = train.scalers(model), model.stages[-1].coefficients.toArray()
    numbers = [f for f in features if f not in encoder.vectors]

    def terms(scaler, first: int):
        std = scaler.std.toArray()
        return weights[first : first + len(std)] / np.where(std == 0, 1.0, std), scaler.mean.toArray()

    weight, mean = terms(scaled[0], 0)
    plain = scoring.linear_contributions(df, dict(zip(numbers, weight)), dict(zip(numbers, mean)))
    coded = [f[: -len(levels.VECTOR)] for f in features if f in encoder.vectors]
    if not coded:
        return plain
    weight, mean = terms(scaled[1], len(numbers))
    at = 0
    for c in coded:
        width = max(encoder.sizes[c], 1)
        w, m = weight[at : at + width], mean[at : at + width]
        at += width
        frame = pd.DataFrame({"position": np.arange(width), "present": w * (1 - m), "absent": -w * m})
        of_column = encoder.dictionary.where(F.col("column_name") == c).select("position", F.concat_ws("_", F.lit(c), F.coalesce("level", F.lit("nan"))).alias("_feature"))
        table = df.sparkSession.createDataFrame(frame).join(of_column, "position")
        # A few rows: the absent levels with the largest terms, the first by name among equals.
        top = table.orderBy(F.abs("absent").desc(), "_feature").limit(top_n + 1).collect()
        others = F.array(*[
            F.struct(F.lit(r["_feature"]).alias("feature"), F.lit(r.absent).alias("contribution"), F.lit(0.0).alias("value"), F.lit(float(r.position)).alias("position"))
            for r in top
        ])
        mine = F.array(F.struct(F.col("_feature").alias("feature"), F.col("present").alias("contribution"), F.lit(1.0).alias("value")))
        index = F.col(f"{c}{levels.INDEX}")
        away = F.transform(F.filter(others, lambda x: x["position"] != index), lambda x: F.struct(x["feature"].alias("feature"), x["contribution"].alias("contribution"), x["value"].alias("value")))
        known = table.select(F.col("position").cast("double").alias("_at"), "_feature", "present")
        joined = plain.join(known, index == F.col("_at"), "left")
        own = F.when(F.col("_feature").isNotNull(), mine).otherwise(F.slice(mine, 1, 0))
        plain = joined.withColumn("contributions", F.concat("contributions", own, away)).drop("_at", "_feature", "present")
    return plain
