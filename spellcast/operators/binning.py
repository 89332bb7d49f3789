"""Supervised binning and one-hot encoding, fitted on training rows and applied elsewhere."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spellcast.operators.ranking import with_running_totals
from spellcast.session import checkpointed

SMOOTHING, MIN_BIN_ROWS = 100, 500
SAME_VALUE = 1e-7  # encoded values closer than this are one value


def global_rate(df: DataFrame, event: str) -> float:
    return df.agg(F.avg(event)).first()[0] or 0.0


def target_rates(df: DataFrame, col: str, event: str, smoothing: float = SMOOTHING, mean: float | None = None) -> DataFrame:
    """Smoothed event rate per category: ``(mean * n + global * m) / (n + m)``."""
    mean = global_rate(df, event) if mean is None else mean
    n, m = F.col("n"), F.lit(float(smoothing))
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.avg(event).alias("mean"), F.count(event).alias("n"))
        .withColumn("rate", (F.col("mean") * n + F.lit(float(mean)) * m) / (n + m))
    )


def encode(df: DataFrame, rates: DataFrame, col: str, mean: float, out: str) -> DataFrame:
    """Join the rate map; unseen and NULL categories get the global mean.

    Left to the optimizer whether the map is broadcast: it is when it is small.
    """
    mapping = rates.select(F.col(col).alias("_category"), F.col("rate").alias("_rate"))
    joined = df.join(mapping, df[col] == F.col("_category"), "left")
    return joined.withColumn(out, F.coalesce("_rate", F.lit(float(mean)))).drop("_category", "_rate")


@dataclass(frozen=True)
class Binner:
    """A fitted binner: rate map, split points, and the bin number of each leaf."""

    col: str
    mean: float
    rates: DataFrame
    thresholds: tuple[float, ...]
    bin_of_leaf: tuple[int, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``<col>_bin``: 1 for the lowest event rate."""
        x = F.col("_encoded").cast("float").cast("double")
        leaf = F.lit(0)
        for i, t in enumerate(self.thresholds):
            leaf = F.when(x > t, i + 1).otherwise(leaf)
        number = F.lit(0)
        for i, b in enumerate(self.bin_of_leaf):
            number = F.when(leaf == i, b).otherwise(number)
        return encode(df, self.rates, self.col, self.mean, "_encoded").withColumn(
            f"{self.col}_bin", number
        ).drop("_encoded")


def _gini_mass(pos: Column, neg: Column) -> Column:
    """Weighted count times gini impurity."""
    total = pos + neg
    return F.when(total > 0, 2 * pos * neg / F.when(total > 0, total))


def fit_binner(
    df: DataFrame, col: str, event: str, n_bins: int = 4, min_rows: int = MIN_BIN_ROWS, smoothing: float = SMOOTHING
) -> Binner:
    """Best-first gini splits of the encoded rate into at most ``n_bins`` leaves.

    The encoded rate is constant per category, so the rows are first counted per distinct
    rate, with running totals in rate order. Every candidate split of every leaf is then a
    column expression over that table and one aggregate finds the best; only split points
    come to the driver.
    """
    mean = global_rate(df, event)
    rates = checkpointed(target_rates(df, col, event, smoothing, mean))
    x = F.col("encoded").cast("float")
    y = F.coalesce(F.col(event), F.lit(0)).cast("long")
    counted = (
        encode(df, rates, col, mean, "encoded")
        .groupBy(x.alias("x"))
        .agg(
            F.count("*").alias("n"), F.sum(y).alias("pos"),
            F.count(event).alias("known"),
        )
    )
    totals = {"n_upto": "n", "pos_upto": "pos", "known_upto": "known"}
    ranked = checkpointed(
        with_running_totals(counted, [], ["x"], totals).withColumn("x", F.col("x").cast("double"))
    )
    n_all, p_all = ranked.agg(F.max("n_upto"), F.max("pos_upto")).first()
    if not n_all:
        return Binner(col, mean, rates, (), (1,))
    weight_pos = n_all / (2.0 * p_all) if p_all else 0.0
    weight_neg = n_all / (2.0 * (n_all - p_all)) if n_all > p_all else 0.0

    # A leaf is (n, pos) before it and (n, pos) at its end, in running totals.
    def best_split(lo: tuple[int, int], hi: tuple[int, int]):
        inside = ranked.where((F.col("n_upto") > lo[0]) & (F.col("n_upto") <= hi[0]))
        left_n, left_pos = F.col("n_upto") - lo[0], F.col("pos_upto") - lo[1]
        right_n, right_pos = F.lit(hi[0]) - F.col("n_upto"), F.lit(hi[1]) - F.col("pos_upto")
        masses = [
            _gini_mass(p * F.lit(weight_pos), (n - p) * F.lit(weight_neg))
            for n, p in ((left_n, left_pos), (right_n, right_pos))
        ]
        whole_pos = (hi[1] - lo[1]) * weight_pos
        whole_neg = (hi[0] - lo[0] - hi[1] + lo[1]) * weight_neg
        if whole_pos <= 0 or whole_neg <= 0:
            return None  # pure
        gain = F.lit(2 * whole_pos * whole_neg / (whole_pos + whole_neg)) - masses[0] - masses[1]
        candidates = inside.where((left_n >= min_rows) & (right_n >= min_rows)).select(
            gain.alias("gain"), "x", "n_upto", "pos_upto"
        )
        best = candidates.orderBy(F.desc("gain"), "x").first()  # one row
        if best is None:
            return None
        after = ranked.where(F.col("n_upto") > best.n_upto).agg(F.min("x")).first()[0]
        if after - best.x <= SAME_VALUE:
            return None
        return best.gain, (best.x + after) / 2.0, (best.n_upto, best.pos_upto)

    leaves = [((0, 0), (n_all, p_all))]
    splits = {leaves[0]: best_split(*leaves[0])}
    thresholds: list[float] = []
    while len(leaves) < n_bins:
        open_leaves = [leaf for leaf in leaves if splits[leaf] is not None]
        if not open_leaves:
            break
        leaf = max(open_leaves, key=lambda k: splits[k][0])
        _, threshold, middle = splits[leaf]
        thresholds.append(threshold)
        parts = [(leaf[0], middle), (middle, leaf[1])]
        at = leaves.index(leaf)
        leaves[at : at + 1] = parts
        for p in parts:
            splits[p] = best_split(*p)
    event_rate = [(hi[1] - lo[1]) / max(hi[0] - lo[0], 1) for lo, hi in leaves]
    order = sorted(range(len(leaves)), key=lambda i: (event_rate[i], i))
    bin_of_leaf = tuple(order.index(i) + 1 for i in range(len(leaves)))
    return Binner(col, mean, rates, tuple(sorted(thresholds)), bin_of_leaf)


# --- one-hot ------------------------------------------------------------------------------


def categorical_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    """Columns to one-hot encode: everything that is not a number, in name order."""
    return sorted(
        f.name for f in df.schema if f.name not in exclude and not isinstance(f.dataType, T.NumericType)
    )


def fit_levels(df: DataFrame, cols: list[str]) -> dict[str, list[str | None]]:
    """Sorted levels per column; NULL, if present, is a level of its own at the end.

    For columns that the caller names to be widened by ``one_hot``, where every level becomes a
    column of the table. Runs encode with ``levels.LevelEncoder``, which holds no levels.
    """
    levels: dict[str, list[str | None]] = {c: [] for c in cols}
    return levels | stored_levels(levels_table(df, cols)) if cols else levels


def one_hot(df: DataFrame, levels: dict[str, list[str | None]]) -> DataFrame:
    """One 0/1 column ``<column>_<level>`` per fitted level; unseen levels are all 0."""
    cols = []
    for c, values in levels.items():
        for v in values:
            hit = F.col(c).isNull() if v is None else F.coalesce(F.col(c).cast("string") == v, F.lit(False))
            cols.append(hit.cast("int").alias(f"{c}_{'nan' if v is None else v}"))
    rest = [F.col(c) for c in df.columns if c not in levels]
    return df.select(*rest, *cols)


def levels_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """The fitted levels as a table, the form in which an encoder is stored."""
    out = None
    for c in cols:
        part = df.select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")).distinct()
        out = part if out is None else out.unionByName(part)
    return out


def stored_levels(table: DataFrame) -> dict[str, list[str | None]]:
    """Read a stored encoder; its size is the number of encoded columns."""
    levels: dict[str, list[str | None]] = {}
    for r in table.orderBy("column_name", F.asc_nulls_last("level")).collect():
        levels.setdefault(r.column_name, []).append(r.level)
    return levels
