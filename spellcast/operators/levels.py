"""Sparse encoding of categorical columns with any number of levels.

The levels of all columns form one table, the dictionary. A level's position is its rank within
its column, NULL last, from a range-partitioned numbering, and rows get positions by joins, so
neither the driver nor one task holds the levels of a column. A row's vector has one entry a
column, whatever the number of levels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spellcast.operators.ranking import with_row_number
from spellcast.session import checkpointed
from spellcast.sources import io

VECTOR, INDEX = "_onehot", "_index"


def level_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column and level (NULL is one) with its number of rows, from one scan."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")) for c in cols]
    return df.select(F.inline(F.array(*cells))).groupBy("column_name", "level").agg(F.count("*").alias("n"))


def fit_dictionary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows (column_name, level, n, position): levels in text order from position 0, NULL at the end."""
    counted = level_counts(df, cols)
    numbered = with_row_number(counted, ["column_name", F.col("level").asc_nulls_last()], "_row")
    firsts = numbered.groupBy("column_name").agg(F.min("_row").alias("_first"))
    # One row a column.
    return numbered.join(F.broadcast(firsts), "column_name").select(
        "column_name", "level", "n", (F.col("_row") - F.col("_first")).alias("position")
    )


@dataclass(frozen=True)
class LevelEncoder:
    """A fitted dictionary, with the number of levels of each column."""

    sizes: dict[str, int]
    dictionary: DataFrame

    @property
    def vectors(self) -> list[str]:
        return [f"{c}{VECTOR}" for c in self.sizes]

    def index(self, df: DataFrame) -> DataFrame:
        """Add ``<column>_index``: the level's position; the number of levels for one never seen.

        Whether a dictionary is broadcast or joined by a shuffle, which splits frequent levels, is
        left to the optimizer.
        """
        for c, size in self.sizes.items():
            mine = self.dictionary.where(F.col("column_name") == c).select(
                F.col("level").alias("_level"), F.col("position").cast("double").alias("_position")
            )
            joined = df.withColumn("_text", F.col(c).cast("string")).join(mine, F.col("_text").eqNullSafe(F.col("_level")), "left")
            known = F.coalesce("_position", F.lit(float(max(size, 1))))
            df = joined.withColumn(f"{c}{INDEX}", known).drop("_text", "_level", "_position")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``<column>_index`` and the sparse 0/1 vector ``<column>_onehot``, all 0 for an unseen level."""
        if not self.sizes:
            return df
        spark = df.sparkSession
        ins = [f"{c}{INDEX}" for c in self.sizes]
        largest = spark.createDataFrame([tuple(float(max(n, 1) - 1) for n in self.sizes.values())], ins)
        # Unseen levels take a last position, which is dropped.
        encoder = OneHotEncoder(inputCols=ins, outputCols=self.vectors, handleInvalid="keep", dropLast=True).fit(largest)
        coded = encoder.transform(self.index(df))
        # Without the list of attribute names, which grows with the levels.
        for v in self.vectors:
            coded = coded.withMetadata(v, {})
        return coded

    def widths(self, features: list[str]) -> list[tuple[str, int]]:
        """The features with the number of positions each takes in a model's vector."""
        by = {f"{c}{VECTOR}": max(n, 1) for c, n in self.sizes.items()}
        return [(f, by.get(f, 1)) for f in features]

    def store(self, path: str) -> None:
        self.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
        io.write_json(self.dictionary.sparkSession, {"sizes": self.sizes}, f"{path}/sizes")


def fit_encoder(df: DataFrame, cols: list[str]) -> LevelEncoder:
    """The dictionary of the given columns; the driver learns one number a column."""
    if not cols:
        none = df.sparkSession.createDataFrame([], "column_name string, level string, n long, position long")
        return LevelEncoder({}, none)
    dictionary = checkpointed(fit_dictionary(df, cols))
    counts = {r.column_name: r.n for r in dictionary.groupBy("column_name").agg(F.count("*").alias("n")).collect()}
    return LevelEncoder({c: counts.get(c, 0) for c in cols}, dictionary)


def load_encoder(spark: SparkSession, path: str) -> LevelEncoder:
    return LevelEncoder(io.read_json(spark, f"{path}/sizes")["sizes"], spark.read.parquet(f"{path}/dictionary"))


def named_positions(encoder: LevelEncoder, features: list[str], values: list[float], spark: SparkSession) -> DataFrame:
    """Per position of a model's vector: position, feature (``<column>_<level>`` for a level) and value.

    ``values`` is what the model holds for every position; the names of levels come from the dictionary
    by a join.
    """
    plain, coded, at = [], [], 0
    for f, width in encoder.widths(features):
        if f in encoder.vectors:
            column = f[: -len(VECTOR)]
            coded += [(at + k, column, k, float(values[at + k])) for k in range(width)]
        else:
            plain.append((at, f, float(values[at])))
        at += width
    out = spark.createDataFrame(plain, "at long, feature string, value double")
    if coded:
        wide = spark.createDataFrame(coded, "at long, column_name string, position long, value double")
        name = F.concat_ws("_", "column_name", F.coalesce("level", F.lit("nan"))).alias("feature")
        out = out.unionByName(wide.join(encoder.dictionary, ["column_name", "position"]).select("at", name, "value"))
    return out
