"""Sources and sinks: scans, newest artifacts, timestamped and overwriting writes, models."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Catalog:
    """Locations of a project, all under one base path."""

    base: str
    project: str = "project"
    metrics: tuple[str, ...] = ("ROC_AUC", "Accuracy", "Precision", "Recall", "F1")
    folders: dict[str, str] = field(
        default_factory=lambda: {
            "raw_train": "input/raw/train", "raw_val": "input/raw/val", "raw_oos": "input/raw/oos",
            "preprocessed_train": "input/preprocessed/train", "preprocessed_val": "input/preprocessed/val",
            "preprocessed_oos": "input/preprocessed/oos", "models": "output/models", "results": "output/results",
        }
    )

    def path(self, folder: str) -> str:
        return f"{self.base.rstrip('/')}/{self.folders[folder]}"


# --- scans --------------------------------------------------------------------------------


def scan(spark: SparkSession, source: str, upper: bool = True) -> DataFrame:
    """A table by name, or parquet files by path; column names in upper case on request."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return df.toDF(*[c.upper() for c in df.columns]) if upper else df


def scan_since(spark: SparkSession, source: str, date_col: str, start: dt.date) -> DataFrame:
    """Rows from ``start`` on; the filter reaches the scan."""
    return scan(spark, source).where(F.col(date_col.upper()) >= F.lit(start))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and an explicit schema: no inference pass, no type drift; NaN is NULL."""
    return spark.read.schema(schema).option("header", True).option("nanValue", "NaN").csv(path).transform(nan_to_null)


def nan_to_null(df: DataFrame) -> DataFrame:
    fixed = {
        f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
        for f in df.schema
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixed) if fixed else df


def files_version(spark: SparkSession, path: str) -> str:
    """A text that changes when the files under ``path`` do: names, sizes and times, not contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    mark = F.xxhash64("path", "modificationTime", "length")
    r = files.agg(F.count("*").alias("n"), F.bit_xor(mark).alias("mark"), F.sum("length").alias("size")).first()
    return f"{r.n}-{r['size']}-{r.mark}"


# --- newest artifacts ---------------------------------------------------------------------


def newest(df: DataFrame, path: str = "path", modified: str = "modified") -> DataFrame:
    """The path changed last, one row; equal times are ordered by path."""
    return df.agg(F.max_by(path, F.struct(modified, path)).alias("path"))


def newest_file(spark: SparkSession, prefix: str, pattern: str = "*") -> str:
    """The file under ``prefix`` changed last; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(prefix)
        .select("path", F.col("modificationTime").alias("modified"))
    )
    found = newest(files).first().path
    if found is None:
        raise FileNotFoundError(f"no file matches {prefix}/{pattern}")
    return found


def name_parts(path: Column) -> list[Column]:
    """Project, model and timestamp of an artifact path ``…/project__model__timestamp.ext``."""
    name = F.element_at(F.split(path, "/"), -1)
    parts = F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "__")
    return [F.get(parts, 0).alias("project"), F.get(parts, 1).alias("model"), F.get(parts, 2).alias("stamp")]


def latest_per_model(artifacts: DataFrame, project: str, models: list[str] | None = None) -> DataFrame:
    """The newest artifact of each model of a project by the timestamp in its name."""
    named = artifacts.select("path", *name_parts(F.col("path"))).where(
        (F.col("project") == project) & F.col("stamp").isNotNull()
    )
    if models is not None:
        named = named.where(F.col("model").isin(*models))
    return named.groupBy("model").agg(
        F.max_by("path", F.struct("stamp", "path")).alias("path"), F.max("stamp").alias("stamp")
    )


# --- sinks --------------------------------------------------------------------------------


def run_stamp(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_run(df: DataFrame, base: str, stamp: str, fmt: str = "parquet", sort_by: list[str] | None = None) -> str:
    """Write one run's output under ``base/run_ts=<stamp>``; CSV on request.

    ``sort_by`` orders rows inside each file, so that date filters skip row groups.
    """
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    path = f"{base.rstrip('/')}/run_ts={stamp}"
    writer = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def latest_run(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The newest run under ``base``; only its partition is read."""
    runs = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(base).select("path")
    stamp = runs.agg(F.max(F.regexp_extract("path", "run_ts=([^/]+)/", 1))).first()[0]
    if not stamp:
        raise FileNotFoundError(f"no run under {base}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{base.rstrip('/')}/run_ts={stamp}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system Spark reads it from."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def publish(df: DataFrame, table: str, base: str | None = None) -> int:
    """Replace the rows of ``table`` in one step, or leave it as it was. Returns the rows.

    The rows are staged in a folder of their own under ``base`` (the warehouse by default), counted
    while they are written and again from the files, and compared in schema. Only then is the table
    pointed at them: by its location where the columns stay the same, else by giving its name to a new
    table, which is undone if it fails. Readers see the former or the new rows; a run that fails leaves
    the former ones, and its staged folder is deleted. Former folders stay until ``drop_former``.
    """
    spark = df.sparkSession
    run = f"{run_stamp()}_{uuid.uuid4().hex[:8]}"
    path = f"{(base or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{table}__runs/{run}"
    written = Observation()
    try:
        df.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(path)
        staged = spark.read.parquet(path)
        n = staged.count()
        if n != written.get["n"] or [(f.name, f.dataType) for f in staged.schema] != [(f.name, f.dataType) for f in df.schema]:
            raise RuntimeError(f"staged rows of {table} differ from those written")
        _switch(spark, table, staged, path, run)
    except Exception:
        delete_path(spark, path)
        raise
    return n


def _switch(spark: SparkSession, table: str, staged: DataFrame, path: str, run: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged.schema)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")
    elif [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in staged.schema]:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        new, old = f"{table}__new_{run}", f"{table}__old_{run}"
        spark.sql(f"CREATE TABLE {new} ({columns}) USING parquet LOCATION '{path}'")
        try:
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
            try:
                spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
            except Exception:
                spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
                raise
        except Exception:
            spark.sql(f"DROP TABLE {new}")
            raise
        spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(table)


def drop_former(spark: SparkSession, table: str, base: str | None = None) -> int:
    """Delete the folders of earlier ``publish`` runs of ``table``; returns how many."""
    root = f"{(base or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{table}__runs"
    live = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first().data_type.rstrip("/").rsplit("/", 1)[-1]
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    former = [n for n in names if n != live]
    for name in former:
        delete_path(spark, f"{root}/{name}")
    return len(former)


def write_output(df: DataFrame, table: str, base: str | None = None) -> int:
    """Publish the output table: names in upper case, non-atomic types as text. Returns rows."""
    atomic = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.StringType)
    cols = [
        F.col(f.name).alias(f.name.upper())
        if isinstance(f.dataType, atomic)
        else F.col(f.name).cast("string").alias(f.name.upper())
        for f in df.schema
    ]
    return publish(df.select(*cols), table, base)


def write_with_fallback(df: DataFrame, primary: Callable[[DataFrame], object], fallback_path: str) -> bool:
    """Run ``primary(df)``; if it fails, write the rows as CSV to ``fallback_path``."""
    try:
        primary(df)
        return True
    except Exception:
        df.write.mode("overwrite").option("header", True).csv(fallback_path)
        return False


# --- small documents and models -----------------------------------------------------------


def write_json(spark: SparkSession, document: dict, path: str) -> None:
    """Store one metadata document as a JSON line."""
    import json

    spark.createDataFrame([(json.dumps(document, default=str),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    """Read one JSON document, on one or several lines."""
    import json

    lines = spark.read.option("wholetext", True).text(path)
    count = lines.count()
    if count == 0:
        raise FileNotFoundError(path)
    if count > 1:
        raise ValueError(f"{path} holds {count} documents")
    return json.loads(lines.first().value)


def read_cutoffs(spark: SparkSession, path: str) -> dict[str, float]:
    """Cutoffs stored bare or under a ``cutoffs`` key."""
    doc = read_json(spark, path)
    return {k: float(v) for k, v in doc.get("cutoffs", doc).items()}


def save_model(spark: SparkSession, model: PipelineModel, features: list[str], path: str) -> None:
    """Store a fitted pipeline with its feature list."""
    model.write().overwrite().save(f"{path}/model")
    write_json(spark, {"features": features}, f"{path}/features")


def load_model(spark: SparkSession, path: str, default_features: list[str] | None = None) -> tuple[PipelineModel, list[str]]:
    """A stored pipeline and its features; a bare pipeline takes the default feature list."""
    try:
        features = read_json(spark, f"{path}/features")["features"]
    except AnalysisException:  # no such folder: not the layout of ``save_model``
        if default_features is None:
            raise
        return PipelineModel.load(path), default_features
    return PipelineModel.load(f"{path}/model"), features
