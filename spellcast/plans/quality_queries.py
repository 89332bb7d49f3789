"""Queries over the consistency checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from spellcast.operators import quality as q
from spellcast.plans.evaluation_queries import rounded
from spellcast.plans.registry import query
from spellcast.sources.fixtures import Fixtures

NUMERIC = ["amount", "balance", "shifted", "sparse", "spiked"]
CATEGORIES = ["status", "priority", "segment", "note"]
LONG_TAIL = ["customer_name", "state"]


def checked(spark, sf_dir):
    return Fixtures(spark, sf_dir).view("checked")


def two_sets(spark, sf_dir):
    """The two periods as separate frames, the later one with a dropped and a retyped column."""
    df = checked(spark, sf_dir)
    train = df.where(F.col("dataset") == "train").drop("dataset")
    later = df.where(F.col("dataset") == "cmp").drop("dataset")
    return train, later


@query
def quality_schema(spark, sf_dir):
    train, later = two_sets(spark, sf_dir)
    later = later.drop("note").withColumn("extra", F.col("amount"))
    return q.schema_and_types(train, later).select(
        "column_name", "train_values", "cmp_values", "schema_passed"
    )


@query
def quality_dtype(spark, sf_dir):
    train, later = two_sets(spark, sf_dir)
    later = later.withColumn("row_id", F.col("row_id").cast("string"))
    out = q.schema_and_types(train, later)
    return out.where(F.col("type_passed").isNotNull()).select("column_name", "train_values", "cmp_values", "type_passed")


@query
def quality_duplicates(spark, sf_dir):
    """Duplicates by a key that repeats: customer, date."""
    return rounded(q.duplicate_check(checked(spark, sf_dir), ["customer_name", "event_date"]))


@query
def quality_missing(spark, sf_dir):
    return rounded(q.missing_check(checked(spark, sf_dir), NUMERIC + CATEGORIES + LONG_TAIL))


@query
def quality_long_tail(spark, sf_dir):
    return rounded(q.long_tail_check(checked(spark, sf_dir), LONG_TAIL + CATEGORIES))


@query
def quality_length(spark, sf_dir):
    """Length distributions of whole texts."""
    return rounded(q.length_check(Fixtures(spark, sf_dir).view("texts"), ["text", "lang", "source"]))


@query
def quality_outlier(spark, sf_dir):
    return rounded(q.outlier_check(checked(spark, sf_dir), NUMERIC), 6)


@query
def quality_unique(spark, sf_dir):
    return rounded(q.unique_check(checked(spark, sf_dir), CATEGORIES))


@query
def quality_top_values(spark, sf_dir):
    return rounded(q.top_values(checked(spark, sf_dir), CATEGORIES + LONG_TAIL))


@query
def quality_distribution(spark, sf_dir):
    return rounded(q.distribution_check(checked(spark, sf_dir), NUMERIC, ("shifted",)), 6)


@query
def quality_drift_table(spark, sf_dir):
    return rounded(q.drift_table(q.distribution_check(checked(spark, sf_dir), NUMERIC, ("shifted",))), 6)


@query
def quality_checks(spark, sf_dir):
    train, later = two_sets(spark, sf_dir)
    return q.run_all_checks(train, later, ["row_id"], NUMERIC, CATEGORIES, LONG_TAIL)


@query
def quality_verdict(spark, sf_dir):
    train, later = two_sets(spark, sf_dir)
    return q.verdict(q.run_all_checks(train, later, ["row_id"], NUMERIC, CATEGORIES, LONG_TAIL))


@query
def column_routing(spark, sf_dir):
    return q.column_routing(checked(spark, sf_dir), ("event_date",))


@query
def column_profile(spark, sf_dir):
    return rounded(q.profile(checked(spark, sf_dir), NUMERIC, CATEGORIES + LONG_TAIL), 6)
