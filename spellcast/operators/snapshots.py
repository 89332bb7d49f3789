"""Snapshot rows: one per spell and spine date inside it, with the horizon label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spellcast.config import KEY, Settings
from spellcast.functions.dates import spine_dates_between


def snapshot_rows(
    spells: DataFrame, s: Settings, min_duration: int = 0, after: Column | None = None, until: Column | None = None
) -> DataFrame:
    """Explode each spell into the spine dates in ``(date_start + min_duration, date_end]``.

    The dates are generated on the row, so there is no join with a date table and no
    non-equi join; the duration filter is part of the generated range. With ``after`` and ``until``
    (NULL: no limit) only the dates in ``(after, until]`` are generated.
    """
    start, end = F.date_add("date_start", min_duration), F.col("date_end")
    lo = start if after is None else F.when(start.isNotNull(), F.greatest(start, after))
    hi = end if until is None else F.when(end.isNotNull(), F.least(end, until))
    return spells.withColumn(
        "date_end_oos", F.explode(spine_dates_between(lo, hi, s))
    ).withColumn("duration_oos", F.datediff("date_end_oos", "date_start"))


def horizon_label(snapshots: DataFrame, s: Settings) -> DataFrame:
    """Label = the spell ends within the horizon with an opt-in; the snapshot date becomes
    the row's end date."""
    limit = F.date_add("date_end_oos", s.horizon_days)
    within = F.col("date_end").between(F.col("date_end_oos"), limit)
    carried = [
        c for c in snapshots.columns
        if c not in ("date_end", "date_end_oos", "duration_oos", "time_of_study",
                     "optin_target_ach", "optin_target_vcc")
    ]
    return snapshots.select(
        *carried,
        F.col("date_end_oos").alias("date_end"),
        F.col("duration_oos").alias("duration"),
        limit.alias("date_end_plus_30" if s.horizon_days == 30 else f"date_end_plus_{s.horizon_days}"),
        F.when(within & (F.col("optin_target_ach") == 1), 1).otherwise(0).alias("opt_in_ach"),
        F.when(within & (F.col("optin_target_vcc") == 1), 1).otherwise(0).alias("opt_in_vcc"),
    )


def gold_spells(spells: DataFrame, s: Settings, after: Column | None = None, until: Column | None = None) -> DataFrame:
    """Labelled snapshots older than ``min_duration`` days; with ``after`` and ``until`` those between the two."""
    return horizon_label(snapshot_rows(spells, s, s.min_duration, after, until), s)


def spell_spans(spells: DataFrame, s: Settings) -> DataFrame:
    """Per spell with a snapshot older than ``min_duration`` days: its first, last and all snapshot dates.

    Computed on the spell row; the snapshots need not be generated for it.
    """
    dates = spine_dates_between(F.date_add("date_start", s.min_duration), F.col("date_end"), s)
    ends = spells.select(*KEY, "date_start", F.array_min(dates).alias("first_end"), F.array_max(dates).alias("until"), dates.alias("ends"))
    return (
        ends.groupBy(*KEY, "date_start")
        .agg(F.min("first_end").alias("first_end"), F.max("until").alias("until"), F.flatten(F.collect_list("ends")).alias("ends"))
        .where(F.col("until").isNotNull())
    )
