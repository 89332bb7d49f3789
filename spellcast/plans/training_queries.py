"""Queries over the training-table layers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from spellcast.config import FIXTURE_SETTINGS as S
from spellcast.functions.dates import date_spine as spine
from spellcast.operators import bronze, lookback, snapshots, spells
from spellcast.plans.pipeline import Sources, StoredTable, fixture_table, run_training_table
from spellcast.plans.registry import query
from spellcast.session import shared_folder


@query
def bronze_payments(spark, sf_dir):
    s = Sources.from_fixtures(spark, sf_dir)
    return bronze.bronze_payments(s.payments, s.providers, S)


@query
def bronze_cancelled(spark, sf_dir):
    s = Sources.from_fixtures(spark, sf_dir)
    return bronze.bronze_cancelled(s.payments, s.providers, S)


@query
def eligible_providers(spark, sf_dir):
    s = Sources.from_fixtures(spark, sf_dir)
    return bronze.eligible_providers(bronze.paid_days(s.payments, S), s.providers, s.history, S)


@query
def cohort0_spells(spark, sf_dir):
    return spells.cohort0_spells(fixture_table(spark, sf_dir).eligible, S)


@query
def action_timeline(spark, sf_dir):
    return fixture_table(spark, sf_dir).timeline


@query
def next_action(spark, sf_dir):
    return spells.next_action(fixture_table(spark, sf_dir).timeline)


@query
def optout_spells(spark, sf_dir):
    return fixture_table(spark, sf_dir).optout_spells


@query
def target_repair(spark, sf_dir):
    t = fixture_table(spark, sf_dir)
    return spells.target_repair(spells.with_in_spell_counts(t.optout_spells, t.paid_days, S))


@query
def all_spells(spark, sf_dir):
    t = fixture_table(spark, sf_dir)
    return spells.all_spells(t.eligible, t.paid_days, t.src.history, S)


@query
def date_spine(spark, sf_dir):
    """Spine dates with the number of spells that hold each of them."""
    t = fixture_table(spark, sf_dir)
    held = snapshots.snapshot_rows(t.spells, S).groupBy("date_end_oos").agg(F.count("*").alias("spells"))
    dates = spine(spark, S)
    return dates.join(held, dates.snap_dt == held.date_end_oos, "left").select(
        "snap_dt", F.coalesce("spells", F.lit(0).cast("long")).alias("spells")
    )


@query
def snapshot_rows(spark, sf_dir):
    return snapshots.snapshot_rows(fixture_table(spark, sf_dir).spells, S)


@query
def horizon_label(spark, sf_dir):
    return fixture_table(spark, sf_dir).gold


@query
def label_rate_by_month(spark, sf_dir):
    """Snapshots, opt-ins and mean 90-day check payments per snapshot month."""
    t = fixture_table(spark, sf_dir)
    spells = lookback.with_payment_days(t.spells, t.src.payments, S, t.spans)
    return (
        lookback.trailing_payments(snapshots.gold_spells(spells, S), S)
        .groupBy(F.trunc("date_end", "MM").alias("month"))
        .agg(
            F.count("*").alias("snapshots"),
            F.sum("opt_in_ach").alias("ach_optins"),
            F.sum("opt_in_vcc").alias("vcc_optins"),
            F.round(F.avg("opt_in_ach"), 8).alias("ach_rate"),
            F.coalesce(F.sum("sumcheckpaymentcount90"), F.lit(0).cast("long")).alias("checks_90"),
        )
    )


@query
def lookback_by_product(spark, sf_dir):
    t = fixture_table(spark, sf_dir)
    return lookback.lookback_by_product(t.gold, t.src.payments, S, t.spans)


@query
def lookback_trailing(spark, sf_dir):
    """Trailing sums over valid and cancelled checks."""
    t = fixture_table(spark, sf_dir)
    return lookback.lookback_trailing(t.gold, t.src.payments, S, t.spans)


@query
def payer_lists(spark, sf_dir):
    t = fixture_table(spark, sf_dir)
    return lookback.payer_lists(t.gold, t.src.payments, S, t.spans, as_text=True)


@query
def prior_optouts(spark, sf_dir):
    t = fixture_table(spark, sf_dir)
    return lookback.prior_optouts(t.gold, t.src.history, S)


@query
def prior_optouts_year(spark, sf_dir):
    t = fixture_table(spark, sf_dir)
    return lookback.prior_optouts(t.gold, t.src.history, S, last_year=True)


@query
def phone_counts(spark, sf_dir):
    t = fixture_table(spark, sf_dir)
    return lookback.phone_counts(t.gold, t.src.interactions, S, t.spans)


@query
def exclusion_flags(spark, sf_dir):
    s = Sources.from_fixtures(spark, sf_dir)
    return lookback.exclusion_flags(s.provider_map, s.provider_flags, S)


@query
def gold_training_row(spark, sf_dir):
    return fixture_table(spark, sf_dir).rows


@query
def training_run(spark, sf_dir):
    """The training table as a run writes it, layer by layer, with a second run that finds all of them."""
    base = f"{shared_folder(spark)}/training-{uuid.uuid4().hex}"
    versions = Sources.fixture_versions(spark, sf_dir)
    for _ in range(2):
        status = run_training_table(spark, Sources.from_fixtures(spark, sf_dir), S, versions, base)
        if not status.ok:
            raise RuntimeError(status.message)
    rows = StoredTable(spark, Sources.from_fixtures(spark, sf_dir), S, versions, base).rows
    return rows.groupBy(F.trunc("date_end", "MM").alias("month")).agg(
        F.count("*").alias("n_rows"), F.lit(len(status.built)).alias("rebuilt"), F.sum("sumtotalpaymentcount").alias("payments")
    )
