"""Queries over the feature formulas, on the whole training table."""

from __future__ import annotations

from spellcast.config import FIXTURE_SETTINGS as S
from spellcast.config import ROW_KEY
from spellcast.functions import features as fx
from spellcast.plans.pipeline import fixture_table
from spellcast.plans.registry import query


CHECKS = [f"sumcheckpayment{kind}{k}" for kind in ("count", "amount") for k in ("", 30, 60, 90)]
CANCELLED = [f"cancelledcheckpayment{kind}{k}" for kind in ("count", "amount") for k in ("", 30, 60, 90)]
CALLS = [f"phonecount{k}" for k in ("", 30, 60, 90)]
SHARES = [f"sum{line}payment{kind}" for line in ("payersponsored", "important") for kind in ("count", "amount")]


def counts_of(names):
    return [name for name in names if "amount" not in name]


def prepared(spark, sf_dir, columns=None):
    """Rows for features, with the payment and call sums named in ``columns`` (None: all)."""
    return fx.fill_and_filter(fixture_table(spark, sf_dir).rows_with(columns))


@query
def feat_fill_filter(spark, sf_dir):
    cols = [c for c in fx.FILL_ZERO + fx.RECENCY]
    return fx.select_available(prepared(spark, sf_dir, cols), ROW_KEY + ["duration"] + cols)


@query
def feat_payers(spark, sf_dir):
    df = fx.payer_features(prepared(spark, sf_dir), S.focus_payer)
    return df.select(*ROW_KEY, "check_contains_metlife", "check_is_only_metlife", "payerid_check_count",
                     "imp_contains_metlife", "imp_is_only_metlife")


@query
def feat_averages(spark, sf_dir):
    df = fx.averages(prepared(spark, sf_dir, CHECKS))
    return df.select(*ROW_KEY, "check_payment_avg", *[f"check_payment_avg_{k}" for k in (30, 60, 90)])


@query
def feat_rates(spark, sf_dir):
    stems = ["check_paymentcount_rate", "cancelled_check_paymentcount_rate", "phonecount_rate"]
    df = fx.rates(prepared(spark, sf_dir, counts_of(CHECKS + CANCELLED + CALLS)))
    return df.select(*ROW_KEY, *[f"{s}{k}" for s in stems for k in ("", "_30", "_60", "_90")])


@query
def feat_momentum(spark, sf_dir):
    df = fx.momentum(fx.rates(prepared(spark, sf_dir, counts_of(CHECKS + CANCELLED + CALLS))))
    names = [f"{stem}_{other}" for stem, _, against in fx.MOMENTUM for other, _ in against]
    return df.select(*ROW_KEY, *names)


@query
def feat_ratios(spark, sf_dir):
    sums = CHECKS + CANCELLED + CALLS + SHARES
    df = fx.window_ratios(fx.sponsored_shares(fx.averages(prepared(spark, sf_dir, sums))))
    windows = ("", "30", "60", "90")
    return df.select(
        *ROW_KEY, "pctpaycountsponsored", "pctpayamountsponsored",
        *[f"phone_call_density_{w}" for w in windows],
        *[f"cancelled_check_amount_ratio{w}" for w in windows],
        *[f"check_payment_stability_{p}" for p in ("30_60", "30_90", "60_90")],
    )


@query
def feat_account_age(spark, sf_dir):
    df = fx.age_bin(fx.account_age(prepared(spark, sf_dir)))
    return df.select(*ROW_KEY, "account_age", "account_age_bin", "firstaction_bool")


@query
def feat_interactions(spark, sf_dir):
    df = fx.phone_bands(fx.engineer(prepared(spark, sf_dir), S.focus_payer))
    return df.select(
        *ROW_KEY, "ach_preference_ratio", "avg_days_between_check_payments", "check_density",
        "engagement_adjusted_friction", "status_recency_gap", "revenue_velocity",
        "undecided_high_roller", "long_undecided_bool", "payment_acceleration", "momentum_30_lifetime",
        "payment_volatility_index", "check_failure_rate_90", "interaction_friction_90",
        fx.F.round("payer_fragmentation", 6).alias("payer_fragmentation"), "metlife_exposure_proxy",
        "state_tax_interact", "sumcheckpaymentcount30_bool", "calls_0_30", "calls_30_60", "calls_60_90",
    )


@query
def feature_table(spark, sf_dir):
    """The selected model features that exist, with the target."""
    df = fx.engineer(prepared(spark, sf_dir), S.focus_payer)
    df = df.withColumn("payer_fragmentation", fx.F.round("payer_fragmentation", 6))
    ids = [c for c in ROW_KEY if c != "tin"]
    return fx.select_available(df, fx.SELECTED_FEATURES + ids + ["duration", "opt_in_ach"])


@query
def scoring_rows(spark, sf_dir):
    """The lean scoring preparation: tolerant sponsored filter, fills, four derived features."""
    cols = ROW_KEY + [
        "duration", "providertype", "payersponsored", "sumcheckpaymentcount", "sumcheckpaymentcount30",
        "sumcheckpaymentamount30", "sumcheckpaymentcount90", "time_since_last_check_payment",
        "time_since_last_cancelled_check_payment", "providercreatedon",
    ]
    df = fx.scoring_features(fixture_table(spark, sf_dir).rows_with(cols).select(*cols))
    return df.select(
        *ROW_KEY, "providertype", "time_since_last_check_payment", "check_payment_avg_30",
        "check_paymentcount_momentum_30_90", "account_age", "firstaction_bool",
    )
