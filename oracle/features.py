"""DuckDB texts for the feature formulas."""

from __future__ import annotations

from oracle.base import cte
from spellcast.config import FIXTURE_SETTINGS as S

ROW = "tin, providerid, date_start, date_end"
# The filled columns.
_STEMS = ["cancelledcheckpaymentcount", "cancelledcheckpaymentamount", "sumcheckpaymentcount",
          "sumcheckpaymentamount", "phonecount"]
FILLED = [f"{s}{k}" for s in _STEMS for k in ("", 30, 60, 90)] + [
    f"sum{p}payment{u}" for p in ("ach", "vcc", "payersponsored", "total") for u in ("count", "amount")
] + ["previousoptincount", "previousachoptincount", "previousvccoptincount"]
RECENT = ["time_since_last_cancelled_check_payment", "time_since_last_check_payment"]

_replace = ", ".join([f"coalesce({c}, 0) AS {c}" for c in FILLED] + [f"coalesce({c}, 9999) AS {c}" for c in RECENT])
cte(
    "prepared",
    f"""SELECT * REPLACE ({_replace}) FROM training_row
        WHERE payersponsored = false AND sumcheckpaymentcount > 0 AND duration >= 90""",
    "training_row",
)


def z(col: str, value: str) -> str:
    """A divisor with its zeros replaced."""
    return f"(CASE WHEN ({col}) = 0 THEN {value} ELSE ({col}) END)"


def div(num: str, den: str, value: str = "1") -> str:
    return f"(CAST({num} AS DOUBLE) / CAST({z(den, value)} AS DOUBLE))"


_avg = {
    "check_payment_avg": div("sumcheckpaymentamount", "sumcheckpaymentcount"),
    "check_payment_avg_30": f"coalesce({div('sumcheckpaymentamount30', 'sumcheckpaymentcount30')}, 0)",
    "check_payment_avg_60": div("sumcheckpaymentamount60", "sumcheckpaymentcount60"),
    "check_payment_avg_90": div("sumcheckpaymentamount90", "sumcheckpaymentcount90"),
}
_rate = {
    "check_paymentcount_rate": div("sumcheckpaymentcount", "duration"),
    "cancelled_check_paymentcount_rate": div("cancelledcheckpaymentcount30", "duration"),
    "phonecount_rate": div("phonecount", "duration"),
    "check_paymentcount_rate_30": "sumcheckpaymentcount30 / 30.0::DOUBLE",
    "check_paymentcount_rate_60": "sumcheckpaymentcount60 / 60.0::DOUBLE",
    "check_paymentcount_rate_90": "sumcheckpaymentcount90 / 90.0::DOUBLE",
    "cancelled_check_paymentcount_rate_30": "cancelledcheckpaymentcount30 / 30.0::DOUBLE",
    "cancelled_check_paymentcount_rate_60": "cancelledcheckpaymentcount60 / 60.0::DOUBLE",
    "cancelled_check_paymentcount_rate_90": "cancelledcheckpaymentcount60 / 90.0::DOUBLE",
    "phonecount_rate_30": "phonecount30 / 30.0::DOUBLE",
    "phonecount_rate_60": "phonecount60 / 60.0::DOUBLE",
    "phonecount_rate_90": "phonecount90 / 60.0::DOUBLE",
}


def _cols(d: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in d.items())


cte("feat_averages", f"SELECT {ROW}, {_cols(_avg)} FROM prepared", "prepared")
cte("feat_rates", f"SELECT {ROW}, {_cols(_rate)} FROM prepared", "prepared")


def _m(rate: str, other: str) -> str:
    return div(f"{rate}_30", rate if other == "alltime" else f"{rate}_{other}", "0.001")


_cr, _xr, _pr = "check_paymentcount_rate", "cancelled_check_paymentcount_rate", "phonecount_rate"
_momentum = {
    "cancelledcheck_paymentcount_momentum_30_alltime": f"coalesce({_m(_xr, 'alltime')}, 0)",
    "cancelledcheck_paymentcount_momentum_30_90": f"coalesce({_m(_xr, '90')}, -1)",
    "check_paymentcount_momentum_30_alltime": _m(_cr, "alltime"),
    "check_paymentcount_momentum_30_90": f"coalesce({_m(_cr, '90')}, -1)",
    "check_paymentcount_momentum_30_60": f"coalesce({_m(_cr, '60')}, 0)",
    "phonecount_momentum_30_alltime": f"coalesce({_m(_pr, 'alltime')}, 0)",
    "phonecount_momentum_30_60": f"coalesce({_m(_pr, '60')}, 0)",
    "phonecount_momentum_30_90": f"coalesce({_m(_pr, '90')}, 0)",
}
cte("feat_momentum", f"SELECT {ROW}, {_cols(_momentum)} FROM feat_rates", "feat_rates")


def _or(num: str, den: str, fallback: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), {fallback})"


_ratios = (
    {
        "pctpaycountsponsored": div("sumpayersponsoredpaymentcount", "sumimportantpaymentcount"),
        "pctpayamountsponsored": div("sumpayersponsoredpaymentamount", "sumimportantpaymentamount"),
    }
    | {f"phone_call_density_{w}": _or(f"phonecount{w}", f"cancelledcheckpaymentcount{w}", "0") for w in ("", 30, 60, 90)}
    | {
        f"cancelled_check_amount_ratio{w}": _or(f"cancelledcheckpaymentamount{w}", f"sumcheckpaymentamount{w}", "0")
        for w in ("", 30, 60, 90)
    }
    | {
        f"check_payment_stability_{x}_{y}": _or(f"check_payment_avg_{x}", f"check_payment_avg_{y}", "1.0")
        for x, y in ((30, 60), (30, 90), (60, 90))
    }
)
_JOINED = "prepared JOIN feat_averages USING (tin, providerid, date_start, date_end)"
cte("feat_ratios", f"SELECT {ROW}, {_cols(_ratios)} FROM {_JOINED}", "prepared", "feat_averages")
AGE_CASE = """CASE WHEN account_age <= 730 THEN 'LT2YR_OLD' WHEN account_age <= 1460 THEN 'BT2_4YR_OLD'
    WHEN account_age <= 2190 THEN 'BT4_6YR_OLD' WHEN account_age <= 2920 THEN 'BT6_8YR_OLD'
    WHEN account_age <= 3650 THEN 'BT8_10YR_OLD' WHEN account_age <= 4380 THEN 'BT10_12YR_OLD'
    WHEN account_age > 4380 THEN 'GT12YR_OLD' END"""
cte(
    "feat_account_age",
    f"""SELECT *, {AGE_CASE} AS account_age_bin FROM (
        SELECT {ROW}, date_end - providercreatedon AS account_age,
               CASE WHEN providercreatedon = date_start THEN 1 ELSE 0 END AS firstaction_bool FROM prepared)""",
    "prepared",
)
cte(
    "feat_payers",
    f"""SELECT {ROW},
        CASE WHEN list_contains(string_split(payerid_list_check, ', '), '{S.focus_payer}') THEN 1 ELSE 0 END
            AS check_contains_metlife,
        CASE WHEN payerid_list_check = '{S.focus_payer}' THEN 1 ELSE 0 END AS check_is_only_metlife,
        coalesce(CAST(len(string_split(payerid_list_check, ',')) AS INT), 0) AS payerid_check_count,
        imp_contains_metlife, imp_is_only_metlife
    FROM prepared""",
    "prepared",
)
_inter = {
    "ach_preference_ratio": div("coalesce(previousachoptincount, 0)", "previousoptincount"),
    "avg_days_between_check_payments": div("duration", "sumcheckpaymentcount"),
    "check_density": div("sumcheckpaymentcount", "duration"),
    "engagement_adjusted_friction": "time_since_last_cancelled_check_payment / CAST(phonecount + 1 AS DOUBLE)",
    "status_recency_gap": "time_since_last_check_payment - time_since_last_cancelled_check_payment",
    "revenue_velocity": f"sumcheckpaymentamount30 / {z('sumcheckpaymentamount90 / 3.0::DOUBLE', '1.0::DOUBLE')} - 1",
    "undecided_high_roller": "firstaction_bool * sumcheckpaymentamount90",
    "long_undecided_bool": "CASE WHEN firstaction_bool = 1 AND duration > 365 THEN 1 ELSE 0 END",
    "payment_acceleration": f"(check_paymentcount_rate_30 - check_paymentcount_rate_90) / {z('check_paymentcount_rate_90', '0.001::DOUBLE')}",
    "momentum_30_lifetime": div("check_paymentcount_rate_30", "check_paymentcount_rate", "0.001"),
    "payment_volatility_index": f"abs(check_payment_avg_30 - check_payment_avg_90) / {z('check_payment_avg_90', '1.0::DOUBLE')}",
    "check_failure_rate_90": div("cancelledcheckpaymentcount90", "sumcheckpaymentcount90"),
    "interaction_friction_90": div("phonecount90", "sumcheckpaymentcount90"),
    "payer_fragmentation": """round(payerid_check_count / CASE WHEN ln(1 + sumcheckpaymentamount90) <= 0
        THEN 1e-6 ELSE ln(1 + sumcheckpaymentamount90) END, 6)""",
    "metlife_exposure_proxy": f"check_contains_metlife * {div('check_payment_avg_30', 'check_payment_avg')}",
    "state_tax_interact": "coalesce(state, 'nan') || '_' || coalesce(taxonomygeneral, 'nan')",
    "sumcheckpaymentcount30_bool": "CASE WHEN sumcheckpaymentcount30 > 0 THEN 1 ELSE 0 END",
    "calls_0_30": "phonecount30",
    "calls_30_60": "greatest(phonecount60 - phonecount30, 0)",
    "calls_60_90": "greatest(phonecount90 - phonecount60, 0)",
}
cte(
    "feat_interactions",
    f"""SELECT {ROW}, {_cols(_inter)} FROM {_JOINED}
        JOIN feat_rates USING (tin, providerid, date_start, date_end)
        JOIN feat_payers USING (tin, providerid, date_start, date_end)
        JOIN feat_account_age USING (tin, providerid, date_start, date_end)""",
    "prepared", "feat_averages", "feat_rates", "feat_payers", "feat_account_age",
)
# The selected features that have a formula.
cte(
    "feature_table",
    f"""SELECT {ROW}, providertype, segment, sumcheckpaymentcount30, sumcheckpaymentamount30, check_payment_avg_30,
        check_paymentcount_momentum_30_90, payerid_check_count, time_since_last_check_payment,
        cancelledcheckpaymentcount30, time_since_last_cancelled_check_payment, check_contains_metlife,
        firstaction_bool, previousachoptincount, account_age, account_age_bin, cancelled_check_amount_ratio30,
        check_payment_stability_30_60, long_undecided_bool, ach_preference_ratio,
        avg_days_between_check_payments, engagement_adjusted_friction, phone_call_density_90,
        status_recency_gap, check_density, undecided_high_roller, revenue_velocity, payment_acceleration,
        momentum_30_lifetime, payment_volatility_index, check_failure_rate_90, payer_fragmentation,
        metlife_exposure_proxy, interaction_friction_90, duration, opt_in_ach
    FROM {_JOINED}
        JOIN feat_payers USING (tin, providerid, date_start, date_end)
        JOIN feat_account_age USING (tin, providerid, date_start, date_end)
        JOIN feat_momentum USING (tin, providerid, date_start, date_end)
        JOIN feat_ratios USING (tin, providerid, date_start, date_end)
        JOIN feat_interactions USING (tin, providerid, date_start, date_end)""",
    "prepared", "feat_averages", "feat_payers", "feat_account_age", "feat_momentum", "feat_ratios",
    "feat_interactions",
)
FEATURE_KEYS = ["feat_averages", "feat_rates", "feat_momentum", "feat_ratios", "feat_account_age",
                "feat_payers", "feat_interactions", "feature_table"]
cte(
    "scoring_rows",
    f"""SELECT {ROW}, providertype, coalesce(time_since_last_check_payment, 9999) AS time_since_last_check_payment,
        coalesce(CAST(coalesce(sumcheckpaymentamount30, 0) AS DOUBLE)
                 / CASE WHEN coalesce(sumcheckpaymentcount30, 0) = 0 THEN 1 ELSE sumcheckpaymentcount30 END, 0)
            AS check_payment_avg_30,
        (coalesce(sumcheckpaymentcount30, 0) / 30.0::DOUBLE)
            / CASE WHEN coalesce(sumcheckpaymentcount90, 0) = 0 THEN 0.001::DOUBLE ELSE sumcheckpaymentcount90 / 90.0::DOUBLE END
            AS check_paymentcount_momentum_30_90,
        date_end - providercreatedon AS account_age,
        CASE WHEN providercreatedon = date_start THEN 1 ELSE 0 END AS firstaction_bool
    FROM training_row
    WHERE (payersponsored IS NULL OR lower(CAST(payersponsored AS VARCHAR)) <> 'true')
      AND sumcheckpaymentcount > 0 AND duration >= 90""",
    "training_row",
)
FEATURE_KEYS.append("scoring_rows")
