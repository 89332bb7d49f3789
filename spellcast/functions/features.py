"""Feature formulas: column expressions over a training row, optional columns tolerated."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spellcast.config import KEY
from spellcast.functions.nulls import ratio, zero_as

# Columns filled with 0, recency columns filled with a sentinel.
FILL_ZERO = [
    "cancelledcheckpaymentcount", "cancelledcheckpaymentcount30", "cancelledcheckpaymentcount60",
    "cancelledcheckpaymentcount90", "cancelledcheckpaymentamount", "cancelledcheckpaymentamount30",
    "cancelledcheckpaymentamount60", "cancelledcheckpaymentamount90", "sumcheckpaymentamount",
    "sumcheckpaymentcount", "sumcheckpaymentamount30", "sumcheckpaymentcount30",
    "sumcheckpaymentamount60", "sumcheckpaymentcount60", "sumcheckpaymentamount90",
    "sumcheckpaymentcount90", "sumachpaymentamount", "sumachpaymentcount", "sumvccpaymentamount",
    "sumvccpaymentcount", "sumpayersponsoredpaymentamount", "sumpayersponsoredpaymentcount",
    "sumtotalpaymentamount", "sumtotalpaymentcount", "previousoptincount", "previousachoptincount",
    "previousvccoptincount", "phonecount", "phonecount30", "phonecount60", "phonecount90",
]
RECENCY = ["time_since_last_cancelled_check_payment", "time_since_last_check_payment"]
NEVER_DAYS = 9999
# Right-closed account-age edges in days and their labels.
AGE_EDGES = [730, 1460, 2190, 2920, 3650, 4380]
AGE_LABELS = [
    "LT2YR_OLD", "BT2_4YR_OLD", "BT4_6YR_OLD", "BT6_8YR_OLD", "BT8_10YR_OLD", "BT10_12YR_OLD",
    "GT12YR_OLD",
]
# Model features in order; names without a formula are dropped by availability.
SELECTED_FEATURES = [
    "tin", "providertype", "segment", "sumcheckpaymentcount30", "sumcheckpaymentamount30",
    "check_payment_avg_30", "check_paymentcount_momentum_30_90", "payerid_check_count",
    "time_since_last_check_payment", "cancelledcheckpaymentcount30",
    "time_since_last_cancelled_check_payment", "check_contains_metlife", "firstaction_bool",
    "previousachoptincount", "account_age", "account_age_bin", "cancelled_check_amount_ratio30",
    "check_payment_stability_30_60", "long_undecided_bool", "ach_preference_ratio",
    "avg_days_between_check_payments", "engagement_adjusted_friction", "taxonomygeneral_bin",
    "state_bin", "phone_call_density_90", "status_recency_gap", "state_tax_interact_bin",
    "active_frustration", "check_density", "undecided_high_roller", "cancel_shock",
    "recency_severity", "paper_fatigue", "revenue_velocity", "pain_point_ratio",
    "payment_acceleration", "momentum_30_lifetime", "payment_volatility_index",
    "check_failure_rate_90", "payer_fragmentation", "metlife_exposure_proxy", "rwi_phone_score",
    "interaction_friction_90",
]


def has(df: DataFrame, *cols: str) -> bool:
    """Are all of these columns present? (Feature inputs are optional.)"""
    present = {c.lower() for c in df.columns}
    return all(c.lower() in present for c in cols)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if not has(df, c)]


def require_columns(df: DataFrame, required: list[str], what: str = "input") -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} is missing {len(missing)} column(s): {missing}")
    return df


def select_available(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if has(df, c)])


def mask_names(df: DataFrame, train_names: dict[str, str]) -> DataFrame:
    """Give a scoring set the training names (``{scoring: training}``)."""
    return df.withColumnsRenamed(train_names)


def unmask_names(df: DataFrame, train_names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({train: own for own, train in train_names.items()})


def _plus(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return df.withColumns(cols) if cols else df


# --- filters and fills --------------------------------------------------------------------


def not_sponsored(null_policy: str = "strict") -> Column:
    """Row filter on the payer-sponsored flag.

    ``strict`` keeps only false (training); ``tolerant`` drops only the text ``true`` in any
    case and keeps NULL (scoring).
    """
    if null_policy == "strict":
        return ~F.col("payersponsored")
    text = F.lower(F.col("payersponsored").cast("string"))
    return text.isNull() | (text != "true")


def fill_and_filter(
    df: DataFrame, time_col: str = "duration", null_policy: str = "strict", min_days: int = 90,
    drop_duplicates: bool = False,
) -> DataFrame:
    """Fill counts, amounts and recencies, then keep rows with checks and enough history.

    Rows of the training table are unique by key; ``drop_duplicates`` is for other inputs.
    """
    if drop_duplicates:
        df = df.dropDuplicates()
    df = df.where(not_sponsored(null_policy))
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in FILL_ZERO if has(df, c)}
    filled |= {c: F.coalesce(F.col(c), F.lit(NEVER_DAYS)) for c in RECENCY if has(df, c)}
    df = _plus(df, filled).where(F.col("sumcheckpaymentcount") > 0)
    return df.where(F.col(time_col) >= min_days) if has(df, time_col) else df


# --- formulas -----------------------------------------------------------------------------


def payer_features(df: DataFrame, focus_payer: str, exact: bool = True) -> DataFrame:
    """Focus-payer flags and the number of payers of the check list.

    ``exact`` compares whole payer ids; otherwise any id containing the text matches.
    """
    if not has(df, "payerid_list_check"):
        return df
    text = F.col("payerid_list_check")
    contains = (
        F.array_contains(F.split(text, ", "), focus_payer) if exact else text.contains(focus_payer)
    )

    def flag(c):
        return F.coalesce(c.cast("int"), F.lit(0))

    return df.withColumns(
        {
            "check_contains_metlife": flag(contains),
            "check_is_only_metlife": flag(text == focus_payer),
            "payerid_check_count": F.coalesce(F.size(F.split(text, ",")), F.lit(0)),
        }
    )


def averages(df: DataFrame) -> DataFrame:
    """Mean check amount, lifetime and trailing."""
    cols = {
        "check_payment_avg": ratio(F.col("sumcheckpaymentamount"), F.col("sumcheckpaymentcount"))
    }
    for k in (30, 60, 90):
        cols[f"check_payment_avg_{k}"] = ratio(
            F.col(f"sumcheckpaymentamount{k}"), F.col(f"sumcheckpaymentcount{k}")
        )
    cols["check_payment_avg_30"] = F.coalesce(cols["check_payment_avg_30"], F.lit(0.0))
    return df.withColumns(cols)


def rates(df: DataFrame, time_col: str = "duration", fixed: bool = False) -> DataFrame:
    """Counts per day, lifetime and trailing.

    By default the 90-day cancelled rate uses the 60-day count and the 90-day phone rate
    divides by 60, as the published feature values do; ``fixed`` uses 90 throughout.
    """
    cols = {}
    if has(df, time_col):
        days = F.col(time_col)
        cols["check_paymentcount_rate"] = ratio(F.col("sumcheckpaymentcount"), days)
        cols["cancelled_check_paymentcount_rate"] = ratio(F.col("cancelledcheckpaymentcount30"), days)
        cols["phonecount_rate"] = ratio(F.col("phonecount"), days)
    for k in (30, 60, 90):
        cancelled = k if fixed or k < 90 else 60
        per = k if fixed or k < 90 else 60
        cols[f"check_paymentcount_rate_{k}"] = F.col(f"sumcheckpaymentcount{k}") / F.lit(float(k))
        cols[f"cancelled_check_paymentcount_rate_{k}"] = F.col(
            f"cancelledcheckpaymentcount{cancelled}"
        ) / F.lit(float(k))
        cols[f"phonecount_rate_{k}"] = F.col(f"phonecount{k}") / F.lit(float(per))
    return df.withColumns(cols)


def account_age(df: DataFrame) -> DataFrame:
    """Account age in days at the snapshot and the first-action flag."""
    cols = {}
    end = "snapshot_end_date" if has(df, "snapshot_end_date") else "date_end"
    if has(df, end, "providercreatedon"):
        cols["account_age"] = F.datediff(end, "providercreatedon")
    if has(df, "providercreatedon", "date_start"):
        same = F.col("providercreatedon") == F.col("date_start")
        cols["firstaction_bool"] = F.coalesce(same, F.lit(False)).cast("int")
    return _plus(df, cols)


def age_label(age: Column) -> Column:
    """Right-closed age band; NULL age has no band."""
    out = F.when(age <= AGE_EDGES[0], AGE_LABELS[0])
    for edge, label in zip(AGE_EDGES[1:], AGE_LABELS[1:]):
        out = out.when(age <= edge, label)
    return out.when(age > AGE_EDGES[-1], AGE_LABELS[-1])


def age_bin(df: DataFrame) -> DataFrame:
    return df.withColumn("account_age_bin", age_label(F.col("account_age"))) if has(df, "account_age") else df


def sponsored_shares(df: DataFrame) -> DataFrame:
    if not has(df, "sumimportantpaymentcount"):
        return df
    return df.withColumns(
        {
            "pctpaycountsponsored": ratio(
                F.col("sumpayersponsoredpaymentcount"), F.col("sumimportantpaymentcount")
            ),
            "pctpayamountsponsored": ratio(
                F.col("sumpayersponsoredpaymentamount"), F.col("sumimportantpaymentamount")
            ),
        }
    )


# Momentum features: output stem, rate stem, then (compared rate, fill for NULL) pairs.
MOMENTUM = [
    ("cancelledcheck_paymentcount_momentum_30", "cancelled_check_paymentcount_rate",
     [("alltime", 0.0), ("90", -1.0)]),
    ("check_paymentcount_momentum_30", "check_paymentcount_rate",
     [("alltime", None), ("90", -1.0), ("60", 0.0)]),
    ("phonecount_momentum_30", "phonecount_rate", [("alltime", 0.0), ("60", 0.0), ("90", 0.0)]),
]


def momentum(df: DataFrame) -> DataFrame:
    """30-day rate over a longer rate; a zero longer rate counts as 0.001."""
    cols = {}
    for stem, rate, against in MOMENTUM:
        for other, fill in against:
            longer = rate if other == "alltime" else f"{rate}_{other}"
            if has(df, longer):
                value = ratio(F.col(f"{rate}_30"), F.col(longer), 0.001)
                cols[f"{stem}_{other}"] = value if fill is None else F.coalesce(value, F.lit(fill))
    return _plus(df, cols)


def window_ratios(df: DataFrame) -> DataFrame:
    """Phone density, cancelled-amount ratio and payment stability across windows."""

    def or_else(num, den, fallback):
        value = F.col(num).cast("double") / F.nullif(F.col(den).cast("double"), F.lit(0.0))
        return F.coalesce(value, F.lit(fallback))

    cols = {}
    for w in ("", "30", "60", "90"):
        if has(df, f"phonecount{w}", f"cancelledcheckpaymentcount{w}"):
            cols[f"phone_call_density_{w}"] = or_else(
                f"phonecount{w}", f"cancelledcheckpaymentcount{w}", 0.0
            )
        if has(df, f"cancelledcheckpaymentamount{w}", f"sumcheckpaymentamount{w}"):
            cols[f"cancelled_check_amount_ratio{w}"] = or_else(
                f"cancelledcheckpaymentamount{w}", f"sumcheckpaymentamount{w}", 0.0
            )
    for x, y in combinations((30, 60, 90), 2):
        if has(df, f"check_payment_avg_{x}", f"check_payment_avg_{y}"):
            cols[f"check_payment_stability_{x}_{y}"] = or_else(
                f"check_payment_avg_{x}", f"check_payment_avg_{y}", 1.0
            )
    return _plus(df, cols)


def interactions(df: DataFrame, time_col: str = "duration", long_days: int = 365) -> DataFrame:
    """Combined features over amounts, counts, recency and calls."""
    c = F.col
    last_check = c("time_since_last_check_payment")
    last_cancelled = c("time_since_last_cancelled_check_payment")
    log_amount = F.log1p("sumcheckpaymentamount90")
    cols = {
        "avg_days_between_check_payments": ratio(c(time_col), c("sumcheckpaymentcount")),
        "check_density": ratio(c("sumcheckpaymentcount"), c(time_col)),
        "engagement_adjusted_friction": last_cancelled / (c("phonecount") + 1),
        "status_recency_gap": last_check - last_cancelled,
        "revenue_velocity": c("sumcheckpaymentamount30")
        / zero_as(c("sumcheckpaymentamount90") / F.lit(3.0), 1.0) - F.lit(1.0),
        "undecided_high_roller": c("firstaction_bool") * c("sumcheckpaymentamount90"),
        "long_undecided_bool": F.coalesce(
            (c("firstaction_bool") == 1) & (c(time_col) > long_days), F.lit(False)
        ).cast("int"),
        "payment_acceleration": (c("check_paymentcount_rate_30") - c("check_paymentcount_rate_90"))
        / zero_as(c("check_paymentcount_rate_90"), 0.001),
        "momentum_30_lifetime": ratio(
            c("check_paymentcount_rate_30"), c("check_paymentcount_rate"), 0.001
        ),
        "payment_volatility_index": F.abs(c("check_payment_avg_30") - c("check_payment_avg_90"))
        / zero_as(c("check_payment_avg_90"), 1.0),
        "check_failure_rate_90": ratio(c("cancelledcheckpaymentcount90"), c("sumcheckpaymentcount90")),
        "interaction_friction_90": ratio(c("phonecount90"), c("sumcheckpaymentcount90")),
        "payer_fragmentation": c("payerid_check_count")
        / F.when(log_amount <= 0, F.lit(1e-6)).otherwise(log_amount),
        "metlife_exposure_proxy": (
            c("check_contains_metlife") * ratio(c("check_payment_avg_30"), c("check_payment_avg"))
            if has(df, "check_contains_metlife") else F.lit(0.0)
        ),
        "sumcheckpaymentcount30_bool": F.when(c("sumcheckpaymentcount30") > 0, 1).otherwise(0),
    }
    if has(df, "previousachoptincount", "previousoptincount"):
        cols["ach_preference_ratio"] = ratio(
            F.coalesce(c("previousachoptincount"), F.lit(0)), c("previousoptincount")
        )
    if has(df, "state", "taxonomygeneral"):
        cols["state_tax_interact"] = F.concat_ws(
            "_", F.coalesce("state", F.lit("nan")), F.coalesce("taxonomygeneral", F.lit("nan"))
        )
    return df.withColumns(cols)


def phone_bands(df: DataFrame) -> DataFrame:
    """Calls per 30-day band, never negative."""
    c = F.col
    return df.withColumns(
        {
            "calls_0_30": c("phonecount30"),
            "calls_30_60": F.greatest(c("phonecount60") - c("phonecount30"), F.lit(0)),
            "calls_60_90": F.greatest(c("phonecount90") - c("phonecount60"), F.lit(0)),
        }
    )


def engineer(df: DataFrame, focus_payer: str, time_col: str = "duration", fixed: bool = False) -> DataFrame:
    """Every formula, in dependency order; one chain of projections without a shuffle."""
    df = payer_features(df, focus_payer)
    df = rates(averages(df), time_col, fixed)
    df = age_bin(account_age(df))
    df = window_ratios(momentum(sponsored_shares(df)))
    return interactions(df, time_col)


def scoring_features(df: DataFrame, time_col: str = "duration") -> DataFrame:
    """The lean set used at scoring time: tolerant filter, fills and four derived features."""
    df = fill_and_filter(df, time_col, null_policy="tolerant", drop_duplicates=True)
    rate_30 = F.col("sumcheckpaymentcount30") / F.lit(30.0)
    rate_90 = F.col("sumcheckpaymentcount90") / F.lit(90.0)
    df = df.withColumns(
        {
            "check_payment_avg_30": F.coalesce(
                ratio(F.col("sumcheckpaymentamount30"), F.col("sumcheckpaymentcount30")), F.lit(0.0)
            ),
            "check_paymentcount_momentum_30_90": F.coalesce(ratio(rate_30, rate_90, 0.001), F.lit(-1.0)),
        }
    )
    return account_age(df)


def id_columns(df: DataFrame) -> list[str]:
    return [c for c in [*KEY, "date_start", "date_end"] if has(df, c)]
