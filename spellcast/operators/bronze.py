"""Bronze layer: typed payments and one row of dates per eligible provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spellcast.config import CANCELLED_STATUS, KEY, PRODUCT_LINES, VALID_STATUSES, Settings

ACH = PRODUCT_LINES["ach"]
VCC = PRODUCT_LINES["vcc"]


def is_valid_payment(s: Settings) -> Column:
    return F.col("statusname").isin(*VALID_STATUSES) & (F.col("paymentamount") > s.min_amount)


def is_cancelled_payment(s: Settings) -> Column:
    return (F.col("statusname") == CANCELLED_STATUS) & (F.col("paymentamount") > s.min_amount)


def _created_in_scope(providers: DataFrame, s: Settings) -> DataFrame:
    return providers.where(F.col("providercreatedon") >= F.lit(s.created_from))


def _typed(payments: DataFrame, providers: DataFrame, keep: Column, s: Settings) -> DataFrame:
    amounts = []
    for prefix, line in PRODUCT_LINES.items():
        hit = F.col("productline") == line
        amounts += [
            F.when(hit, F.col("paymentcount")).otherwise(0).alias(f"{prefix}paymentcount"),
            F.when(hit, F.col("paymentamount")).otherwise(0.0).alias(f"{prefix}paymentamount"),
        ]
    created = _created_in_scope(providers, s).select(*KEY, "providercreatedon")
    return payments.where(keep).join(created, KEY).select("*", *amounts)


def bronze_payments(payments: DataFrame, providers: DataFrame, s: Settings) -> DataFrame:
    """Valid payments of providers in scope, with a count and amount column per product line."""
    return _typed(payments, providers, is_valid_payment(s), s)


def bronze_cancelled(payments: DataFrame, providers: DataFrame, s: Settings) -> DataFrame:
    """Cancelled payments of providers in scope, same shape as ``bronze_payments``."""
    return _typed(payments, providers, is_cancelled_payment(s), s)


def status_days(history: DataFrame) -> DataFrame:
    """History collapsed to provider-days with opt-in / opt-out flags.

    The first of two aggregation levels: a provider's rows are spread over the tasks by
    ``(key, day)``, so only a calendar-bounded number of rows per provider moves on.
    """
    opt_in = F.col("statusname") == "Opt-In"
    line = F.col("productlinename")
    flags = {
        "ach_in": opt_in & line.like("%VRA%"),
        "vcc_in": opt_in & line.like("%Select%"),
        "out": F.col("statusname") == "Opt-Out",
    }
    return (
        history.where(F.col("statusname").isin("Opt-In", "Opt-Out"))
        .groupBy(*KEY, F.to_date("statusstartdate").alias("day"))
        .agg(*[F.max(c.cast("int")).alias(n) for n, c in flags.items()])
    )


def paid_days(payments: DataFrame, s: Settings) -> DataFrame:
    """Valid ACH+ and VCC payments by provider-day: number of rows and payment count of each.

    The one scan of the payments that eligibility, the timeline and the in-spell counts need.
    A count is NULL where the day has no payment of that kind.
    """
    line, n = F.col("productline"), F.coalesce(F.col("paymentcount"), F.lit(0)).cast("long")
    aggs = []
    for kind, value in (("ach", ACH), ("vcc", VCC)):
        aggs += [F.count(F.when(line == value, 1)).alias(f"{kind}_rows"), F.sum(F.when(line == value, n)).alias(kind)]
    kept = payments.where(is_valid_payment(s) & line.isin(ACH, VCC))
    return kept.groupBy(*KEY, F.to_date("paymentweek").alias("day")).agg(*aggs)


def eligible_providers(
    paid: DataFrame, providers: DataFrame, history: DataFrame, s: Settings
) -> DataFrame:
    """Providers in scope with first payment dates, opt-in / opt-out dates and day counts.

    Both event sources are aggregated to one row per provider before they are joined, so
    the joins are one-to-one. ``paid`` comes from ``paid_days``. Stored layers of a row per provider look
    small enough to be sent to the driver, as they compress well; so joins on the provider name their kind.
    """
    first_paid = paid.groupBy(*KEY).agg(
        F.min(F.when(F.col("ach_rows") > 0, F.col("day"))).alias("firstachpaydate"),
        F.min(F.when(F.col("vcc_rows") > 0, F.col("day"))).alias("firstvccpaydate"),
    )

    def stats(flag: str, first: str, last: str, n: str) -> list[Column]:
        on = F.col(flag) == 1
        return [
            F.min(F.when(on, F.col("day"))).alias(first),
            F.max(F.when(on, F.col("day"))).alias(last),
            F.nullif(F.sum(flag), F.lit(0)).alias(n),
        ]

    per_provider = (
        status_days(history)
        .groupBy(*KEY)
        .agg(
            *stats("ach_in", "date_first_ach_optin", "date_last_ach_optin", "ach_optin_count"),
            *stats("vcc_in", "date_first_vcc_optin", "date_last_vcc_optin", "vcc_optin_count"),
            *stats("out", "date_first_optout", "date_last_optout", "optout_counts"),
        )
    )
    return (
        _created_in_scope(providers, s)
        .join(first_paid.hint("merge"), KEY, "left")
        .join(per_provider.hint("merge"), KEY, "left")
        .withColumn("optin_ach", F.col("firstachpaydate").isNotNull().cast("int"))
        .withColumn("optin_vcc", F.col("firstvccpaydate").isNotNull().cast("int"))
    )
