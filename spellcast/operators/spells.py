"""Silver layer: paper-period spells for the three opt-out cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spellcast.config import KEY, Settings
from spellcast.functions.dates import day_number
from spellcast.functions.nulls import null_propagating_least
from spellcast.operators.bronze import ACH, VCC

ATTRIBUTES = [
    "segment", "apv", "providertype", "taxonomygeneral", "taxonomyspecialty", "state",
    "providercreatedon",
]
COHORT_LABELS = {
    0: "Provider All Time Opt Outs = 0",
    1: "Provider All Time Opt Outs = 1",
    2: "Provider All Time Opt Outs > 1",
}


def tpid() -> Column:
    """``tin | providerid`` as one text."""
    return F.concat(F.col("tin").cast("string"), F.lit(" | "), F.col("providerid").cast("string"))


def with_cohort(eligible: DataFrame) -> DataFrame:
    """0 = never opted out, 1 = on one day, 2 = on several days."""
    n = F.col("optout_counts")
    return eligible.withColumn(
        "cohort", F.when(n.isNull(), 0).when(n == 1, 1).when(n > 1, 2)
    )


def attributes_of(df: DataFrame) -> list[str]:
    return [c for c in ATTRIBUTES if c in df.columns]


def cohort0_spells(eligible: DataFrame, s: Settings) -> DataFrame:
    """From account creation to the first opt-in (or ``as_of``) for providers without opt-outs.

    The four branches are disjoint, so they are one projection instead of a union.
    """
    ach = null_propagating_least(F.col("firstachpaydate"), F.col("date_first_ach_optin"))
    vcc = null_propagating_least(F.col("firstvccpaydate"), F.col("date_first_vcc_optin"))
    has_ach, has_vcc = F.col("optin_ach") == 1, F.col("optin_vcc") == 1
    date_end = (
        F.when(has_ach & has_vcc, F.when(ach < vcc, ach).otherwise(vcc))
        .when(has_ach, ach)
        .when(has_vcc, vcc)
        .otherwise(F.lit(s.as_of))
    )
    target_ach = F.when(has_ach & has_vcc, F.when(ach <= vcc, 1).otherwise(0)).otherwise(F.col("optin_ach"))
    target_vcc = F.when(has_ach & has_vcc, F.when(vcc <= ach, 1).otherwise(0)).otherwise(F.col("optin_vcc"))
    return (
        with_cohort(eligible)
        .where(F.col("cohort") == 0)
        .select(
            tpid().alias("tpid"), *KEY, *attributes_of(eligible),
            F.col("providercreatedon").alias("date_start"),
            date_end.alias("date_end"),
            F.datediff(date_end, F.col("providercreatedon")).alias("time_of_study"),
            target_ach.alias("optin_target_ach"),
            target_vcc.alias("optin_target_vcc"),
            F.lit(COHORT_LABELS[0]).alias("silver_cohort"),
        )
    )


def action_timeline(eligible: DataFrame, paid: DataFrame, history: DataFrame) -> DataFrame:
    """Creation, opt-out and opt-in actions of providers that ever opted out.

    Equal actions of one provider-day are one row with their number in ``n_events``; a
    provider with very many payments thus adds a calendar-bounded number of rows. ``paid``
    comes from ``bronze.paid_days``.
    """
    line = F.col("productlinename")
    is_out = F.col("statusname") == "Opt-Out"
    from_history = history.where(
        is_out | ((F.col("statusname") == "Opt-In") & (line.like("%VRA%") | line.like("%Select%")))
    ).select(
        *KEY,
        F.to_date("statusstartdate").alias("action_date"),
        F.when(is_out, "Opt-Out").otherwise("Opt-In").alias("action_type"),
        F.when(is_out, F.lit(None)).when(line.like("%VRA%"), ACH).otherwise(VCC).alias("productline"),
        F.lit(1).cast("long").alias("n"),
    )
    kinds = F.array(F.struct(F.lit(ACH).alias("line"), F.col("ach_rows").alias("n")), F.struct(F.lit(VCC).alias("line"), F.col("vcc_rows").alias("n")))
    from_payments = (
        paid.select(*KEY, F.col("day").alias("action_date"), F.explode(kinds).alias("kind"))
        .where("kind.n > 0")
        .select(*KEY, "action_date", F.lit("Opt-In").alias("action_type"), F.col("kind.line").alias("productline"), "kind.n")
    )
    events = (
        from_history.unionByName(from_payments)
        .groupBy(*KEY, "action_date", "action_type", "productline")
        .agg(F.sum("n").alias("n_events"))
    )
    ever_out = with_cohort(eligible).where(F.col("cohort") > 0)
    creation = ever_out.select(
        *KEY,
        F.col("providercreatedon").alias("action_date"),
        F.lit("Account Creation").alias("action_type"),
        F.lit(None).cast("string").alias("productline"),
        F.lit(1).cast("long").alias("n_events"),
        "cohort",
    )
    return events.join(ever_out.select(*KEY, "cohort").hint("merge"), KEY).unionByName(creation)


def next_action(timeline: DataFrame) -> DataFrame:
    """Each action with the one that follows, in the total order date, action rank, product line."""
    rank = (
        F.when(F.col("action_type") == "Account Creation", 0)
        .when(F.col("action_type") == "Opt-Out", 1)
        .otherwise(2)
    )
    w = Window.partitionBy(*KEY).orderBy("action_date", "action_rank", "productline")
    return timeline.withColumn("action_rank", rank).select(
        "*",
        F.lead("action_date").over(w).alias("next_action_date"),
        F.lead("action_type").over(w).alias("next_action_type"),
        F.lead("productline").over(w).alias("next_productline"),
    )


def optout_spells(actions: DataFrame, eligible: DataFrame, s: Settings) -> DataFrame:
    """Spells of the cohorts with opt-outs, with their history columns.

    Two or more equal opt-outs on one day form a zero-length spell before the real one
    (providers with several opt-out days only); such repeats are one row.
    """
    out, created = F.col("action_type") == "Opt-Out", F.col("action_type") == "Account Creation"
    nxt, many = F.col("next_action_type"), F.col("cohort") == 2
    repeat = F.col("part") == 0
    parts = F.when(out & many & (F.col("n_events") > 1), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(1))
    )
    spells = (
        actions.withColumn("part", F.explode(parts))
        .where(created | repeat | (out & (nxt.isNull() | (nxt == "Opt-In") | (many & (nxt == "Opt-Out")))))
        .select(
            *KEY, "cohort", "part", "action_rank",
            F.col("action_date").alias("date_start"),
            F.when(repeat, F.col("action_date"))
            .otherwise(F.coalesce("next_action_date", F.lit(s.as_of)))
            .alias("date_end"),
            F.col("action_type").alias("start_status"),
            F.when(repeat, F.lit("Opt-Out")).otherwise(nxt).alias("end_status"),
            F.when(~repeat, F.col("next_productline")).alias("next_productline"),
        )
    )
    w = Window.partitionBy(*KEY).orderBy("date_start", "action_rank", "part")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    opted_in = F.coalesce(F.col("end_status") == "Opt-In", F.lit(False))
    into_ach = opted_in & (F.col("next_productline") == ACH)
    into_vcc = opted_in & (F.col("next_productline") == VCC)

    def one(cond):
        return F.when(cond, 1).otherwise(0)

    windowed = spells.select(
        "*",
        F.sum(one(opted_in)).over(before).alias("previousoptincount"),
        F.sum(one(into_ach)).over(before).alias("previousachoptincount"),
        F.sum(one(into_vcc)).over(before).alias("previousvccoptincount"),
        F.lag("date_start").over(w).alias("previous_start_date"),
        F.lag("start_status").over(w).alias("previous_start_status"),
        F.lag("date_end").over(w).alias("previous_end_date"),
        F.lag("end_status").over(w).alias("previous_end_status"),
        F.lead("date_start").over(w).alias("next_start_date"),
        F.lead("start_status").over(w).alias("next_start_status"),
    ).select(
        "*",
        F.when(
            F.col("previous_end_status") == "Opt-In",
            F.datediff("date_start", "previous_end_date"),
        ).alias("lastoptinduration"),
        F.datediff("date_end", "date_start").alias("time_of_study"),
        one(into_ach).alias("optin_target_ach"),
        one(into_vcc).alias("optin_target_vcc"),
    )
    return (
        windowed.drop("part", "action_rank")
        .join(eligible.select(*KEY, *attributes_of(eligible)).hint("merge"), KEY, "left")
        .withColumn("tpid", tpid())
    )


def with_in_spell_counts(spells: DataFrame, paid: DataFrame, s: Settings) -> DataFrame:
    """Add ACH+ and VCC payment counts between a spell's end and the next spell's start (closed).

    NULL means there was no such payment at all. Every spell has two edges, the day before its
    end and the last day that counts; edges and paid days of a provider lie in one order, where
    running totals are taken at the edges, and a spell's count is the difference of its two.
    So the work is linear in paid days and spells, and no spell holds a provider's days.
    """
    until = F.coalesce("next_start_date", F.lit(s.as_of))
    order = [F.col(c) for c in ("date_start", "date_end", "start_status", "end_status", "next_productline")]
    numbered = spells.withColumn("_spell", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)))
    edges = F.array(
        F.struct(F.lit(0).alias("side"), (day_number(F.col("date_end")) - 1).alias("day_no")),
        F.struct(F.lit(1).alias("side"), day_number(until).alias("day_no")),
    )
    at_edges = numbered.withColumn("_edge", F.explode(edges)).select("*", "_edge.side", "_edge.day_no").drop("_edge")
    days = paid.select(*KEY, day_number(F.col("day")).alias("day_no"), "ach", "vcc")
    running = Window.partitionBy(*KEY).orderBy("day_no").rangeBetween(Window.unboundedPreceding, 0)
    totals = {f"_{f}_{k}": F.coalesce(agg(k).over(running), F.lit(0)) for k in ("ach", "vcc") for f, agg in (("sum", F.sum), ("days", F.count))}
    of_spell = Window.partitionBy(*KEY, "_spell").orderBy("side")
    both = (
        at_edges.unionByName(days, allowMissingColumns=True)
        .withColumns(totals)
        .where(F.col("side").isNotNull())
        .withColumns({c: F.col(c) - F.lag(c).over(of_spell) for c in totals})
        .where(F.col("side") == 1)
    )

    def total(kind: str) -> Column:
        return F.when(F.col("date_end").isNotNull() & (F.col(f"_days_{kind}") > 0), F.col(f"_sum_{kind}"))

    return both.select(*spells.columns, *(total(k).alias(f"{k}_counts_during_optin") for k in ("ach", "vcc")))


def target_repair(spells: DataFrame) -> DataFrame:
    """Row eligibility and repaired targets: an opt-in without a payment of its own kind but
    with one of the other kind counts for the other."""
    ach, vcc = F.col("optin_target_ach"), F.col("optin_target_vcc")
    paid_ach = F.col("ach_counts_during_optin").isNotNull()
    paid_vcc = F.col("vcc_counts_during_optin").isNotNull()
    eligible = F.when(
        ((ach == 0) & (vcc == 0)) | ((ach == 1) & paid_ach) | ((vcc == 1) & paid_vcc), 1
    ).otherwise(0)
    label = F.when(F.col("cohort") == 1, COHORT_LABELS[1]).otherwise(COHORT_LABELS[2])
    semi = F.col("semi_row_eligible") == 1
    return (
        spells.withColumn("silver_cohort", label)
        .withColumn("semi_row_eligible", eligible)
        .withColumn("new_optin_target_ach", F.when(semi, ach).when((vcc == 1) & paid_ach, 1).otherwise(0))
        .withColumn("new_optin_target_vcc", F.when(semi, vcc).when((ach == 1) & paid_vcc, 1).otherwise(0))
    )


def all_spells(eligible: DataFrame, paid: DataFrame, history: DataFrame, s: Settings) -> DataFrame:
    """Distinct union of the spells of all cohorts."""
    never = cohort0_spells(eligible, s).select(
        "tpid", *KEY, *attributes_of(eligible), "date_start", "date_end",
        F.lit(0).cast("long").alias("previousoptincount"),
        F.lit(0).cast("long").alias("previousachoptincount"),
        F.lit(0).cast("long").alias("previousvccoptincount"),
        F.lit(None).cast("int").alias("lastoptinduration"),
        "time_of_study", "optin_target_ach", "optin_target_vcc", "silver_cohort",
    )
    spells = optout_spells(next_action(action_timeline(eligible, paid, history)), eligible, s)
    repaired = target_repair(with_in_spell_counts(spells, paid, s)).select(
        "tpid", *KEY, *attributes_of(eligible), "date_start", "date_end",
        "previousoptincount", "previousachoptincount", "previousvccoptincount",
        "lastoptinduration", "time_of_study",
        F.col("new_optin_target_ach").alias("optin_target_ach"),
        F.col("new_optin_target_vcc").alias("optin_target_vcc"),
        "silver_cohort",
    )
    return never.unionByName(repaired).distinct()
