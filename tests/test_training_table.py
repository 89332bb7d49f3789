"""Rules of the training-table layers on literal rows."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from spellcast.config import Settings
from spellcast.functions.dates import date_spine, next_spine_date
from spellcast.functions.nulls import null_propagating_least
from spellcast.operators import bronze, lookback, snapshots, spells

D = dt.date.fromisoformat
S = Settings(as_of=D("2024-01-01"), created_from=D("2020-01-01"), spine_start=D("2020-01-01"), spine_end=D("2023-12-31"), focus_payer="7")


def payments(spark, rows):
    return spark.createDataFrame(
        [(1, p, D(w), line, status, payer, n, float(a)) for p, w, line, status, payer, n, a in rows],
        "tin int, providerid int, paymentweek date, productline string, statusname string, payerid int, "
        "paymentcount int, paymentamount double",
    )


def providers(spark, rows):
    return spark.createDataFrame(
        [(1, p, D(c), "S", "NY") for p, c in rows],
        "tin int, providerid int, providercreatedon date, segment string, state string",
    )


def history(spark, rows):
    return spark.createDataFrame(
        [(1, p, st, line, D(d), 0, note) for p, st, line, d, note in rows],
        "tin int, providerid int, statusname string, productlinename string, statusstartdate date, "
        "optout_reason int, notes string",
    )


PAID = "Processed - Paid"


def test_valid_payment_filter_and_created_scope(spark):
    p = payments(spark, [(1, "2021-01-01", "Check", PAID, 7, 1, 1.0), (1, "2021-01-01", "Check", PAID, 7, 2, 1.5),
                         (1, "2021-01-01", "VCC", "Cancelled", 7, 1, 9), (2, "2021-01-01", "Check", PAID, 7, 1, 9)])
    pr = providers(spark, [(1, "2020-05-01"), (2, "2019-05-01")])
    valid = bronze.bronze_payments(p, pr, S).collect()
    assert [(r.checkpaymentcount, r.vccpaymentcount) for r in valid] == [(2, 0)]
    assert bronze.bronze_cancelled(p, pr, S).first().vccpaymentcount == 1


def test_least_propagates_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a int, b int")
    got = [r[0] for r in df.select(null_propagating_least(F.col("a"), F.col("b"))).collect()]
    assert got == [1, None, None]


def test_cohort0_tie_gives_both_targets(spark):
    p = payments(spark, [(1, "2021-03-01", "ACH+", PAID, 7, 1, 5), (1, "2021-03-01", "VCC", PAID, 7, 1, 5)])
    h = history(spark, [(1, "Opt-In", "VRA", "2021-02-01", None), (1, "Opt-In", "Select", "2021-02-01", None)])
    e = bronze.eligible_providers(bronze.paid_days(p, S), providers(spark, [(1, "2020-05-01")]), h, S)
    r = spells.cohort0_spells(e, S).first()
    assert (r.date_end, r.optin_target_ach, r.optin_target_vcc) == (D("2021-02-01"), 1, 1)


def test_same_day_order_and_repeated_optouts(spark):
    """Opt-out sorts before opt-in on one day; a repeated opt-out is one zero-length spell."""
    h = history(spark, [(1, "Opt-Out", "x", "2021-01-10", None), (1, "Opt-Out", "x", "2021-01-10", None),
                        (1, "Opt-Out", "x", "2021-05-01", None), (1, "Opt-In", "VRA", "2021-05-01", None)])
    p = payments(spark, [])
    e = bronze.eligible_providers(bronze.paid_days(p, S), providers(spark, [(1, "2020-05-01")]), h, S)
    actions = spells.next_action(spells.action_timeline(e, bronze.paid_days(p, S), h))
    got = [
        (str(r.date_start), str(r.date_end), r.end_status, r.previousoptincount)
        for r in spells.optout_spells(actions, e, S).orderBy("date_start", "date_end").collect()
    ]
    assert got == [
        ("2020-05-01", "2021-01-10", "Opt-Out", None),
        ("2021-01-10", "2021-01-10", "Opt-Out", 0),
        ("2021-01-10", "2021-05-01", "Opt-Out", 0),
        ("2021-05-01", "2021-05-01", "Opt-In", 0),
    ]


def test_target_repair_moves_target_to_the_paid_product(spark):
    """An ACH+ opt-in that only ever paid by VCC counts for VCC; NULL means never."""
    h = history(spark, [(1, "Opt-Out", "x", "2021-01-10", None), (1, "Opt-In", "VRA", "2021-02-10", None)])
    p = payments(spark, [(1, "2021-02-11", "VCC", PAID, 7, 3, 5)])
    e = bronze.eligible_providers(bronze.paid_days(p, S), providers(spark, [(1, "2020-05-01")]), h, S)
    sp = spells.optout_spells(spells.next_action(spells.action_timeline(e, bronze.paid_days(p, S), h)), e, S)
    r = spells.target_repair(spells.with_in_spell_counts(sp, bronze.paid_days(p, S), S)).where("start_status = 'Opt-Out'").first()
    assert (r.ach_counts_during_optin, r.vcc_counts_during_optin, r.semi_row_eligible) == (None, 3, 0)
    assert (r.new_optin_target_ach, r.new_optin_target_vcc) == (0, 1)


def test_date_spine_is_first_and_fifteenth(spark):
    s = Settings(as_of=D("2026-03-01"))
    days = [r.snap_dt for r in date_spine(spark, s).collect()]
    assert len(days) == 99 and {d.day for d in days} == {1, 15} and days[0] == D("2022-01-01")


def test_next_spine_date(spark):
    df = spark.createDataFrame([(D(x),) for x in ("2021-01-01", "2021-01-14", "2021-01-15", "2021-12-31")], "d date")
    got = [str(r[0]) for r in df.select(next_spine_date(F.col("d"), (1, 15))).collect()]
    assert got == ["2021-01-15", "2021-01-15", "2021-02-01", "2022-01-01"]


def gold_of(spark, start, end, target=1):
    spell = spark.createDataFrame(
        [("1 | 1", 1, 1, D(start), D(end), 10, target, 0)],
        "tpid string, tin int, providerid int, date_start date, date_end date, time_of_study int, "
        "optin_target_ach int, optin_target_vcc int",
    )
    return snapshots.gold_spells(spell, S)


def test_gold_needs_more_than_90_days_and_labels_within_horizon(spark):
    rows = gold_of(spark, "2021-01-01", "2021-06-10").orderBy("date_end").collect()
    assert [str(r.date_end) for r in rows] == ["2021-04-15", "2021-05-01", "2021-05-15", "2021-06-01"]
    assert [r.opt_in_ach for r in rows] == [0, 0, 1, 1]  # 40 days ahead of 1 May, 26 of 15 May


def test_lookback_end_is_exclusive_and_windows_nest(spark):
    gold = gold_of(spark, "2021-01-01", "2021-05-10")
    p = payments(spark, [(1, "2021-05-01", "Check", PAID, 7, 1, 10), (1, "2021-04-30", "Check", PAID, 8, 2, 20),
                         (1, "2021-01-01", "Check", PAID, 9, 4, 40), (1, "2020-12-31", "Check", PAID, 9, 8, 80),
                         (1, "2021-04-20", "Check", "Cancelled", 9, 16, 50)])
    row = {r.date_end: r for r in lookback.lookback_trailing(gold, p, S).collect()}[D("2021-05-01")]
    assert (row.sumcheckpaymentcount30, row.cancelledcheckpaymentcount30) == (2, 16)
    life = {r.date_end: r for r in lookback.lookback_by_product(gold, p, S).collect()}[D("2021-05-01")]
    assert (life.sumcheckpaymentcount, life.sumcheckpaymentamount) == (6, 60.0)
    assert life.lastcheckdate == D("2021-04-30") and life.sumachpaymentcount is None
    lists = {r.date_end: r for r in lookback.payer_lists(gold, p, S).collect()}[D("2021-05-01")]
    assert lists.payerid_list_check == [8, 9] and lists.payerid_list_ach is None


def test_hot_provider_day_collapses_before_the_join(spark):
    p = payments(spark, [(1, "2021-04-20", "Check", PAID, i % 3, 1, 2) for i in range(3000)])
    assert lookback.payment_days(p, S).count() == 1
    gold = gold_of(spark, "2021-01-01", "2021-05-10")
    got = [r.sumcheckpaymentcount30 for r in lookback.lookback_trailing(gold, p, S).orderBy("date_end").collect()]
    assert got == [None, 3000]


def test_prior_optout_notes(spark):
    gold = gold_of(spark, "2021-01-01", "2021-05-10")
    h = history(spark, [(1, "Opt-Out", "x", "2019-01-10", "will not pay a Fee"), (1, "Opt-Out", "x", "2021-03-01", None)])
    r = lookback.prior_optouts(gold, h, S).first()
    assert (r.total_prev_optouts, r.last_optout_note, r.optout_notes_fee_flag) == (2, None, 1)
    y = lookback.prior_optouts(gold, h, S, last_year=True).first()
    assert (y.total_prev_optouts_last_year, y.optout_notes_fee_flag_last_year) == (1, 0)


def test_last_optout_keeps_its_time(spark):
    gold = gold_of(spark, "2021-01-01", "2021-05-10")
    h = history(spark, [(1, "Opt-Out", "x", "2021-03-01", "early"), (1, "Opt-Out", "x", "2021-03-01", "late")])
    h = h.withColumn("statusstartdate", F.when(F.col("notes") == "early", F.lit("2021-03-01 08:00:00")).otherwise("2021-03-01 17:30:00").cast("timestamp_ntz"))
    r = lookback.prior_optouts(gold, h, S).first()
    assert (r.date_last_optout, r.last_optout_note, r.total_prev_optouts) == (dt.datetime(2021, 3, 1, 17, 30), "late", 2)


def test_exclusions_do_not_fan_out(spark):
    m = spark.createDataFrame([(1, 1, False, False, 31, 3), (1, 1, False, False, 31, 1)],
                              "tin int, providerid int, donotcall boolean, globalexcluded boolean, statusid int, productlineid int")
    f = spark.createDataFrame([(1, True, False)], "providerid int, iswhitelabel boolean, isdirectzero boolean")
    rows = lookback.exclusion_flags(m, f, S).collect()
    assert len(rows) == 1 and rows[0].payersponsored is True


def test_trailing_windows_must_fit_the_duration_filter():
    with pytest.raises(ValueError):
        Settings(as_of=D("2024-01-01"), trailing_days=(30, 120))


def test_payer_lists_equal_brute_force_over_many_spells(spark):
    """Circle-back spells of one provider, with payers that come before, at the start and in between."""
    rng = random.Random(4)
    starts = ["2019-03-05", "2021-01-01", "2021-08-16", "2022-06-15"]
    spans = list(zip(starts, starts[1:] + ["2023-11-20"]))
    day = lambda a, b: D(a) + dt.timedelta(days=rng.randrange((D(b) - D(a)).days))
    rows = [(rng.choice([1, 2]), str(day("2018-12-01", "2023-12-31")), rng.choice(["Check", "ACH+", "ACH Reversal"]),
             rng.choice([PAID, "Cancelled"]), rng.randrange(40), 1, 5) for _ in range(400)] + [(1, "2021-01-01", "Check", PAID, 77, 1, 5)]
    spell = spark.createDataFrame(
        [("x", 1, p, D(a), D(b), 10, 1, 0) for p in (1, 2) for a, b in spans],
        "tpid string, tin int, providerid int, date_start date, date_end date, time_of_study int, optin_target_ach int, optin_target_vcc int",
    )
    gold, p = snapshots.gold_spells(spell, S), payments(spark, rows)
    got = lookback.payer_lists(gold, p, S, snapshots.spell_spans(spell, S)).collect()
    assert len(got) > 60
    for r in got:
        mine = [x for x in rows if x[0] == r.providerid and r.date_start <= D(x[1]) < r.date_end]
        check = sorted({x[4] for x in mine if x[2] == "Check" and x[3] == PAID})
        gone = sorted({x[4] for x in mine if x[2] == "Check" and x[3] != PAID})
        total = sorted({x[4] for x in mine if x[2] != "ACH Reversal" and x[3] == PAID})
        assert (r.payerid_list_check, r.cancelled_payeridlist_check, r.payerid_list_total) == (check or None, gone or None, total or None)


def test_hot_provider_payers_are_spread_by_payer(spark):
    """100,000 payers of one provider: the payer is part of a shuffle key, and each enters once."""
    n = 100_000
    p = spark.range(n).select(
        F.lit(1).alias("tin"), F.lit(1).alias("providerid"), F.date_add(F.lit(D("2021-01-01")), (F.col("id") % 100).cast("int")).alias("paymentweek"),
        F.lit("Check").alias("productline"), F.lit(PAID).alias("statusname"), F.col("id").cast("int").alias("payerid"),
        F.lit(1).alias("paymentcount"), F.lit(5.0).alias("paymentamount"),
    )
    gold = gold_of(spark, "2021-01-01", "2021-05-10")
    entries = lookback.payer_entries(lookback.spans_of(gold), p, S)
    plan = entries._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any(re.search(r"date_start#\d+, payerid#\d+", line) for line in exchanges)
    assert entries.count() == n
    sizes = lookback.payer_lists(gold, p, S).select("date_end", F.size("payerid_list_check").alias("n")).orderBy("date_end").collect()
    assert [(str(r.date_end), r.n) for r in sizes] == [("2021-04-15", n), ("2021-05-01", n)]


def test_in_spell_counts_equal_brute_force(spark):
    rng = random.Random(9)
    day = lambda: D("2021-01-01") + dt.timedelta(days=rng.randrange(200))
    paid = [(p, day(), line, rng.choice([0, 1, 3, None])) for p in (1, 2, 3) for line in ("ACH+", "VCC") for _ in range(rng.randrange(12))]
    rows = []
    for p in (1, 2, 3, 4):
        for _ in range(25):
            end = day()
            rows.append((1, p, day(), end, "a", "b", "c", rng.choice([None, end, end + dt.timedelta(days=rng.randrange(60))])))
    rows += [(1, 1, None, None, "a", "b", "c", None), rows[0], rows[0]]
    spell = spark.createDataFrame(
        rows, "tin int, providerid int, date_start date, date_end date, start_status string, end_status string, next_productline string, next_start_date date")
    p = spark.createDataFrame(
        [(1, i, d, line, PAID, 1, n, 9.0) for i, d, line, n in paid],
        "tin int, providerid int, paymentweek date, productline string, statusname string, payerid int, paymentcount int, paymentamount double")
    out = spells.with_in_spell_counts(spell, bronze.paid_days(p, S), S)
    assert out.count() == len(rows)
    for r in out.collect():
        until = r.next_start_date or S.as_of
        for line, got in (("ACH+", r.ach_counts_during_optin), ("VCC", r.vcc_counts_during_optin)):
            hits = [n or 0 for i, d, x, n in paid if r.date_end and i == r.providerid and x == line and r.date_end <= d <= until]
            assert got == (sum(hits) if hits else None)


def test_payments_are_read_three_times(spark, sf_dir):
    from spellcast.plans import pipeline

    reads = []
    t = pipeline.fixture_table(spark, sf_dir)
    plans = [bronze.paid_days(t.src.payments, S), t.rows]
    for df in plans:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        reads.append(len(re.findall(r"Relation \[[^\]]*l_shipdate", plan)))
    assert reads == [1, 2]


def test_snapshots_are_neither_shuffled_nor_sorted(spark, sf_dir):
    """A row per snapshot comes last: above the step that generates the snapshots no rows move."""
    from spellcast.plans import pipeline, training_queries

    plans = [pipeline.fixture_table(spark, sf_dir).rows, training_queries.lookback_by_product(spark, sf_dir), training_queries.payer_lists(spark, sf_dir)]
    for df in plans:
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        above = lines[: next(i for i, line in enumerate(lines) if "Generate explode" in line)]
        assert not [line for line in above if re.search(r"Exchange|Sort |Window|Join", line)]


def test_joins_of_stored_layers_do_not_go_through_the_driver(spark, sf_dir, tmp_path):
    """Layers in files look small; a row per provider, spell or snapshot is not broadcast for that."""
    from spellcast.config import FIXTURE_SETTINGS
    from spellcast.plans import pipeline

    sources = pipeline.Sources.from_fixtures(spark, sf_dir)
    t = pipeline.StoredTable(spark, sources, FIXTURE_SETTINGS, pipeline.Sources.fixture_versions(spark, sf_dir), str(tmp_path))
    plans = [spells.all_spells(t.eligible, t.paid_days, sources.history, FIXTURE_SETTINGS), pipeline.TrainingTable.rows.func(t)]
    for df in plans:
        assert "BroadcastHashJoin [tin" not in df._jdf.queryExecution().executedPlan().toString()


def test_opt_outs_of_unknown_date_are_in_no_look_back(spark):
    gold = gold_of(spark, "2021-01-01", "2021-05-10")
    h = history(spark, [(1, "Opt-Out", "x", "2021-03-01", None)])
    h = h.union(h.withColumn("statusstartdate", F.lit(None).cast("date")))
    assert {r.total_prev_optouts for r in lookback.prior_optouts(gold, h, S).collect()} == {1}


def test_payments_are_joined_alike_at_any_size(spark, sf_dir):
    from spellcast.plans.pipeline import Sources

    sources = Sources.from_fixtures(spark, sf_dir)
    for df in (sources.payments, sources.history, sources.interactions):
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert joins and all("SortMergeJoin" in line for line in joins)


def test_payments_meet_a_few_copies_of_the_spells(spark):
    """Payers are joined with PAYER_PARTS rows a spell, not with one for every snapshot interval that it reaches into."""
    gold = gold_of(spark, "2020-01-01", "2023-11-20")
    p = payments(spark, [(1, "2021-03-01", "Check", PAID, 7, 1, 5), (1, "2021-03-01", "VCC", "Cancelled", 8, 1, 5)])
    spans = lookback.spans_of(gold)
    entries = lookback.payer_entries(spans, p, S)
    assert [(r.payerid, str(r.payerid_list_check), r.payerid_list_ach) for r in entries.collect()] == [(7, "2021-03-15", None)]
    plan = entries._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert joins and all(re.search(r"providerid#\d+\w*, part#", line) for line in joins)


def test_payer_lists_of_some_snapshots(spark):
    """Snapshots that a caller left out, and some that are there twice, have no bearing on the lists of the others."""
    rng = random.Random(6)
    rows = [(1, str(D("2020-11-01") + dt.timedelta(days=rng.randrange(700))), "Check", rng.choice([PAID, "Cancelled"]), rng.randrange(30), 1, 5) for _ in range(80)]
    gold = gold_of(spark, "2021-01-01", "2022-11-10").where(F.month("date_end") % 3 != 0)
    gold = gold.union(gold.where(F.year("date_end") == 2022))
    got = lookback.payer_lists(gold, payments(spark, rows), S).collect()
    assert sorted(r.date_end for r in got) == sorted(r.date_end for r in gold.collect())
    for r in got:
        check = {x[4] for x in rows if r.date_start <= D(x[1]) < r.date_end and x[3] == PAID}
        assert r.payerid_list_check == (sorted(check) or None)


def test_only_the_sums_asked_for_are_made(spark, sf_dir):
    """A query on a few sums moves no others, no calls, and a provider's day lists no more than once."""
    from spellcast.plans import feature_queries

    plan = feature_queries.feat_averages(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for name in ("sumachpayment", "sumvccpayment", "cancelledcheckpayment", "phonecount", "o_orderpriority"):
        assert name not in plan
    top = plan.split("collect_list")[0]
    assert "date_start" not in "".join(line for line in top.splitlines() if "Exchange" in line)


def test_rows_with_some_columns_equal_the_whole_ones(spark, sf_dir):
    """Same snapshots and same values, also where calls and payments share a day."""
    from spellcast.config import ROW_KEY
    from spellcast.plans import pipeline

    t = pipeline.fixture_table(spark, sf_dir)
    for cols in (["sumcheckpaymentamount30", "cancelledcheckpaymentcount90"], ["phonecount", "phonecount60", "sumtotalpaymentamount"]):
        some, whole = (t.rows_with(c).select(*ROW_KEY, *cols, "time_since_last_check_payment") for c in (cols, None))
        assert some.count() == whole.count() > 0 and some.exceptAll(whole).isEmpty()


@pytest.mark.parametrize("days", [(1, 15), (28, 3, 14)])
def test_spine_dates_are_cut_from_the_spine(spark, days):
    """Counted from the months, without a sequence of dates for every row; the ends are those of the spine."""
    from spellcast.functions.dates import spine_dates_between

    s = Settings(as_of=D("2003-01-01"), spine_start=D("2001-02-10"), spine_end=D("2002-11-14"), spine_days=days)
    rng = random.Random(3)
    ends = [(D("2000-11-20") + dt.timedelta(days=rng.randrange(900)), D("2000-11-20") + dt.timedelta(days=rng.randrange(900))) for _ in range(400)]
    ends += [(D("2001-02-10"), D("2001-02-10") + dt.timedelta(days=k)) for k in range(-3, 40)] + [(None, D("2002-01-01")), (D("2002-01-01"), None)]
    got = spark.createDataFrame(ends, "a date, b date").withColumn("dates", spine_dates_between(F.col("a"), F.col("b"), s))
    assert "sequence(" not in got._jdf.queryExecution().optimizedPlan().toString()
    every = [s.spine_start + dt.timedelta(days=k) for k in range((s.spine_end - s.spine_start).days + 1)]
    spine = [d for d in every if d.day in days]
    for r in got.collect():
        assert (r.dates or []) == ([d for d in spine if r.a < d <= r.b] if r.a and r.b else [])


def test_days_meet_their_spells_as_rows(spark, sf_dir):
    """A provider's days are neither gathered into one list nor taken out of it again: only the snapshots are generated."""
    from spellcast.plans import feature_queries

    for query in (feature_queries.feat_ratios, feature_queries.feat_momentum, feature_queries.feat_rates, feature_queries.scoring_rows):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Generate explode", plan)) == 1


def test_only_the_windows_asked_for_are_made(spark, sf_dir):
    from spellcast.plans import pipeline

    some = pipeline.fixture_table(spark, sf_dir).rows_with(["sumcheckpaymentcount30", "phonecount90"]).columns
    assert {"sumcheckpaymentcount30", "phonecount90"} < set(some)
    assert not {"sumcheckpaymentcount60", "sumcheckpaymentcount90", "phonecount30", "phonecount60"} & set(some)
