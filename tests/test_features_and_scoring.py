import pytest
from pyspark.sql import functions as F

from spellcast.functions import features as fx
from spellcast.operators import evaluate as ev
from spellcast.operators import ranking as rk
from spellcast.operators import scoring as sc


def test_sponsored_filter_policies(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "payersponsored boolean")
    assert df.where(fx.not_sponsored("strict")).count() == 1
    assert df.where(fx.not_sponsored("tolerant")).count() == 2


def test_rates_keep_the_published_90_day_inputs_unless_fixed(spark):
    cols = {f"{p}{k}": float(k) for p in ("sumcheckpaymentcount", "cancelledcheckpaymentcount", "phonecount") for k in (30, 60, 90)}
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    r = fx.rates(df).first()
    assert r.cancelled_check_paymentcount_rate_90 == 60 / 90 and r.phonecount_rate_90 == 90 / 60
    r = fx.rates(df, fixed=True).first()
    assert r.cancelled_check_paymentcount_rate_90 == 1.0 and r.phonecount_rate_90 == 1.0


def test_payer_match_exact_or_by_text(spark):
    df = spark.createDataFrame([("17, 71",), ("7",), (None,)], "payerid_list_check string")
    exact = [tuple(r)[1:] for r in fx.payer_features(df, "7").collect()]
    assert exact == [(0, 0, 2), (1, 1, 1), (0, 0, 0)]
    assert [r.check_contains_metlife for r in fx.payer_features(df, "7", exact=False).collect()] == [1, 1, 0]


def test_age_bands_are_right_closed(spark):
    df = spark.createDataFrame([(730,), (731,), (4380,), (4381,), (None,)], "account_age int")
    got = [r[0] for r in df.select(fx.age_label(F.col("account_age"))).collect()]
    assert got == ["LT2YR_OLD", "BT2_4YR_OLD", "BT10_12YR_OLD", "GT12YR_OLD", None]


def test_missing_columns_raise_and_optional_columns_are_skipped(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="missing 1"):
        fx.require_columns(df, ["id", "nope"])
    assert fx.select_available(df, ["nope", "id"]).columns == ["id"]
    assert fx.age_bin(df).columns == ["id"]


def test_masking_names_round_trip(spark):
    names = {"own_target": "train_target"}
    df = spark.range(1).withColumnRenamed("id", "own_target")
    assert fx.unmask_names(fx.mask_names(df, names), names).columns == ["own_target"]


@pytest.fixture(scope="module")
def tied(spark):
    """Scores with a third of all rows on one value."""
    rows = [(i, 0.5 if i % 3 == 0 else (i * 37 % 101) / 101.0, int(i % 7 == 0)) for i in range(600)]
    return rows, spark.createDataFrame(rows, "id int, prob double, target int")


def test_row_number_is_global_and_total(tied):
    rows, df = tied
    got = {r.id: r.row_number for r in rk.with_row_number(df, [F.desc("prob"), "id"]).collect()}
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == want


def test_bucket_sizes_match_array_split(spark):
    numbers = spark.range(1, 24).withColumn("b", rk.bucket_of(F.col("id"), F.lit(23), F.lit(10)))
    sizes = [r["count"] for r in numbers.groupBy("b").count().orderBy("b").collect()]
    assert sizes == [3, 3, 3] + [2] * 7


def test_exact_quantiles_match_linear_interpolation(spark):
    import numpy as np

    values = [float(x * x % 97) for x in range(200)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    r = rk.exact_quantiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).first()
    assert np.allclose([r.p10, r.p50, r.p99], np.quantile(values, [0.1, 0.5, 0.99]))


def test_auc_equals_pair_counting_and_ap(tied):
    rows, df = tied
    r = ev.auc_ap(ev.score_table(df.withColumn("m", F.lit(1)), ["m"]), ["m"]).first()
    pos = [p for _, p, t in rows if t]
    neg = [p for _, p, t in rows if not t]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert abs(r.roc_auc - wins / (len(pos) * len(neg))) < 1e-12
    ap, tp, seen = 0.0, 0, 0
    for p in sorted({x[1] for x in rows}, reverse=True):
        here = [x for x in rows if x[1] == p]
        tp, seen, gain = tp + sum(x[2] for x in here), seen + len(here), sum(x[2] for x in here)
        ap += gain / len(pos) * tp / seen
    assert abs(r.average_precision - ap) < 1e-12


def test_quantile_table_invariants(tied):
    _, df = tied
    t = ev.quantile_table(df, ["id"], (10, 20)).toPandas()
    for n, part in t.groupby("n_bins"):
        assert part.counts.sum() == 600 and part.counts.max() - part.counts.min() <= 1
        assert abs(part.overall_target_pct.sum() - 100) < 1e-9 and len(part) == n


def test_cutoffs_cover_and_empty_buckets_show_zero(tied, spark):
    _, df = tied
    bins = ev.cutoff_list(ev.cutoffs(ev.quantile_table(df, ["id"], (10,))))
    assert bins[10][0][2] == 10.0 and bins[10][-1][1] == 0.0
    high = df.where("prob > 0.95").withColumn("split", F.lit("x"))
    t = ev.apply_cutoffs(ev.score_table(high, ["split"]), bins, ["split"]).toPandas()
    assert len(t) == 10 and t.counts.sum() == high.count() and (t.counts == 0).sum() >= 8


def test_tiers_deciles_and_order(spark):
    c = sc.TIER_CUTOFFS["august"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate((0.99, c["High"], 0.7, 0.3, 0.0, 0.95))], "id int, opt_in_probability double")
    df = df.withColumn("opt_in_category", sc.tier(F.col("opt_in_probability"), c))
    got = {r.id: (r.opt_in_category, r.opt_in_order_within_category, r.call_target_order) for r in sc.call_order(df, ["id"]).collect()}
    assert got[0] == ("Very High", 1, 1) and got[5] == ("Very High", 2, 2) and got[1] == ("High", 1, 3)
    assert got[4] == ("Very Low", 1, 6)
    d = sc.DECILE_CUTOFFS["june"]
    probs = spark.createDataFrame([(d["d10_min"],), (d["d2_min"],), (0.0,)], "p double")
    assert [r[0] for r in probs.select(sc.decile(F.col("p"), d)).collect()] == [1, 9, 10]


def test_drivers_threshold_order_and_padding(spark):
    df = spark.createDataFrame([(1, 2.0, 10.0, 0.0)], "id int, a double, b double, c double")
    df = sc.linear_contributions(df, {"a": 1.0, "b": -1.0, "c": 0.001}, {"a": 0.0, "b": 0.0, "c": 1.0})
    r = sc.top_drivers(df, {"b": "the b"}, top_n=3).first()
    assert (r.optindriver_1, r.optindriver_1_value, r.optindriver_2, r.optindriver_3) == ("the b", 10.0, "a", None)
