import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from spellcast.operators import binning, quality, sampling, selection
from spellcast.sources import io


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"c{i % 13}", int((i * 7919) % 101 < 5 + 6 * (i % 13 % 5))) for i in range(2600)]
    return data, spark.createDataFrame(data, "id int, c string, y int")


def brute_force_thresholds(x, y, n_bins, min_rows):
    """Best-first balanced-gini splits over single rows."""
    n, p = len(y), y.sum()
    w = np.where(y == 1, n / (2 * p), n / (2 * (n - p)))

    def mass(i):
        a, b = w[i & (y == 1)].sum(), w[i & (y == 0)].sum()
        return 2 * a * b / (a + b) if a + b else 0.0

    def best(i):
        out = None
        values = np.unique(x[i])
        for lo, hi in zip(values, values[1:]):
            t = (float(lo) + float(hi)) / 2
            left, right = i & (x <= t), i & (x > t)
            if left.sum() >= min_rows and right.sum() >= min_rows:
                gain = mass(i) - mass(left) - mass(right)
                if out is None or gain > out[0] + 1e-12:
                    out = (gain, t, left, right)
        return out

    leaves, cuts = [np.ones(n, bool)], []
    while len(leaves) < n_bins:
        options = [(best(i), k) for k, i in enumerate(leaves)]
        options = [(b, k) for b, k in options if b]
        if not options:
            break
        b, k = max(options, key=lambda o: o[0][0])
        leaves[k : k + 1] = [b[2], b[3]]
        cuts.append(b[1])
    return sorted(cuts)


def test_binner_equals_row_level_tree(spark, rows):
    data, df = rows
    fitted = binning.fit_binner(df, "c", "y", 4, min_rows=200)
    rate = {r.c: r.rate for r in fitted.rates.collect()}
    x = np.array([np.float32(rate[c]) for _, c, _ in data])
    y = np.array([t for _, _, t in data])
    want = brute_force_thresholds(x, y, 4, 200)
    assert np.allclose(fitted.thresholds, want, atol=1e-7) and len(want) == 3
    out = fitted.transform(df).groupBy("c_bin").agg(F.avg("y").alias("r")).orderBy("c_bin").collect()
    assert [o.c_bin for o in out] == [1, 2, 3, 4] and all(a.r < b.r for a, b in zip(out, out[1:]))


def test_unseen_category_takes_the_global_mean_bin(spark, rows):
    _, df = rows
    fitted = binning.fit_binner(df, "c", "y", 3, min_rows=200)
    new = spark.createDataFrame([(1, "never", 0), (2, None, 0)], "id int, c string, y int")
    got = {r.c_bin for r in fitted.transform(new).collect()}
    leaf = sum(fitted.mean > t for t in fitted.thresholds)
    assert got == {fitted.bin_of_leaf[leaf]}


def test_one_hot_unseen_is_all_zero_and_null_is_a_level(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    levels = binning.fit_levels(df, ["k"])
    assert levels == {"k": ["a", "b", None]}
    assert binning.stored_levels(binning.levels_table(df, ["k"])) == levels
    out = binning.one_hot(spark.createDataFrame([("z",), ("a",)], "k string"), levels).collect()
    assert [tuple(r) for r in out] == [(0, 0, 0), (1, 0, 0)]


def test_undersample_is_exact_and_repeatable(spark, rows):
    _, df = rows
    neg, pos = sampling.class_counts(df, "y")
    a = sampling.undersample(df, ["id"], "y", ratio=1.5)
    assert sampling.class_counts(a, "y") == (int(pos * 1.5), pos)
    b = sampling.undersample(df.repartition(7), ["id"], "y", ratio=1.5)
    assert a.select("id").exceptAll(b.select("id")).isEmpty()
    assert sampling.class_counts(sampling.undersample(df, ["id"], "y", ratio=200), "y") == (neg, pos)


def test_stratified_split_keeps_class_shares(spark, rows):
    _, df = rows
    neg, pos = sampling.class_counts(df, "y")
    marked = sampling.stratified_split(df, ["id"], "y")
    test = sampling.class_counts(marked.where("is_test"), "y")
    assert test == (round(neg * 0.2), round(pos * 0.2)) and marked.count() == neg + pos


def test_correlation_groups():
    m = [[1, 0.9, 0.1], [0.9, 1, 0.2], [0.1, 0.2, 1]]
    assert selection.correlation_groups(m, 0.8) == [0, 0, 2]


def test_quality_checks_pass_on_equal_sets_and_flag_drift(spark):
    a = spark.createDataFrame([(i, "x" if i % 4 else "y", float(i)) for i in range(400)], "id int, k string, v double")
    same = quality.run_all_checks(a, a, ["id"], ["v"], ["k"], ["k"])
    assert quality.verdict(same).first().overall_status == "PASS"
    b = a.withColumn("v", F.col("v") * 2).withColumn("k", F.when(F.col("id") % 2 == 0, "new").otherwise(F.col("k")))
    drift = {r.check_name: r.status for r in quality.run_all_checks(a, b, ["id"], ["v"], ["k"], ["k"]).collect()}
    assert drift["Data Distribution Check"] == drift["Unique Value Check"] == drift["Long Tail Check"] == "WARNING"
    assert drift["Schema Check"] == "PASS"
    structure = quality.schema_and_types(a, a.drop("v").withColumn("id", F.col("id").cast("string")))
    failed = {r.column_name: (r.schema_passed, r.type_passed) for r in structure.collect()}
    assert failed == {"id": (True, False), "k": (True, True), "v": (False, None)}


def test_duplicate_check_fails_on_missing_key(spark):
    df = spark.createDataFrame([("train", 1), ("train", 1), ("cmp", 1)], "dataset string, id int")
    got = {r.dataset: (r.duplicates, r.passed) for r in quality.duplicate_check(df, ["id"]).collect()}
    assert got == {"train": (1, False), "cmp": (0, True)}
    assert not quality.duplicate_check(df, ["nope"]).first().passed


def test_runs_csv_json_and_newest(spark, tmp_path):
    base = str(tmp_path / "runs")
    df = spark.createDataFrame([(1, 2.5), (2, None)], "id int, v double")
    for stamp, fmt in (("20240101_000000", "parquet"), ("20240201_000000", "csv")):
        io.write_run(df.withColumn("stamp", F.lit(stamp)), f"{base}/{fmt}", stamp, fmt)
    assert io.latest_run(spark, f"{base}/parquet").first().stamp == "20240101_000000"
    back = io.read_csv(spark, f"{base}/csv/run_ts=20240201_000000", "id int, v double, stamp string")
    assert sorted((r.id, r.v) for r in back.collect()) == [(1, 2.5), (2, None)]
    io.write_json(spark, {"cutoffs": {"High": 0.8}}, f"{base}/c1")
    io.write_json(spark, {"High": 0.8}, f"{base}/c2")
    assert io.read_cutoffs(spark, f"{base}/c1") == io.read_cutoffs(spark, f"{base}/c2") == {"High": 0.8}
    assert io.newest_file(spark, f"{base}/csv", "*.csv").endswith(".csv")


def test_latest_per_model(spark):
    names = ["a/p__LR__20240101_1.m", "a/p__LR__20240301_1.m", "a/p__GBT__20240201_1.m", "a/q__LR__20250101_1.m", "a/x.m"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    got = {r.model: r.path for r in io.latest_per_model(df, "p").collect()}
    assert got == {"LR": names[1], "GBT": names[2]}


def test_scan_since_pushes_the_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1))], "id int, d date").write.parquet(path)
    df = io.scan_since(spark, path, "d", dt.date(2024, 1, 15))
    assert df.columns == ["ID", "D"] and [r.ID for r in df.collect()] == [2]
    assert "GreaterThanOrEqual(d,2024-01-15)" in df._jdf.queryExecution().executedPlan().toString()


def test_fallback_write(spark, tmp_path):
    def broken(_):
        raise RuntimeError("no table")

    path = str(tmp_path / "fb")
    assert io.write_with_fallback(spark.range(3), broken, path) is False
    assert spark.read.option("header", True).csv(path).count() == 3


def test_tree_contributions_equal_brute_force(spark):
    """Coalition by coalition on single rows, and they add up to the model's output."""
    import itertools
    import math

    from spellcast.operators import contributions, train

    data = [(i, float(i * 7 % 31), float(i * 11 % 17), float(i * 5 % 13), int((i * 7 % 31) > 15 and (i * 11 % 17) < 9 or i % 29 == 0)) for i in range(800)]
    names = ["a", "b", "c"]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, y int")
    for family, grid in (("DecisionTreeClassifier", {"maxDepth": [4], "minInstancesPerNode": [5]}),
                         ("GBTClassifier", {"maxIter": [3], "maxDepth": [2]})):
        fitted = train.tune(family, df, names, "y", ["id"], None, grid)
        assert fitted.error is None
        leaves = contributions.tree_leaves(fitted.model)
        got = contributions.tree_contributions(df.where("id < 20"), fitted.model, names).orderBy("id").collect()

        def value(x, known):
            total = 0.0
            for leaf in leaves:
                w = leaf.value
                for f, lo, hi, share in leaf.path:
                    w *= float(lo < x[f] <= hi) if f in known else share
                total += w
            return total

        for r in got:
            x = [r.a, r.b, r.c]
            phi = {c.feature: c.contribution for c in r.contributions}
            for i, n in enumerate(names):
                others = [j for j in range(3) if j != i]
                want = sum(
                    math.factorial(k) * math.factorial(2 - k) / 6 * (value(x, {*s, i}) - value(x, set(s)))
                    for k in range(3) for s in itertools.combinations(others, k)
                )
                assert abs(phi[n] - want) < 1e-9
            assert abs(sum(phi.values()) + value(x, set()) - value(x, {0, 1, 2})) < 1e-9
        if family == "DecisionTreeClassifier":
            probs = {r.id: r.prob for r in train.predict(fitted.model, df.where("id < 20")).collect()}
            assert all(abs(value([r.a, r.b, r.c], {0, 1, 2}) - probs[r.id]) < 1e-9 for r in got)


def test_levels_are_positions_and_unseen_ones_are_all_zero(spark):
    from pyspark.ml.functions import vector_to_array

    from spellcast.operators import levels

    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "y"), ("a", None)], "k string, m string")
    encoder = levels.fit_encoder(df, ["k", "m"])
    assert encoder.sizes == {"k": 3, "m": 3}
    new = spark.createDataFrame([("z", "x"), ("a", "q"), (None, None)], "k string, m string")
    got = [tuple(r) for r in encoder.transform(new).select("k_index", vector_to_array("k_onehot"), vector_to_array("m_onehot")).collect()]
    assert sorted(got) == sorted([(3.0, [0, 0, 0], [1, 0, 0]), (0.0, [1, 0, 0], [0, 0, 0]), (2.0, [0, 0, 1], [0, 0, 1])])
    none = levels.fit_encoder(df.where("false"), ["k"])
    assert none.sizes == {"k": 0} and none.transform(new).select(F.sum("k_index")).first()[0] == 3


def test_200000_levels_fit_store_load_and_score(spark, tmp_path):
    """A column with a level for nearly every row: dictionary, sparse vectors, a linear model and its drivers."""
    from spellcast.operators import contributions, levels, scoring, train

    n = 200_000
    df = spark.range(n + 20_000).select(
        "id", F.when(F.col("id") >= n, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("k"), (F.col("id") % 7).cast("double").alias("x"),
        ((F.col("id") % 7 > 3) | (F.col("id") >= n)).cast("int").alias("y"),
    )
    encoder = levels.fit_encoder(df, ["k"])
    assert encoder.sizes == {"k": n + 1}
    plan = encoder.index(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and len(plan) < 20_000  # no level is part of the plan
    coded = encoder.transform(df)
    fitted = train.tune("LogisticRegression", coded, ["x", "k_onehot"], "y", ["id"], None, {"C": [1.0], "maxIter": [5]}, encoder)
    assert fitted.error is None and fitted.features == ["x", "k_onehot"]
    encoder.store(str(tmp_path / "levels"))
    again = levels.load_encoder(spark, str(tmp_path / "levels"))
    new = spark.createDataFrame([(1, "v5", 0.0), (2, "hot", 0.0), (3, "unseen", 0.0), (4, "unseen", 6.0)], "id long, k string, x double")
    scored = train.predict(fitted.model, again.transform(new))
    prob = {r.id: r.prob for r in scored.collect()}
    assert prob[2] > prob[3] and prob[4] > prob[3]
    out = scoring.top_drivers(contributions.linear_contributions(scored, fitted.model, fitted.features, again))
    top = {r.id: (r.optindriver_1, r.optindriver_2) for r in out.collect()}
    assert top[2][0] == "k_hot" and top[4][0] == "x"
    importance = train.feature_importance(spark, fitted, again).limit(2).collect()
    assert {r.feature for r in importance} == {"x", "k_hot"}


def test_sparse_levels_give_the_model_of_widened_ones(spark):
    """Scaled without centring, the vectors lead to the same probabilities and drivers as 0/1 columns."""
    from spellcast.operators import contributions, levels, scoring, train

    rows = [(i, "abcd"[(i * i) % 4 if i % 9 else 3], float(i * 7 % 23), int((i * 31) % 11 < 3 + i % 4)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k string, x double, y int")
    encoder = levels.fit_encoder(df, ["k"])
    sparse = train.tune("LogisticRegression", encoder.transform(df), ["x", "k_onehot"], "y", ["id"], None, {"C": [0.5]}, encoder)
    wide_rows = binning.one_hot(df, binning.fit_levels(df, ["k"]))
    names = [c for c in wide_rows.columns if c not in ("id", "y")]
    wide = train.tune("LogisticRegression", wide_rows, names, "y", ["id"], None, {"C": [0.5]})
    assert sparse.error is None and wide.error is None
    a = {r.id: r.prob for r in train.predict(sparse.model, encoder.transform(df)).collect()}
    b = {r.id: r.prob for r in train.predict(wide.model, wide_rows).collect()}
    assert max(abs(a[i] - b[i]) for i in a) < 1e-4
    none = levels.fit_encoder(df, [])
    one = {r.id: {c.feature: c.contribution for c in r.contributions} for r in contributions.linear_contributions(encoder.transform(df), sparse.model, sparse.features, encoder).collect()}
    two = {r.id: {c.feature: c.contribution for c in r.contributions} for r in contributions.linear_contributions(wide_rows, wide.model, names, none).collect()}
    assert all(set(one[i]) == set(two[i]) and max(abs(one[i][f] - two[i][f]) for f in one[i]) < 1e-3 for i in one)
    tree = train.tune("DecisionTreeClassifier", encoder.transform(df), ["x", "k_onehot"], "y", ["id"], None, {"maxDepth": [4], "minInstancesPerNode": [5]}, encoder)
    leaves = contributions.tree_leaves(tree.model)
    got = contributions.tree_contributions(encoder.transform(df), tree.model, tree.features, encoder)
    base = sum(leaf.value * float(np.prod([share for *_, share in leaf.path])) for leaf in leaves)
    probs = {r.id: r.prob for r in train.predict(tree.model, encoder.transform(df)).collect()}
    for r in got.collect():
        assert {c.feature for c in r.contributions} <= {"x", "k_a", "k_b", "k_c", "k_d"}
        assert abs(sum(c.contribution for c in r.contributions) + base - probs[r.id]) < 1e-9
    assert len(scoring.top_drivers(got).first().asDict()) > 10


def test_two_documents_are_an_error(spark, tmp_path):
    from spellcast.sources import io

    for name in "ab":
        (tmp_path / name).write_text('{"x": 1}')
    with pytest.raises(ValueError):
        io.read_json(spark, str(tmp_path))


def test_rows_without_a_score_rank_last(spark):
    from pyspark.sql import functions as F

    from spellcast.operators import scoring

    cut, deciles = scoring.TIER_CUTOFFS["june"], scoring.DECILE_CUTOFFS["june"]
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 0.99), (4, 0.0)], "id int, opt_in_probability double")
    p = F.col("opt_in_probability")
    scored = df.select("*", scoring.tier(p, cut).alias("opt_in_category"), scoring.decile(p, deciles).alias("decile"))
    rows = {r.id: r for r in scoring.call_order(scored, ["id"]).collect()}
    assert [rows[i].opt_in_category == scoring.TIERS[4] for i in (1, 2, 3, 4)] == [True, True, False, True]
    assert [rows[i].decile for i in (1, 2, 3)] == [10, 10, 1]
    assert [rows[i].call_target_order for i in (3, 4, 1, 2)] == [1, 2, 3, 4]


def test_checks_report_a_retyped_column(spark):
    from spellcast.operators import quality

    a = spark.createDataFrame([(1, 1.0, "a", "x"), (2, 2.0, "b", "y")], "id long, v double, c string, t string")
    b = spark.createDataFrame([(1, "one", "a", "x"), (2, "two", "b", "y")], "id long, v string, c string, t string")
    got = {r.check_name: r for r in quality.run_all_checks(a, b, ["id"], ["v"], ["c"], ["t"]).collect()}
    assert got["Data Type Check"].status == "FAIL" and got["Unique Value Check"].checked > 0


def test_publish_leaves_the_former_rows_when_a_run_fails(spark, tmp_path):
    base, table = str(tmp_path), "published_rows"
    runs = tmp_path / f"{table}__runs"
    assert io.publish(spark.range(3).toDF("id"), table, base) == 3
    assert io.publish(spark.range(5).toDF("id"), table, base) == 5 and spark.table(table).count() == 5
    broken = spark.range(40).select(F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        io.publish(broken.repartition(4), table, base)
    assert sorted(r.id for r in spark.table(table).collect()) == [0, 1, 2, 3, 4]
    assert len(list(runs.iterdir())) == 2
    # Other columns: the name goes to a new table.
    assert io.write_output(spark.range(2).select("id", F.array("id").alias("several")), table, base) == 2
    assert [tuple(r) for r in spark.table(table).orderBy("ID").collect()] == [(0, "[0]"), (1, "[1]")]
    assert [t.name for t in spark.catalog.listTables() if table in t.name] == [table]
    assert io.drop_former(spark, table, base) == 2 and spark.table(table).count() == 2
    assert io.publish(spark.range(0).toDF("id"), table, base) == 0 and spark.table(table).count() == 0
    spark.sql(f"DROP TABLE {table}")


def quantile_rows(spark):
    rng = np.random.default_rng(3)
    groups = {
        "a": rng.normal(size=20_000), "b": np.repeat([1.0, 2.0, 2.0, 7.0], 3_000), "c": np.array([5.0]), "d": np.array([1.0, 2.0]),
        "e": np.concatenate([np.zeros(9_000), rng.integers(-5, 5, 9_000)]), "f": np.array([]), "g": rng.uniform(size=3_001) ** 9,
    }
    rows = [(k, float(x)) for k, xs in groups.items() for x in xs] + [(k, None) for k in groups] + [("a", float("nan"))] * 7
    return groups, spark.createDataFrame(rows, "k string, v double").repartition(5)


PROBS = {"p00": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p999": 0.999, "p100": 1.0}


@pytest.mark.parametrize("close", [2_000_000, 400, 1])
def test_quantiles_by_sketch_are_exact(spark, monkeypatch, close):
    from spellcast.operators import ranking

    sorts = []
    monkeypatch.setattr(ranking, "CLOSE_VALUES", close)
    plain = ranking.sorted_quantiles
    monkeypatch.setattr(ranking, "sorted_quantiles", lambda *a: sorts.append(a) or plain(*a))
    groups, df = quantile_rows(spark)
    got = {r.k: [r[p] for p in PROBS] for r in ranking.exact_quantiles(df, ["k"], "v", PROBS).collect()}
    assert set(got) == {k for k, xs in groups.items() if len(xs)} and not sorts
    for k, values in got.items():
        assert np.allclose(values, np.quantile(groups[k], list(PROBS.values())), rtol=0, atol=1e-12)


def test_ranks_outside_their_fences_are_found_by_sorting(spark, monkeypatch):
    from spellcast.operators import ranking

    monkeypatch.setattr(ranking, "SKETCH_K", 8)
    monkeypatch.setattr(ranking, "SKETCH_ERROR", 0.0)
    groups, df = quantile_rows(spark)
    got = {r.k: [r[p] for p in PROBS] for r in ranking.exact_quantiles(df, ["k"], "v", PROBS).collect()}
    for k, values in got.items():
        assert np.allclose(values, np.quantile(groups[k], list(PROBS.values())), rtol=0, atol=1e-12)


def test_outlier_check_does_not_sort_the_values(spark, monkeypatch):
    from spellcast.operators import ranking

    plans = []
    plain = ranking.checkpointed
    monkeypatch.setattr(ranking, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df))
    df = spark.range(1000).select(F.when(F.col("id") < 600, "train").otherwise("cmp").alias("dataset"), F.col("id").cast("double").alias("v"))
    row = quality.outlier_check(df, ["v"]).first()
    assert abs(row.lower - (59.9 - 1.5 * 479.2)) < 1e-9 and plans
    assert not any("rangepartitioning" in p for p in plans)


def test_best_round_waits_for_patience():
    from spellcast.operators import train

    assert train.best_round([3, 2, 1, 2, 2, 2, 0.5], patience=3) == 3
    assert train.best_round([3, 2, 1, 2, 2, 0.5], patience=3) == 6
    assert train.best_round([3, 2, 1], patience=20) == 3 and train.best_round([1, 1, 1]) == 1


def test_boosting_stops_at_the_best_round(spark):
    """Held-out rows that contradict what later trees learn: the model is that of the best round, also in the fallback."""
    from spellcast.operators import train

    rng = np.random.default_rng(5)
    x, noise = rng.integers(0, 40, 1200), rng.random(1200)
    rows = [(i, float(a), float(i % 37), int((a + i % 37 > 38) != (u < 0.08))) for i, (a, u) in enumerate(zip(x, noise))]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    fit, held = df.where("id < 600"), df.where("id >= 600")
    grid = {"maxIter": [60], "maxDepth": [2], "stepSize": [0.3], "subsamplingRate": [1.0], "featureSubsetStrategy": ["all"]}
    done = train.tune("GBTClassifier", fit, ["a", "b"], "y", ["id"], held, grid)
    assert done.error is None and len(done.losses) == 60
    best = train.best_round(done.losses)
    assert best == int(np.argmin(done.losses[: best + train.PATIENCE])) + 1 < 60 and best > 1
    model = done.model.stages[-1]
    assert model.getNumTrees == best and len(model.treeWeights) == best and model.getMaxDepth() == 2
    # The cut model is the one that so many rounds would have given.
    short = train.tune("GBTClassifier", fit, ["a", "b"], "y", ["id"], None, grid | {"maxIter": [best]})
    a, b = ({r.id: r.prob for r in train.predict(m, held).collect()} for m in (done.model, short.model))
    assert max(abs(a[i] - b[i]) for i in a) < 1e-12
    broken = train.tune("GBTClassifier", fit, ["a", "b"], "y", ["id"], held, grid | {"maxDepth": [-1]})
    assert broken.error and broken.losses and broken.model.stages[-1].getNumTrees == train.best_round(broken.losses)


def test_tree_drivers_boosts_all_rounds_of_its_family(spark, tmp_path, monkeypatch):
    """The query explains a model of the family's rounds, cut at the best one on held-out rows, and not of a few rounds."""
    import dataclasses

    from spellcast.operators import train
    from spellcast.plans import model_queries

    rng = np.random.default_rng(3)
    n = 4000
    customer, year, noise = rng.integers(0, 50, n).tolist(), rng.integers(1998, 2001, n).tolist(), rng.normal(size=n).tolist()
    hit = [i % (5 + customer[i] % 25 % 7) == 0 for i in range(n)]  # the target of the view
    orders = [(i, customer[i], dt.date(year[i], 6, 1), 100 + 40 * hit[i] + 12 * noise[i]) for i in range(n)]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice double"),
        "customer": ([(c, c % 25, f"s{c % 5}", float(c)) for c in range(50)], "c_custkey long, c_nationkey long, c_mktsegment string, c_acctbal double"),
        "nation": ([(k, k % 5, f"n{k}") for k in range(25)], "n_nationkey long, n_regionkey long, n_name string"),
        "region": ([(k, f"r{k}") for k in range(5)], "r_regionkey long, r_name string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    family, fits, tune = train.FAMILIES["GBTClassifier"], [], train.tune
    monkeypatch.setitem(train.FAMILIES, "GBTClassifier", dataclasses.replace(family, grid=family.grid | {"maxIter": [40]}))
    monkeypatch.setattr(train, "tune", lambda *a, **k: fits.append(tune(*a, **k)) or fits[-1])
    out = model_queries.tree_drivers(spark, str(tmp_path))
    (fitted,) = fits
    assert fitted.error is None and fitted.params["maxIter"] == len(fitted.losses) == 40
    assert fitted.model.stages[-1].getNumTrees == train.best_round(fitted.losses) > 5
    assert out.count() == n and out.where("optindriver_1 = 'amount'").count() > n // 2


def test_models_go_to_tasks_after_an_observation(spark):
    """A session that has observed a frame cannot be sent to tasks; models must not hold it."""
    from pyspark.sql import Observation

    from spellcast.operators import train
    from spellcast.session import checkpointed

    seen = Observation("seen")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    df = spark.createDataFrame([(i, float(i % 7), int(i % 7 > 3)) for i in range(200)], "id int, a double, y int")
    for family, grid in (("LogisticRegression", {"C": [1.0]}), ("RandomForestClassifier", {"numTrees": [2], "maxDepth": [2], "minInstancesPerNode": [5], "featureSubsetStrategy": ["all"]})):
        fitted = train.tune(family, df, ["a"], "y", ["id"], None, grid)
        assert fitted.error is None and checkpointed(train.predict(fitted.model, df)).count() == 200


def test_concurrent_search_equals_the_serial_one(spark):
    from spellcast.operators import train

    rows = [(i, float(i * 7 % 31), float(i * 11 % 17), int((i * 7 % 31) > 15 and i % 5 > 0)) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    grid = {"maxDepth": [2, 4], "minInstancesPerNode": [5, 50]}
    one, four = (train.tune("DecisionTreeClassifier", df, ["a", "b"], "y", ["id"], None, grid, parallelism=n) for n in (1, 4))
    assert [(r["params"], r["pr_auc_score"]) for r in one.log] == [(r["params"], r["pr_auc_score"]) for r in four.log]
    assert one.params == four.params and len(one.log) == 4 and one.error is None and four.error is None


def test_customers_do_not_pass_through_the_driver(spark, sf_dir):
    from spellcast.plans import model_queries

    plan = model_queries.binned(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "c_custkey" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    # Fits read the joined rows, not the joins.
    assert not any("customer" in f for f in model_queries.model_rows(spark, sf_dir).inputFiles())
