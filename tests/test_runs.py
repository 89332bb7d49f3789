"""Whole runs on the smallest scale factor."""

import dataclasses
import datetime as dt
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from spellcast.config import FIXTURE_SETTINGS, ROW_KEY
from spellcast.operators import scoring
from spellcast.plans import pipeline, retrain, score
from spellcast.session import checkpointed
from spellcast.sources import io


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return pipeline.fixture_table(spark, sf_dir)


def test_entry_and_keys(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("without", ["spellcast/llm corpus_pipeline.py", "spellcast/llm", "corpus_pipeline.py"])
def test_entry_without_the_optional_operators(tmp_path, without):
    """The registry of everything else stays whole when the optional folders are gone."""
    ignored = shutil.ignore_patterns(".git", "__pycache__", "tests", *([] if "llm" not in without else ["llm"]), *[x for x in without.split() if x.endswith(".py")])
    shutil.copytree(REPO, tmp_path / "copy", ignore=ignored)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(k.startswith('op') and k[2].isdigit() for k in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, oracles, numbered = map(int, out.stdout.split())
    assert n - numbered - ("pipeline" in entry.queries() and "llm" not in without and "corpus" not in without) >= 86 and oracles > 70
    assert (numbered == 0) == ("llm" in without)


def test_plan_has_no_pairwise_join(table):
    plan = table.rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan
    physical = table.rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in physical and "CartesianProduct" not in physical


def test_look_back_windows_nest(table):
    r = table.rows
    zero = F.lit(0)
    c = {k: F.coalesce(f"sumcheckpaymentcount{k}", zero) for k in ("", "30", "60", "90")}
    bad = r.where((c["30"] > c["60"]) | (c["60"] > c["90"]) | (c["90"] > c[""]))
    assert bad.isEmpty() and r.count() == r.select("tin", "providerid", "date_start", "date_end").distinct().count()


def test_retrain_and_score(spark, table, tmp_path):
    cfg = retrain.RetrainConfig(
        train_end=dt.date(1999, 1, 1), val_end=dt.date(2000, 1, 1), target="opt_in_vcc", undersample_ratio=20,
        models=("LogisticRegression", "DecisionTreeClassifier"), n_bins=(10, 20), min_bin_rows=100,
        overrides={"LogisticRegression": {"C": [1.0]}, "DecisionTreeClassifier": {"maxDepth": [3], "minInstancesPerNode": [20]}},
    )
    rows = checkpointed(table.rows)
    checked = {"duration", "sumcheckpaymentcount30", "account_age", "opt_in_vcc", "segment", "state", "payerid_list_check", *ROW_KEY}
    engineered = retrain.prepare(rows, FIXTURE_SETTINGS, cfg).columns
    cfg = dataclasses.replace(cfg, not_considered=tuple(c for c in engineered if c not in checked | {"split"}))
    result = retrain.retrain(rows, FIXTURE_SETTINGS, cfg)
    assert all(f.model is not None and f.error is None for f in result.fitted.values())
    assert {"providertype", "segment"} <= set(result.encoder.sizes) and not set(result.encoder.sizes) & set(result.features)
    board = result.leaderboard.toPandas()
    assert len(board) == 6 and set(board.model_rank) == {1, 2}
    assert set(result.checks) == {"val", "oos"}
    catalog, stamp = io.Catalog(str(tmp_path)), "20240101_000000"
    retrain.store(spark, result, catalog, stamp)
    path = f"{catalog.path('models')}/project__LogisticRegression__{stamp}"
    model, features = io.load_model(spark, path)
    assert features == result.features
    assert io.latest_run(spark, f"{catalog.path('results')}/tuning_log/LogisticRegression").columns[0] == "model"
    for name in ("feature_importance/DecisionTreeClassifier", "checks_val", "checks_oos", "leaderboard"):
        assert io.latest_run(spark, f"{catalog.path('results')}/{name}").count() > 0
    sizes = [io.latest_run(spark, catalog.path(f"preprocessed_{split}")).count() for split in ("train", "val", "oos")]
    assert all(sizes) and sum(sizes) == result.encoded.count()
    # The stored artifacts alone score new rows as the run itself did.
    binners, encoder = retrain.load_encoders(spark, f"{catalog.path('models')}/project__encoders__{stamp}")
    assert encoder.sizes == result.encoder.sizes and set(binners) == set(result.binners)
    prepared = score.prepare_retrained(rows, FIXTURE_SETTINGS, binners, encoder)
    again = score.score(prepared, model, features, scoring.TIER_CUTOFFS["june"], scoring.DECILE_CUTOFFS["june"])
    ids = ["tin", "providerid", "date_start", "date_end"]
    before = result.scored.where(F.col("model") == "LogisticRegression").select(*ids, "prob")
    both = before.join(again.select(*ids, "opt_in_probability"), ids).withColumn("off", F.abs(F.col("prob") - F.col("opt_in_probability")))
    n, off = both.agg(F.count("*"), F.max("off")).first()
    assert n == before.count() and off < 1e-9

    # A scoring run from a scan to the written rows, with a linear and a tree model.
    rows.write.parquet(str(tmp_path / "new"))
    rows = io.scan_since(spark, str(tmp_path / "new"), "date_end", dt.date(1999, 6, 1))
    for name in ("LogisticRegression", "DecisionTreeClassifier"):
        done = score.run(
            spark, rows, FIXTURE_SETTINGS, catalog, name, stamp, scoring.TIER_CUTOFFS["june"], scoring.DECILE_CUTOFFS["june"], f"scored_{name.lower()}",
            base=str(tmp_path / "out"),
        )
        out = spark.table(done.table)
        assert out.count() == done.n > 0 and out.columns[:4] == [c.upper() for c in ids] and {"SEGMENT", "CALL_TARGET_ORDER", "OPTINDRIVER_1"} <= set(out.columns)
        order = [r[0] for r in out.select("CALL_TARGET_ORDER").orderBy("CALL_TARGET_ORDER").collect()]
        assert order == list(range(1, done.n + 1))
        falling = out.orderBy("CALL_TARGET_ORDER").select("OPT_IN_PROBABILITY").toPandas().OPT_IN_PROBABILITY
        assert falling.is_monotonic_decreasing
        assert out.where("OPTINDRIVER_1 is not null").count() > 0
        assert sum(r.n for r in done.tiers.collect()) == done.n
        spark.sql(f"DROP TABLE {done.table}")


def test_only_key_tier_and_score_are_numbered(spark, monkeypatch):
    """The numbering stores narrow rows; the wide ones are joined to it."""
    from spellcast.operators import ranking

    stored = []
    plain = ranking.checkpointed
    monkeypatch.setattr(ranking, "checkpointed", lambda df: stored.append(df.columns) or plain(df))
    df = spark.createDataFrame([(1, None, 0.5, "w"), (None, 2, 0.9, "x"), (1, 1, None, "y"), (None, None, 0.1, "z")], "a int, b int, opt_in_probability double, wide string")
    df = df.withColumn("opt_in_category", scoring.tier(F.col("opt_in_probability"), scoring.TIER_CUTOFFS["june"]))
    got = {r.wide: (r.call_target_order, r.opt_in_order_within_category) for r in scoring.call_order(df, ["a", "b"]).collect()}
    assert got == {"x": (1, 1), "w": (2, 1), "z": (3, 1), "y": (4, 2)}
    assert stored == [["_tier", "_score", "_a", "_b", "_at"]]


def test_repeated_and_clashing_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert retrain.unique_rows(df, ["k"]).count() == 2
    with pytest.raises(ValueError):
        retrain.unique_rows(df.union(spark.createDataFrame([(2, "c")], "k int, v string")), ["k"])


def test_a_failed_run_resumes_after_its_last_layer(spark, sf_dir, tmp_path):
    """A run that fails after the spells leaves them, with the error as text; the next one builds only the rest."""
    src = pipeline.Sources.from_fixtures(spark, sf_dir)
    versions = pipeline.Sources.fixture_versions(spark, sf_dir)
    broken = dataclasses.replace(src, interactions=src.interactions.withColumn("actionname", F.raise_error(F.lit("lost contacts")).cast("string")))
    base, target = str(tmp_path / "base"), "trained_rows"
    first = pipeline.run_training_table(spark, broken, FIXTURE_SETTINGS, versions, base, target)
    assert not first.ok and "lost contacts" in first.message and first.built == ("paid_days", "eligible", "spells")
    assert not spark.catalog.tableExists(target)
    # The payments are not needed for the layers that are there.
    gone = dataclasses.replace(src, history=src.history.withColumn("statusname", F.raise_error(F.lit("read again")).cast("string")))
    table = pipeline.StoredTable(spark, gone, FIXTURE_SETTINGS, versions, base)
    assert table.spells.count() > 0 and table.reused == ["spells"] and not table.built
    second = pipeline.run_training_table(spark, src, FIXTURE_SETTINGS, versions, base, target)
    assert second.ok and second.built == ("rows",) and set(second.reused) == {"spells", "eligible"}
    assert spark.table(target).count() == second.n_rows > 0
    third = pipeline.run_training_table(spark, broken, FIXTURE_SETTINGS, versions, base, target)
    assert third.ok and third.built == () and third.n_rows == second.n_rows
    # Another version of one source rebuilds what depends on it, and only that.
    changed = versions | {"interactions": "2"}
    fourth = pipeline.run_training_table(spark, broken, FIXTURE_SETTINGS, changed, base, target)
    assert not fourth.ok and spark.table(target).count() == second.n_rows
    assert pipeline.fingerprint("spells", FIXTURE_SETTINGS, changed) == pipeline.fingerprint("spells", FIXTURE_SETTINGS, versions)
    assert pipeline.fingerprint("spells", FIXTURE_SETTINGS, versions | {"payments": "2"}) != pipeline.fingerprint("spells", FIXTURE_SETTINGS, versions)
    spark.sql(f"DROP TABLE {target}")
