from unittest.mock import MagicMock as Mock

import pytest
from pyspark.sql import functions as F

from loanframe.operators.classify import RiskClassifier, probability_columns
from loanframe.operators import explain
from loanframe.operators.explain import permutation_importance, with_shuffled
from loanframe.operators.features import LoanPreprocessor
from loanframe.operators.labels import LIMIT, RISK
from loanframe.operators.regress import LimitRegressor
from loanframe.operators.splits import with_time_folds
from loanframe.operators.metrics import summarize
from loanframe.operators.tuning import tune_classifier, tune_regressor
from loanframe.operators.two_stage import TwoStageClassifier, TwoStageModel
from loanframe.operators.weighting import resolve
from loanframe.plans import catalog, prepare, scoring, training
from loanframe.sources import tables
from tests.conftest import SMALL

LIGHT = {"n_estimators": 2, "max_depth": 2}


@pytest.fixture(scope="module")
def split(spark):
    return prepare.labelled_splits(tables.loans(spark, SMALL)).persist()


@pytest.fixture(scope="module")
def featured(split):
    model = LoanPreprocessor().fit(split.where("split = 'train'"))
    return model, model.transform(split).persist()


@pytest.mark.parametrize("kind,params", [
    ("logistic_regression", {"max_iter": 5}), ("decision_tree", {"max_depth": 3}), ("random_forest", {"n_estimators": 3, "max_depth": 3}),
    ("xgboost", LIGHT),
])
def test_classifiers_give_probabilities(spark, featured, tmp_path, kind, params):
    pre, table = featured
    model = RiskClassifier(kind, pre.outputs, RISK, "auto", **params).fit(table.where("split = 'train'"))
    out = probability_columns(model.transform(table), model.classes, [0, 1, 2, 3])
    total = out.select((F.col("p0") + F.col("p1") + F.col("p2") + F.col("p3")).alias("t"))
    assert total.where(F.abs(F.col("t") - 1) > 1e-9).count() == 0 and out.count() == table.count()
    model.save(str(tmp_path / kind))
    again = type(model).load(str(tmp_path / kind)).transform(table)
    assert again.select("id", "prediction").exceptAll(out.select("id", "prediction")).count() == 0


def test_absent_class_keeps_labels(spark, featured):
    pre, table = featured
    model = RiskClassifier("decision_tree", pre.outputs, RISK, max_depth=3).fit(table.where(f"{RISK} <> 1"))
    assert model.classes == [0, 2, 3]
    assert {r.prediction for r in model.transform(table).select("prediction").distinct().collect()} <= {0, 2, 3}


def test_weight_modes():
    counts = {0: 90, 1: 10}
    assert resolve(counts, "none") is None and resolve(counts, "auto") == {0: 100 / 180, 1: 5.0}
    assert resolve(counts, "manual", {1: 7, 9: 3}) == {0: 1.0, 1: 7.0}
    with pytest.raises(ValueError):
        resolve(counts, "manual", {9: 3})


def test_two_stage_and_tuning(spark, featured):
    pre, table = featured
    train, valid = table.where("split = 'train'"), table.where("split = 'val'")
    model = TwoStageClassifier(pre.outputs, RISK, kind="decision_tree", valid=valid, **{"max_depth": 3}).fit(train)
    out = model.transform(valid)
    assert out.where(F.abs(F.col("p0") + F.col("p1") + F.col("p2") + F.col("p3") - 1) > 1e-9).count() == 0
    only = train.where(f"{RISK} in (0, 3)")
    constant = TwoStageClassifier(pre.outputs, RISK, kind="decision_tree", **{"max_depth": 3}).fit(only).transform(valid)
    assert {r.prediction for r in constant.select("prediction").distinct().collect()} <= {0, 3}
    tuned = tune_classifier(with_time_folds(train, 2), valid, "decision_tree", pre.outputs, RISK, {"max_depth": [2, 3]}, ("none",), n_folds=2)
    assert len(tuned.trials) == 2 and tuned.score == max(v for _, v in tuned.trials)


def test_two_stage_tune(spark, featured):
    pre, table = featured
    train, valid = table.where("split = 'train'"), table.where("split = 'val'")
    model = TwoStageClassifier(pre.outputs, RISK, kind="decision_tree").tune(with_time_folds(train, 2), valid, {"max_depth": [2, 3]}, n_folds=2)
    out = model.transform(valid)
    assert out.count() == valid.count() and out.where(F.abs(F.col("p0") + F.col("p1") + F.col("p2") + F.col("p3") - 1) > 1e-9).count() == 0
    assert model.first.classes == [0, 1] and 0 not in model.second.classes and 0 < model.threshold <= 1


@pytest.mark.parametrize("two_stage,resample", [(True, True), (True, False), (False, True)])
def test_chain_with_resampling_and_two_stages(spark, split, two_stage, resample):
    chain = training.train_chain(split, two_stage=two_stage, resample=resample, top_k=10, n_trees=2, tree_depth=3, **LIGHT)
    assert isinstance(chain.risk, TwoStageModel) == two_stage and 0 <= chain.metrics["macro_f1"] <= 1
    assert scoring.score_batch(tables.loans(spark, SMALL), chain).count() == tables.loans(spark, SMALL).count()


def test_fitted_queries_use_the_defaults(monkeypatch):
    """What the queries hand to the fits, without running them."""
    used = []

    def note(name):
        return lambda *args, **params: used.append((name, [x for x in args if x != RISK and not isinstance(x, Mock)], params)) or Mock()

    for module, names in ((catalog, ["RiskClassifier", "TwoStageClassifier", "_split", "_loans", "_preprocessed", "_train_rows", "probability_columns", "evaluate_stages"]),
                          (catalog.training, ["stored_features", "train_chain"]), (catalog, ["checkpoint_folder"]), (catalog.selection, ["FeatureSelector"]), (catalog.regress, ["LimitRegressor"]),
                          (catalog.experiments, [n for n in vars(catalog.experiments) if n.startswith(("compare_", "weight_threshold_", "four_class_", "three_class_"))])):
        for name in names:
            monkeypatch.setattr(module, name, note(name) if name != "_preprocessed" else lambda *a: (Mock(), Mock()))
    monkeypatch.setattr(catalog.decision, "capped_limit", note("capped_limit"))
    monkeypatch.setattr(catalog.scoring, "score_batch", note("score_batch"))
    fitted = ["forest_scores", "gbt_scores", "gbt_limits", "two_stage_scores", "two_stage_evaluation", "batch_scoring", "grid_search", "strategy_experiment",
              "baseline_experiment", "weight_mode_experiment", "limit_model_experiment", "purification_experiment", "maturity_experiment", "final_confusion",
              "three_class_experiment", "sampling_experiment", "pca_components"]
    for name in fitted:
        catalog.queries()[name](Mock(), "")
    small = {"n_estimators", "max_depth", "n_trees", "top_k", "tree_depth", "max_iter", "params"}
    assert len(used) > len(fitted)
    assert not [u for u in used if small & set(u[2]) or any(isinstance(x, dict) and x for x in u[1])]


def test_ridge_matches_normal_equations(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = x @ [2.0, -1.0] + 3 + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, t double")
    model = LimitRegressor("ridge", ["a", "b"], "t", alpha=10.0).fit(df)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(2), xc.T @ yc)
    np.testing.assert_allclose(model.stage.coefficients.toArray(), want, rtol=1e-6)


def test_shuffled_values_are_a_permutation(spark, featured):
    pre, table = featured
    out = with_shuffled(table.select("id", "loan_amnt__scaled"), ["loan_amnt__scaled"], "id", 3, buckets=5)
    a = sorted(r[0] for r in out.select("loan_amnt__scaled").collect())
    assert a == sorted(r[0] for r in out.select("other.c0").collect())
    model = RiskClassifier("decision_tree", pre.outputs, RISK, max_depth=3).fit(table)
    scores = {r.feature: r.importance for r in permutation_importance(model, table, RISK).collect()}
    assert scores["delinq_amnt__scaled"] > 0 and len(scores) == len(pre.outputs)


def test_chain_scores_batch_and_single_row(spark, split, tmp_path):
    options = dict(top_k=10, n_trees=2, tree_depth=3, **LIGHT)
    chain = training.trained_or_loaded(split, str(tmp_path / "chain"), **options)
    again = training.trained_or_loaded(split, str(tmp_path / "chain"), **options)
    loans = tables.loans(spark, SMALL)
    first, second = [scoring.score_batch(loans, c).select("id", *[r for r in scoring.RECORD if r != "risk_probabilities"]) for c in (chain, again)]
    assert first.exceptAll(second).count() == 0 and first.count() == loans.count()
    from loanframe.operators.decision import cap_violations

    checked = loans.join(first.select("id", "risk_label", "approved_credit_limit"), "id").withColumn("lim", F.col("approved_credit_limit") - 0.01)
    assert cap_violations(checked, "lim", "risk_label").first().n_violations == 0
    one = tables.loans_from_rows(spark, [{"annual_inc": 180000, "dti": 21.5, "loan_amnt": 20000, "loan_status": "Current"}])
    assert scoring.score_batch(one, chain).count() == 1


def test_feature_table_is_reloaded_by_its_manifest(spark, split, tmp_path, monkeypatch):
    """Written once per rows and settings; other rows or settings get a table of their own, an unfinished one is made anew."""
    fits, fit = [], training.prepare_features
    monkeypatch.setattr(training, "prepare_features", lambda *a, **k: fits.append(k) or fit(*a, **k))
    settings = {"top_k": 5, "n_trees": 2, "max_depth": 3}
    one, path = training.stored_features(split, str(tmp_path), **settings), str(tmp_path)
    again = training.stored_features(split.repartition(3), path, **settings)
    assert len(fits) == 1 and again.features == one.features and again.table.columns == one.table.columns
    assert again.table.exceptAll(one.table).count() == 0 and one.table.count() == split.count()
    fresh = again.selector.transform(again.preprocessor.transform(split)).select(*one.table.columns)
    assert fresh.select("id", *one.features).exceptAll(one.table.select("id", *one.features)).count() == 0
    training.stored_features(split, path, **{**settings, "top_k": 4})
    training.stored_features(split.where("id % 2 = 0"), path, **settings)
    assert len(fits) == 3
    manifest = training.manifest_of(split, **settings)
    assert training.FeatureTable.load(spark, path + "/nothing", manifest) is None
    one.save(path + "/other", {**manifest, "rows": 1})
    assert training.FeatureTable.load(spark, path + "/other", manifest) is None


def test_importance_attributions_and_metric_file(spark, featured, tmp_path):
    pre, table = featured
    model = RiskClassifier("lightgbm", pre.outputs, RISK, "auto", n_estimators=4).fit(table.where("split = 'train'"))
    top = explain.top_importance(model.importance(spark), 15).collect()
    assert [r["rank"] for r in top] == list(range(1, 16)) and sorted((-r.importance, r.feature) for r in top) == [(-r.importance, r.feature) for r in top]
    parts = explain.tree_attributions(model, table).toPandas()
    assert len(parts) == 4 * (len(pre.outputs) + 1) and (parts["mean_abs"] >= parts["mean"].abs() - 1e-12).all()
    margin = model.stages[0].margins
    from loanframe.operators.blocks import binned

    values = table.select(*[F.col(f"`{c}`") for c in pre.outputs]).toPandas()
    want = margin(binned([values.iloc[:, i].to_numpy(float) for i in range(values.shape[1])], model.stages[0].cuts)).mean(axis=0)
    got = parts.groupby("label")["mean"].sum().sort_index().to_numpy()
    assert abs(got - want).max() < 1e-9
    tables.write_metrics(explain.top_importance(model.importance(spark), 3), str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).count() == 3


def test_lasso_and_tuning_by_sums_of_products(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(600, 3)), 1)       # few enough values for a bin each, whatever the rows
    y = x @ [2.0, 0.0, -1.0] + 5 + rng.normal(size=600)
    fold = np.sort(rng.integers(-1, 3, 600))
    df = spark.createDataFrame([(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold)], "a double, b double, c double, t double, fold int")
    model = LimitRegressor("lasso", ["a", "b", "c"], "t", alpha=0.5).fit(df)
    b = model.stage.coefficients.toArray()
    slope = (x - x.mean(axis=0)).T @ (y - y.mean() - (x - x.mean(axis=0)) @ b) / 600
    assert b[1] == 0 and np.allclose(slope[[0, 2]], 0.5 * np.sign(b[[0, 2]])) and abs(slope[1]) <= 0.5
    for kind in ("ridge", "lasso", "linear_regression"):
        tuned = tune_regressor(df, df, kind, ["a", "b", "c"], "t", n_folds=3)
        for setting, score in tuned.trials:
            errors = []
            for f in range(3):
                part = LimitRegressor(kind, ["a", "b", "c"], "t", **setting).fit(df.where(f"fold < {f}"))
                errors.append(part.transform(df.where(f"fold = {f}")).select(F.sqrt(F.avg((F.col("raw_limit") - F.col("t")) ** 2))).first()[0])
            assert abs(score - np.mean(errors)) < 1e-8
    boosted = tune_regressor(df, None, "lightgbm", ["a", "b", "c"], "t", {"n_estimators": [2, 4], "max_depth": [2, 3]}, n_folds=2, together=3)
    alone = LimitRegressor("lightgbm", ["a", "b", "c"], "t", n_estimators=2, max_depth=3).fit(df.where("fold < 1")).transform(df.where("fold = 1"))
    first = LimitRegressor("lightgbm", ["a", "b", "c"], "t", n_estimators=2, max_depth=3).fit(df.where("fold < 0")).transform(df.where("fold = 0"))
    want = np.mean([d.select(F.sqrt(F.avg((F.col("raw_limit") - F.col("t")) ** 2))).first()[0] for d in (first, alone)])
    assert len(boosted.trials) == 4 and abs(dict((tuple(s.values()), v) for s, v in boosted.trials)[2, 3] - want) < 1e-9


def test_boosted_tuning_shares_fits(featured):
    """Settings that differ in the number of trees are scored from one fit, as if each were fitted alone."""
    pre, table = featured
    train = with_time_folds(table.where("split = 'train'"), 2)
    names = pre.nominal_outputs[:6]       # two values each: the same cuts for any rows
    tuned = tune_classifier(train, None, "lightgbm", names, RISK, {"n_estimators": [1, 3], "max_depth": [2]}, ("none", "auto"), n_folds=2)
    assert len(tuned.trials) == 4
    for setting, score in tuned.trials:
        alone = [summarize(RiskClassifier("lightgbm", names, RISK, **setting).fit(train.where(f"fold < {f}")).transform(train.where(f"fold = {f}")), RISK, "prediction").first()["weighted_f1"]
                 for f in range(2)]
        assert abs(score - sum(alone) / 2) < 1e-9


def test_build_tables_round_trip(spark, tmp_path):
    sizes = prepare.build_tables(tables.loans(spark, SMALL), str(tmp_path))
    written = spark.read.parquet(str(tmp_path / "splits"))
    assert written.count() == sum(sizes.values()) and "issue_month" in written.columns
    assert spark.read.parquet(str(tmp_path / "purified")).where("split = 'val'").count() <= sizes["val"]
    csv = str(tmp_path / "csv")
    tables.write_table(tables.loans(spark, SMALL).select("id", "dti", "term"), csv)
    schema = "id bigint, dti double, term string"
    from pyspark.sql.types import StructType

    assert tables.read_loans(spark, csv, "csv", StructType.fromDDL(schema)).where("dti is not null").count() == tables.loans(spark, SMALL).where("dti is not null").count()


def test_fitted_queries_run_to_the_end(spark, monkeypatch):
    """The fitted queries with few and small trees: their rows, their probabilities, their metrics within their range.

    The two that resample are left to the tests of the chain, as their cleaning takes a minute each.
    """
    from loanframe.operators import classify, regress, selection

    for table, small in ((classify.DEFAULTS, {"n_estimators": 2, "max_depth": 2, "max_iter": 5}), (regress.DEFAULTS, {"n_estimators": 2, "max_depth": 2})):
        for kind, own in table.items():
            monkeypatch.setitem(table, kind, {**own, **{k: v for k, v in small.items() if k in own}})
    fit = selection.forest_importance
    monkeypatch.setattr(selection, "forest_importance", lambda df, columns, label, n_trees=200, max_depth=None, seed=42: fit(df, columns, label, 2, 3, seed))
    queries, n = catalog.queries(), tables.loans(spark, SMALL).count()
    split_rows = prepare.labelled_splits(tables.loans(spark, SMALL)).count()
    for name in ("gbt_scores", "forest_scores", "two_stage_scores"):
        rows = queries[name](spark, SMALL).collect()
        assert len(rows) == split_rows and all(abs(r.p0 + r.p1 + r.p2 + r.p3 - 1) < 1e-9 and r.prediction in (0, 1, 2, 3) for r in rows), name
    assert all(r.raw_limit is not None and 0 <= r.capped_limit for r in queries["gbt_limits"](spark, SMALL).collect())
    assert queries["batch_scoring"](spark, SMALL).count() == n
    shapes = {"two_stage_evaluation": None, "grid_search": 18, "baseline_experiment": 3, "weight_mode_experiment": 3, "purification_experiment": 2,
              "maturity_experiment": 16, "final_confusion": 16, "three_class_experiment": None, "limit_model_experiment": 4, "model_importance": 15,
              "tree_attributions": None}
    for name, count in shapes.items():
        rows = queries[name](spark, SMALL).collect()
        assert rows and count in (None, len(rows)), (name, len(rows))
        for r in rows:
            for key, v in r.asDict().items():
                if key.endswith(("f1", "recall", "precision", "accuracy")) and v is not None:
                    assert 0 <= v <= 1, (name, key, v)
    whole = queries["final_confusion"](spark, SMALL).groupBy().sum("n").first()[0]
    assert whole == prepare.labelled_splits(tables.loans(spark, SMALL)).where("split = 'test'").count()
