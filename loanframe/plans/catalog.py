"""Named queries on the order tables, one per operator or experiment.

Each takes a session and the folder of the tables and runs over the whole
tables.  Values that depend on summation order are rounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.functions import vocab
from loanframe.functions.fields import lookup, quoted
from loanframe.operators import decision, explain, features, labels, metrics, purify, regress, resample, selection, splits, strategy
from loanframe.operators.classify import RiskClassifier, probability_columns
from loanframe.operators.labels import LIMIT, OVERDUE, RISK, SCENE, with_labels
from loanframe.operators.ordering import checkpoint_folder, random_sample
from loanframe.operators.tuning import tune_classifier, tune_regressor
from loanframe.operators.two_stage import TwoStageClassifier, evaluate_stages, predict_with_rules
from loanframe.operators.weighting import balanced_weight_table
from loanframe.plans import experiments, prepare, scoring, training
from loanframe.session import tuned
from loanframe.sources import tables

CLASSES = [0, 1, 2, 3]
PROBS = ["p0", "p1", "p2", "p3"]
THRESHOLD = 0.8
NUMBERS = ["loan_amnt", "annual_inc", "dti", "delinq_amnt", "delinq_2yrs", "inq_last_6mths", "acc_now_delinq", "revol_util", "revol_bal"]
# never interpolated in these tables, and full of ties at six digits
EXACT = ["delinq_amnt"]
SAMPLE_ROWS = 5_000


def _loans(spark, folder):
    return tables.loans(tuned(spark), folder)


def _labelled(spark, folder):
    return with_labels(_loans(spark, folder))


def _split(spark, folder):
    return prepare.labelled_splits(tables.loans(tuned(spark), folder, spread=True))


def _scores(spark, folder):
    return tables.loan_scores(tuned(spark), folder)


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _scored_loans(spark, folder):
    return _loans(spark, folder).join(_scores(spark, folder), "id")


def _adjusted(df):
    return df.withColumn("pred", decision.threshold_class([F.col(p) for p in PROBS], THRESHOLD).cast("int"))


# ------------------------------------------------------------------ scans and columns


def scan_profile(spark, folder):
    return tables.column_profile(_loans(spark, folder))


def head_profile(spark, folder):
    head = tables.first_rows(_loans(spark, folder), 1000)
    return _rounded(tables.describe_columns(head, NUMBERS), 6, "mean", "std", "low", "high")


def column_describe(spark, folder):
    described = tables.describe_columns(_labelled(spark, folder), [LIMIT, *NUMBERS])
    return _rounded(described, 4, "mean", "std", "low", "high")


def schema_aligned_rows(spark, folder):
    loans = _loans(spark, folder)
    return tables.align_columns(loans, ["id", "dti", "absent_number", "loan_amnt"])


def applicant_defaults(spark, folder):
    picked = _loans(spark, folder).select("id", "annual_inc", "dti", "grade", "term")
    return tables.with_applicant_fields(picked).select("id", "annual_inc", "dti", "emp_length", "sub_grade", "historical_max_overdue_days")


def identifiers_dropped(spark, folder):
    return tables.drop_identifiers(_loans(spark, folder)).groupBy("grade").agg(F.count("*").alias("n"))


def feature_policy_projection(spark, folder):
    loans = _labelled(spark, folder)
    return loans.select("id", *features.allowed_columns(loans))


def feature_group_profile(spark, folder):
    return _rounded(features.group_profile(_loans(spark, folder)), 6, "null_share", "mean", "std")


# --------------------------------------------------------------------- labels, splits


def issue_month_counts(spark, folder):
    return splits.month_counts(_loans(spark, folder)).select(F.date_format("issue_month", "yyyy-MM").alias("issue_month"), "n")


def invalid_issue_count(spark, folder):
    return splits.undated_count(_loans(spark, folder))


def overdue_days(spark, folder):
    loans = _loans(spark, folder)
    return loans.select("id", labels.overdue_days(loans).alias(OVERDUE))


def risk_labels(spark, folder):
    return _labelled(spark, folder).select("id", RISK, f"{RISK}_name")


def credit_limits(spark, folder):
    return _labelled(spark, folder).select("id", LIMIT, f"{LIMIT}_band")


def scene_labels(spark, folder):
    return _labelled(spark, folder).select("id", SCENE, f"{SCENE}_name")


def label_summary(spark, folder):
    """Rows, mean overdue days and mean limit per split and risk class."""
    out = _split(spark, folder).groupBy("split", RISK).agg(
        F.count("*").alias("n"), F.avg(OVERDUE).alias("avg_overdue_days"), F.avg(LIMIT).alias("avg_credit_limit")
    )
    return _rounded(out, 6, "avg_overdue_days", "avg_credit_limit")


def label_distribution(spark, folder):
    return labels.class_distribution(_labelled(spark, folder), RISK, CLASSES)


def distribution_compare(spark, folder):
    labelled = _labelled(spark, folder)
    return labels.compare_distributions(labelled, purify.purify(labelled), RISK)


def normal_risk_summary(spark, folder):
    return _rounded(purify.normal_risk_summary(_labelled(spark, folder)), 6, "normal_risk_ratio")


def class_remap(spark, folder):
    schemes = {"three_class": vocab.TO_THREE_CLASS, "severity_class": vocab.TO_THREE_CLASS_SEVERITY, "two_class": vocab.TO_TWO_CLASS}
    return _labelled(spark, folder).select("id", *[labels.remap_class(F.col(RISK), s).alias(n) for n, s in schemes.items()])


def maturity_filter(spark, folder):
    return labels.mature_only(_loans(spark, folder)).select("id")


def maturity_impact(spark, folder):
    return labels.maturity_impact(_labelled(spark, folder), CLASSES)


def temporal_split_counts(spark, folder):
    return splits.temporal_split(_loans(spark, folder)).groupBy("split").agg(F.count("*").alias("n"))


def temporal_split_rows(spark, folder):
    return splits.temporal_split(_loans(spark, folder)).select("id", "split")


def month_plan(spark, folder):
    return splits.month_plan(_loans(spark, folder))


def bootstrap_split(spark, folder):
    return prepare.demo_splits(_loans(spark, folder)).select("id", "split", RISK)


def time_folds(spark, folder):
    return splits.fold_sizes(splits.with_time_folds(_loans(spark, folder)))


def time_fold_rows(spark, folder):
    return splits.with_time_folds(_loans(spark, folder)).select("id", "fold")


# ----------------------------------------------------------------------- purification


def observed_months(spark, folder):
    loans = _loans(spark, folder)
    return loans.select("id", purify.observed_months(loans).alias("observed_months"))


def repayment_periods(spark, folder):
    loans = _loans(spark, folder)
    return loans.select("id", purify.repayment_periods(loans).alias("repayment_periods"))


def purified_rows(spark, folder):
    return purify.purify(_labelled(spark, folder)).select("id")


def purify_rule_counts(spark, folder):
    return purify.rule_counts(_labelled(spark, folder))


def strata_quota(spark, folder):
    kept = purify.purify(_labelled(spark, folder))
    keyed = purify.with_strata(kept.where(purify.is_normal(kept)))
    return purify.quotas(purify.strata_sizes(keyed), 3000)


def stratified_sample(spark, folder):
    return purify.stratified_sample(_labelled(spark, folder), target_ratio=1.0).select("id")


def seeded_sample(spark, folder):
    return random_sample(_loans(spark, folder), SAMPLE_ROWS, 42).select("id")


def purified_splits(spark, folder):
    return purify.purify_splits(_split(spark, folder), 1.0).groupBy("split", RISK).agg(F.count("*").alias("n"))


# --------------------------------------------------------------------------- features


def _fill_state(train):
    columns = features.allowed_columns(train)
    continuous, categorical = features.split_types(train, columns)
    low = features.is_low_cardinality(train, categorical, 10)
    return continuous, categorical, low, features.fit_fills(train, continuous, categorical, low)


def _train_rows(split):
    return split.where(F.col("split") == "train")


def _kept_train(split):
    """The features of the training rows, kept for the passes of a fit, so that the tables are joined and sent about once."""
    return _train_rows(split).select(*[quoted(c) for c in features.allowed_columns(split)]).persist()


def imputer_fit(spark, folder):
    train = _kept_train(_split(spark, folder))
    *_, fills = _fill_state(train)
    train.unpersist()
    rows = [(c, None if isinstance(v, str) else round(v, 6), v if isinstance(v, str) else None) for c, v in fills.items()]
    return spark.createDataFrame(rows, "feature string, fill_number double, fill_text string")


def imputed_rows(spark, folder):
    split = _split(spark, folder)
    train = _kept_train(split)
    continuous, categorical, _, fills = _fill_state(train)
    train.unpersist()
    filled = features.imputed(split, fills, continuous, categorical)
    return _rounded(split.select("id", *[v.alias(c) for c, v in filled.items()]), 6, *[c for c in continuous if c not in EXACT])


def _bounds(split):
    train = _kept_train(split)
    continuous, categorical, _, fills = _fill_state(train)
    filled = train.select(*[v.alias(c) for c, v in features.imputed(train, fills, continuous, []).items()])
    bounds = features.fit_bounds(filled, continuous)
    train.unpersist()
    return continuous, fills, bounds


def iqr_bounds(spark, folder):
    *_, bounds = _bounds(_split(spark, folder))
    rows = [(c, round(float(a), 6), round(float(b), 6)) for c, (a, b) in bounds.items()]
    return spark.createDataFrame(rows, "feature string, low double, high double")


def clipped_rows(spark, folder):
    split = _split(spark, folder)
    continuous, fills, bounds = _bounds(split)
    filled = features.imputed(split, fills, continuous, [])
    clipped = split.select("id", *[features.clamp(filled[c], *bounds[c]).alias(c) for c in continuous])
    return _rounded(clipped, 6, *[c for c in continuous if c not in EXACT])


def _preprocessed(spark, folder):
    split = _split(spark, folder)
    model = features.LoanPreprocessor().fit(_train_rows(split))
    return model, model.transform(split)


def one_hot(spark, folder):
    model, table = _preprocessed(spark, folder)
    return table.select("id", *[quoted(c) for c in model.nominal_outputs])


def target_encoding(spark, folder):
    model, _ = _preprocessed(spark, folder)
    return _rounded(model.encodings, 9, "encoded")


def target_encoded_rows(spark, folder):
    _, table = _preprocessed(spark, folder)
    return table.select("id", F.round("addr_state__target_encoded", 9).alias("encoded"))


def scaled_rows(spark, folder):
    _, table = _preprocessed(spark, folder)
    return table.select("id", *[F.round(f"{c}__scaled", 6).alias(f"{c}__scaled") for c in NUMBERS])


def variance_filter(spark, folder):
    model, table = _preprocessed(spark, folder)
    out = selection.variances(_train_rows(table), model.outputs)
    return out.select("feature", F.round("variance", 9).alias("variance"), (F.col("variance") > 0.01).alias("kept"))


def correlation_pairs(spark, folder):
    return selection.correlations(_scores(spark, folder), PROBS).select("left", "right", F.round("correlation", 6).alias("correlation"))


def correlation_drop(spark, folder):
    loans = _labelled(spark, folder)
    columns = ["loan_amnt", "installment", "revol_bal", OVERDUE, RISK]
    return selection.correlated_columns(selection.correlations(loans, columns), 0.8)


def class_weights(spark, folder):
    return _rounded(balanced_weight_table(_labelled(spark, folder), RISK), 9, "weight")


def row_weights(spark, folder):
    return _labelled(spark, folder).select("id", lookup(F.col(RISK), {1: 2.0, 2: 6.0, 3: 10.0}, 1.0).alias("weight"))


def oversample_targets(spark, folder):
    return resample.target_table(_labelled(spark, folder), RISK, 5.0)


def mean_abs_values(spark, folder):
    model, table = _preprocessed(spark, folder)
    columns = [f"{c}__scaled" for c in NUMBERS]
    return _rounded(metrics.mean_abs(table, columns), 6, "value")


# --------------------------------------------------------------------------- decisions


def threshold_adjust(spark, folder):
    return _adjusted(_scores(spark, folder)).select("id", "pred")


CURVE = ["normal_precision", "risk_recall_mean", "macro_f1", "weighted_f1", "predicted_normal_ratio"]


def threshold_curve(spark, folder):
    return _rounded(decision.threshold_curve(_scores(spark, folder), "y_true", PROBS), 9, *CURVE)


def best_threshold(spark, folder):
    curve = decision.threshold_curve(_scores(spark, folder), "y_true", PROBS)
    found = [decision.best_threshold(curve, f).withColumn("floor", F.lit(f)) for f in (0.8, 0.85, 0.99)]
    return _rounded(found[0].unionByName(found[1]).unionByName(found[2]), 9, *CURVE)


def _three_class(spark, folder):
    return _scores(spark, folder).select(
        "id", lookup(F.col("y_true"), vocab.TO_THREE_CLASS).alias("y3"),
        F.col("p0").alias("q0"), (F.col("p1") + F.col("p2")).alias("q1"), F.col("p3").alias("q2"),
    )


def loss_threshold_scan(spark, folder):
    scan = decision.loss_threshold_scan(_three_class(spark, folder), "y3", ["q0", "q1", "q2"], [0, 1, 2], 2)
    return _rounded(scan, 9, *[c for c in scan.columns if c != "setting"])


def historic_overdue(spark, folder):
    loans = _labelled(spark, folder)
    return loans.select("id", decision.historic_overdue(loans).alias("days"))


def rule_override(spark, folder):
    ruled = decision.with_rules(_adjusted(_scored_loans(spark, folder)), "pred")
    return ruled.select("id", "fired_rule", "final_pred")


def rule_escalate3(spark, folder):
    joined = _loans(spark, folder).join(_three_class(spark, folder), "id")
    picked = joined.withColumn("pick", decision.pick_class([F.col(c) for c in ("q0", "q1", "q2")], [0, 1, 2]))
    return picked.select("id", decision.escalate_three(picked, "pick").alias("final_class"))


def disposable_income(spark, folder):
    loans = _loans(spark, folder)
    return loans.select("id", F.round(decision.disposable_income(loans), 6).alias("monthly_income"))


def _capped(spark, folder):
    loans = _labelled(spark, folder).withColumn("raw_limit", F.col("loan_amnt") * 2.5 - 3000)
    return loans.withColumn("capped_limit", decision.capped_limit(loans, "raw_limit", RISK))


def limit_caps(spark, folder):
    return _capped(spark, folder).select("id", "capped_limit")


def cap_violations(spark, folder):
    capped = _capped(spark, folder)
    raw = decision.cap_violations(capped, "raw_limit", RISK).withColumn("stage", F.lit("raw"))
    done = decision.cap_violations(capped, "capped_limit", RISK)
    return raw.unionByName(done.withColumn("stage", F.lit("capped")))


def two_stage_compose(spark, folder):
    scores = _scores(spark, folder)
    risk = 1.0 - F.col("p0")
    given = {c: F.col(f"p{c}") / risk for c in (1, 2, 3)}
    composed = decision.compose_two_stage(F.col("p0"), risk, given)
    return scores.select("id", *[F.round(p, 9).alias(f"q{i}") for i, p in enumerate(composed)])


def aligned_probabilities(spark, folder):
    aligned = metrics.align_probabilities(F.array("p0", "p1", "p3"), [0, 1, 3], [0, 1, 2, 3, 4])
    out = _scores(spark, folder).select("id", aligned.alias("a"))
    return out.select("id", *[F.round(F.col("a")[i], 9).alias(f"a{i}") for i in range(5)])


# -------------------------------------------------------------------------- evaluation


def confusion(spark, folder):
    return metrics.confusion_matrix(_adjusted(_scores(spark, folder)), "y_true", "pred", CLASSES)


def _report(spark, folder):
    return metrics.class_report(metrics.confusion_counts(_adjusted(_scores(spark, folder)), "y_true", "pred"), classes=CLASSES)


def class_report(spark, folder):
    return _rounded(_report(spark, folder), 9, "precision", "recall", "f1")


def macro_weighted_f1(spark, folder):
    out = metrics.report_summary(_report(spark, folder))
    return _rounded(out, 9, *[c for c in out.columns if c != "n_rows"])


def ovr_auc(spark, folder):
    return metrics.rank_metrics(_scores(spark, folder), "y_true", PROBS, CLASSES).select("label", F.round("auc", 9).alias("auc"))


def ks(spark, folder):
    return metrics.rank_metrics(_scores(spark, folder), "y_true", PROBS, CLASSES).select("label", F.round("ks", 9).alias("ks"))


def pair_auc(spark, folder):
    return _rounded(metrics.pair_auc(_scores(spark, folder), "y_true", PROBS, CLASSES), 9, "auc")


def ovo_auc(spark, folder):
    return _rounded(metrics.ovo_auc(_scores(spark, folder), "y_true", PROBS, CLASSES), 9, "auc_ovo_macro", "auc_ovo_weighted")


def pair_roc_points(spark, folder):
    curve = metrics.pair_curves(_scores(spark, folder), "y_true", PROBS, CLASSES)
    return curve.select("left", "right", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


def bad_capture(spark, folder):
    return _rounded(metrics.bad_capture(_scores(spark, folder), "y_true", PROBS, CLASSES), 9, "capture")


def prediction_distribution(spark, folder):
    return labels.class_distribution(_adjusted(_scores(spark, folder)), "pred", CLASSES)


def degeneration_flags(spark, folder):
    return metrics.degeneration(_report(spark, folder))


def _proxy(spark, folder):
    return _labelled(spark, folder).withColumn("proxy", F.col("loan_amnt") * 0.6)


def regression_metrics(spark, folder):
    return _rounded(metrics.regression_metrics(_proxy(spark, folder), LIMIT, "proxy"), 6, "mae", "rmse", "r2", "mape")


def residual_histogram(spark, folder):
    return _rounded(metrics.residual_histogram(_proxy(spark, folder), LIMIT, "proxy"), 6, "bin_start")


def ols_limit_line(spark, folder):
    return _rounded(regress.ols_by_moments(_labelled(spark, folder), "loan_amnt", LIMIT, ["grade"]), 6, "slope", "intercept")


def _strategy_results(spark, folder):
    base = _adjusted(_scored_loans(spark, folder)).withColumn("raw_pred", decision.pick_class([F.col(p) for p in PROBS], CLASSES))
    ruled = decision.with_rules(base, "pred")
    named = F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(c).cast("int").alias("guess"))
        for n, c in (("raw", "raw_pred"), ("threshold", "pred"), ("threshold_rules", "final_pred"))
    ]))
    rows = ruled.select("y_true", named.alias("s")).select("y_true", "s.*")
    out = metrics.summarize(rows, "y_true", "guess", CLASSES, ["model"])
    return out.select("model", "macro_f1", "weighted_f1", "normal_precision", F.col("risk_recall_mean").alias("high_risk_recall"))


def strategy_compare(spark, folder):
    return _rounded(_strategy_results(spark, folder), 9, "macro_f1", "weighted_f1", "normal_precision", "high_risk_recall")


def best_strategy(spark, folder):
    return metrics.rank_models(_strategy_results(spark, folder)).limit(1).select("model", F.round("macro_f1", 9).alias("macro_f1"))


def dashboard_risk_levels(spark, folder):
    loans = _labelled(spark, folder).withColumn("level", F.when(F.col("loan_status").isNotNull(), F.col(f"{RISK}_name")))
    return metrics.name_counts(loans, "level", vocab.UNKNOWN_NAME)


# ----------------------------------------------------------------- scoring and texts


def _decided(spark, folder):
    raw = _scored_loans(spark, folder).withColumn("raw_limit", F.col("loan_amnt") * 1.5)
    return scoring.decide(raw, THRESHOLD, CLASSES)


def score_records(spark, folder):
    names = {f"share_{c}": F.try_element_at("risk_probabilities", F.lit(n)) for c, n in vocab.RISK_NAMES.items()}
    skip = ("risk_probabilities", "strategy_content")
    kept = [c for c in scoring.RECORD if c not in skip]
    return _decided(spark, folder).select("id", *kept, *[v.alias(n) for n, v in names.items()])


def scenario_text(spark, folder):
    return _decided(spark, folder).select("id", "strategy_scenario", "strategy_content", "strategy_source")


def scenario_resolution(spark, folder):
    loans = _labelled(spark, folder).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.concat(F.lit(" "), F.col(f"{SCENE}_name"))).when(F.col("id") % 3 == 1, "未登记").alias("postloan_scene_label_name"),
        F.when(F.col("id") % 5 < 3, F.col(SCENE)).otherwise(F.lit(9)).alias("postloan_scene_label"),
        (F.col(RISK) + F.when(F.col("id") % 7 == 0, 2).otherwise(0)).alias("preloan_risk_label"),
    )
    return loans.select("id", strategy.scenario(loans).alias("strategy_scenario"))


def prompt_rows(spark, folder):
    decided = _decided(spark, folder)
    return decided.select("id", strategy.prompt(decided, ["id", "risk_label", "annual_inc", "dti", "approved_credit_limit"]).alias("prompt"))


REPLY_SQL = """CASE o_orderkey % 6
  WHEN 0 THEN concat('{"compliant": true, "issues": [], "revised_content": "修订 ', o_orderkey, '"}')
  WHEN 1 THEN concat('```json\n{"compliant": false, "revised_content": " 修订 ', o_orderkey, ' "}\n```')
  WHEN 2 THEN concat('审核结果如下：{"revised_content": "修订 ', o_orderkey, '"} 以上。')
  WHEN 3 THEN '内容合规，无需修改'
  WHEN 4 THEN '{"compliant": true, "revised_content": "  "}'
  ELSE NULL END"""


def review_responses(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    texts = orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("原文 "), F.col("o_orderkey").cast("string")).alias("original"),
        F.expr(REPLY_SQL).alias("reply"),
    )
    return texts.select("id", strategy.reviewed_text(F.col("original"), F.col("reply")).alias("final_content"))


# ------------------------------------------------------------------- fitted operators


def _features(spark, folder):
    """The feature table of a folder, fitted by the first query of the session that needs it."""
    checkpoint_folder(spark)
    return training.stored_features(_split(spark, folder), spark.sparkContext.getCheckpointDir())


def rf_top_features(spark, folder):
    return _features(spark, folder).selector.importance(spark)


def pca_components(spark, folder):
    model, table = _preprocessed(spark, folder)
    selector = selection.FeatureSelector(model.outputs, RISK, pca_share=0.95).fit(_train_rows(table))
    out = selector.transform(table)
    return out.select("id", *selector.outputs)


def _scored_by(spark, folder, kind, **params):
    ft = _features(spark, folder)
    model = RiskClassifier(kind, ft.features, RISK, "auto", **params).fit(ft.part("train"))
    return probability_columns(model.transform(ft.table), model.classes, CLASSES).select("id", "split", RISK, *PROBS, "prediction")


def lr_scores(spark, folder):
    return _scored_by(spark, folder, "logistic_regression")


def tree_scores(spark, folder):
    return _scored_by(spark, folder, "decision_tree")


def forest_scores(spark, folder):
    return _scored_by(spark, folder, "random_forest")


def gbt_scores(spark, folder):
    return _scored_by(spark, folder, "lightgbm")


def _limits_by(spark, folder, kind, **params):
    ft = _features(spark, folder)
    model = regress.LimitRegressor(kind, ft.features, LIMIT, **params).fit(ft.part("train"))
    scored = model.transform(ft.table)
    return scored.select("id", "split", LIMIT, "raw_limit", decision.capped_limit(scored, "raw_limit", RISK).alias("capped_limit"))


def ridge_limits(spark, folder):
    return _limits_by(spark, folder, "ridge")


def gbt_limits(spark, folder):
    return _limits_by(spark, folder, "lightgbm")


def two_stage_scores(spark, folder):
    ft = _features(spark, folder)
    model = TwoStageClassifier(ft.features, RISK, valid=ft.part("val")).fit(ft.part("train"))
    return model.transform(ft.table).select("id", "split", RISK, *PROBS, "prediction")


def two_stage_evaluation(spark, folder):
    ft = _features(spark, folder)
    model = TwoStageClassifier(ft.features, RISK, valid=ft.part("val")).fit(ft.part("train"))
    return evaluate_stages(model, ft.part("test"), RISK)


def two_stage_threshold_rules(spark, folder):
    return predict_with_rules(_scored_loans(spark, folder), 0.9).select("id", "threshold_pred", "final_pred")


def three_class_maps(spark, folder):
    three = _labelled(spark, folder).withColumn("three", lookup(F.col(RISK), vocab.TO_THREE_CLASS))
    return three.select(
        "id", decision.risk_name(F.col("three"), 3).alias("risk_name"),
        decision.scene_of_risk(F.col("three"), 3).alias("scene_label"), decision.cap_class_of_risk(F.col("three"), 3).alias("cap_class"),
    )


def bad_versus_good_ks(spark, folder):
    rows = _scores(spark, folder).select("id", (F.col("y_true") != 0).cast("int").alias("bad"), "p0", (1.0 - F.col("p0")).alias("p_bad"))
    return metrics.rank_metrics(rows, "bad", ["p0", "p_bad"], [0, 1]).where("label = 1").select(F.round("ks", 9).alias("ks"), F.round("auc", 9).alias("auc"))


def metric_table(spark, folder):
    table = metrics.diagnose(_adjusted(_scores(spark, folder)), "y_true", "pred", PROBS, CLASSES)
    return _rounded(table, 9, "value")


def tuned_model(spark, folder):
    ft = _features(spark, folder)
    found = tune_classifier(splits.with_time_folds(ft.part("train")), ft.part("val"), "logistic_regression", ft.features, RISK)
    return found.trial_table(spark)


def tuned_regressor(spark, folder):
    ft = _features(spark, folder)
    found = tune_regressor(splits.with_time_folds(ft.part("train")), ft.part("val"), "ridge", ft.features, LIMIT)
    return found.trial_table(spark)


def smote_rows(spark, folder):
    model, table = _preprocessed(spark, folder)
    made = resample.smote(_train_rows(table), RISK, model.outputs, model.nominal_outputs)
    return made.groupBy(RISK, "is_synthetic").agg(F.count("*").alias("n"))


def enn_rows(spark, folder):
    model, table = _preprocessed(spark, folder)
    rows = _train_rows(table).withColumn("row_key", F.col("id").cast("string"))
    kept = resample.clean_contradicted(rows, RISK, [f"{c}__scaled" for c in NUMBERS])
    return kept.groupBy(RISK).agg(F.count("*").alias("n"))


def linear_attributions(spark, folder):
    ft = _features(spark, folder)
    model = RiskClassifier("logistic_regression", ft.features, RISK).fit(ft.part("train"))
    return explain.linear_attributions(model, ft.part("test"), ft.part("train"))


def overall_attributions(spark, folder):
    return explain.overall_attributions(linear_attributions(spark, folder))


def permutation_importance(spark, folder):
    ft = _features(spark, folder)
    model = RiskClassifier("decision_tree", ft.features, RISK, "auto").fit(ft.part("train"))
    return explain.permutation_importance(model, ft.part("test"), RISK)


def batch_scoring(spark, folder):
    split = _split(spark, folder)
    chain = training.train_chain(split)
    return scoring.score_batch(_loans(spark, folder), chain).select("id", *scoring.RECORD)


def model_importance(spark, folder):
    """Gain shares of the boosted model's features, the fifteen largest first."""
    ft = _features(spark, folder)
    model = RiskClassifier("lightgbm", ft.features, RISK, "auto").fit(ft.part("train"))
    return explain.top_importance(model.importance(spark), 15)


def tree_attributions(spark, folder):
    """What each feature adds to the margins of the boosted model, per class, over the test rows."""
    ft = _features(spark, folder)
    model = RiskClassifier("lightgbm", ft.features, RISK, "auto").fit(ft.part("train"))
    return explain.tree_attributions(model, ft.part("test"))


def grid_search(spark, folder):
    return experiments.weight_threshold_grid(_features(spark, folder))


def strategy_experiment(spark, folder):
    return experiments.compare_strategies(_features(spark, folder))


def baseline_experiment(spark, folder):
    return experiments.compare_kinds(_features(spark, folder), ("logistic_regression", "random_forest", "xgboost"), "test")


def weight_mode_experiment(spark, folder):
    return experiments.compare_weight_modes(_features(spark, folder))


def limit_model_experiment(spark, folder):
    return experiments.compare_limit_kinds(_features(spark, folder), LIMIT)


def purification_experiment(spark, folder):
    return experiments.compare_purification(_split(spark, folder), {})


def maturity_experiment(spark, folder):
    return experiments.four_class_confusion(_split(spark, folder), {})


def final_confusion(spark, folder):
    return experiments.four_class_confusion(_split(spark, folder), {}, filter_mature=False)


def three_class_experiment(spark, folder):
    return experiments.three_class_scan(_split(spark, folder), {})


def sampling_experiment(spark, folder):
    return experiments.compare_sampling(_features(spark, folder))


def queries() -> dict:
    """Every public function of this module by name."""
    own = globals()
    return {
        name: f for name, f in own.items()
        if callable(f) and getattr(f, "__module__", "") == __name__ and not name.startswith("_") and name != "queries"
    }
