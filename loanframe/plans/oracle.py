"""The catalog queries in plain SQL, for a second engine on the same tables.

Written from the rules, not from the DataFrame code, and without its
shortcuts: ranks are plain windows here, thresholds are evaluated one by one.
"""

from __future__ import annotations

import re

from loanframe.functions import vocab
from loanframe.plans.catalog import EXACT, NUMBERS, REPLY_SQL, SAMPLE_ROWS
from loanframe.sources.tables import LOAN_SCORES_SQL, LOANS_SQL

NAMES = {"orders": "orders", "customer": "customer", "nation": "nation"}
LOANS = LOANS_SQL.format(**NAMES)
SCORES = LOAN_SCORES_SQL.format(**NAMES)
COLUMNS = """id member_id issue_d last_pymnt_d last_credit_pull_d term loan_amnt annual_inc dti installment
total_pymnt grade loan_status delinq_amnt hardship_dpd recoveries debt_settlement_flag settlement_status
hardship_flag delinq_2yrs inq_last_6mths acc_now_delinq revol_util revol_bal purpose home_ownership
addr_state url""".split()
TEXTS = ["term", "purpose", "home_ownership", "addr_state"]
LOSS = "('charged off', 'default', 'does not meet the credit policy. status:charged off')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _case(key: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {k} THEN {_quote(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"CASE {key} {whens} ELSE {default} END"


CTES: dict[str, str] = {
    "loans": LOANS,
    "scores": SCORES,
    "st": "SELECT *, lower(trim(coalesce(loan_status, ''))) AS status FROM loans",
    "od": f"""SELECT *, CAST(trunc(CASE
        WHEN status IN {LOSS} AND d0 < 181 THEN 181
        WHEN d0 <> 0 THEN d0
        WHEN status = 'in grace period' THEN 15
        WHEN status = 'late (16-30 days)' THEN 23
        WHEN status = 'late (31-120 days)' THEN
          CASE WHEN coalesce(installment, 0) = 0 THEN 60 ELSE least(greatest(ceil(greatest(coalesce(delinq_amnt, 0), 0) / installment) * 30, 31), 120) END
        WHEN coalesce(delinq_amnt, 0) > 0 THEN 15
        ELSE 0 END) AS INTEGER) AS estimated_overdue_days
      FROM (SELECT *, greatest(coalesce(hardship_dpd, 0), 0) AS d0 FROM st)""",
    "rl": f"""SELECT *, CASE
        WHEN status IN {LOSS} OR estimated_overdue_days > 180 OR upper(coalesce(debt_settlement_flag, '')) = 'Y'
          OR settlement_status IS NOT NULL OR coalesce(recoveries, 0) > 0 THEN 3
        WHEN estimated_overdue_days BETWEEN 31 AND 180 THEN 2
        WHEN estimated_overdue_days BETWEEN 1 AND 30 THEN 1 ELSE 0 END AS preloan_risk_label FROM od""",
    "lb0": """SELECT *, least(greatest(coalesce(loan_amnt, 0), 0),
          greatest(coalesce(annual_inc, 0), 0) * least(greatest(0.45::DOUBLE - 0.30::DOUBLE * least(greatest(greatest(coalesce(dti, 0), 0) / 100, 0), 1.5::DOUBLE), 0.08::DOUBLE), 0.45::DOUBLE))
        * (CASE preloan_risk_label WHEN 0 THEN 1.0 WHEN 1 THEN 0.85 WHEN 2 THEN 0.55 ELSE 0.20 END)::DOUBLE AS lim FROM rl""",
    "lb": """SELECT *, CAST(CASE WHEN lim > 0 THEN round_even(greatest(lim, 500) / 100, 0) * 100 ELSE 0 END AS INTEGER) AS calibrated_credit_limit,
        CASE WHEN upper(coalesce(hardship_flag, '')) = 'Y' OR upper(coalesce(debt_settlement_flag, '')) = 'Y'
               OR settlement_status IS NOT NULL OR preloan_risk_label = 3 THEN 3
             WHEN estimated_overdue_days > 30 OR preloan_risk_label = 2 THEN 2
             WHEN estimated_overdue_days > 0 OR preloan_risk_label = 1 THEN 1 ELSE 0 END AS postloan_scene_label FROM lb0""",
    "dated": """SELECT *, CAST(try_strptime(issue_d, '%b-%Y') AS DATE) AS im, CAST(try_strptime(last_pymnt_d, '%b-%Y') AS DATE) AS pm,
        CAST(try_strptime(last_credit_pull_d, '%b-%Y') AS DATE) AS cm FROM lb""",
    "ranked": "SELECT *, row_number() OVER (ORDER BY im, id) - 1 AS rn, count(*) OVER () AS total FROM dated WHERE im IS NOT NULL",
    "split": """SELECT *, CASE WHEN rn < floor(total * 0.70::DOUBLE) THEN 'train'
        WHEN rn < floor(total * 0.70::DOUBLE) + floor(total * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM ranked""",
    "mat": """SELECT *, (status IN ('fully paid', 'charged off', 'default', 'does not meet the credit policy. status:fully paid', 'does not meet the credit policy. status:charged off')
        OR estimated_overdue_days > 0
        OR coalesce(im + CAST(30 * coalesce(TRY_CAST(nullif(regexp_extract(term, '([0-9]+)', 1), '') AS INTEGER), 36) AS INTEGER) <= (SELECT max(cm) FROM dated), false)) AS is_mature FROM dated""",
    "obs": """SELECT *, CAST(greatest(coalesce((year(coalesce(pm, cm, im)) - year(im)) * 12 + month(coalesce(pm, cm, im)) - month(im), 0), 0) AS INTEGER) AS months,
        status IN ('fully paid', 'current') AND preloan_risk_label = 0 AS is_normal FROM dated""",
    "per": "SELECT *, greatest(coalesce(floor(greatest(total_pymnt, 0) / nullif(installment, 0)), months), months)::DOUBLE AS periods FROM obs",
    "rules": """SELECT *, (annual_inc IS NULL OR dti IS NULL OR delinq_2yrs IS NULL OR inq_last_6mths IS NULL) AS missing_core,
        is_normal AND months < 6 AS too_fresh, is_normal AND periods < 3 AS too_few_payments,
        is_normal AND coalesce(revol_util < 1, false) AS unused_line,
        is_normal AND coalesce(dti > 80, false) AND coalesce(delinq_2yrs, 0) <= 0 AND coalesce(acc_now_delinq, 0) <= 0 AS odd_clean_debtor FROM per""",
    "pure": "SELECT * FROM rules WHERE NOT (missing_core OR too_fresh OR too_few_payments OR unused_line OR odd_clean_debtor)",
    "train": "SELECT * FROM split WHERE split = 'train'",
}
ORDER = list(CTES)
NEEDS = {
    "loans": [], "scores": [], "st": ["loans"], "od": ["st"], "rl": ["od"], "lb0": ["rl"], "lb": ["lb0"], "dated": ["lb"],
    "ranked": ["dated"], "split": ["ranked"], "mat": ["dated"], "obs": ["dated"], "per": ["obs"], "rules": ["per"],
    "pure": ["rules"], "train": ["split"],
}


def _sql(body: str, *ctes: str, extra: dict[str, str] | None = None) -> str:
    wanted: set[str] = set()

    def need(name):
        if name not in wanted:
            wanted.add(name)
            for n in NEEDS[name]:
                need(n)

    for c in ctes:
        need(c)
    parts = [f"{c} AS {'MATERIALIZED ' if c in ('rl', 'lb0', 'lb') else ''}({CTES[c]})" for c in ORDER if c in wanted]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# ---------------------------------------------------------------------------- pieces

FILLS = {
    **{f"f_{c}": f"median({c})" for c in NUMBERS},
    **{f"f_{c}": f"(SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in TEXTS},
}
FILL_CTE = "SELECT " + ", ".join(f"{q if q.startswith('median') else f'any_value({q})'} AS {n}" for n, q in FILLS.items()) + " FROM train"
IMPUTED_CTE = (
    "SELECT id, split, preloan_risk_label, " + ", ".join(f"coalesce({c}, f_{c}) AS {c}" for c in NUMBERS + TEXTS) + " FROM split, fills"
)
BOUND_CTE = "SELECT " + ", ".join(
    f"CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN min({c}) "
    f"ELSE quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) END AS lo_{c}, "
    f"CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN max({c}) "
    f"ELSE quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) END AS hi_{c}"
    for c in NUMBERS
) + " FROM imp WHERE split = 'train'"
CLIP_CTE = (
    "SELECT id, split, preloan_risk_label, " + ", ".join(f"least(greatest({c}, lo_{c}), hi_{c}) AS {c}" for c in NUMBERS)
    + ", " + ", ".join(TEXTS) + " FROM imp, bounds"
)
MOMENT_CTE = "SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in NUMBERS
) + " FROM clip WHERE split = 'train'"
ENCODING_CTE = """SELECT 'addr_state' AS feature, addr_state AS category,
    g * (1 - count(*) / (count(*) + 20.0::DOUBLE)) + avg(preloan_risk_label) * (count(*) / (count(*) + 20.0::DOUBLE)) AS encoded
  FROM imp, (SELECT avg(preloan_risk_label) AS g FROM imp WHERE split = 'train') WHERE split = 'train' GROUP BY addr_state, g"""
FEATURE_CTES = {"fills": FILL_CTE, "imp": IMPUTED_CTE, "bounds": BOUND_CTE, "clip": CLIP_CTE, "moments": MOMENT_CTE, "enc": ENCODING_CTE}

# categories of the low-cardinality texts in these tables
ONE_HOT = {
    "term": [" 36 months", " 60 months"],
    "purpose": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "home_ownership": ["MORTGAGE", "OWN", "RENT"],
}


def _one_hot_columns(source: str = "") -> list[tuple[str, str]]:
    out = []
    for c, values in ONE_HOT.items():
        out += [(f"{c}={v}", f"CASE WHEN {c} = {_quote(v)} THEN 1.0 ELSE 0.0 END::DOUBLE") for v in values]
        listed = ", ".join(_quote(v) for v in values)
        out.append((f"{c}=__unknown__", f"CASE WHEN {c} NOT IN ({listed}) THEN 1.0 ELSE 0.0 END::DOUBLE"))
    return out


def _features(body: str, upto: str) -> str:
    names = list(FEATURE_CTES)
    extra = {n: FEATURE_CTES[n] for n in names[: names.index(upto) + 1]}
    return _sql(body, "train", extra=extra)


RISK_PICK = "list_position([p1, p2, p3], greatest(p1, p2, p3))"
ADJ = f"SELECT *, CAST(CASE WHEN p0 >= 0.8::DOUBLE THEN 0 ELSE {RISK_PICK} END AS INTEGER) AS pred FROM scores"
GRID = "SELECT x / 100.0::DOUBLE AS threshold FROM range(50, 100) t(x)"


def _report(keys: str) -> str:
    """Per-class report of a confusion table ``cf`` (keys, y, pred, n)."""
    k = f"{keys}, " if keys else ""
    return f"""SELECT {k}label, CAST(sum(support) AS BIGINT) AS support, CAST(sum(predicted) AS BIGINT) AS predicted, CAST(sum(hits) AS BIGINT) AS hits,
        coalesce(sum(hits) / nullif(sum(predicted), 0), 0)::DOUBLE AS "precision", coalesce(sum(hits) / nullif(sum(support), 0), 0)::DOUBLE AS recall,
        coalesce(2 * sum(hits) / nullif(sum(predicted) + sum(support), 0), 0)::DOUBLE AS f1
      FROM (SELECT {k}y AS label, n AS support, 0 AS predicted, CASE WHEN y = pred THEN n ELSE 0 END AS hits FROM cf
            UNION ALL SELECT {k}pred, 0, n, 0 FROM cf) GROUP BY {k}label"""


def _round(names: list[str], digits: int) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


CURVE = ["normal_precision", "risk_recall_mean", "macro_f1", "weighted_f1", "predicted_normal_ratio"]
CURVE_CTES = {
    "grid": GRID,
    "cf": f"""SELECT threshold, y, pred, count(*) AS n FROM (SELECT threshold, y_true AS y,
        CASE WHEN p0 >= threshold THEN 0 ELSE {RISK_PICK} END AS pred FROM scores, grid) GROUP BY ALL""",
    "rep": _report("threshold"),
    "curve": """SELECT threshold, coalesce(max("precision") FILTER (label = 0), 0) AS normal_precision,
        avg(recall) FILTER (label <> 0) AS risk_recall_mean, avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1,
        coalesce(max(predicted) FILTER (label = 0), 0) / sum(support) AS predicted_normal_ratio FROM rep GROUP BY threshold""",
}


def _best(floor: float) -> str:
    return f"""(SELECT threshold, {', '.join(CURVE)}, normal_precision >= {floor}::DOUBLE AS above_floor, {floor}::DOUBLE AS floor FROM curve
      ORDER BY above_floor DESC,
        CASE WHEN normal_precision >= {floor}::DOUBLE THEN round(risk_recall_mean, 9) ELSE round(normal_precision, 9) END DESC,
        CASE WHEN normal_precision >= {floor}::DOUBLE THEN round(macro_f1, 9) ELSE round(risk_recall_mean, 9) END DESC, threshold LIMIT 1)"""


INFERRED = "CASE WHEN installment > 0 THEN ceil(greatest(coalesce(delinq_amnt, 0), 0) / installment) * 30 ELSE 0 END"


def _historic(explicit: list[str]) -> str:
    signals = ", ".join([*explicit, f"""CASE WHEN status IN {LOSS} THEN 181
      WHEN status = 'late (31-120 days)' THEN CASE WHEN inferred > 0 THEN least(greatest(inferred, 31), 120) ELSE 60 END
      WHEN status = 'late (16-30 days)' THEN 23 WHEN status = 'in grace period' THEN 15 END""", "CASE WHEN inferred > 0 THEN inferred END"])
    return f"coalesce(greatest({signals}), 0)::DOUBLE"


RULE = """CASE WHEN days > 180 THEN 'overdue_over_180' WHEN days BETWEEN 91 AND 180 THEN 'overdue_91_to_180'
  WHEN days BETWEEN 31 AND 90 THEN 'overdue_31_to_90' WHEN coalesce(dti, 0) > 60 AND coalesce(delinq_2yrs, 0) > 0 THEN 'burden_and_delinquency'
  WHEN coalesce(inq_last_6mths, 0) > 10 AND coalesce(dti, 0) > 50 THEN 'burden_and_inquiries' END"""
RULE_CLASS = "CASE fired_rule WHEN 'overdue_over_180' THEN 3 WHEN 'overdue_91_to_180' THEN 2 WHEN 'overdue_31_to_90' THEN 2 WHEN 'burden_and_delinquency' THEN 2 WHEN 'burden_and_inquiries' THEN 1 END"
RULE_CTES = {
    "adj": ADJ,
    "ruled": f"""SELECT *, {RULE} AS fired_rule FROM (SELECT *, {_historic(['hardship_dpd'])} AS days FROM (SELECT *, {INFERRED} AS inferred FROM st))""",
    "fin": f"""SELECT r.*, a.y_true, a.p0, a.p1, a.p2, a.p3, a.pred, list_position([a.p0, a.p1, a.p2, a.p3], greatest(a.p0, a.p1, a.p2, a.p3)) - 1 AS raw_pred,
        CAST(coalesce({RULE_CLASS}, a.pred) AS INTEGER) AS final_pred FROM ruled r JOIN adj a USING (id)""",
}
INCOME = "greatest(coalesce(annual_inc, 0) * (1.0 - least(greatest(coalesce(dti, 0) / 100, 0), 1)) / 12, 0)"


def _cap(risk: str) -> str:
    return f"({INCOME} * (CASE {risk} WHEN 0 THEN 12 WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END)::DOUBLE)"


def _roc(source: str, keys: str) -> dict[str, str]:
    """``roc``: counts per distinct score with running sums by falling score."""
    return {
        "long": source,
        "cnt": f"SELECT {keys}, score, sum(hit) AS pos, count(*) AS n FROM long GROUP BY {keys}, score",
        "roc": f"""SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n, sum(pos) OVER (PARTITION BY {keys}) AS all_pos,
            sum(n) OVER (PARTITION BY {keys}) AS all_n FROM cnt WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""",
    }


AUC = "sum((n - pos)::DOUBLE * (cum_pos - pos / 2.0::DOUBLE)) / (max(all_pos)::DOUBLE * max(all_n - all_pos))"
CLASS_LONG = _union([f"SELECT id, {c} AS label, p{c} AS score, CASE WHEN y_true = {c} THEN 1 ELSE 0 END AS hit FROM scores" for c in range(4)])
PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]
PAIR_LONG = _union([
    f'SELECT {a} AS "left", {b} AS "right", {c} AS side, p{c} AS score, CASE WHEN y_true = {c} THEN 1 ELSE 0 END AS hit FROM scores WHERE y_true IN ({a}, {b})'
    for a, b in PAIRS for c in (a, b)
])
PAIR_AUC = f'SELECT "left", "right", avg(auc) AS auc, max(np) AS n_pair FROM (SELECT "left", "right", side, {AUC} AS auc, CAST(max(all_n) AS BIGINT) AS np FROM roc GROUP BY "left", "right", side) GROUP BY "left", "right"'
SHARE_LONG = _union([
    f'SELECT {a} AS "left", {b} AS "right", p{b} / greatest(p{a} + p{b}, 1e-12::DOUBLE) AS score, CASE WHEN y_true = {b} THEN 1 ELSE 0 END AS hit FROM scores WHERE y_true IN ({a}, {b})'
    for a, b in PAIRS
])
FULL_REPORT = {
    "adj": ADJ,
    "cf": "SELECT y_true AS y, pred, count(*) AS n FROM adj GROUP BY ALL UNION ALL SELECT c, c, 0 FROM range(4) t(c)",
    "rep": _report(""),
}
SUMMARY = """SELECT CAST(sum(support) AS BIGINT) AS n_rows, round(sum(hits) / sum(support), 9) AS accuracy,
  round(sum("precision" * support) / sum(support), 9) AS precision_weighted, round(sum(recall * support) / sum(support), 9) AS recall_weighted,
  round(avg(f1) FILTER (support + predicted > 0), 9) AS macro_f1, round(avg(f1), 9) AS report_macro_f1,
  round(sum(f1 * support) / sum(support), 9) AS weighted_f1, round(max("precision") FILTER (label = 0), 9) AS normal_precision,
  round(avg(recall) FILTER (label <> 0), 9) AS risk_recall_mean, round(avg(recall) FILTER (label <> 0 AND support > 0), 9) AS risk_recall_supported,
  round(avg(recall) FILTER (support > 0), 9) AS balanced_accuracy, round(max(predicted) FILTER (label = 0) / sum(support), 9) AS predicted_normal_ratio,
  round(max(predicted) / sum(support), 9) AS dominant_prediction_ratio,
  round(sum(f1 * support) / sum(support) - avg(f1) FILTER (support + predicted > 0), 9) AS f1_gap FROM rep"""

STRATA_CTES = {
    "norm": "SELECT * FROM {source} WHERE is_normal",
    "edges": "SELECT " + ", ".join(
        f"list_sort(list_distinct(quantile_cont({c}, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e_{c}" for c in ("annual_inc", "dti")
    ) + " FROM norm",
    "keyed": "SELECT norm.*, concat(coalesce(grade, 'Unknown'), '|', " + ", '|', ".join(
        f"CASE WHEN {c} IS NULL OR len(e_{c}) < 2 THEN '{p}_unknown' ELSE concat('{p}_', "
        f"greatest(len([x for x in e_{c} if x < {c}]) - 1, 0)) END" for c, p in (("annual_inc", "inc"), ("dti", "dti"))
    ) + ") AS strata_key FROM norm, edges",
    "sizes": "SELECT strata_key, count(*) AS n FROM keyed GROUP BY strata_key",
    "alloc": "SELECT *, n / sum(n) OVER ()::DOUBLE * {target} AS exact FROM sizes",
    "base": "SELECT *, least(floor(exact), n) AS b FROM alloc",
    "quota": """SELECT strata_key, n, CAST(b + CASE WHEN b < n AND row_number() OVER (PARTITION BY b < n ORDER BY exact - b DESC, strata_key) <= {target} - sum(b) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM base""",
}


def _strata(source: str, target: str) -> dict[str, str]:
    return {n: q.replace("{source}", source).replace("{target}", target) for n, q in STRATA_CTES.items()}


SAMPLED = """SELECT id FROM (SELECT k.*, quota, row_number() OVER (PARTITION BY strata_key ORDER BY md5(concat(CAST(id AS VARCHAR), '-42')), id) AS pos
    FROM keyed k JOIN quota USING (strata_key)) WHERE pos <= quota"""


def _metric_table() -> str:
    """The long table of all metrics: per class, over all classes, and means of the ranked ones."""
    def renamed(ctes: dict[str, str], tag: str) -> dict[str, str]:
        for old in ("long", "cnt", "roc"):
            ctes = {k: re.sub(rf"\b{old}\b", f"{tag}_{old}", v) for k, v in ctes.items()}
        return {f"{tag}_{k}": v for k, v in ctes.items()}

    ranked = f"""SELECT label, {AUC} AS auc, greatest(max(cum_pos / all_pos - (cum_n - cum_pos) / (all_n - all_pos)), 0) AS ks FROM one_roc GROUP BY label"""
    captured = """SELECT label, sum(hit) FILTER (pos <= top) / sum(hit)::DOUBLE AS capture FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, id) AS pos,
      greatest(floor(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE), 1) AS top FROM one_long) GROUP BY label"""
    pairs = PAIR_AUC.replace("FROM roc", "FROM two_roc")
    extra = {
        **FULL_REPORT, **renamed(_roc(CLASS_LONG, "label"), "one"), **renamed(_roc(PAIR_LONG, '"left", "right", side'), "two"),
        "ranked": ranked, "captured": captured, "summary": SUMMARY,
        "pair": f"SELECT avg(auc) AS auc_ovo_macro, sum(auc * n_pair) / sum(n_pair) AS auc_ovo_weighted FROM ({pairs})",
    }
    own = {"rep": ["precision", "recall", "f1", "support", "predicted"], "ranked": ["auc", "ks"], "captured": ["capture"]}
    parts = [f"SELECT 'class' AS scope, CAST(label AS INTEGER) AS label, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value FROM {t}" for t, ms in own.items() for m in ms]
    overall = re.findall(r"AS (\w+)(?=,| FROM rep)", SUMMARY)
    parts += [f"SELECT 'all', NULL, '{m}', CAST({m} AS DOUBLE) FROM summary" for m in overall if m not in ("n_rows", "BIGINT")]
    parts += [f"SELECT 'all', NULL, '{m}', {m} FROM pair" for m in ("auc_ovo_macro", "auc_ovo_weighted")]
    parts += [f"SELECT 'all', NULL, '{m}_mean', avg({m}) FROM {t}" for t, m in (("ranked", "auc"), ("ranked", "ks"), ("captured", "capture"))]
    return _sql(f"SELECT 'model' AS model, scope, label, metric, round(value, 9) AS value FROM ({_union(parts)})", "scores", extra=extra)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # scans
    q["scan_profile"] = _sql(_union([
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_present, count(DISTINCT {c}) AS n_distinct FROM loans" for c in COLUMNS
    ]), "loans")
    moments = lambda c, src, d: (
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), {d}) AS mean, round(stddev_samp({c}), {d}) AS std, "
        f"round(min({c})::DOUBLE, {d}) AS low, round(max({c})::DOUBLE, {d}) AS high FROM {src}"
    )
    q["head_profile"] = _sql(
        _union([moments(c, "head", 6) for c in NUMBERS]), "loans", extra={"head": "SELECT * FROM loans ORDER BY id LIMIT 1000"}
    )
    q["column_describe"] = _sql(_union([moments(c, "lb", 4) for c in ["calibrated_credit_limit", *NUMBERS]]), "lb")
    q["schema_aligned_rows"] = _sql("SELECT id, dti, 0.0::DOUBLE AS absent_number, loan_amnt FROM loans", "loans")
    q["applicant_defaults"] = _sql(
        "SELECT id, annual_inc, dti, NULL::VARCHAR AS emp_length, NULL::VARCHAR AS sub_grade, NULL::DOUBLE AS historical_max_overdue_days FROM loans", "loans"
    )
    q["identifiers_dropped"] = _sql("SELECT grade, count(*) AS n FROM loans GROUP BY grade", "loans")
    q["feature_policy_projection"] = _sql(f"SELECT id, {', '.join(NUMBERS + TEXTS)} FROM loans", "loans")
    groups = {
        "loan_amnt": "loan_product_features", "term": "loan_product_features", "purpose": "loan_product_features",
        "annual_inc": "repayment_capacity_features", "dti": "repayment_capacity_features", "revol_util": "repayment_capacity_features",
        "revol_bal": "repayment_capacity_features", "delinq_amnt": "credit_risk_features", "delinq_2yrs": "credit_risk_features",
        "inq_last_6mths": "credit_risk_features", "acc_now_delinq": "credit_risk_features",
        "home_ownership": "user_base_features", "addr_state": "user_base_features",
    }
    q["feature_group_profile"] = _sql(_union([
        f"SELECT '{c}' AS feature, '{g}' AS feature_group, round(1 - count({c}) / count(*)::DOUBLE, 6) AS null_share, count(DISTINCT {c}) AS n_distinct, "
        + (f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std" if c in NUMBERS else "NULL::DOUBLE AS mean, NULL::DOUBLE AS std")
        + " FROM loans" for c, g in groups.items()
    ]), "loans")
    # labels and splits
    q["issue_month_counts"] = _sql("SELECT strftime(im, '%Y-%m') AS issue_month, count(*) AS n FROM dated GROUP BY 1", "dated")
    q["invalid_issue_count"] = _sql("SELECT count(*) FILTER (im IS NULL) AS n_undated, count(*) AS n_rows FROM dated", "dated")
    q["overdue_days"] = _sql("SELECT id, estimated_overdue_days FROM od", "od")
    q["risk_labels"] = _sql(f"SELECT id, preloan_risk_label, {_case('preloan_risk_label', vocab.RISK_NAMES)} AS preloan_risk_label_name FROM rl", "rl")
    q["credit_limits"] = _sql("""SELECT id, calibrated_credit_limit, CASE WHEN calibrated_credit_limit <= 5000 THEN '<=5k' WHEN calibrated_credit_limit <= 10000 THEN '5k-10k'
      WHEN calibrated_credit_limit <= 20000 THEN '10k-20k' WHEN calibrated_credit_limit <= 50000 THEN '20k-50k' ELSE '50k+' END AS calibrated_credit_limit_band FROM lb""", "lb")
    q["scene_labels"] = _sql(f"SELECT id, postloan_scene_label, {_case('postloan_scene_label', vocab.SCENE_NAMES)} AS postloan_scene_label_name FROM lb", "lb")
    q["label_summary"] = _sql("""SELECT split, preloan_risk_label, count(*) AS n, round(avg(estimated_overdue_days), 6) AS avg_overdue_days,
      round(avg(calibrated_credit_limit), 6) AS avg_credit_limit FROM split GROUP BY ALL""", "split")
    q["label_distribution"] = _sql("SELECT preloan_risk_label AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share FROM rl GROUP BY 1", "rl")
    q["distribution_compare"] = _sql("""SELECT preloan_risk_label AS label, count(*) AS n_before,
      count(*) FILTER (NOT (missing_core OR too_fresh OR too_few_payments OR unused_line OR odd_clean_debtor)) AS n_after FROM rules GROUP BY 1""", "rules")
    q["normal_risk_summary"] = _sql("""SELECT count(*) AS n_rows, count(*) FILTER (is_normal) AS n_normal, count(*) FILTER (NOT is_normal) AS n_risk,
      round(count(*) FILTER (is_normal) / (count(*) FILTER (NOT is_normal))::DOUBLE, 6) AS normal_risk_ratio FROM obs""", "obs")
    q["class_remap"] = _sql("""SELECT id, CASE preloan_risk_label WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS three_class,
      least(preloan_risk_label, 2) AS severity_class, least(preloan_risk_label, 1) AS two_class FROM rl""", "rl")
    q["maturity_filter"] = _sql("SELECT id FROM mat WHERE is_mature", "mat")
    q["maturity_impact"] = _sql("""SELECT label, n_before, n_after, round(n_before / sum(n_before) OVER ()::DOUBLE, 6) AS share_before,
      round(n_after / sum(n_after) OVER ()::DOUBLE, 6) AS share_after, round(sum(n_after) OVER () / (sum(n_before) OVER ())::DOUBLE, 6) AS kept_share
      FROM (SELECT preloan_risk_label AS label, count(*) AS n_before, count(*) FILTER (is_mature) AS n_after FROM mat GROUP BY 1)""", "mat")
    q["temporal_split_counts"] = _sql("SELECT split, count(*) AS n FROM split GROUP BY 1", "split")
    q["temporal_split_rows"] = _sql("SELECT id, split FROM split", "split")
    q["month_plan"] = _sql("""SELECT im AS issue_month, count(*) AS n, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val,
      count(*) FILTER (split = 'test') AS n_test FROM split GROUP BY 1""", "split")
    q["bootstrap_split"] = _sql("""SELECT id, CASE WHEN rn < floor(total * 0.70::DOUBLE) THEN 'train' WHEN rn < floor(total * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split,
      preloan_risk_label FROM (SELECT *, row_number() OVER (ORDER BY im, id) - 1 AS rn, count(*) OVER () AS total
        FROM (SELECT * FROM dated ORDER BY id LIMIT 12000) WHERE im IS NOT NULL)""", "dated")
    q["time_folds"] = _sql("""SELECT CAST(f AS INTEGER) AS fold_no, count(*) FILTER (rn < total - (5 - f) * (total // 6)) AS n_train,
      count(*) FILTER (rn >= total - (5 - f) * (total // 6) AND rn < total - (4 - f) * (total // 6)) AS n_valid FROM ranked, range(5) t(f) GROUP BY f""", "ranked")
    q["time_fold_rows"] = _sql("SELECT id, CAST((SELECT count(*) FROM range(5) t(f) WHERE rn >= total - (5 - f) * (total // 6)) - 1 AS INTEGER) AS fold FROM ranked", "ranked")
    # purification
    q["observed_months"] = _sql("SELECT id, months AS observed_months FROM obs", "obs")
    q["repayment_periods"] = _sql("SELECT id, periods AS repayment_periods FROM per", "per")
    q["purified_rows"] = _sql("SELECT id FROM pure", "pure")
    rules = ["missing_core", "too_fresh", "too_few_payments", "unused_line", "odd_clean_debtor"]
    q["purify_rule_counts"] = _sql(_union(
        [f"SELECT '{r}' AS rule, count(*) FILTER ({r}) AS n_rows FROM rules" for r in rules]
        + [f"SELECT 'any_rule', count(*) FILTER ({' OR '.join(rules)}) FROM rules"]
    ), "rules")
    q["strata_quota"] = _sql("SELECT * FROM quota", "pure", extra=_strata("pure", "3000"))
    q["stratified_sample"] = _sql(
        f"SELECT id FROM obs WHERE NOT is_normal UNION ALL {SAMPLED}", "obs",
        extra=_strata("obs", "(SELECT count(*) FROM obs WHERE NOT is_normal)"),
    )
    q["seeded_sample"] = _sql(f"SELECT id FROM loans ORDER BY md5(concat(CAST(id AS VARCHAR), '-42')), id LIMIT {SAMPLE_ROWS}", "loans")
    target = "(SELECT count(*) FROM tr WHERE NOT is_normal)"
    q["purified_splits"] = _sql(
        f"""SELECT split, preloan_risk_label, count(*) AS n FROM (SELECT split, preloan_risk_label, id FROM both2 WHERE split <> 'train' OR NOT is_normal
          OR id IN ({SAMPLED})) GROUP BY ALL""", "pure", "split",
        extra={"both2": "SELECT p.*, s.split FROM pure p JOIN split s USING (id)", "tr": "SELECT * FROM both2 WHERE split = 'train'", **_strata("tr", target)},
    )
    # features
    q["imputer_fit"] = _features(_union(
        [f"SELECT '{c}' AS feature, round(f_{c}, 6) AS fill_number, NULL::VARCHAR AS fill_text FROM fills" for c in NUMBERS]
        + [f"SELECT '{c}', NULL::DOUBLE, f_{c} FROM fills" for c in TEXTS]
    ), "fills")
    values = f"{_round([c for c in NUMBERS if c not in EXACT], 6)}, {', '.join(EXACT)}"
    q["imputed_rows"] = _features(f"SELECT id, {values}, {', '.join(TEXTS)} FROM imp", "imp")
    q["iqr_bounds"] = _features(_union([f"SELECT '{c}' AS feature, round(lo_{c}, 6) AS low, round(hi_{c}, 6) AS high FROM bounds" for c in NUMBERS]), "bounds")
    q["clipped_rows"] = _features(f"SELECT id, {values} FROM clip", "clip")
    q["one_hot"] = _features("SELECT id, " + ", ".join(f'{e} AS "{n}"' for n, e in _one_hot_columns()) + " FROM imp", "imp")
    q["target_encoding"] = _features("SELECT feature, category, round(encoded, 9) AS encoded FROM enc", "enc")
    q["target_encoded_rows"] = _features("SELECT id, round(coalesce(encoded, (SELECT avg(preloan_risk_label) FROM train)), 9) AS encoded FROM imp LEFT JOIN enc ON addr_state = category", "enc")
    q["scaled_rows"] = _features("SELECT id, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}__scaled" for c in NUMBERS) + " FROM clip, moments", "moments")
    q["variance_filter"] = _features(_union(
        [f"SELECT '{c}__scaled' AS feature, round(var_pop(({c} - m_{c}) / s_{c}), 9) AS variance, var_pop(({c} - m_{c}) / s_{c}) > 0.01 AS kept FROM clip, moments WHERE split = 'train'" for c in NUMBERS]
        + [f"SELECT {_quote(n)}, round(var_pop({e}), 9), var_pop({e}) > 0.01 FROM clip WHERE split = 'train'" for n, e in _one_hot_columns()]
        + ["SELECT 'addr_state__target_encoded', round(var_pop(encoded), 9), var_pop(encoded) > 0.01 FROM clip JOIN enc ON addr_state = category WHERE split = 'train'"]
    ), "enc")
    q["correlation_pairs"] = _sql(_union([
        f"SELECT 'p{a}' AS \"left\", 'p{b}' AS \"right\", round(corr(p{a}, p{b}), 6) AS correlation FROM scores" for a, b in PAIRS
    ]), "scores")
    wide = ["loan_amnt", "installment", "revol_bal", "estimated_overdue_days", "preloan_risk_label"]
    q["correlation_drop"] = _sql("SELECT r AS feature, count(*) AS n_partners, round(max(abs(c)), 6) AS top_correlation FROM pairs WHERE abs(c) > 0.8 GROUP BY r", "rl", extra={
        "pairs": _union([f"SELECT '{b}' AS r, corr({a}, {b}) AS c FROM rl" for i, b in enumerate(wide) for a in wide[:i]])
    })
    q["class_weights"] = _sql("""SELECT preloan_risk_label AS label, count(*) AS n,
      round(sum(count(*)) OVER () / ((count(*) OVER ()) * count(*))::DOUBLE, 9) AS weight FROM rl GROUP BY 1""", "rl")
    q["row_weights"] = _sql("SELECT id, (CASE preloan_risk_label WHEN 1 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 10 ELSE 1 END)::DOUBLE AS weight FROM rl", "rl")
    q["oversample_targets"] = _sql("""SELECT label, n, CAST(CASE WHEN n > 1 AND n < (SELECT max(n) FROM c)
        THEN greatest(n, least((SELECT max(n) FROM c), greatest((SELECT max(n) FROM c WHERE n < (SELECT max(n) FROM c)), ceil((SELECT max(n) FROM c) / 5.0)))) ELSE n END AS BIGINT) AS target FROM c""",
        "rl", extra={"c": "SELECT preloan_risk_label AS label, count(*) AS n FROM rl GROUP BY 1"})
    q["mean_abs_values"] = _features(_union([f"SELECT '{c}__scaled' AS feature, round(avg(abs(({c} - m_{c}) / s_{c})), 6) AS value FROM clip, moments" for c in NUMBERS]), "moments")
    # decisions
    q["threshold_adjust"] = _sql("SELECT id, pred FROM adj", "scores", extra={"adj": ADJ})
    q["threshold_curve"] = _sql(f"SELECT threshold, {_round(CURVE, 9)} FROM curve", "scores", extra=CURVE_CTES)
    q["best_threshold"] = _sql(f"SELECT threshold, {_round(CURVE, 9)}, above_floor, floor FROM ({_union([_best(f) for f in (0.8, 0.85, 0.99)])})", "scores", extra=CURVE_CTES)
    q3 = """SELECT id, CASE y_true WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS y3, p0 AS q0, p1 + p2 AS q1, p3 AS q2,
      list_position([p0, p1 + p2, p3], greatest(p0, p1 + p2, p3)) - 1 AS pick FROM scores"""
    steps = ", ".join(f"('{t:.2f}', {t}::DOUBLE)" for t in (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15)) + ", ('argmax', 9::DOUBLE)"
    q["loss_threshold_scan"] = _sql(
        """SELECT setting, round(sum(f1 * support) / sum(support), 9) AS weighted_f1, round(avg(f1), 9) AS macro_f1,
          round(coalesce(max(recall) FILTER (label = 0), 0), 9) AS recall_0, round(coalesce(max(recall) FILTER (label = 1), 0), 9) AS recall_1,
          round(coalesce(max(recall) FILTER (label = 2), 0), 9) AS recall_2 FROM rep GROUP BY setting""", "scores",
        extra={
            "q3": q3,
            "cf": f"SELECT setting, y, pred, count(*) AS n FROM (SELECT setting, y3 AS y, CASE WHEN q2 >= t THEN 2 ELSE pick END AS pred FROM q3, (VALUES {steps}) s(setting, t)) GROUP BY ALL",
            "rep": _report("setting"),
        },
    )
    q["historic_overdue"] = _sql(f"SELECT id, {_historic(['estimated_overdue_days', 'hardship_dpd'])} AS days FROM (SELECT *, {INFERRED} AS inferred FROM od)", "od")
    q["rule_override"] = _sql("SELECT id, fired_rule, final_pred FROM fin", "st", "scores", extra=RULE_CTES)
    q["rule_escalate3"] = _sql(
        f"""SELECT id, CAST(greatest(pick, CASE coalesce({RULE_CLASS}, 0) WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS INTEGER) AS final_class
          FROM ruled JOIN q3 USING (id)""", "st", "scores", extra={"ruled": RULE_CTES["ruled"], "q3": q3})
    q["disposable_income"] = _sql(f"SELECT id, round({INCOME}, 6) AS monthly_income FROM loans", "loans")
    capped = f"round_even(least(greatest(loan_amnt * 2.5 - 3000, 0), {_cap('preloan_risk_label')}), 2)"
    q["limit_caps"] = _sql(f"SELECT id, {capped} AS capped_limit FROM rl", "rl")
    q["cap_violations"] = _sql(_union([
        f"SELECT count(*) AS n_rows, count(*) FILTER ({e} > {_cap('preloan_risk_label')} + 1e-6::DOUBLE) AS n_violations, '{s}' AS stage FROM rl"
        for s, e in (("raw", "loan_amnt * 2.5 - 3000"), ("capped", capped))
    ]), "rl")
    q["two_stage_compose"] = _sql("SELECT id, " + ", ".join(f"round(x{i} / greatest(x0 + x1 + x2 + x3, 1e-12::DOUBLE), 9) AS q{i}" for i in range(4))
        + " FROM (SELECT id, p0 AS x0, " + ", ".join(f"(1.0 - p0) * (p{i} / (1.0 - p0)) AS x{i}" for i in (1, 2, 3)) + " FROM scores)", "scores")
    q["aligned_probabilities"] = _sql("SELECT id, round(p0, 9) AS a0, round(p1, 9) AS a1, 0.0::DOUBLE AS a2, round(p3, 9) AS a3, 0.0::DOUBLE AS a4 FROM scores", "scores")
    # evaluation
    q["confusion"] = _sql("""SELECT CAST(a AS INTEGER) AS y, CAST(b AS INTEGER) AS pred, count(id) AS n FROM range(4) r(a), range(4) s(b)
      LEFT JOIN adj ON y_true = a AND pred = b GROUP BY a, b""", "scores", extra={"adj": ADJ})
    q["class_report"] = _sql('SELECT label, support, predicted, hits, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1 FROM rep', "scores", extra=FULL_REPORT)
    q["macro_weighted_f1"] = _sql(SUMMARY, "scores", extra=FULL_REPORT)
    roc = _roc(CLASS_LONG, "label")
    q["ovr_auc"] = _sql(f"SELECT label, round({AUC}, 9) AS auc FROM roc GROUP BY label", "scores", extra=roc)
    q["ks"] = _sql("SELECT label, round(greatest(max(cum_pos / all_pos - (cum_n - cum_pos) / (all_n - all_pos)), 0), 9) AS ks FROM roc GROUP BY label", "scores", extra=roc)
    pairs = _roc(PAIR_LONG, '"left", "right", side')
    q["pair_auc"] = _sql(f'SELECT "left", "right", round(auc, 9) AS auc, n_pair FROM ({PAIR_AUC})', "scores", extra=pairs)
    q["ovo_auc"] = _sql(f"SELECT round(avg(auc), 9) AS auc_ovo_macro, round(sum(auc * n_pair) / sum(n_pair), 9) AS auc_ovo_weighted FROM ({PAIR_AUC})", "scores", extra=pairs)
    q["pair_roc_points"] = _sql('SELECT "left", "right", round((cum_n - cum_pos) / (all_n - all_pos)::DOUBLE, 9) AS fpr, round(cum_pos / all_pos::DOUBLE, 9) AS tpr FROM roc', "scores", extra=_roc(SHARE_LONG, '"left", "right"'))
    q["bad_capture"] = _sql(
        """SELECT label, CAST(sum(hit) AS BIGINT) AS n_class, CAST(sum(hit) FILTER (pos <= top) AS BIGINT) AS n_captured,
          round(sum(hit) FILTER (pos <= top) / sum(hit)::DOUBLE, 9) AS capture
          FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, id) AS pos,
            greatest(floor(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE), 1) AS top FROM long) GROUP BY label""",
        "scores", extra={"long": CLASS_LONG})
    q["prediction_distribution"] = _sql("""SELECT CAST(c AS INTEGER) AS label, count(id) AS n, round(count(id) / sum(count(id)) OVER ()::DOUBLE, 6) AS share
      FROM range(4) t(c) LEFT JOIN adj ON pred = c GROUP BY c""", "scores", extra={"adj": ADJ})
    q["degeneration_flags"] = _sql("""SELECT coalesce(string_agg(CAST(label AS VARCHAR), ',' ORDER BY label) FILTER (recall = 0), '') AS zero_recall_classes,
      count(*) FILTER (recall = 0) > 0 AS has_zero_recall,
      max(predicted) FILTER (label = 0) / sum(support) > 0.9 AND max(recall) FILTER (label <> 0) < 0.1 AS lazy_normal,
      abs(sum(f1 * support) / sum(support) - avg(f1) FILTER (support + predicted > 0)) > 0.3 AS wide_f1_gap FROM rep""", "scores", extra=FULL_REPORT)
    err = "(calibrated_credit_limit - loan_amnt * 0.6::DOUBLE)"
    q["regression_metrics"] = _sql(f"""SELECT round(avg(abs({err})), 6) AS mae, round(sqrt(avg({err} * {err})), 6) AS rmse,
      round(1 - avg({err} * {err}) / var_pop(calibrated_credit_limit), 6) AS r2,
      round(avg(abs({err} / calibrated_credit_limit)) FILTER (abs(calibrated_credit_limit) > 1e-8), 6) AS mape FROM lb""", "lb")
    q["residual_histogram"] = _sql("""SELECT CAST(b AS INTEGER) AS bin, round(lo + b * ((hi - lo) / 30), 6) AS bin_start, count(e) AS n
      FROM range(30) t(b) CROSS JOIN (SELECT min(e) AS lo, max(e) AS hi FROM r) s
      LEFT JOIN r ON least(floor((r.e - s.lo) / (s.hi - s.lo) * 30), 29) = b GROUP BY b, lo, hi""", "lb",
        extra={"r": "SELECT loan_amnt * 0.6::DOUBLE - calibrated_credit_limit AS e FROM lb"})
    q["ols_limit_line"] = _sql("""SELECT grade, round(regr_slope(calibrated_credit_limit, loan_amnt), 6) AS slope,
      round(regr_intercept(calibrated_credit_limit, loan_amnt), 6) AS intercept FROM lb GROUP BY grade""", "lb")
    strategies = {
        **RULE_CTES,
        "cf": """SELECT model, y, pred, count(*) AS n FROM (SELECT 'raw' AS model, y_true AS y, raw_pred AS pred FROM fin UNION ALL SELECT 'threshold', y_true, pred FROM fin
          UNION ALL SELECT 'threshold_rules', y_true, final_pred FROM fin) GROUP BY ALL""",
        "rep": _report("model"),
        "res": """SELECT model, round(avg(f1), 9) AS macro_f1, round(sum(f1 * support) / sum(support), 9) AS weighted_f1,
          round(coalesce(max("precision") FILTER (label = 0), 0), 9) AS normal_precision, round(avg(recall) FILTER (label <> 0), 9) AS high_risk_recall FROM rep GROUP BY model""",
    }
    q["strategy_compare"] = _sql("SELECT * FROM res", "st", "scores", extra=strategies)
    q["best_strategy"] = _sql("SELECT model, macro_f1 FROM res ORDER BY macro_f1 DESC, high_risk_recall DESC, normal_precision DESC, model LIMIT 1", "st", "scores", extra=strategies)
    q["dashboard_risk_levels"] = _sql(f"SELECT CASE WHEN loan_status IS NULL THEN '未知' ELSE {_case('preloan_risk_label', vocab.RISK_NAMES)} END AS risk_level, count(*) AS n FROM rl GROUP BY 1", "rl")
    # records and texts
    def name(col):
        return _case(col, vocab.RISK_NAMES, "'未知'")

    approved = f"round_even(least(greatest(loan_amnt * 1.5, 0), {_cap('final_pred')}), 2)"
    scene = _case("final_pred", vocab.SCENE_NAMES)
    q["score_records"] = _sql(f"""SELECT id, CAST(raw_pred AS INTEGER) AS raw_model_risk_label, {name('raw_pred')} AS raw_model_risk_label_name,
      pred AS threshold_adjusted_risk_label, {name('pred')} AS threshold_adjusted_risk_label_name, final_pred AS rule_adjusted_risk_label,
      {name('final_pred')} AS rule_adjusted_risk_label_name, final_pred AS risk_label, {name('final_pred')} AS risk_label_name,
      0.8::DOUBLE AS normal_class_threshold, round_even(greatest(loan_amnt * 1.5, 0), 2) AS raw_credit_limit, {approved} AS approved_credit_limit,
      {scene} AS strategy_scenario, 'local_fallback' AS strategy_source, {', '.join(f'round_even(p{c}, 4) AS share_{c}' for c in range(4))} FROM fin""",
        "st", "scores", extra=RULE_CTES)
    texts = {n: t.split("{limit}") for n, t in vocab.STRATEGY_TEXTS.items()}
    filled = "CASE final_pred " + " ".join(
        f"WHEN {c} THEN " + (f"concat({_quote(texts[n][0])}, CAST({approved} AS VARCHAR), {_quote(texts[n][1])})" if len(texts[n]) == 2 else _quote(texts[n][0]))
        for c, n in vocab.SCENE_NAMES.items()
    ) + " END"
    q["scenario_text"] = _sql(f"SELECT id, {scene} AS strategy_scenario, {filled} AS strategy_content, 'local_fallback' AS strategy_source FROM fin", "st", "scores", extra=RULE_CTES)
    by_label = _case("preloan_risk_label + CASE WHEN id % 7 = 0 THEN 2 ELSE 0 END", vocab.SCENE_NAMES, "'风险预警'")
    q["scenario_resolution"] = _sql(f"""SELECT id, CASE WHEN id % 3 = 0 OR id % 5 < 3 THEN {_case('postloan_scene_label', vocab.SCENE_NAMES)} ELSE {by_label} END AS strategy_scenario FROM lb""", "lb")
    q["two_stage_threshold_rules"] = _sql("SELECT id, pred AS threshold_pred, final_pred FROM fin", "st", "scores",
        extra={**RULE_CTES, "adj": ADJ.replace("0.8::DOUBLE", "0.9::DOUBLE")})
    three = "CASE preloan_risk_label WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END"
    q["three_class_maps"] = _sql(f"""SELECT id, {_case(three, vocab.RISK_NAMES_3)} AS risk_name, CAST(CASE {three} WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END AS INTEGER) AS scene_label,
      CAST({three} AS INTEGER) AS cap_class FROM rl""", "rl")
    bad = _roc("SELECT id, 1 AS label, 1.0::DOUBLE - p0 AS score, CASE WHEN y_true <> 0 THEN 1 ELSE 0 END AS hit FROM scores", "label")
    q["bad_versus_good_ks"] = _sql(f"SELECT round(greatest(max(cum_pos / all_pos - (cum_n - cum_pos) / (all_n - all_pos)), 0), 9) AS ks, round({AUC}, 9) AS auc FROM roc", "scores", extra=bad)
    q["metric_table"] = _metric_table()
    facts = [("id", "id"), ("risk_label", "final_pred"), ("annual_inc", "annual_inc"), ("dti", "dti"), ("approved_credit_limit", approved)]
    lines = ", ".join(f"concat('  \"{n}\" : ', CAST({e} AS VARCHAR))" if n == "id" else
                      f"CASE WHEN {e} IS NOT NULL THEN concat('  \"{n}\" : ', CAST({e} AS VARCHAR)) END" for n, e in facts)
    task = "CASE final_pred " + " ".join(f"WHEN {c} THEN {_quote(vocab.PROMPT_TEXTS[n])}" for c, n in vocab.SCENE_NAMES.items()) + " END"
    fixed = _quote(f"\n\n{vocab.RED_LINES}\n\n{vocab.OUTPUT_RULES}\n\n{vocab.PROFILE_HEADING}\n")
    q["prompt_rows"] = _sql(f"""SELECT id, concat({task}, {fixed}, '{{', chr(10), array_to_string(list_filter([{lines}], lambda x: x IS NOT NULL), ',' || chr(10)), chr(10), '}}') AS prompt
      FROM fin""", "st", "scores", extra=RULE_CTES)
    wanted = """CASE WHEN n > 1 AND n < (SELECT max(n) FROM c)
      THEN greatest(n, least((SELECT max(n) FROM c), greatest((SELECT max(n) FROM c WHERE n < (SELECT max(n) FROM c)), ceil((SELECT max(n) FROM c) / 5.0)))) ELSE n END"""
    q["smote_rows"] = _sql(f"""SELECT label AS preloan_risk_label, false AS is_synthetic, n FROM c
      UNION ALL SELECT label, true, CAST({wanted} - n AS BIGINT) FROM c WHERE {wanted} > n""",
        "train", extra={"c": "SELECT preloan_risk_label AS label, count(*) AS n FROM train GROUP BY 1"})
    reply = REPLY_SQL
    q["review_responses"] = f"""SELECT id, coalesce(nullif(trim(json_extract_string(nullif(regexp_extract(reply, '(?s)([{{].*[}}])', 1), ''), '$.revised_content')), ''), original) AS final_content
      FROM (SELECT o_orderkey AS id, concat('原文 ', o_orderkey) AS original, {reply} AS reply FROM orders)"""
    return q
