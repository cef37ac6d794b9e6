"""Fixed vocabularies: label names, status words, feature policy, texts."""

# ---- fixed values: statuses (trimmed, lower case) ----
FULLY_PAID = "fully paid"
CURRENT = "current"
GRACE = "in grace period"
LATE_SHORT = "late (16-30 days)"
LATE_LONG = "late (31-120 days)"
CHARGED_OFF = "charged off"
DEFAULTED = "default"
POLICY_PAID = "does not meet the credit policy. status:fully paid"
POLICY_CHARGED_OFF = "does not meet the credit policy. status:charged off"

NORMAL_STATUSES = [FULLY_PAID, CURRENT]
LOSS_STATUSES = [CHARGED_OFF, DEFAULTED, POLICY_CHARGED_OFF]
TERMINAL_STATUSES = LOSS_STATUSES + [FULLY_PAID, POLICY_PAID]

# ---- fixed values: display names ----
RISK_NAMES = {0: "正常类", 1: "关注类", 2: "次级/可疑类", 3: "损失类"}
RISK_NAMES_3 = {0: "正常类", 1: "风险类", 2: "损失类"}
SCENE_NAMES = {0: "正常维护", 1: "风险预警", 2: "逾期催收", 3: "协商还款"}
UNKNOWN_NAME = "未知"
DEFAULT_SCENE = 1

# ---- fixed values: class schemes built from the 4-class label ----
TO_THREE_CLASS = {0: 0, 1: 1, 2: 1, 3: 2}
TO_THREE_CLASS_SEVERITY = {0: 0, 1: 1, 2: 2, 3: 2}
TO_TWO_CLASS = {0: 0, 1: 1, 2: 1, 3: 1}

# ---- fixed values: class weights ----
STRONG_WEIGHTS = {0: 1.0, 1: 5.0, 2: 20.0, 3: 35.0}
MILD_WEIGHTS = {0: 1.0, 1: 2.0, 2: 6.0, 3: 10.0}
MIDDLE_WEIGHTS = {0: 1.0, 1: 3.0, 2: 8.0, 3: 15.0}
STAGE_ONE_WEIGHTS = {0: 1.0, 1: 3.0}
STAGE_TWO_WEIGHTS = {1: 5.0, 2: 20.0, 3: 35.0}

# ---- fixed values: identifiers and label columns ----
IDENTIFIERS = ["id", "member_id", "url"]
LABEL_COLUMNS = [
    "calibrated_credit_limit", "calibrated_credit_limit_band", "estimated_overdue_days",
    "postloan_scene_label", "postloan_scene_label_name",
    "preloan_risk_label", "preloan_risk_label_name",
]

# ---- fixed values: fields known at application time ----
APPLICATION_FIELDS = [
    "acc_now_delinq", "acc_open_past_24mths", "addr_state", "all_util", "annual_inc", "annual_inc_joint",
    "application_type", "avg_cur_bal", "bc_open_to_buy", "bc_util", "collections_12_mths_ex_med",
    "delinq_2yrs", "delinq_amnt", "desc", "dti", "dti_joint", "earliest_cr_line", "emp_length", "emp_title",
    "home_ownership", "il_util", "inq_fi", "inq_last_12m", "inq_last_6mths", "loan_amnt", "max_bal_bc",
    "mo_sin_old_il_acct", "mo_sin_old_rev_tl_op", "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl", "mort_acc",
    "mths_since_last_delinq", "mths_since_last_major_derog", "mths_since_last_record", "mths_since_rcnt_il",
    "mths_since_recent_bc", "mths_since_recent_bc_dlq", "mths_since_recent_inq",
    "mths_since_recent_revol_delinq", "num_accts_ever_120_pd", "num_actv_bc_tl", "num_actv_rev_tl",
    "num_bc_sats", "num_bc_tl", "num_il_tl", "num_op_rev_tl", "num_rev_accts", "num_rev_tl_bal_gt_0",
    "num_sats", "num_tl_120dpd_2m", "num_tl_30dpd", "num_tl_90g_dpd_24m", "num_tl_op_past_12m", "open_acc",
    "open_acc_6m", "open_act_il", "open_il_12m", "open_il_24m", "open_rv_12m", "open_rv_24m",
    "pct_tl_nvr_dlq", "percent_bc_gt_75", "pub_rec", "pub_rec_bankruptcies", "purpose", "pymnt_plan",
    "revol_bal", "revol_bal_joint", "revol_util", "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med", "sec_app_earliest_cr_line", "sec_app_inq_last_6mths",
    "sec_app_mort_acc", "sec_app_mths_since_last_major_derog", "sec_app_num_rev_accts", "sec_app_open_acc",
    "sec_app_open_act_il", "sec_app_revol_util", "tax_liens", "term", "title", "tot_coll_amt", "tot_cur_bal",
    "tot_hi_cred_lim", "total_acc", "total_bal_ex_mort", "total_bal_il", "total_bc_limit", "total_cu_tl",
    "total_il_high_credit_limit", "total_rev_hi_lim", "verification_status", "verification_status_joint",
    "zip_code",
]

# ---- fixed values: fields known only after the loan was paid out ----
OUTCOME_FIELDS = [
    "collection_recovery_fee", "debt_settlement_flag", "hardship_flag", "hardship_type", "hardship_reason",
    "hardship_status", "hardship_amount", "hardship_start_date", "hardship_end_date", "hardship_length",
    "hardship_dpd", "last_credit_pull_d", "last_pymnt_amnt", "last_pymnt_d", "loan_status", "next_pymnt_d",
    "out_prncp", "out_prncp_inv", "payment_plan_start_date", "recoveries", "settlement_amount",
    "settlement_date", "settlement_percentage", "settlement_status", "total_pymnt", "total_pymnt_inv",
    "total_rec_int", "total_rec_late_fee", "total_rec_prncp",
]
OUTCOME_PREFIXES = [
    "hardship_", "last_pymnt", "next_pymnt", "out_prncp", "settlement_", "total_pymnt",
    "total_rec_",
]

# ---- fixed values: name fragments per business group, first match wins ----
GROUP_FRAGMENTS = {
    "loan_product_features": [
        "loan", "funded", "term", "int_rate", "grade", "sub_grade", "purpose", "title", "installment",
        "policy_code", "disbursement", "application_type", "initial_list_status", "issue_d",
    ],
    "repayment_capacity_features": [
        "annual_inc", "dti", "installment", "revol_bal", "revol_util", "total_bal", "tot_cur_bal",
        "avg_cur_bal", "bc_open_to_buy", "all_util", "il_util", "total_rev_hi_lim", "total_bc_limit",
        "total_il_high_credit_limit", "tot_hi_cred_lim", "mort_acc", "open_acc", "num_sats",
    ],
    "credit_risk_features": [
        "delinq", "inq", "pub_rec", "collection", "chargeoff", "bankrupt", "tax_liens", "mths_since",
        "hardship", "settlement", "acc_now_delinq", "num_tl", "pct_tl", "percent_bc", "earliest_cr_line",
    ],
}
OTHER_GROUP = "user_base_features"

# ---- fixed values: fields of one applicant that default to null ----
APPLICANT_FIELDS = {
    "loan_amnt": "double", "annual_inc": "double", "dti": "double", "emp_length": "string",
    "home_ownership": "string", "purpose": "string", "grade": "string", "sub_grade": "string",
    "verification_status": "string", "term": "string", "issue_d": "string", "loan_status": "string",
    "delinq_2yrs": "double", "inq_last_6mths": "double", "delinq_amnt": "double", "installment": "double",
    "hardship_dpd": "double", "historical_max_overdue_days": "double", "estimated_overdue_days": "double",
}

# ---- fixed values: strategy texts per scene ({limit} = approved limit) ----
STRATEGY_TEXTS = {
    "正常维护": (
        "复贷建议：结合当前授信额度 {limit} 元，优先推荐低风险复贷产品。\n"
        "权益方案：提供账单提醒、费率优惠和优质客户关怀服务。\n"
        "维护话术：感谢客户保持良好还款记录，鼓励持续稳定用信。\n"
        "合规提醒：禁止虚假承诺，沟通内容需真实、审慎、可审计。"
    ),
    "风险预警": (
        "还款提醒：提前提示账单日和还款日，建议设置自动提醒。\n"
        "风险提示：关注收入波动和负债压力变化，避免进一步逾期。\n"
        "还款规划：建议分配月度现金流，优先保障核心还款。\n"
        "合规提醒：禁止威胁辱骂，沟通必须克制、专业、真实。"
    ),
    "逾期催收": (
        "合规催收话术：提示客户当前存在逾期，请尽快核实并安排还款。\n"
        "还款方案：建议一次性还清或尽快制定阶段性还款安排。\n"
        "逾期后果：说明逾期可能影响征信和后续授信资格。\n"
        "合规提醒：禁止暴力催收、禁止威胁辱骂、禁止虚假承诺。"
    ),
    "协商还款": (
        "协商方案：优先评估客户还款意愿和可承受能力，制定分期方案。\n"
        "分期建议：按月度现金流设置合理期数，减少一次性压力。\n"
        "沟通话术：强调协商目标是解决问题并控制风险，保持尊重和克制。\n"
        "合规提醒：禁止暴力催收、禁止威胁辱骂、禁止虚假承诺。"
    ),
}

# ---- fixed values: prompt texts per scene ----
PROMPT_TEXTS = {
    "正常维护": (
        "你是一名资深客户运营专家，需要为优质或正常客户制定维护策略。\n"
        "请输出以下内容：\n1. 复贷建议\n2. 权益方案\n3. 维护话术\n4. 风险关注点\n"
        "要求：语气专业、友好、稳健，突出客户价值和长期关系维护。"
    ),
    "风险预警": (
        "你是一名风险预警专员，需要为存在潜在还款压力的客户制定提醒策略。\n"
        "请输出以下内容：\n1. 还款提醒\n2. 风险提示\n3. 还款规划建议\n4. 客户沟通话术\n"
        "要求：表达清晰、克制、合规，避免制造恐慌。"
    ),
    "逾期催收": (
        "你是一名合规催收专员，需要为逾期客户制定合规催收策略。\n"
        "请输出以下内容：\n1. 合规催收话术\n2. 可执行还款方案\n3. 逾期后果说明\n4. 升级处理建议\n"
        "要求：强调合规、事实清晰、尊重客户，不得出现过激表达。"
    ),
    "协商还款": (
        "你是一名坏账处置专员，需要为高风险客户制定协商还款方案。\n"
        "请输出以下内容：\n1. 协商方案\n2. 分期建议\n3. 沟通话术\n4. 风险处置建议\n"
        "要求：以解决问题为目标，兼顾风险控制和客户沟通体验。"
    ),
}
RED_LINES = (
    "合规红线必须严格遵守：禁止暴力催收、禁止威胁辱骂、禁止虚假承诺、"
    "禁止诱导客户提供虚假信息、禁止承诺未经审批的减免或展期。"
)
OUTPUT_RULES = (
    "请基于以下用户信息生成结构化输出。\n输出要求：\n- 使用简体中文\n- 分点输出\n"
    "- 结尾补充“合规提醒”小节\n- 所有建议必须可执行、可落地、可审计"
)
PROFILE_HEADING = "用户信息："
