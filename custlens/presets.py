"""Presets: display labels, bin edges and thresholds.

Two bindings share the operators: the bank's own tables (values as the
reference dashboard shows them) and the driver's TPC-H-ish tables.
"""

# Fixed values (bank preset): display names of the four balance columns,
# the four holding flags and the dashboard histogram bins.
BANK_BALANCE_LABELS = {
    "deposit_balance": "存款",
    "financial_balance": "理财",
    "fund_balance": "基金",
    "insurance_balance": "保险",
}
BANK_FLAG_LABELS = {
    "deposit_flag": "存款产品",
    "financial_flag": "理财产品",
    "fund_flag": "基金产品",
    "insurance_flag": "保险产品",
}
BANK_AGE_EDGES = [20, 30, 40, 50, 60]
BANK_AGE_LABELS = ["20岁以下", "20-29岁", "30-39岁", "40-49岁", "50-59岁", "60岁以上"]
BANK_ASSET_EDGES = [100_000, 500_000, 1_000_000, 5_000_000, 10_000_000]
BANK_ASSET_LABELS = ["10万以下", "10-50万", "50-100万", "100-500万", "500-1000万", "1000万以上"]
BANK_LEVEL_EDGES = [500_000, 800_000, 1_000_000]
BANK_LEVEL_LABELS = ["50万以下", "50-80万", "80-100万", "100万+"]
BANK_UNKNOWN = "未知"

# Driver preset: the same shapes with ASCII labels; balances of the
# customer table (c_acctbal) stand in for the age histogram.
DRIVER_BALANCE_LABELS = {
    "deposit_balance": "deposit",
    "financial_balance": "financial",
    "fund_balance": "fund",
    "insurance_balance": "insurance",
}
DRIVER_FLAG_LABELS = {
    "deposit_flag": "deposit products",
    "financial_flag": "financial products",
    "fund_flag": "fund products",
    "insurance_flag": "insurance products",
}
DRIVER_ASSET_EDGES = BANK_ASSET_EDGES
DRIVER_ASSET_LABELS = ["<100k", "100k-500k", "500k-1M", "1M-5M", "5M-10M", ">=10M"]
DRIVER_LEVEL_EDGES = BANK_LEVEL_EDGES
DRIVER_LEVEL_LABELS = ["<500k", "500k-800k", "800k-1M", ">=1M"]
DRIVER_INCOME_EDGES = [0, 2000, 4000, 6000, 8000]
DRIVER_INCOME_LABELS = ["<0", "0-2k", "2k-4k", "4k-6k", "6k-8k", ">=8k"]


# ------------------------------------------------------------ segment rules
# Ordered naming rules over a per-segment profile (first match wins).  The
# bank preset keeps the reference's thresholds and names (fixed values);
# the driver preset applies the same shapes to the driver's columns.

def bank_rules_a(c):
    """Ladder A over profile means; ``c(name)`` returns the column."""
    return [
        ("高复购高资产客户", (c("total_assets") > 1000000) & (c("financial_repurchase_count") > 10)),
        ("中产家庭客户", (c("total_assets") > 500000) & (c("age") > 30) & (c("marriage_status_encoded") == 0)),
        ("年轻高消费客户", (c("age") < 30) & (c("credit_card_monthly_expense") > 5000)),
        ("投资偏好客户", (c("financial_balance") > 300000) & (c("fund_balance") > 200000)),
        ("稳健储蓄客户", c("deposit_balance") > 500000),
        ("活跃数字化客户", (c("app_login_count") > 30) & (c("app_financial_view_time") > 1000)),
        ("基础客户", (c("monthly_income") < 5000) & (c("total_assets") < 100000)),
    ]


BANK_DEFAULT_PREFIX = "客户群"


def bank_rules_b(c):
    """Ladder B over profile means and modes."""
    return [
        ("年轻高消费客户", (c("age") < 35) & (c("credit_card_monthly_expense") > 10000)),
        ("高复购客户", (c("financial_repurchase_count") > 5) & (c("product_count") > 3)),
        ("中产家庭客户", (c("marriage_status_mode") == "已婚") & c("monthly_income").between(15000, 30000)
         & c("total_assets").between(500000, 1500000)),
        ("高资产客户", c("total_assets") > 2000000),
        ("投资活跃客户", (c("investment_monthly_count") > 3) & (c("financial_balance") > 500000)),
        ("稳健储蓄客户", c("deposit_balance") > c("total_assets") * 0.6),
        ("活跃数字化客户", (c("app_login_count") > 20) & (c("app_financial_view_time") > 1000)),
        ("基础客户", (c("total_assets") < 100000) & (c("app_login_count") < 5)),
    ]


BANK_BETTER_NAMES = {
    "客户群2": "普通客户群1",
    "客户群3": "中产稳健客户",
    "客户群4": "普通客户群2",
    "客户群5": "普通客户群3",
    "客户群6": "中产高资产客户",
    "客户群8": "高复购客户",
    "年轻高消费客户": "年轻高消费客户",
    "高资产客户": "高资产客户",
}


# Driver preset: segments of order accounts.  Bounds are the quartiles of the
# customers' latest months at scale 0.01, rounded: amount 140,000 / 257,000 /
# 385,000, balance 1,700 / 4,300 / 7,400.
AMOUNT_Q1, AMOUNT_Q3 = 140_000, 385_000
BALANCE_Q2, BALANCE_Q3 = 4_300, 7_400


def driver_rules_a(c):
    """Segments by how accounts order, over profile means."""
    return [
        ("urgent buyers", c("deposit_balance") >= c("total_assets") * 0.3),
        ("weekly buyers", c("txn_count") >= 3),
        ("full accounts", c("monthly_income") > BALANCE_Q3),
        ("returning buyers", c("txn_count").between(1.5, 3)),
        ("usual orders", c("total_assets").between(AMOUNT_Q1, AMOUNT_Q3)),
    ]


def driver_rules_b(c):
    """Segments by who orders, over profile means and the most frequent industry."""
    return [
        ("machinery orders", (c("occupation_type_mode") == "MACHINERY") & (c("txn_count") < 1.5)),
        ("thin accounts", c("monthly_income") < BALANCE_Q2),
        ("planned orders", c("fund_balance") > c("financial_balance")),
        ("upper quarter", c("total_assets") > AMOUNT_Q3),
    ]


DRIVER_DEFAULT_PREFIX = "tier "
DRIVER_BETTER_NAMES = {
    "machinery orders": "industry",
    "upper quarter": "key accounts",
    "tier 1": "all others",
}
