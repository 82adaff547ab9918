"""Fixed values.

Every constant below is data the results depend on (codes found in the sources,
labels written into the output).  Functions take them as default arguments.
"""

# Event categories of the affiliate order feed.
ORDER_COMPLETE = "Order Complete (App)"
ORDER_CANCEL = "Order Cancel (App)"

# Partner (commission) feed: action and label given to its rows.
PARTNER_ACTION = "dynamic"
PARTNER_LABEL = "coin"

# Affiliate order filters.
PAY_ACTION = "^PAY"
SHOPPING_LABEL = "쇼핑"
INTERNAL_USER_PATTERN = "IU_%"

# Action code -> entry label.
ENTRY_LABELS = {
    "balso1sa1": "바로가기",
    "balso1sr1": "바로가기",
    "balso2sr1": "바로가기",
    "balso2sa2": "바로가기",
    "balso1sr2": "퀴즈쿠팡",
    "balso2sa1": "챌린지인증쿠팡",
}

# Share of the order price that is earned as revenue.
COMMISSION_SHARE = 0.046

# Mall order states that count as a purchase, and those that count as a refund.
MALL_VALID_STATUSES = (
    "DELIVERY_DONE",
    "DELIVERY_PREPARE",
    "DELIVERY_ING",
    "BUY_CONFIRM",
    "PAY_DONE",
    "EXCHANGE_DONE",
    "PRODUCT_PREPARE",
)
MALL_REFUND_STATUSES = ("CANCEL DONE", "RETURN_DONE")
REFUND_WINDOW_DAYS = 90

# Category text.
NO_CATEGORY_TEXT = "None"
NO_SUBCATEGORY = "없음"

# Ledger states.
LEDGER_CREDITS = ("취소로 인한 지급", "지급")
LEDGER_DEBITS = ("차감",)

# Repurchase cycle classes (upper bound in days, label), risk classes and the
# class of first-time buyers.
CYCLE_CLASSES = ((7, "초단기"), (28, "단기"), (60, "중기"))
CYCLE_LONGEST = "장기"
CYCLE_NEW = "신규"
RISK_CLASSES = ((0.2, "High-Risk"), (0.5, "Medium-Risk"), (0.8, "Low-Risk"))
RISK_NONE = "Safe"

# Score weights, in the order of SCORE_NAMES.
SCORE_NAMES = ("r_score", "f_score", "m_score", "term_score", "term_diff_score", "volatility_score")
SCORE_WEIGHTS = (0.22, 0.427, 0.35, 0.0, 0.0, 0.0)

# Grades from best to worst with the percentile a score must exceed, and the
# thresholds of an earlier period.
GRADE_PERCENTILES = ((0.9, "VIP"), (0.7, "GOLD"), (0.4, "SILVER"))
GRADE_THRESHOLDS = ((7.15, "VIP"), (4.504, "GOLD"), (3.15, "SILVER"))
GRADE_LOWEST = "IRON"

# Weight study: starting weights, least weights, importance of each score.
STUDY_START_WEIGHTS = (0.1, 0.35, 0.35, 0.01, 0.05, 0.05)
STUDY_MIN_WEIGHTS = (0.0, 0.20, 0.35, 0.0, 0.0, 0.0)
STUDY_IMPORTANCE = (0.2, 0.3, 0.2, 0.15, 0.1, 0.05)

# Adjusted lifetime value, a pair (repurchasers, single buyers) where both differ: weight of
# the cycle, its least length, share of the money that counts as quality, frequency factor
# (exponent, constant), money per cycle, gain of the logarithm of the frequency in the
# survival and in the whole, whole of single buyers; percentiles that scale and cap.
LTV_CYCLE_WEIGHT = (1.0, 0.3)
LTV_LEAST_CYCLE = 0.1
LTV_SINGLE_QUALITY = 0.7
LTV_FREQUENCY = (1.5, 0.5)
LTV_PER_CYCLE = (1.3, 0.7)
LTV_SURVIVAL_GAIN = 0.2
LTV_GAIN = 0.3
LTV_SINGLE = 0.6
LTV_SCALE_PERCENTILES = (0.5, 0.95)
LTV_CAP_PERCENTILES = (0.97, 0.95)

# Balance bands (exclusive lower bound, inclusive upper bound, label).
CASH_BANDS = (
    (0, 1000, "1 ~  1,000"),
    (1000, 1500, "1,000 ~ 1,500"),
    (1500, 2000, "1,500 ~ 2,000"),
    (2000, 5000, "2,000 ~ 5,000"),
    (5000, 10000, "5,000 ~  10,000"),
    (10000, 15000, "10,000 ~ 15,000"),
    (15000, 20000, "15,000 ~ 20,000"),
    (20000, 30000, "20,000 ~ 30,000"),
    (30000, 50000, "30,000 ~ 50,000"),
    (50000, 100000, "50,000 ~ 100,000"),
    (100000, None, "100,000 ~"),
)

# Recency given to a user without purchases in a channel.
NO_PURCHASE_RECENCY = 99999
