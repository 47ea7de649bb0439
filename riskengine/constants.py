"""These must equal the published system's for results to agree."""

# Location names counted as domestic; all others are foreign.
DOMESTIC_LOCATIONS = ("Hanoi", "HCM City", "Da Nang", "Can Tho", "Hai Phong")

# Wire formats.
ACCOUNT_ID_PATTERN = "^(ACC_[0-9]{5}|FRD_[A-Z0-9_]+)$"
CARD_ID_PATTERN = "^(CARD|FRD_CARD)_[0-9]{5}$"
CHANNELS = ("ATM", "POS", "ONLINE")
STATUSES = ("Approved", "Declined")
RULE_FIELDS = ("amount", "account_id")
RULE_OPERATORS = ("GT", "GTE", "LT", "LTE", "EQ", "NEQ")
RULE_ACTIONS = ("BLOCK", "ALERT")

# Decisions, in ascending severity.
APPROVED, ALERT, BLOCK = "APPROVED", "ALERT", "BLOCK"

# Topics.
TRANSACTIONS_TOPIC = "transactions"
RULES_TOPIC = "rules-updates"

# Pattern defaults.
LOCATION_JUMP_WINDOW_S = 3600
HIGH_FREQUENCY_WINDOW_S = 3600
HIGH_FREQUENCY_AMOUNT = 100_000_000
DECLINED_BURST_WINDOW_S = 120
MICROPAYMENT_WINDOW_S = 120
MICROPAYMENT_MIN, MICROPAYMENT_MAX = 2_000, 10_000
PATTERN_COUNT = 3

# Scoring.
SCORE_THRESHOLD = 0.9184
PRIORITY_ACCOUNTS = ("FRD_RULE_UPDATE_SC6",)
RULE_TEST_ACCOUNTS_LIKE = "FRD_RULE_UPDATE_ACC_%"
FEATURES = (
    "amount", "hour_of_day", "is_home", "is_domestic",
    "avg_amount_24h", "log_amount_ratio_24h",
    "tx_count_1h", "tx_count_3h",
    "time_since_last_tx_sec",
)
MODEL_TARGETS = {"precision": 0.80, "recall": 0.75, "f1": 0.78, "auc_roc": 0.85, "auc_pr": 0.70}
