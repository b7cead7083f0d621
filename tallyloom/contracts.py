"""Names, keys and limits the tables have to keep."""

from __future__ import annotations

from pyspark.sql import types as T

# Layers and dataset kinds.
LAYERS = ("raw", "norm", "feed")
KINDS = ("quotes_daily", "financials", "analyst", "corp_actions", "universe", "calendar", "ref")

# Primary key per dataset kind.
PRIMARY_KEYS = {
    "quotes_daily": ["symbol", "trade_date"],
    "financials": ["symbol", "period_end", "report_type", "statement_type", "update_flag"],
    "analyst": ["symbol", "ann_date", "report_date", "analyst_id"],
    "corp_actions": ["symbol", "ex_date", "action_type"],
    "universe": ["symbol"],
    "calendar": ["exchange", "calendar_date"],
    "ref": ["symbol"],
}

# De-duplication strategy per dataset kind.
DEDUPE_STRATEGY = {
    "quotes_daily": "keep_latest_update",
    "financials": "keep_official_report",
    "analyst": "keep_latest_update",
    "corp_actions": "keep_latest_update",
}

# Quality limits.
MAX_NULL_RATIO = 0.95
MAX_DUPLICATE_RATIO = 0.01
OUTLIER_STD = 5.0
OUTLIER_WARNING_RATIO = 0.05
RECONCILE_TOLERANCE = 50000.0
RECONCILE_MAX_PERCENT = 3.0
CASH_FLOW_MAX_PERCENT = {"12": 30.0}
DIVIDEND_MAX_SPREAD = 0.1
MIN_TTM_COVERAGE = 0.8
MAX_NEGATIVE_QUARTER_RATIO = 0.1

# Dates at which rules change (yyyyMMdd).
BEIJING_OPENING = 20211115
LOSS_SIGN_CHANGE = 20190630

# Status words.
IMPLEMENTED = "实施"
LISTED = "L"
DELISTED = "D"

# Retention in days.
FEED_RETENTION_DAYS = 30
SNAPSHOT_RETENTION_DAYS = 30

# Partition grains.
GRAINS = ("SNAPSHOT", "DAILY", "MONTHLY", "QUARTERLY", "SYMBOL")

# Suffixes of derived fields.
SUFFIXES = {"sc": "_sc", "sq": "_sq", "ttm": "_ttm", "yoy": "_yoy", "qoq": "_qoq"}
INTERVAL_SUFFIX = {"quarterly": "_q", "annual": "_a"}

# Output columns in order.
STATEMENT_FIELDS = ["ts_code", "f_ann_date", "end_date", "file_path", "file_md5",
                    "comp_type", "ann_date", "update_flag"]
INDICATOR_FIELDS = ["ts_code", "ann_date", "end_date", "file_path", "file_md5", "update_flag"]
DAILY_FIELDS = ["ts_code", "trade_date", "open", "high", "low", "close", "pre_close",
                "change", "pct_chg", "volume", "$amount"]
ADJ_FIELDS = ["ts_code", "trade_date", "factor"]
BASIC_FIELDS = ["ts_code", "trade_date", "close", "turnover_rate", "turnover_rate_f",
                "volume_ratio", "pe", "pe_ttm", "pb", "ps", "ps_ttm", "dv_ratio", "dv_ttm",
                "total_shares", "float_shares", "free_shares", "total_market_cap",
                "float_market_cap"]

# Columns a statement class drops before de-duplication.
INCOME_DROPS = ["ebit", "ebitda"]
CASH_FLOW_DROPS = ["free_cashflow"]
INDICATOR_DROPS = ["fcff", "fcfe", "fcff_ps", "fcfe_ps"]

# Type families used by the type check.
TYPE_FAMILIES = {
    "float": (T.FloatType, T.DoubleType),
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "str": (T.StringType,),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
}


def field_names(base: str) -> dict[str, str]:
    """the names of the derived variants of one field."""
    return {kind: base + suffix for kind, suffix in SUFFIXES.items()}
