"""Table contracts and the fixed values they rest on."""

from __future__ import annotations

from pyspark.sql import types as T

MARKET_A = "TWSE"
MARKET_B = "TPEx"
MARKETS = [MARKET_A, MARKET_B]

# The header a raw day file of each exchange must carry, in order.
RAW_FIELDS_A = [
    "證券代號", "證券名稱", "成交股數", "成交筆數", "成交金額", "開盤價", "最高價", "最低價",
    "收盤價", "漲跌(+/-)", "漲跌價差", "最後揭示買價", "最後揭示買量", "最後揭示賣價",
    "最後揭示賣量", "本益比",
]
RAW_FIELDS_B = [
    "代號", "名稱", "收盤", "漲跌", "開盤", "最高", "最低", "均價", "成交股數", "成交金額(元)",
    "成交筆數", "最後買價", "最後買量(張數)", "最後賣價", "最後賣量(張數)", "發行股數",
    "次日 參考價", "次日 漲停價", "次日 跌停價",
]

# Headers of the official instrument lists.
LIST_ID = "公司代號"
LIST_COMPANY = "公司名稱"
LIST_SHORT_NAME = "公司簡稱"
LIST_INDUSTRY = "產業別"
LIST_LISTING_DATE = {MARKET_A: "上市日期", MARKET_B: "上櫃日期"}

# Labels accepted by the quality rules.
WEIGHTING_METHODS = ["trade_value", "trade_volume", "mixed"]
RATINGS = ["extreme fear", "fear", "neutral", "greed", "extreme greed"]
FETCH_STATUSES = ["success", "no_data", "unknown_failure"]


def strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# Positional layouts of one raw row; everything stays text until parsed.
RAW_ROW_A = strings(
    "stock_id stock_name trade_volume transaction_count trade_value open_price high_price "
    "low_price close_price change_symbol_raw change_amount last_bid_price last_bid_volume "
    "last_ask_price last_ask_volume pe_ratio"
)
RAW_ROW_B = strings(
    "stock_id stock_name close_price change_symbol_raw open_price high_price low_price "
    "average_price trade_volume trade_value transaction_count last_bid_price last_bid_volume "
    "last_ask_price last_ask_volume issued_shares next_day_reference_price next_day_limit_up "
    "next_day_limit_down"
)

RAW_DAY = "fields array<string>, data array<array<string>>, fields_match_expected boolean"
RAW_DAY_B = f"{RAW_DAY}, actual_trade_date string, actual_trade_date_roc string"
RAW_HISTORY = (
    "stock_id string, market string, trade_date string, open double, high double, "
    "low double, close double, volume bigint"
)
RAW_SENTIMENT = (
    "fear_and_greed struct<score: double, rating: string, timestamp: string>, "
    "fear_and_greed_historical struct<data: array<struct<x: double, y: double, rating: string>>>"
)
SEED_CODES = "industry_code string, industry_name string"

# The unified quote table: both exchanges and the instrument history end up here.
QUOTES = (
    "dt string, stock_id string, stock_name string, market string, open_price double, "
    "high_price double, low_price double, close_price double, average_price double, "
    "trade_volume bigint, trade_value bigint, transaction_count bigint, change_amount double, "
    "last_bid_price double, last_bid_volume bigint, last_ask_price double, "
    "last_ask_volume bigint, pe_ratio double, issued_shares bigint"
)
CLEAN_SENTIMENT = "dt string, score double, fear_greed_rating string"
UNIVERSE = (
    "stock_id string, company_name string, stock_name string, industry_code string, "
    "listing_date date, market string"
)


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat DDL string."""
    return [tuple(part.split(" ", 1)) for part in ddl.split(", ")]


def names(ddl: str) -> list[str]:
    return [name for name, _ in fields(ddl)]
