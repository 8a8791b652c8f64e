"""Declared schemas and fixed values.

FIXED VALUES -- these must equal the behaviour being reproduced:
  * stock-loan change columns: AVAILABLE, FEERATE, REBATERATE
  * stock-loan symbol column: SYM
  * snapshot placeholders turned into null: "NA" and ""
  * snapshot folder name pattern: YYYY-MM-DD_HH-MM-SS
  * BOF line: #BOF|YYYY.MM.DD|HH:MM:SS
  * stock-loan column rename map: IB_CONTRACT_ID -> CON, REBATE_RATE ->
    REBATERATE, FEE_RATE -> FEERATE, AVAILABLE_SHARES -> AVAILABLE
  * abbreviated header CUR -> CURRENCY (our reader)
  * earnings quality bounds: Market Cap in [1e5, 5e12], EPS in [-10, 50]
  * ticker index cap per source and run (compat mode only): 5000
  * default top-n: 50; default z-score window: 20; default min pct change: 50
  * daily calendar CSV header: Company Name, Symbol, Market Cap, EPS
    Forecast, Time, Fiscal Quarter Ending, No. of ESTs, Last Year's EPS,
    Scraped At; API record fields in the same order: name, symbol,
    marketCap, epsForecast, time, fiscalQuarterEnding, noOfEsts, lastYearEPS
  * meeting CSV columns: Year, Month, Dates, Summary of Economic
    Projections, Unscheduled, Cancelled, Notation Vote, Transcript HTML
    Link, Transcript Release Date
  * CSV null tokens used by compat mode (pandas read_csv defaults):
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null"
"""

from __future__ import annotations

from pyspark.sql import types as T

CHANGE_COLS = ["AVAILABLE", "FEERATE", "REBATERATE"]
SYMBOL_COL = "SYM"
SNAPSHOT_PLACEHOLDERS = ["NA", ""]
SNAPSHOT_FOLDER_FORMAT = "yyyy-MM-dd_HH-mm-ss"
BOF_FORMAT = "yyyy.M.d H:m:s"

STOCK_LOAN_RENAMES = {
    "IB_CONTRACT_ID": "CON",
    "REBATE_RATE": "REBATERATE",
    "FEE_RATE": "FEERATE",
    "AVAILABLE_SHARES": "AVAILABLE",
    "CUR": "CURRENCY",
}

MARKET_CAP_MIN = 1e5
MARKET_CAP_MAX = 5e12
EPS_FORECAST_MIN = -10.0
EPS_FORECAST_MAX = 50.0

DEFAULT_TOP_N = 50
DEFAULT_ZSCORE_WINDOW = 20
DEFAULT_MIN_PCT_CHANGE = 50.0

PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Declared column types per source (type coercion is per value, try_cast).
# Text columns are declared StringType, so nulls stay proper nulls.
STOCK_LOAN_TYPES = {
    "SYM": T.StringType(),
    "CURRENCY": T.StringType(),
    "NAME": T.StringType(),
    "CON": T.StringType(),
    "ISIN": T.StringType(),
    "REBATERATE": T.DoubleType(),
    "FEERATE": T.DoubleType(),
    "AVAILABLE": T.DoubleType(),
    "COUNTRY": T.StringType(),
}

EARNINGS_TYPES = {
    "symbol": T.StringType(),
    "name": T.StringType(),
    "reportDate": T.StringType(),
    "fiscalDateEnding": T.StringType(),
    "estimate": T.DoubleType(),
    "currency": T.StringType(),
}

# API record field -> CSV header, in file order.
NASDAQ_RECORD_FIELDS = [
    ("name", "Company Name"),
    ("symbol", "Symbol"),
    ("marketCap", "Market Cap"),
    ("epsForecast", "EPS Forecast"),
    ("time", "Time"),
    ("fiscalQuarterEnding", "Fiscal Quarter Ending"),
    ("noOfEsts", "No. of ESTs"),
    ("lastYearEPS", "Last Year's EPS"),
]

FOMC_SCHEMA = T.StructType([
    T.StructField("Year", T.IntegerType()),
    T.StructField("Month", T.StringType()),
    T.StructField("Dates", T.StringType()),
    T.StructField("Summary of Economic Projections", T.BooleanType()),
    T.StructField("Unscheduled", T.BooleanType()),
    T.StructField("Cancelled", T.BooleanType()),
    T.StructField("Notation Vote", T.BooleanType()),
    T.StructField("Transcript HTML Link", T.StringType()),
    T.StructField("Transcript Release Date", T.StringType()),
])

ATS_TYPES = {
    "issueSymbolIdentifier": T.StringType(),
    "totalWeeklyShareQuantity": T.DoubleType(),
    "totalWeeklyTradeCount": T.DoubleType(),
    "lastUpdateDate": T.StringType(),
    "initialPublishedDate": T.StringType(),
}

SOURCE_NAMES = [
    "stock_loan", "earnings", "nasdaq_earnings", "fomc", "ats_otc",
    "edgar_filings",
]

# order of rows with equal times, as far as a table has these columns
TIE_BREAKERS = ("SEQ", "COUNTRY", "CON")
