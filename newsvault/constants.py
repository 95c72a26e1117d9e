"""Fixed values.

Everything here has to be exactly this for results to agree with existing tables and
ledgers: theme codes, status words, messages, file naming and calendar origin.
"""

# Theme codes that make a record relevant (substring match).
THEME_CODES = ["ECON_MONEYLAUNDERING", "WB_2076_MONEY_LAUNDERING"]

# Feed calendar and file naming.
FEED_START_TS = 20260101000000
FEED_START_DATE = "2026-01-01"
TICK_MINUTES = 15
FILES_PER_DAY = 96
MAX_FILES_PER_RUN = 17280
FEED_FILE_SUFFIX = ".gkg.csv.zip"
BRONZE_SUFFIX = ".bronze.csv"
RAW_WIDTH = 27

# Names stored in data and control rows.
DATASET = "gkg"
STAGING_RECORD_SOURCE = "bronze_csv"
VAULT_RECORD_SOURCE = "stg_gkg_news"
DAY_PROCESS_NAME = "daily_ai_insights"

# Ledger status words and messages.
RUN_RUNNING, RUN_SUCCESS, RUN_PARTIAL, RUN_FAILED = "running", "success", "partial", "failed"
RUN_FINAL_STATES = ["success", "partial", "failed"]
FILE_QUEUED, FILE_DOWNLOADING = "queued", "downloading"
FILE_DOWNLOADED, FILE_SKIPPED, FILE_FAILED = "downloaded", "skipped", "failed"
MSG_NO_THEMES = "No AML themes found"
MSG_FUTURE = "404 - Future date"
MSG_MISSING = "404 Not Found"

# Enrichment limits and texts.
PAGE_DROP_TAGS = ["script", "style", "nav", "footer", "header"]
PAGE_MIN_CHARS = 100
PROMPT_MAX_CHARS = 4000
ABSTRACT_MAX_WORDS = 40
NOT_RELEVANT = "NOT RELEVANT"
FALLBACK_ABSTRACT = "Summary unavailable. Tone: "

# Strings a pandas CSV read with default settings turns into nulls.
PANDAS_NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Separator between the parts of a composite hash.
HASH_SEPARATOR = "|"

# Fixed value: cut-off used while the weekly fact is still empty.
EMPTY_TARGET_WEEK = "1900-01-01"
