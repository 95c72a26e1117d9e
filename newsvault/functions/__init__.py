"""Column-to-column helpers; all of them stay inside the JVM."""

from newsvault.functions.hashing import change_hash, composite_key, hash_key, number_text
from newsvault.functions.numeric import (
    day_coverage,
    percent,
    risk_score,
    round2,
    sentiment_band,
    to_double,
    to_int_or_zero,
    two_decimals,
    volatility_band,
)
from newsvault.functions.text import (
    contains_ignoring_case,
    country_codes,
    feed_file_name,
    feed_url,
    first_words,
    from_pg_array,
    keep_if_longer,
    pg_array_size,
    squish,
    theme_match,
    to_pg_array,
    truncate_chars,
)
from newsvault.functions.times import (
    compact_ts,
    date_lit,
    days_behind,
    next_tick,
    parse_compact_ts,
    ts_lit,
    utc_day,
    utc_instant,
    week_start,
)

__all__ = [name for name in dir() if not name.startswith("_")]
