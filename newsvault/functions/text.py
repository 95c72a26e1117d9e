"""Delimited text, array text and article text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsvault.constants import FEED_FILE_SUFFIX, THEME_CODES

# The white space characters of Unicode text.
_SPACE_CHARS = "".join(chr(c) for c in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_SPACES = r"(?U)\s+"

# A location is type#name#CC#...; locations are separated by ';'. The third part counts
# when it is exactly two letters after trimming. One scan of the text, no lambda.
_COUNTRY = r"(?:^|;)[^#;]*#[^#;]*#(?U:\s*)(\p{L}{2})(?U:\s*)(?=#|;|$)"


def theme_match(themes: Column, codes: list[str] | None = None) -> Column:
    """True when any code occurs in the theme text; NULL text is false."""
    return F.coalesce(themes.rlike("|".join(codes or THEME_CODES)), F.lit(False))


def country_codes(locations: Column) -> Column:
    """Distinct two-letter codes of a location text, sorted; empty for NULL."""
    found = F.regexp_extract_all(locations, F.lit(_COUNTRY), F.lit(1))
    return F.coalesce(F.sort_array(F.array_distinct(found)),
                      F.array().cast("array<string>"))


def to_pg_array(values: Column) -> Column:
    """['CA', 'US'] to '{CA,US}'; an empty array to NULL."""
    return F.when(F.size(values) > 0,
                  F.concat(F.lit("{"), F.array_join(values, ","), F.lit("}")))


def from_pg_array(text: Column) -> Column:
    """'{CA,US}' to ['CA', 'US']; NULL, '' and '{}' to NULL."""
    inner = F.btrim(text, F.lit("{}"))
    return F.when(inner != "", F.split(inner, ","))


def pg_array_size(text: Column) -> Column:
    """Number of elements of '{CA,US}'; 0 for NULL and empty."""
    return F.coalesce(F.size(from_pg_array(text)), F.lit(0))


def contains_ignoring_case(c: Column, needle: str) -> Column:
    return F.contains(F.upper(c), F.lit(needle.upper()))


def squish(c: Column) -> Column:
    """Runs of white space to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, _SPACES, " "))


def first_words(c: Column, n: int) -> Column:
    """The trimmed text when it has at most n words, else its first n words and '...'."""
    trimmed = F.btrim(c, F.lit(_SPACE_CHARS))
    words = F.split(trimmed, _SPACES, n + 1)
    cut = F.concat(F.array_join(F.slice(words, 1, n), " "), F.lit("..."))
    return F.when(F.size(words) > n, cut).otherwise(trimmed)


def truncate_chars(c: Column, n: int) -> Column:
    """The text when it has at most n characters, else its first n and '...'."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def keep_if_longer(c: Column, n: int) -> Column:
    """The text when it has more than n characters, else NULL."""
    return F.when(F.length(c) > n, c)


def feed_file_name(file_ts: Column) -> Column:
    return F.concat(file_ts.cast("string"), F.lit(FEED_FILE_SUFFIX))


def feed_url(file_ts: Column, base_url: str) -> Column:
    return F.concat(F.lit(base_url.rstrip("/") + "/"), feed_file_name(file_ts))
