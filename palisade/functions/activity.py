"""Column expressions for user-activity logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.functions.numeric import col

# Formats, words and address suffix the result columns depend on.
TIMESTAMP_PATTERNS = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm")
SUSPICIOUS_URL_WORDS = ("login", "auth", "verify", "secure")
INTERNAL_ADDRESS = "@dtaa.com"
DOMAIN_PATTERN = r"https?://([^/]+)"


def flag(condition: Column) -> Column:
    """0/1 byte; an unknown condition stays null."""
    return condition.cast("tinyint")


def normalised(name: str | Column) -> Column:
    return F.lower(col(name))


def equals_flag(name: str | Column, value: str) -> Column:
    """1 when the text equals ``value`` in any letter case."""
    return flag(F.lower(col(name)) == value.lower())


def parse_timestamp(text: str | Column, patterns: Sequence[str] = TIMESTAMP_PATTERNS) -> Column:
    """First pattern that fits wins; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(col(text), F.lit(p)) for p in patterns])


def after_hours(
    hour: str | Column, start: int = 8, end: int = 18, end_counts: bool = False
) -> Column:
    """1 before ``start`` or after ``end``; e-mail also counts ``end`` itself."""
    hour = col(hour)
    late = hour >= end if end_counts else hour > end
    return flag((hour < start) | late)


def iso_weekday(when: str | Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(col(when)) + 1


def weekend(weekday: str | Column, weekend_from: int = 5) -> Column:
    """1 on weekday ``weekend_from`` and later; by default Friday already counts."""
    return flag(col(weekday) >= weekend_from)


def with_calendar(df: DataFrame, column: str = "timestamp", patterns: Sequence[str] | None = None) -> DataFrame:
    """Replace a datetime (or multi-format text) column by date, hour and weekday."""
    when = parse_timestamp(column, patterns) if patterns else col(column)
    return df.withColumns(
        {"date": F.to_date(when), "hour": F.hour(when), "weekday": iso_weekday(when)}
    ).drop(column)


def boolean_flag(name: str | Column) -> Column:
    return flag(F.coalesce(col(name), F.lit(False)))


def separated_count(name: str | Column, separator: str = ";") -> Column:
    """Number of separated parts, 0 for null."""
    text = col(name)
    return F.when(
        text.isNotNull(), F.regexp_count(text, F.lit(_literal(separator))) + 1
    ).otherwise(0).cast("int")


def keyword_count(name: str | Column) -> Column:
    """Number of spaces plus one; null for null."""
    return F.regexp_count(col(name), F.lit(" ")) + 1


def recipients(fields: Sequence[str | Column], drop_empty: bool = True) -> Column:
    """Addresses of several nullable ``;`` separated fields as one array.

    ``drop_empty=False`` keeps the empty entries that null fields leave behind.
    """
    joined = F.concat_ws(";", *[F.coalesce(col(f), F.lit("")) for f in fields])
    parts = F.split(joined, ";")
    return F.filter(parts, lambda a: a != "") if drop_empty else parts


def external_count(addresses: str | Column, internal: str = INTERNAL_ADDRESS) -> Column:
    return F.size(F.filter(col(addresses), lambda a: ~a.contains(internal)))


def url_domain(url: str | Column) -> Column:
    return F.nullif(F.regexp_extract(col(url), DOMAIN_PATTERN, 1), F.lit(""))


def suspicious_url(url: str | Column, words: Sequence[str] = SUSPICIOUS_URL_WORDS) -> Column:
    return flag(F.lower(col(url)).rlike("|".join(words)))


def corrected(name: str, key: str, fixes: Mapping[str, str]) -> Column:
    """Replace the value of ``name`` on rows whose ``key`` is listed."""
    result = col(name)
    for value, replacement in fixes.items():
        result = F.when(col(key) == value, F.lit(replacement)).otherwise(result)
    return result


def _literal(text: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|" else c for c in text)
