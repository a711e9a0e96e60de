"""Value normalisation: timestamps, booleans, addresses, placeholders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRUE_WORDS = ("true", "1", "yes", "y", "t")
FLAG_WORDS = ("true", "1", "yes")
BLANK_ADDRESSES = ("", "unknown", "null", "none", "nan")
PLACEHOLDERS = ("", "\u2014", "-", "N/A", "n/a", "None", "null")
NAIVE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
)
DISPLAY_ZONE = "Asia/Ho_Chi_Minh"
HTTP_DATE = "dd/MMM/yyyy:HH:mm:ss Z"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
OFFSET_SUFFIX = r"(?:[Zz]|[+-]\d{2}:?\d{2})$"


def tolerant_timestamp(text: Column) -> Column:
    """Any ISO-like text, with or without zone, as a UTC timestamp; else null."""
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit(HTTP_DATE)))


def naive_timestamp(text: Column) -> Column:
    """The four plain layouts; a trailing Z is ignored and 26 characters are read."""
    trimmed = F.substring(F.regexp_replace(F.trim(text), "[Zz]+$", ""), 1, 26)
    whole = F.when(trimmed.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"), trimmed)
    return F.try_to_timestamp(whole)


def display_timestamp(text: Column, zone: str = DISPLAY_ZONE) -> Column:
    """Zoned text moves to the display zone's wall clock; naive text stays as it is."""
    zoned = F.substring(F.trim(text), 11, 100).rlike(OFFSET_SUFFIX)
    return F.when(zoned, F.from_utc_timestamp(F.try_to_timestamp(F.trim(text)), zone)).otherwise(
        naive_timestamp(text))


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, ISO_MILLIS)


def truthy(value: Column) -> Column:
    """Words, booleans and non-zero numbers count as true; null is false."""
    text = F.lower(F.trim(value.cast("string")))
    number = text.try_cast("double")
    return F.coalesce(
        text.isin(*TRUE_WORDS) | F.coalesce(number != 0, F.lit(False)), F.lit(False))


def truthy_text(value: Column) -> Column:
    """Text columns: only the listed words are true."""
    return F.coalesce(F.lower(F.trim(value)).isin(*TRUE_WORDS), F.lit(False))


def any_flag(*values: Column) -> Column:
    """True when any of several flag columns reads true, 1 or yes."""
    result = F.lit(False)
    for value in values:
        result = result | F.coalesce(
            F.lower(F.trim(value.cast("string"))).isin(*FLAG_WORDS), F.lit(False))
    return result


def alert_flag(value: Column) -> Column:
    """Alert booleans: numbers by non-zero, text by the three listed words."""
    text = F.lower(value.cast("string"))
    number = text.try_cast("double")
    return F.when(number.isNotNull(), number != 0).otherwise(
        F.coalesce(text.isin(*FLAG_WORDS), F.lit(False)))


def clean_address(ip: Column) -> Column:
    bad = F.lower(ip).isin(*BLANK_ADDRESSES) | ~ip.rlike("[.:]")
    return F.when(~bad, ip)


def clean_text(value: Column) -> Column:
    text = F.coalesce(F.trim(value.cast("string")), F.lit(""))
    return F.when(text.isin(*PLACEHOLDERS), "").otherwise(text)


def number_or_null(value: Column) -> Column:
    return F.nullif(clean_text(value), F.lit("")).try_cast("double")


def nest_geo(country: Column, city: Column) -> Column:
    return F.struct(country.alias("country_name"), city.alias("city_name"))


def ip_hash(ip: Column, blank_is_zero: bool = False) -> Column:
    """First 32 bits of md5 as an unsigned number; a missing address hashes to 0."""
    hashed = F.conv(F.substring(F.md5(ip), 1, 8), 16, 10).cast("bigint")
    if blank_is_zero:
        hashed = F.when(ip != "", hashed)
    return F.coalesce(hashed, F.lit(0).cast("bigint"))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))
