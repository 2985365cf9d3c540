"""Column expressions shared by the plans (section 2.9). All stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(value: Column) -> Column:
    """The value is NULL or only spaces; never NULL itself."""
    return value.isNull() | (F.trim(value.cast("string")) == "")


def flag(value: Column) -> Column:
    """The strings that mean yes, ignoring case and outer spaces."""
    # Accepted spellings.
    return F.lower(F.trim(value)).isin("1", "true", "yes", "y")


def list_items(raw: Column) -> Column:
    """The non-blank, trimmed items of a comma-separated string, as an array."""
    return F.filter(F.transform(F.split(raw, ","), lambda item: F.trim(item)), lambda item: item != "")


def pseudonym(key: Column) -> Column:
    """A stable name for a key that does not show it (24 hex digits of SHA-256)."""
    return F.substring(F.sha2(key, 256), 1, 24)


def page_name(page: Column) -> Column:
    """I16: zero-padded page label; longer numbers are kept whole."""
    return F.format_string("%06d", page)


def iso_timestamp(text: Column) -> Column:
    """ISO text with Z, an offset or neither (then UTC); bad text gives NULL."""
    return F.try_to_timestamp(text)


def iso_date(text: Column) -> Column:
    """I4: ISO date text; bad or empty text gives NULL."""
    return F.try_to_date(text)


def date_key(day: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic instead of formatting and parsing text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def days_before(day: Column, span: Column) -> Column:
    """First day of an inclusive span of ``span`` days that ends on ``day``."""
    return F.date_sub(day, F.greatest(span - 1, F.lit(0)).cast("int"))


def age_hours(later: Column, earlier: Column) -> Column:
    """Hours between two timestamps, with fractions."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)


def short_text(text: Column, length: int) -> Column:
    """Error text as kept in audit records."""
    return F.left(text, F.lit(length))


def asset_count(assets: Column) -> Column:
    """Array size, -1 for a missing array."""
    return F.coalesce(F.size(assets), F.lit(-1))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """Part / whole where whole is positive, else 0.0; a NULL part stays NULL."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def steady_sum(value: Column) -> Column:
    """Sum of doubles that hardly depends on the order of addition, at full precision.

    Each value is parted into a decimal of eight places, added exactly, and what is left
    of it, added as double: for values of a few decimals that rest is zero or some units
    in the last place, so replays agree to the bit. What a decimal cannot hold (NaN,
    infinities, 1e20 and more) is rest as a whole.
    """
    part = value.try_cast("decimal(28,8)")
    rest = F.sum(F.coalesce(value - part.cast("double"), value))
    total = F.sum(part).cast("double")
    return F.when(total.isNull(), rest).otherwise(total + rest)


def steady_mean(value: Column) -> Column:
    """Mean of doubles by ``steady_sum``; NULLs are ignored, no values give NULL."""
    return steady_sum(value) / F.count(value)
