"""Column functions shared by the operators. All are built-in expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: texts that stand for a missing value.
NULL_WORDS = ("NULL", "None")

# A zone or an offset behind a time of day.
ZONE_AFTER_TIME = r":\d\d(\.\d*)?\s*[A-Za-z+-]"

MONEY = "decimal(18,2)"


def later_of(a: Column, b: Column) -> Column:
    """The later value, or `b` where the two cannot be compared (unlike `greatest`)."""
    return F.when(a > b, a).otherwise(b)


def is_blank(column: str, data_type: T.DataType, match: str = "contains") -> Column:
    """True where a value counts as missing: NULL, NaN, '', or text with a word for NULL in it.

    `match="exact"` takes only text that equals such a word. Never NULL itself.
    """
    value = F.col(f"`{column}`")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    if isinstance(data_type, T.StringType):
        if match == "exact":
            words = value.isin(*NULL_WORDS)
        elif match == "contains":
            words = value.contains(NULL_WORDS[0]) | value.contains(NULL_WORDS[1])
        else:
            raise ValueError(f"unknown match {match!r}")
        return value.isNull() | (value == "") | words
    return value.isNull()


def parse_timestamp(value: Column, data_type: T.DataType) -> Column:
    """Source date or datetime as a timestamp without zone (the source types carry none).

    Text that is no date gives NULL. Text that names a zone or an offset gives the time in UTC; other text is
    taken as it stands. Neither depends on the session time zone.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return value
    if isinstance(data_type, (T.TimestampType, T.DateType)):
        return value.cast("timestamp_ntz")
    text = value.cast("string")
    seconds = (F.unix_micros(text.try_cast("timestamp")) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    in_utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.when(text.rlike(ZONE_AFTER_TIME), in_utc).otherwise(text.try_cast("timestamp_ntz"))


def render_timestamp(value: Column) -> Column:
    """Timestamp without zone as text `MM-dd-yyyy HH:mm:ss`.

    Rearranged from its plain text: `date_format` would pass through the session time zone, where a
    local time may not exist.
    """
    return F.regexp_replace(
        value.cast("string"), r"^(.*)-(\d\d)-(\d\d) (\d\d:\d\d:\d\d).*$", "$2-$3-$1 $4"
    )


def money(value: Column) -> Column:
    """Exact two-digit amount: rounding a binary double directly gives engine-dependent ties."""
    return value.cast(MONEY)


# Prices of four digits and rates of six after the point keep a product within 38 digits, so nothing is rounded
# before the one rounding asked for.
PRICE, RATE = "decimal(16,4)", "decimal(9,6)"


def _price(quantity: Column, unit_price: Column) -> Column:
    return quantity.cast("decimal(10,0)") * unit_price.cast(PRICE)


def amount_excluding_tax(quantity: Column, unit_price: Column) -> Column:
    return F.round(_price(quantity, unit_price), 2)


def tax_amount(quantity: Column, unit_price: Column, percent: Column) -> Column:
    rate = (percent.cast("decimal(7,4)") * F.lit(0.01).cast("decimal(2,2)")).cast(RATE)
    return F.round(_price(quantity, unit_price) * rate, 2)
