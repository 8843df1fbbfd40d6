"""Money, percentages, value bands, change hashes.

Facts carry money as whole cents in a BIGINT: sums are exact, do not depend on the order of
the rows, and stay in primitive arithmetic, where a DECIMAL sum past 18 digits would build an
object per row. Results turn into amounts once, on the finished groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lower bounds of lifetime sales per loyalty tier, highest first.
LOYALTY_TIERS = [(5000, "PLATINUM"), (2500, "GOLD"), (1000, "SILVER")]
LOWEST_TIER = "BRONZE"


def amount(cents: Column) -> Column:
    """Cents as a currency amount."""
    return cents.cast("double") / 100


def in_cents(amount: Column) -> Column:
    """An amount of two places in whole cents."""
    return (amount * 100).cast("bigint")


def exact_amount(cents: Column) -> Column:
    """Cents as an amount of two places."""
    return (cents.cast("decimal(20,0)") * Decimal("0.01")).cast("decimal(18,2)")


def as_double(amount: Column) -> Column:
    return amount.cast("double")


def rounded(value: Column, places: int = 2) -> Column:
    """Round through a decimal, so that ties do not depend on the binary form of a double."""
    return F.round(value.cast("decimal(30,8)"), places).cast("double")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole; null when the whole is 0 or null."""
    return rounded(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), places)


def percent_or_zero(part: Column, whole: Column, places: int = 2) -> Column:
    """Like :func:`percent`, but a whole of 0 counts as 1."""
    return percent(part, F.when(whole == 0, F.lit(1)).otherwise(whole), places)


def percent_change(current: Column, previous: Column, places: int = 1) -> Column:
    """Change against the size of the previous value; null when that is 0 or missing."""
    return percent(current - previous, F.abs(previous), places)


def mean(total: Column, count: Column, places: int = 2) -> Column:
    """An average from its exact sum and count, rounded."""
    return rounded(F.try_divide(total.cast("double"), count.cast("double")), places)


def line_revenue(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    """Signed revenue of one line: a return has a negative quantity."""
    gross = quantity.cast("decimal(12,0)") * unit_price.cast("decimal(12,2)")
    kept = F.lit(100).cast("decimal(3,0)") - discount_percent.cast("decimal(5,2)")
    return F.round(gross * kept / 100, 2).cast("decimal(18,2)")


def with_tax(price: Column, rate: str = "0.18") -> Column:
    """Price with the tax on top, rounded half up to two places."""
    return F.round(price.cast("decimal(15,2)") * F.lit(f"1{rate[1:]}").cast("decimal(3,2)"), 2)


def net_price(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """Line price after the discount; a missing discount is no discount."""
    rate = F.coalesce(discount_pct, F.lit(0).cast("decimal(5,2)"))
    return F.round(quantity * unit_price * (100 - rate) / 100, 2).cast("decimal(10,2)")


def discount_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    rate = F.coalesce(discount_pct, F.lit(0).cast("decimal(5,2)"))
    return F.round(quantity * unit_price * rate / 100, 2).cast("decimal(10,2)")


def loyalty_tier(lifetime_sales: Column) -> Column:
    tier = None
    for bound, name in LOYALTY_TIERS:
        met = lifetime_sales >= bound
        tier = F.when(met, name) if tier is None else tier.when(met, name)
    return tier.otherwise(LOWEST_TIER)


def value_band(revenue: Column, high: float = 10000, medium: float = 5000) -> Column:
    return F.when(revenue > high, "High").when(revenue >= medium, "Medium").otherwise("Low")


def _text_form(name: str, kind: T.DataType) -> Column:
    """One text per value whatever its numeric type, with a mark for null."""
    value = F.col(name)
    if isinstance(kind, (T.FractionalType,)):
        value = value.cast("decimal(38,6)")
    return F.coalesce(value.cast("string"), F.lit("\u0000"))


def record_hash(schema: T.StructType, attributes: Sequence[str]) -> Column:
    """MD5 over the tracked attributes, used to tell changed rows from unchanged ones."""
    return F.md5(F.concat_ws("|", *[_text_form(name, schema[name].dataType) for name in attributes]))


def hashed_email(email: Column) -> Column:
    return F.sha2(F.lower(F.trim(email)), 256)


def hashed_phone(phone: Column) -> Column:
    return F.sha2(F.trim(phone), 256)
