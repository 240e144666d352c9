"""Prices, fees, rates. Sums stay exact decimals; a rounded quotient is an exact decimal, others are doubles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
UNIT = "decimal(18,6)"


def half_up(x: Column, places: int) -> Column:
    """Round half up on the binary value, the same in every engine."""
    scale = float(10**places)
    return F.floor(x.cast("double") * scale + 0.5) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """One double division; null when the divisor is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded_ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """ROUND of the exact quotient, ties away from zero, as a decimal; null when the divisor is zero or null.

    Both sides count up to six places. Doubling makes the tie a whole number, so integer division decides it.
    """
    top, bottom = (c.cast("decimal(38,6)") for c in (numerator, denominator))
    twice = F.abs(top) * F.lit(Decimal(2 * 10**places)) + F.abs(bottom)
    units = F.call_function("div", twice, F.when(bottom != 0, F.abs(bottom) * F.lit(Decimal(2))))
    signed = F.when((top < 0) != (bottom < 0), -units).otherwise(units)
    return (signed.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(28,{places})")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return rounded_ratio(part * 100, whole, places)


def guarded_ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """Rounded quotient, zero when there is nothing to divide by."""
    return F.when(denominator > 0, rounded_ratio(numerator, denominator, places)).otherwise(F.lit(Decimal(0)).cast(f"decimal(28,{places})"))


def sale_price(list_price: Column, discount: Column) -> Column:
    return (list_price * (F.lit(1) - discount)).cast(MONEY)


def line_total(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast(MONEY)


def unit_price(total: Column, quantity: Column) -> Column:
    """Price per piece, exact to six places so that sums do not depend on row order."""
    return F.try_divide(total, quantity).cast(UNIT)


def volume(length: Column, height: Column, width: Column) -> Column:
    return (length * height * width).cast(MONEY)


def density(weight: Column, cubic: Column) -> Column:
    """Weight per volume, zero without a volume."""
    return F.when(cubic > 0, F.try_divide(weight, cubic)).otherwise(F.lit(0)).cast("decimal(18,4)")


# Fixed values of the fee: base, per kilogram, per 10,000 cm3, per kilometre.
BASE_FEE, PER_KG, PER_10_DM3, PER_KM = 15000, 4000, 2500, 300


def shipping_fee(weight_g: Column, volume_cm3: Column, distance_km: Column) -> Column:
    """Linear fee with a floor at the base, in exact decimals: 4 per gram, 0.25 per cm3, 300 per km."""
    weight = F.coalesce(weight_g, F.lit(0)).cast(MONEY) * F.lit(PER_KG // 1000)
    space = F.coalesce(volume_cm3, F.lit(0)).cast(MONEY) * F.lit(PER_10_DM3) / F.lit(10000)
    way = distance_km.cast(MONEY) * F.lit(PER_KM)
    fee = F.lit(BASE_FEE) + weight + space + way
    return F.greatest(fee, F.lit(BASE_FEE)).cast(MONEY)
