"""Money columns. Amounts are integer minor units (cents)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yuan(amount: Column) -> Column:
    """Minor units to major units with two decimals."""
    return (amount.cast("decimal(38,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(38,2)")


def fee(
    amount: Column,
    rate_type: Column,
    rate_pct: Column,
    fixed_fee: Column,
    floor_amount: Column,
    cap_amount: Column,
) -> Column:
    """Platform fee: rate plus fixed part, raised to the floor, then held by the cap.

    Half cents round towards positive infinity. A floor or cap that is null or
    not positive does not apply; the cap wins over the floor.
    """
    by_rate = F.floor(amount.cast("double") * rate_pct.cast("double") + F.lit(0.5)).cast("long")
    raw = F.when(rate_type == "fixed", fixed_fee).otherwise(by_rate + fixed_fee)
    raised = F.greatest(raw, F.when(floor_amount > 0, floor_amount))
    return F.least(raised, F.when(cap_amount > 0, cap_amount))


def settlement(amount: Column, fee_amount: Column) -> Column:
    return amount - fee_amount


def correction_legs(amount_abs: Column, fee_amount: Column) -> Column:
    """Signed amount, fee and settlement of a refund or chargeback."""
    return F.struct(
        (-amount_abs).alias("amount_minor"),
        (-fee_amount).alias("take_rate_amount"),
        (-(amount_abs - fee_amount)).alias("settlement_amount"),
    )


def ppm(part: Column, whole: Column) -> Column:
    """Integer share in parts per million; null for an empty whole."""
    return F.when(whole > 0, F.floor(part.cast("decimal(38,0)") * 1_000_000 / whole).cast("long"))
