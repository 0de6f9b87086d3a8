"""Column expressions used by several operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
LEDGER_MONEY = "decimal(15,2)"


def date_id(day: Column | str) -> Column:
    """Integer key ``YYYYMMDD`` of a date or timestamp (plain integer arithmetic, no formatter)."""
    day = F.col(day) if isinstance(day, str) else day
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def rounded(value: Column, digits: int) -> Column:
    """Round half up in decimal, so that 50.005 goes to 50.01 whatever its binary form; as double."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient as double; null where the divisor is zero or null."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def percent(top: Column, bottom: Column, digits: int = 2) -> Column:
    """``top / bottom`` as a percentage (0-100); null where the divisor is zero."""
    return rounded(ratio(top, bottom) * 100, digits)


# Amounts are worked out and summed as whole cents (bigint): exact like decimals, at a fraction
# of their cost per row, and good for 9e16 units before ANSI raises.


def cents(amount: Column | str) -> Column:
    """A MONEY amount in whole cents."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return (amount * 100).cast("bigint")


def hundredths(value: Column | str) -> Column:
    """A raw double with two decimals (an amount, a share) as a whole number of hundredths."""
    value = F.col(value) if isinstance(value, str) else value
    return F.rint(value * 100).cast("bigint")


def money(total_cents: Column | str) -> Column:
    """Cents as MONEY."""
    total_cents = F.col(total_cents) if isinstance(total_cents, str) else total_cents
    return (total_cents.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def divided(top: Column, bottom: Column | int) -> Column:
    """Quotient of whole numbers, rounded half away from zero. A column as divisor must not be
    negative; where it is 0 the result is null."""
    bottom = F.lit(bottom) if isinstance(bottom, int) else F.nullif(bottom, F.lit(0))
    twice = 2 * top + F.when(top < 0, -bottom).otherwise(bottom)
    return F.call_function("div", twice, 2 * bottom)


def units(total_cents: Column | str) -> Column:
    """Cents back to currency units, as double."""
    total_cents = F.col(total_cents) if isinstance(total_cents, str) else total_cents
    return total_cents.cast("double") / 100


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def double(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("double")


def or_zero(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value, F.lit(0))
