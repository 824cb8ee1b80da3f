"""Money arithmetic.

Amounts arrive as doubles.  A sum of money has three parts, all plain partial
aggregates: amounts below ``LARGE`` as whole ten-thousandths of a unit, added
exactly as decimals; finite amounts from there up to ``HUGE`` as decimals with
four places; and what that leaves (fractions below a ten-thousandth, and every
amount that is not finite or larger), added as doubles.  The parts are put
together once per group.  So cents never drift however many rows a group has,
and nothing is lost: tiny amounts add up, and NaN and infinities come through
as in a plain sum.  Results are rounded half up to 2 decimals.
"""

from __future__ import annotations

import decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# the exact part counts whole ten-thousandths of a currency unit; below LARGE
# a double tells them apart
UNIT = decimal.Decimal("0.0001")
LARGE, HUGE = 9e11, 1e23
_UNITS = "decimal(18,0)"
_PLACES = "decimal(28,4)"
_SUM = "decimal(38,0)"
_PARTS = ("units", "large", "rest")


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round2(x: Column | str) -> Column:
    """Round half up to 2 decimals (2.675 -> 2.68 on the double's value)."""
    return F.round(_col(x), 2)


def subtotal(quantity: Column | str = "quantity", price: Column | str = "price") -> Column:
    return _col(quantity) * _col(price)


def _whole(x: Column) -> Column:
    """Whole ten-thousandths of an amount (bigint); 0 if it is not finite or
    too large, NULL for NULL."""
    counted = F.floor(x * F.lit(10000.0) + F.lit(0.5)).cast("bigint")
    return F.when(F.abs(x) < LARGE, counted).when(x.isNotNull(), F.lit(0).cast("bigint"))


def _large(x: Column) -> Column:
    """A large amount as a decimal, else NULL (the slow cast is for these)."""
    return F.when((F.abs(x) >= LARGE) & (F.abs(x) < HUGE), x.cast(_PLACES))


def _rest(x: Column) -> Column:
    """What the exact parts leave of an amount."""
    return (
        F.when(F.abs(x) < LARGE, x - _whole(x).cast("double") / 10000.0)
        .when(F.abs(x) < HUGE, F.lit(0.0))
        .otherwise(x)
    )


def _joined(units: Column, large: Column, rest: Column) -> Column:
    exact = units * F.lit(UNIT) + F.coalesce(large, F.lit(0).cast(_PLACES))
    return round2(exact.cast("double") + rest)


def money_parts(x: Column | str, name: str = "_money") -> list[Column]:
    """The partial sums of an amount column, named ``<name>_<part>``."""
    c = _col(x).cast("double")
    parts = (_whole(c).cast(_UNITS), _large(c), _rest(c))
    return [F.sum(p).alias(f"{name}_{n}") for p, n in zip(parts, _PARTS)]


def add_parts(name: str = "_money", to: str | None = None) -> list[Column]:
    """Sums of already summed parts, under the same names (or those of
    ``to``)."""
    return [F.sum(f"{name}_{n}").alias(f"{to or name}_{n}") for n in _PARTS]


def money_total(name: str = "_money") -> Column:
    """The parts as one amount, rounded to cents (NULL when nothing was
    summed)."""
    return _joined(*[F.col(f"{name}_{n}") for n in _PARTS])


def items_total(items: Column | str = "items") -> Column:
    """Sum of quantity * price over an ``items`` array, per row, by the same
    rule as ``money_total`` (rounded to cents).

    A higher-order ``aggregate``: no explode, no shuffle.  NULL array -> NULL,
    empty array -> 0.0; an item without quantity or price adds nothing.
    """

    def add(acc: Column, item: Column) -> Column:
        amount = F.coalesce((item["quantity"] * item["price"]).cast("double"), F.lit(0.0))
        large = F.coalesce(_large(amount), F.lit(0).cast(_PLACES))
        return F.struct(
            (acc["units"] + _whole(amount).cast(_UNITS)).cast(_SUM).alias("units"),
            (acc["large"] + large).cast("decimal(38,4)").alias("large"),
            (acc["rest"] + _rest(amount)).alias("rest"),
        )

    zero = F.struct(
        F.lit(0).cast(_SUM).alias("units"), F.lit(0).cast("decimal(38,4)").alias("large"), F.lit(0.0).alias("rest")
    )
    return F.aggregate(_col(items), zero, add, lambda acc: _joined(acc["units"], acc["large"], acc["rest"]))
