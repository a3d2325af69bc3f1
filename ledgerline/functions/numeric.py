"""Rounding and exact sums.

The reference rounds doubles by binary scaling: ``round(x * 10^n) / 10^n`` with halves away from
zero, keeping the sign of a zero result.  Spark's ``round(x, n)`` rounds the shortest decimal text
of ``x`` instead (it differs on values such as 0.285), goes through ``BigDecimal`` per value and
drops the sign of zero.  ``rint`` (round half to even, in plain double arithmetic) gives the same
result as the reference except on exact halves, which are detected exactly and moved away from
zero; the expression stays inside generated code with no allocation.

A sum is kept in two parts.  Amounts below 10^15 are summed as whole decimal units (cents for
money), exactly and in any order.  Whatever is left (infinite, not a number, or too large for whole
units) is summed as doubles, the way the reference sums everything.  ``total`` puts both together.

Whole units are summed in three limbs of 20 bits (the highest takes the rest and the sign), each a
plain integer sum in generated code: a limb cannot overflow below 2^43 rows a group, and the limbs
are put together once a group.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

_LIMB_BITS = 20
_LIMBS = 3
# Amounts from here on are summed as doubles; so are those of which a long cannot hold the units.
_LARGE = 1e15
_LARGE_UNITS = 9e18
MONEY = 100
# Discounts are averaged to this many units per point.
RATE = 10_000


def _c(v: Column | str) -> Column:
    return F.col(v) if isinstance(v, str) else v


def round_half_away(y: Column) -> Column:
    """Nearest integer (as double), halves away from zero, ``-0.0`` kept."""
    r = F.rint(y)
    return F.when(F.abs(y - r) == F.lit(0.5), y + F.signum(y) * F.lit(0.5)).otherwise(r)


def round_to(v: Column | str, places: int) -> Column:
    """Like the reference, a value that scaling would make infinite comes back as it is."""
    scale, x = F.lit(float(10**places)), _c(v)
    finite = F.abs(x) < F.lit(1e300)
    return F.when(finite, round_half_away(x * scale) / scale).otherwise(x)


def r2(v: Column | str) -> Column:
    return round_to(v, 2)


def r1(v: Column | str) -> Column:
    return round_to(v, 1)


def limbs(v: Column | str, units: int = MONEY) -> dict[str, Column]:
    """The summands of ``v`` by name: limbs of its whole units, lowest first, and the double ``rest``."""
    x = _c(v)
    whole = F.abs(x) < F.lit(min(_LARGE, _LARGE_UNITS / units))
    # Cut to the range first: ANSI casts raise on what ``when`` leaves out only if evaluated.
    unit = F.when(whole, F.rint(x * F.lit(float(units))).cast("bigint"))
    low = F.lit((1 << _LIMB_BITS) - 1)
    out = {f"l{i}": F.shiftright(unit, i * _LIMB_BITS).bitwiseAND(low) for i in range(_LIMBS - 1)}
    out[f"l{_LIMBS - 1}"] = F.shiftright(unit, (_LIMBS - 1) * _LIMB_BITS)
    return out | {"rest": F.when(~whole, x)}


def joined(sums: dict[str, Column]) -> Column:
    """A sum as a struct (``whole`` in units, ``rest``) from the sums of its limbs and of the rest."""
    parts = [sums[f"l{i}"].cast("decimal(20,0)") * F.lit(1 << (i * _LIMB_BITS)).cast("decimal(13,0)") for i in range(_LIMBS)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole + part
    return F.struct(whole.cast("decimal(38,0)").alias("whole"), sums["rest"].alias("rest"))


def exact_sum(v: Column | str, units: int = MONEY) -> Column:
    """Sum of ``v`` as a struct: ``whole`` in units, ``rest`` as a double (NULL if there is none)."""
    return joined({name: F.sum(part) for name, part in limbs(v, units).items()})


def total(s: Column | str, units: int = MONEY) -> Column:
    """The double value of a sum made by ``exact_sum``; NULL if nothing was summed."""
    c = _c(s)
    whole, rest = c["whole"].cast("double") / F.lit(float(units)), c["rest"]
    return F.when(rest.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest)


def total_of_both(a: Column | str, b: Column | str, units: int = MONEY) -> Column:
    """``total`` of two sums added; NULL if one of them is."""
    x, y = _c(a), _c(b)
    whole = (x["whole"] + y["whole"]).cast("double") / F.lit(float(units))
    plain = x["rest"].isNull() & y["rest"].isNull()
    return F.when(plain, whole).otherwise(total(x, units) + total(y, units))


def grand_total(s: Column | str, units: int = MONEY) -> Column:
    """``total`` over all rows of a small grouped result."""
    c, w = _c(s), Window.partitionBy()
    both = F.struct(F.sum(c["whole"]).over(w).alias("whole"), F.sum(c["rest"]).over(w).alias("rest"))
    return total(both, units)


def exact_mean(s: Column | str, n: Column | str, units: int = RATE) -> Column:
    """Mean from a sum and the count of its values."""
    return F.try_divide(total(s, units), _c(n))


def as_double(v: Column | str) -> Column:
    return _c(v).cast("double")


def ratio(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0.0))


def pct(num: Column, den: Column, places: int = 1) -> Column:
    """``100 * num / den`` rounded; NULL for a zero ``den``."""
    return round_to(F.lit(100.0) * as_double(num) / F.nullif(as_double(den), F.lit(0.0)), places)
