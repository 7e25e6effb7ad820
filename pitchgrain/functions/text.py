"""Text rendering of numbers, clocks, percentages and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = 134217729.0  # 2**27 + 1, splits a double into two exact halves


def fixed(value: Column, places: int) -> Column:
    """A double with a fixed number of decimals, rounded by its exact binary value.

    Ties go to the even digit. Neither ``round`` nor ``format_string`` does this: they round the
    shortest decimal form (3.45 prints as 3.5 although the double is above 3.45 by 1e-16).
    The sign of ``2 * scale * value - (2n + 1)`` is found without rounding error by splitting
    the value in two halves whose products are exact.
    """
    scale = 10**places
    v = F.abs(value.cast("double"))
    n = F.floor(v * scale)
    product = v * (2.0 * scale)
    big = v * _SPLITTER
    high = big - (big - v)
    low = v - high
    error = (high * (2.0 * scale) - product) + low * (2.0 * scale)
    side = (product - (n * 2 + 1).cast("double")) + error
    up = (side > 0) | ((side == 0) & (n % 2 == 1))
    units = n + F.when(up, 1).otherwise(0)
    sign = F.when((value < 0), "-").otherwise("")
    whole = F.floor(units / scale) if places else units
    text = F.concat(sign, whole.cast("bigint").cast("string"))
    if not places:
        return text
    rest = F.lpad((units % scale).cast("string"), places, "0")
    return F.concat(text, F.lit("."), rest)


def percent(part: Column, whole: Column) -> Column:
    """'81.2%', or 'n/a' when there is nothing to divide by."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100
    return F.coalesce(F.concat(fixed(share, 1), F.lit("%")), F.lit("n/a"))


def clock(minute: Column, second: Column) -> Column:
    """12'05" ; '?' without a minute."""
    seconds = F.lpad(F.coalesce(second, F.lit(0)).cast("string"), 2, "0")
    return F.coalesce(
        F.concat(minute.cast("string"), F.lit("'"), seconds, F.lit('"')), F.lit("?")
    )


def short_name(nickname: Column, name: Column) -> Column:
    return F.coalesce(F.nullif(nickname, F.lit("")), name)


def jersey_label(jersey: Column, nickname: Column, name: Column) -> Column:
    """'#9 Name'; without a jersey number just the name, without a name '?'."""
    who = F.coalesce(F.nullif(short_name(nickname, name), F.lit("")), F.lit("?"))
    return F.when(F.coalesce(jersey, F.lit(0)) != 0, F.concat(F.lit("#"), jersey.cast("string"), F.lit(" "), who)).otherwise(who)


def shown(value: Column, missing: str = "n/a") -> Column:
    return F.coalesce(value.cast("string"), F.lit(missing))
