"""Derived match metrics. All results are unrounded doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def kda(kills: ColumnOrName, deaths: ColumnOrName, assists: ColumnOrName) -> Column:
    """(kills + assists) / deaths, where no or unknown deaths count as one."""
    taken_part = _col(kills).cast("double") + _col(assists).cast("double")
    return taken_part / F.greatest(_col(deaths), F.lit(1)).cast("double")


def total_cs(lane: ColumnOrName, jungle: ColumnOrName) -> Column:
    return F.try_add(_col(lane), _col(jungle))


def per_minute(amount: ColumnOrName, seconds: ColumnOrName) -> Column:
    """Amount per minute of play; the validity filter keeps the divisor positive."""
    return _col(amount).cast("double") / (_col(seconds).cast("double") / F.lit(60.0).cast("double"))


def ratio_guarded(amount: ColumnOrName, base: ColumnOrName) -> Column:
    """amount / base, where a base below one counts as one."""
    return _col(amount).cast("double") / F.greatest(_col(base), F.lit(1)).cast("double")
