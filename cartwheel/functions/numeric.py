"""Guarded ratios and step functions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` to two digits, 0 where there is no whole."""
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def at_least(value: Column, steps: Sequence[tuple[Any, Any]], otherwise: Any) -> Column:
    """The result of the first step whose bound ``value`` reaches."""
    return _steps([(value >= bound, result) for bound, result in steps], otherwise)


def at_most(value: Column, steps: Sequence[tuple[Any, Any]], otherwise: Any) -> Column:
    """The result of the first step whose bound ``value`` does not exceed."""
    return _steps([(value <= bound, result) for bound, result in steps], otherwise)


def first_match(cases: Sequence[tuple[Column, Any]], otherwise: Any) -> Column:
    return _steps(cases, otherwise)


def _steps(cases: Sequence[tuple[Column, Any]], otherwise: Any) -> Column:
    (condition, result), *rest = cases
    ladder = F.when(condition, result)
    for condition, result in rest:
        ladder = ladder.when(condition, result)
    return ladder.otherwise(otherwise)


def day(as_of: dt.date | str | None) -> Column:
    """The reference date of a report; today where none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
