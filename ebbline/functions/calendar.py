"""The forecast calendar: which rows are alive on which forecast day.

Maturities are dates, the valuation instant ``as_of`` has a time of day.  Forecast
day ``d`` looks at the instant ``as_of + (d - 1) days``.

* A position drops out once ``maturity <= instant`` and is read only if
  ``maturity >= date(as_of)``.
* A cash flow drops out once ``maturity < instant`` and is read only if
  ``maturity >= as_of``.

Both therefore live ``maturity - date(as_of)`` days, except that at exactly
midnight a cash flow lives one day longer.  No maturity means alive throughout.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITION = "position"
CASH_FLOW = "cash_flow"


def instant(at: dt.datetime) -> Column:
    """A literal timestamp without time zone.

    Goes through text: a Python datetime would be read in the client's time zone and
    shown in the session's.
    """
    return F.lit(at.isoformat(" ")).cast("timestamp_ntz")


def _at_midnight(as_of: dt.datetime) -> bool:
    return as_of.time() == dt.time(0)


def survives(maturity: Column, as_of: dt.datetime, kind: str) -> Column:
    """Row is read at all.  A plain date comparison, so it reaches the scan."""
    first = as_of.date()
    if kind == CASH_FLOW and not _at_midnight(as_of):
        first += dt.timedelta(days=1)
    return maturity.isNull() | (maturity >= F.lit(first))


def live_days(maturity: Column, as_of: dt.datetime, n_days: int, kind: str) -> Column:
    """Number of forecast days (0..n_days) on which a surviving row counts."""
    extra = 1 if kind == CASH_FLOW and _at_midnight(as_of) else 0
    left = F.datediff(maturity, F.lit(as_of.date())) + F.lit(extra)
    return (
        F.when(maturity.isNull(), F.lit(n_days))
        .otherwise(F.least(F.lit(n_days), left))
        .cast("int")
    )


def maturity_bucket(maturity: Column, as_of: dt.datetime) -> Column:
    """Label of the maturity band counted in days from ``as_of``."""
    days = F.datediff(maturity, F.lit(as_of.date()))
    return (
        F.when(maturity.isNull(), "open")
        .when(days < 0, "matured")
        .when(days < 90, "0-89")
        .when(days < 180, "90-179")
        .when(days < 365, "180-364")
        .otherwise("365+")
    )
