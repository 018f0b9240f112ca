"""Names for calendar numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import lit

# Calendar names.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
WEEK_ORDER = DAY_NAMES[1:] + DAY_NAMES[:1]
SEASON_ORDER = ["Winter", "Spring", "Summer", "Fall"]


def _pick(names: list[str], one_based: Column) -> Column:
    return F.get(F.array(*[lit(n) for n in names]), one_based - 1)


def day_name(dow: Column, short: bool = False) -> Column:
    """Name of a day numbered 0 = Sunday; independent of the locale."""
    names = [n[:3] for n in DAY_NAMES] if short else DAY_NAMES
    return _pick(names, dow + 1)


def month_name(month: Column, short: bool = False) -> Column:
    names = [n[:3] for n in MONTH_NAMES] if short else MONTH_NAMES
    return _pick(names, month)


def quarter(month: Column) -> Column:
    """Quarter of a month; NULL counts as the fourth, as in the published queries."""
    return F.when(month <= 3, 1).when(month <= 6, 2).when(month <= 9, 3).otherwise(4)


def is_weekend(dow: Column) -> Column:
    return F.coalesce(dow.isin(0, 6), lit(False))


def season(month: Column) -> Column:
    """Season of a month; NULL counts as Fall, as in the published queries."""
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )
