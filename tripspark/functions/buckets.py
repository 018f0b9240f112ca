"""Range buckets and the fixed display order of their labels.

As in the published queries, NULL falls through to the last bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

# Fixed values: (upper edge, label) in order; the last label takes the rest.
DISTANCE = [(1, "0-1 mile"), (3, "1-3 miles"), (5, "3-5 miles"), (10, "5-10 miles")]
DISTANCE_REST = "10+ miles"
FARE = [(10, "0-10"), (20, "10-20"), (30, "20-30"), (50, "30-50")]
FARE_REST = "50+"
NO_TIP = "No Tip"
TIP = [(2, "0-2"), (5, "2-5"), (10, "5-10")]
TIP_COARSE = [(5, "0-5"), (10, "5-10")]
TIP_REST = "10+"

DISTANCE_ORDER = [label for _, label in DISTANCE] + [DISTANCE_REST]
FARE_ORDER = [label for _, label in FARE] + [FARE_REST]
TIP_ORDER = [NO_TIP] + [label for _, label in TIP] + [TIP_REST]


def _steps(value: Column, steps, rest: str, start: Column | None = None) -> Column:
    expr = start
    for edge, label in steps:
        expr = (expr if expr is not None else F).when(value <= edge, label)
    return expr.otherwise(rest)


def distance_category(miles: Column) -> Column:
    return _steps(miles, DISTANCE, DISTANCE_REST)


def fare_category(fare: Column) -> Column:
    return _steps(fare, FARE, FARE_REST)


def tip_category(tip: Column) -> Column:
    return _steps(tip, TIP, TIP_REST, start=F.when(tip == 0, NO_TIP))


def tip_category_coarse(tip: Column) -> Column:
    return _steps(tip, TIP_COARSE, TIP_REST, start=F.when(tip == 0, NO_TIP))


def rank_of(column: str, order: Sequence[str]) -> Column:
    """Sort position of a label; labels outside the list, and NULL, come last."""
    position = F.array_position(F.array(*[lit(x) for x in order]), col(column))
    return F.when(position > 0, position).otherwise(len(order) + 1)


def tip_percentage(tip: Column, fare: Column) -> Column:
    """Tip as a percentage of the fare; zero unless the fare is positive."""
    return F.when(fare > 0, tip / fare * 100).otherwise(0.0)
