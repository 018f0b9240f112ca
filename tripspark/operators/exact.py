"""Sums and averages of doubles that are exact and do not depend on the order of tasks.

A double stands for the decimal that is printed for it: 0.1 for a tenth, 12.34 for an amount in
cents. These decimals are split into whole digits in base 10**7, which are
added up as longs, so nothing is lost at any size, in any order; the total is rounded once, to the
nearest double. Four digits hold any double from its own lowest place on. That place, the range,
is a further key of the first aggregation. Amounts in whole millionths below a billion all have
the same range and are split by arithmetic alone, so that aggregation has as many rows as there
are groups; others are split by their printed form. The second aggregation brings the few ranges
of a group together. Both combine rows before they shuffle.

A group may hold nine hundred billion values; beyond that the sums of longs raise an error. NaN
and the infinities give what floating-point addition gives. NULL is not added; a sum of none is
NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

STEPS = 1_000_000  # parts of a whole that are told apart in percentages
LARGEST = 1e18

PLACES = 7  # decimal places of a digit
BASE = "10000000L"
DIGITS = 4
COMMON = 0  # the range whose lowest digit counts millionths
# Ranges of the values that are no numbers.
INFINITE, MINUS_INFINITE, NOT_A_NUMBER = 1000, 1001, 1002

# The expressions are SQL texts: as calls they would be some thousand of them per query.


def _column(value: str | Column) -> Column:
    return (col(value) if isinstance(value, str) else value).cast("double")


def _let(value: str, name: str, use: str) -> str:
    """``use`` of a value that is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def _is_common(v: str) -> str:
    """Whether a value is a whole number of millionths, told apart by a double: up to 15 digits."""
    steps = f"rint({v} * 1e6D)"
    return f"(abs({steps}) < 1e15D AND {steps} / 1e6D = {v})"


def _common_steps(v: str) -> str:
    """A common value in millionths, NULL for others."""
    return f"CASE WHEN {_is_common(v)} THEN CAST(rint({v} * 1e6D) AS BIGINT) END"


def _common_digits(steps: str) -> list[str]:
    return [
        f"({steps}) % {BASE}",
        f"(({steps}) div {BASE}) % {BASE}",
        f"({steps}) div {BASE} div {BASE}",
        f"CASE WHEN ({steps}) IS NOT NULL THEN 0L END",
    ]


def _odd_part(v: str) -> str:
    """Range and digits of a value that is not common, by its printed form.

    That is a whole number `m` and the power of ten it counts; `p` is that power from a millionth
    on. The number's digits are moved up to a multiple of ``PLACES``.
    """
    text = f"CAST({v} AS STRING)"
    number = f"substring_index({text}, 'E', 1)"
    power = f"CASE WHEN contains({text}, 'E') THEN substring_index({text}, 'E', -1) ELSE '0' END"
    printed = (
        f"named_struct('m', try_cast(replace({number}, '.', '') AS BIGINT),"
        f" 'p', try_cast({power} AS INT) - length(substring_index({number}, '.', -1)) + 6)"
    )
    powers = ", ".join(f"{10**i}L" for i in range(PLACES))
    up = f"element_at(array({powers}), pmod(x.p, {PLACES}) + 1)"
    moved = (
        f"named_struct('a', x.m % {BASE} * {up}, 'b', x.m div {BASE} % {BASE} * {up},"
        f" 'c', x.m div {BASE} div {BASE} * {up}, 'range', CAST(floor(x.p / {PLACES}) AS INT))"
    )
    second = f"(y.b + y.a div {BASE})"
    third = f"(y.c + {second} div {BASE})"
    part = (
        f"named_struct('range', CASE WHEN abs({v}) < double('Infinity') THEN y.range"
        f" WHEN isnan({v}) THEN {NOT_A_NUMBER} WHEN {v} > 0 THEN {INFINITE}"
        f" ELSE {MINUS_INFINITE} END,"
        f" 'digits', array(y.a % {BASE}, {second} % {BASE}, {third} % {BASE}, {third} div {BASE}))"
    )
    return _let(printed, "x", _let(moved, "y", part))


def _carried(digits: str) -> str:
    """Digits brought between 0 and BASE - 1, lowest first, and what is carried out of the top."""
    return (
        f"aggregate({digits}, named_struct('o', CAST(array() AS ARRAY<BIGINT>), 'c', 0L),"
        f" (s, d) -> named_struct('o', concat(s.o, array(pmod(d + s.c, {BASE}))),"
        f" 'c', (d + s.c - pmod(d + s.c, {BASE})) div {BASE}))"
    )


def _nearest(digits: str, first: str) -> str:
    """The double nearest to carried digits, of which the lowest is that of the range ``first``."""
    written = f"transform(reverse({digits}), g -> lpad(CAST(g AS STRING), {PLACES}, '0'))"
    power = f"CAST({first} * {PLACES} - 6 AS STRING)"
    return f"CAST(concat(array_join({written}, ''), 'E', {power}) AS DOUBLE)"


def _rounded(parts: str) -> str:
    """The sum of an array of structs (range, digits), as the nearest double."""
    # Two places more for what a trillion values carry up.
    digits = (
        f"transform(sequence(0, b.l - b.f + {DIGITS + 1}), i -> aggregate(p, 0L,"
        " (t, e) -> t + coalesce(get(e.digits, i - (e.range - b.f)), 0L)))"
    )
    minus = _nearest(f"{_carried('transform(d, x -> -x)')}.o", "b.f")
    signed = f"CASE WHEN u.c < 0 THEN -{minus} ELSE {_nearest('u.o', 'b.f')} END"
    span = (
        "named_struct('f', array_min(transform(p, e -> e.range)),"
        " 'l', array_max(transform(p, e -> e.range)))"
    )
    finite = _let(span, "b", _let(digits, "d", _let(_carried("d"), "u", signed)))
    # A common sum that a double tells apart: one division rounds it.
    small = (
        f"size(p) = 1 AND p[0].range = {COMMON} AND abs(p[0].digits[0]) < 1000000000000000L"
        " AND abs(p[0].digits[1]) < 100000000L AND p[0].digits[2] = 0"
    )

    def has(kind: int) -> str:
        return f"exists(p, e -> e.range = {kind})"

    settled = f"""CASE WHEN size(p) = 0 THEN CAST(NULL AS DOUBLE)
        WHEN {small} THEN CAST(p[0].digits[0] + p[0].digits[1] * {BASE} AS DOUBLE) / 1e6D
        WHEN {has(NOT_A_NUMBER)} OR ({has(INFINITE)} AND {has(MINUS_INFINITE)}) THEN double('NaN')
        WHEN {has(INFINITE)} THEN double('Infinity')
        WHEN {has(MINUS_INFINITE)} THEN double('-Infinity')
        ELSE {finite} END"""
    return _let(parts, "p", settled)


def exact_total(name: str) -> Column:
    """The exact sum of a column of arrays of doubles."""
    digits = ", ".join(_common_digits(_common_steps("v")))
    part = (
        f"CASE WHEN {_is_common('v')} THEN"
        f" named_struct('range', {COMMON}, 'digits', array({digits})) ELSE {_odd_part('v')} END"
    )
    return F.expr(_rounded(f"transform(filter({name}, v -> v IS NOT NULL), v -> {part})"))


# --- two aggregations -----------------------------------------------------------------


def with_digits(df: DataFrame, values: dict[str, str | Column]) -> DataFrame:
    """Add what ``range_key`` and ``sum_parts`` need of the named values.

    As columns of their own they are worked out once per row, and the printed form only where a
    value is not common.
    """
    named = df.withColumns({f"{name}_value": _column(v) for name, v in values.items()})
    split = {}
    for name in values:
        v = f"{name}_value"
        odd = f"CASE WHEN {v} IS NOT NULL AND NOT {_is_common(v)} THEN {_odd_part(v)} END"
        split |= {f"{name}_steps": F.expr(_common_steps(v)), f"{name}_odd": F.expr(odd)}
    return named.withColumns(split).drop(*[f"{name}_value" for name in values])


def range_key(name: str) -> Column:
    """The further key of an aggregation of ``sum_parts``; without a value the common range."""
    return F.expr(f"coalesce({name}_odd.range, {COMMON})").alias(f"{name}_range")


def sum_parts(name: str) -> list[Column]:
    """What an aggregation by the group's keys and ``range_key`` keeps of a value."""
    steps, odd = f"{name}_steps", f"{name}_odd"
    return [
        F.expr(f"count_if({steps} IS NOT NULL OR {odd} IS NOT NULL) AS {name}_n"),
        *[
            F.expr(
                f"sum(CASE WHEN {odd} IS NULL THEN {common} ELSE {odd}.digits[{i}] END)"
                f" AS {name}_digit{i}"
            )
            for i, common in enumerate(_common_digits(steps))
        ],
    ]


def part_names(name: str) -> list[str]:
    return [f"{name}_n", *(f"{name}_digit{i}" for i in range(DIGITS))]


def added_parts(name: str) -> list[Column]:
    """The parts of several rows of the same keys and range as those of one."""
    return [F.sum(p).alias(p) for p in part_names(name)]


def sum_of_parts(name: str) -> Column:
    """The exact sum, as an aggregate over rows of ``sum_parts``.

    A group's rows are one per combination of ranges.
    """
    digits = ", ".join(f"{name}_digit{i}" for i in range(DIGITS))
    part = f"named_struct('range', {name}_range, 'digits', array({digits}))"
    return F.expr(_rounded(f"collect_list(CASE WHEN {name}_n > 0 THEN {part} END)"))


def avg_of_parts(name: str) -> Column:
    """The exact sum over the number of values; NULL without any."""
    return F.try_divide(sum_of_parts(name), F.sum(f"{name}_n"))


@dataclass(frozen=True)
class Measure:
    """One result column of ``aggregate``.

    ``value`` is what is added up exactly. ``parts`` are aggregates over rows, by the name they get
    as a prefix; ``total`` makes the result of the prefix, as an aggregate over parts.
    """

    name: str
    total: Callable[[str], Column]
    value: Column | None = None
    parts: Callable[[str], list[Column]] = lambda prefix: []


def exact_sum(value: str | Column, name: str) -> Measure:
    return Measure(name, sum_of_parts, _column(value))


def exact_avg(value: str | Column, name: str) -> Measure:
    return Measure(name, avg_of_parts, _column(value))


def count_rows(name: str) -> Measure:
    return Measure(
        name,
        lambda p: F.coalesce(F.sum(f"{p}_n"), lit(0)),
        parts=lambda p: [F.count(lit(1)).alias(f"{p}_n")],
    )


def whole_avg(value: str | Column, name: str) -> Measure:
    """The average of whole numbers, whose sum is exact as it is."""
    value = col(value) if isinstance(value, str) else value
    return Measure(
        name,
        lambda p: F.try_divide(F.sum(f"{p}_sum"), F.sum(f"{p}_n")),
        parts=lambda p: [
            F.sum(value.cast("long")).alias(f"{p}_sum"), F.count(value).alias(f"{p}_n")
        ],
    )


def percent_steps(value: Column) -> Column:
    """A percentage in whole millionths, halves up: the same number in any engine."""
    steps = F.floor(value * STEPS + 0.5).cast("double")
    return F.when(F.abs(value) < LARGEST / STEPS, steps).otherwise(value * STEPS)


def avg_percent(value: Column, name: str) -> Measure:
    """The average of percentages, each taken to six places."""
    return Measure(
        name,
        lambda p: F.try_divide(sum_of_parts(p) / STEPS, F.sum(f"{p}_n")),
        _column(percent_steps(value)),
    )


def aggregate(df: DataFrame, keys: list[str | Column], *measures: Measure) -> DataFrame:
    """``df.groupBy(*keys).agg(*measures)``; without keys one row.

    Measures of the same value share its parts. Only ask for measures that are wanted: the
    range of a value is a key, which Catalyst cannot prune.
    """
    values: dict[str, tuple[str, Column]] = {}
    parts, totals = [], []
    for i, measure in enumerate(measures):
        prefix = f"_m{i}"
        if measure.value is not None:
            named = (f"_v{len(values)}", measure.value)
            prefix = values.setdefault(str(measure.value), named)[0]
        parts += measure.parts(prefix)
        totals.append(measure.total(prefix).alias(measure.name))
    ranges = [range_key(prefix) for prefix, _ in values.values()]
    for prefix, _ in values.values():
        parts += sum_parts(prefix)
    split = with_digits(df, dict(values.values())) if values else df
    first = split.groupBy(*keys, *ranges).agg(*parts)
    names = [f"`{c}`" for c in first.columns[: len(keys)]]
    return first.groupBy(*names).agg(*totals)
