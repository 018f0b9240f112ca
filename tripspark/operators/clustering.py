"""Orders in which rows near in several columns at once are near each other."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import lit


def z_order(columns: list[Column], bits: int) -> Column:
    """The bits of whole numbers below 2**bits, the highest of each first, in one long."""
    cells = [c.cast("long") for c in columns]
    key = lit(0).cast("long")
    for bit in range(bits):
        for i, cell in enumerate(cells):
            at = F.shiftright(cell, bit).bitwiseAND(lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(at, bit * len(cells) + len(cells) - 1 - i))
    return key


def runs(values: list[int], most: int = 200) -> list[tuple[int, int]]:
    """Whole numbers as ranges without gaps; past ``most`` the narrowest gaps are filled.

    A filter on the ranges then lets too much pass, never too little.
    """
    out: list[list[int]] = []
    for value in sorted(set(values)):
        if out and value <= out[-1][1] + 1:
            out[-1][1] = value
        else:
            out.append([value, value])
    if len(out) > most:
        gaps = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1])
        closed = set(gaps[: len(out) - most])
        merged = [out[0]]
        for i, run in enumerate(out[1:], 1):
            if i in closed:
                merged[-1][1] = run[1]
            else:
                merged.append(run)
        out = merged
    return [(a, b) for a, b in out]
