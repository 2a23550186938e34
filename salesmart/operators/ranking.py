"""Global n-tiles without sorting or moving the rows.

``NTILE(n)`` needs only its n - 1 boundary rows: a row's tile is one more than the number of boundaries
below it. The boundaries are found by counting: each pass splits the interval of numbers that holds a
boundary into equal parts and counts the rows of each part, combined in every task, until one
number is left; rows with that number are told apart by the tie number in the same way. The last pass is a
projection. A number that very many rows share costs nothing more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

PARTS = 1024  # of an interval in one pass
_NUMBER = "bigint"


@dataclass
class _Search:
    """A boundary: the row at ``place`` (from 1) of those that satisfy ``inside``, by ``column``."""

    order: str
    column: str
    place: int
    low: int
    high: int
    equal_to: int | None = None  # the number whose ties are being told apart


def with_ntiles(df: DataFrame, tiles: int, orders: Mapping[str, Column], tie: Column) -> DataFrame:
    """Add one global ``NTILE(tiles)`` column per entry of ``orders`` (name -> ascending whole number).

    Rows with equal numbers are ordered by ``tie``, a unique whole number; NULL numbers come first. The
    boundaries of all orders are searched together, about two passes for each ten binary digits
    of the numbers' ranges. ``df`` is read in each pass: hand in a settled frame.
    """
    names = list(orders)
    base = df.select("*", tie.cast(_NUMBER).alias("__tie"), *[orders[n].cast(_NUMBER).alias(f"__v_{n}") for n in names])
    ends = [f(c).alias(f"{f.__name__}{c}") for c in ["__tie", *[f"__v_{n}" for n in names]] for f in (F.min, F.max)]
    seen = base.agg(F.count(F.lit(1)).alias("rows"), *ends).first()
    for n in names:  # a NULL number is the one below the least
        base = base.withColumn(f"__v_{n}", F.coalesce(f"__v_{n}", F.lit((seen[f"min__v_{n}"] or 0) - 1)))
    wanted = [
        _Search(n, f"__v_{n}", place, (seen[f"min__v_{n}"] or 0) - 1, seen[f"max__v_{n}"] or 0)
        for n in names for place in _last_places(seen["rows"], tiles)
    ]
    numbers = _find(base, wanted)
    by_tie = [
        _Search(s.order, "__tie", s.place - before, seen["min__tie"], seen["max__tie"], number)
        for s, (number, before) in zip(wanted, numbers)
    ]
    ties = _find(base, by_tie)
    tiled = {}
    for n in names:
        v = F.col(f"__v_{n}")
        tile = F.lit(1).cast(_NUMBER)
        for s, (number, _), (last, _) in zip(wanted, numbers, ties):
            if s.order == n:
                beyond = (v > number) | ((v == number) & (F.col("__tie") > last))
                tile = tile + beyond.cast(_NUMBER)
        tiled[n] = tile
    return base.select(*df.columns, *[tiled[n].alias(n) for n in names])


def _last_places(rows: int, tiles: int) -> list[int]:
    """Places of the last rows of all tiles but the last; the first ``rows % tiles`` tiles get one row more."""
    size, extra = divmod(rows, tiles)
    ends = [tile * size + min(tile, extra) for tile in range(1, tiles)]
    return [end for end in ends if 0 < end < rows]


def _find(base: DataFrame, searches: list[_Search]) -> list[tuple[int, int]]:
    """(number, rows with a smaller one) at the place of each search.

    At most ``PARTS`` counts per search come to the driver in a pass.
    """
    state = [(s.low, s.high, 0) for s in searches]
    while any(low < high for low, high, _ in state):
        open_ = sorted({(s.column, s.order, s.equal_to, low, high) for s, (low, high, _) in zip(searches, state) if low < high}, key=repr)
        cells = []
        for i, (column, order, equal_to, low, high) in enumerate(open_):
            inside = F.col(column).between(low, high)
            if equal_to is not None:
                inside &= F.col(f"__v_{order}") == equal_to
            part = F.expr(f"(`{column}` - ({low})) div {_step(low, high)}")
            cells.append(F.when(inside, F.struct(F.lit(i).alias("i"), part.alias("part"))))
        rows = base.select(F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c"))
        counts: dict[int, list[tuple[int, int]]] = {}
        for r in rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["c"]["i"], []).append((r["c"]["part"], r["n"]))
        for k, (s, (low, high, before)) in enumerate(zip(searches, state)):
            if low < high:
                step = _step(low, high)
                for part, n in sorted(counts[open_.index((s.column, s.order, s.equal_to, low, high))]):
                    if before + n >= s.place:
                        state[k] = (low + part * step, min(high, low + (part + 1) * step - 1), before)
                        break
                    before += n
    return [(low, before) for low, _, before in state]


def _step(low: int, high: int) -> int:
    return -(-(high - low + 1) // PARTS)
