"""Row filters: calendar month, recency, id ranges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_column(as_of: date | None) -> Column:
    """The processing date: a fixed one, or the session's current date."""
    return F.current_date() if as_of is None else F.lit(as_of)


def in_month(day: Column, as_of: date | None) -> Column:
    """True where ``day`` lies in the calendar month of ``as_of``.

    Written as a half-open range whose bounds fold to literals, so it reaches the scan.
    """
    first = F.trunc(as_of_column(as_of), "month")
    return (day >= first) & (day < F.add_months(first, 1))


def since_days(day: Column, as_of: date | None, days: int) -> Column:
    """True where ``day`` is at most ``days`` days before ``as_of`` (or later)."""
    return day >= F.date_sub(as_of_column(as_of), days)


@dataclass(frozen=True)
class IdRange:
    """A closed id range; None leaves it open at that end. Open below, it has null ids too."""

    number: int
    first: int | None
    last: int | None

    def holds(self, id_column: Column) -> Column:
        if self.first is None:
            below = F.lit(True) if self.last is None else id_column <= self.last
            return id_column.isNull() | below
        if self.last is None:
            return id_column >= self.first
        return id_column.between(self.first, self.last)


def id_ranges(first: int, width: int, count: int) -> list[IdRange]:
    """``count`` ranges that share no id and leave none out, of ``width`` ids from ``first`` on.

    The first one is open below, and the last one above.
    """
    if width < 1 or count < 1:
        raise ValueError("width and count must be positive")
    starts = [first + i * width for i in range(count)]
    return [
        IdRange(
            i + 1,
            None if i == 0 else start,
            None if i == count - 1 else start + width - 1,
        )
        for i, start in enumerate(starts)
    ]


# The bounds of the historical load. The first two ranges share two ids.
HISTORY_RANGES = [
    IdRange(1, 0, 2176918),
    IdRange(2, 2176917, 4176917),
    IdRange(3, 4176918, 6176917),
    IdRange(4, 6176918, 8176917),
    IdRange(5, 8176918, 10176917),
    IdRange(6, 10176918, 12176917),
    IdRange(7, 12176918, 14176917),
    IdRange(8, 14176918, 16176917),
    IdRange(9, 16176918, 18176917),
    IdRange(10, 18176918, None),
]


def _ordered(ranges: Sequence[IdRange]) -> list[IdRange]:
    return sorted(ranges, key=lambda r: (r.first is not None, r.first or 0))


def overlapping(ranges: Sequence[IdRange]) -> tuple[IdRange, IdRange] | None:
    """Two neighbouring ranges that share an id, if there are any."""
    ordered = _ordered(ranges)
    for left, right in zip(ordered, ordered[1:]):
        if left.last is None or right.first is None or left.last >= right.first:
            return left, right
    return None


def complete(ranges: Sequence[IdRange]) -> bool:
    """Whether the ranges leave out no id, null included."""
    ordered = _ordered(ranges)
    reached: int | None = None
    for i, r in enumerate(ordered):
        if (r.first is not None) if i == 0 else (r.first is not None and r.first > reached + 1):
            return False
        if r.last is None:
            return True
        reached = r.last if reached is None else max(reached, r.last)
    return False


def split_by_range(
    df: DataFrame,
    id_name: str,
    ranges: Sequence[IdRange],
    out: str = "chunk",
    repeat: bool = True,
) -> DataFrame:
    """One row per range that holds the row's id, the range's number in ``out``.

    One scan serves all ranges. Overlapping ranges repeat a row once per range, or, without
    ``repeat``, give it to the first of them. A row in no range ends the job: none is lost.
    """
    id_column = F.col(id_name)
    numbers = [F.when(r.holds(id_column), F.lit(r.number)) for r in _ordered(ranges)]
    missing = F.concat(F.lit("id in no range: "), F.coalesce(id_column.cast("string"), F.lit("null")))
    first = F.coalesce(*numbers)
    if not complete(ranges):
        first = F.coalesce(first, F.raise_error(missing).cast("int"))
    if not repeat or not overlapping(ranges):
        return df.withColumn(out, first)
    every = F.array_compact(F.array(*numbers))
    if not complete(ranges):
        every = F.when(F.size(every) > 0, every).otherwise(F.array(first))
    return df.withColumn(out, F.explode(every))


def jdbc_predicates(id_name: str, ranges: Sequence[IdRange]) -> list[str]:
    """One WHERE text per range, for a database read with one task per range."""

    def text(r: IdRange) -> str:
        if r.first is None and r.last is None:
            return "1 = 1"
        if r.first is None:
            return f"({id_name} <= {r.last} OR {id_name} IS NULL)"
        return f"{id_name} >= {r.first}" + ("" if r.last is None else f" AND {id_name} <= {r.last}")

    return [text(r) for r in ranges]
