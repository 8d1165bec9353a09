"""Joins laid out for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    right_on: Sequence[str] | None = None,
    lane: int = 0,
) -> DataFrame:
    """Equi-join in which adaptive execution can split a hot key.

    It splits a skewed partition only where both inputs come straight out of shuffles made
    for this join, and where no later step relies on the join's partitioning. An input
    already grouped by the key, or a group-by on it afterwards, prevents that. Comparing a
    hash of the keys as well changes no result, yet gives the join a partitioning of its
    own. A join on the key of a join before it takes another ``lane``, as else it would reuse
    that one's partitioning. The right side's key columns are left out of the result.
    """
    right_on = list(right_on or on)
    renamed = {name: f"_right_key_{i}" for i, name in enumerate(right_on)}
    for name, other in zip(on, right_on):
        have, want = left.schema[name].dataType, right.schema[other].dataType
        if have != want:
            # Hashes of equal numbers differ between types.
            raise TypeError(f"join keys {name}: {have} and {other}: {want} differ in type")
    marks = [F.lit(lane)] if lane else []
    same = F.xxhash64(*marks, *on) == F.xxhash64(*marks, *renamed.values())
    for name, other in zip(on, renamed.values()):
        same = same & (F.col(name) == F.col(other))
    joined = left.join(right.withColumnsRenamed(renamed), same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())
