"""Positions in a total order without a single-task sort: dense ids and ranks in groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctmart.operators.joins import splittable_join
from acctmart.session import ensure_checkpoint_dir

# monotonically_increasing_id keeps the partition number above bit 33.
_ROW_BITS = 33


def _sorted_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned and sorted, each row with its partition and row number.

    The result is checkpointed: every later read sees the same partitioning, also after
    an executor is lost. A hash of the whole row ends the sort order, so that rows tied
    on ``order`` still spread over several partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tie_break = F.xxhash64(*[F.col(c) for c in df.columns])
    return (
        df.orderBy(*order, tie_break)
        .withColumn("_row", F.monotonically_increasing_id())
        .select(
            *df.columns,
            F.shiftright("_row", _ROW_BITS).alias("_part"),
            F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
        )
        .checkpoint()
    )


def _offsets(parts: DataFrame) -> DataFrame:
    """Running start per partition from (_part, _n).

    There is one row per shuffle partition, a number the session sets and the data does
    not, so the ordered window and the broadcast below stay small at any table size.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        F.col("_part").alias("_offset_part"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )


def with_positions(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Zero-based position of every row under ``order``."""
    rows = _sorted_rows(df, order)
    offsets = _offsets(rows.groupBy("_part").agg(F.count("*").alias("_n")))
    return rows.join(F.broadcast(offsets), F.col("_part") == F.col("_offset_part")).select(
        *df.columns, (F.col("_offset") + F.col("_row")).alias(out)
    )


def assign_dense_ids(
    df: DataFrame, order: Sequence[Column], start: int, out: str
) -> DataFrame:
    """Ids ``start``, ``start``+1, … in the given order, without gaps.

    An ``out`` column that already exists is overwritten where it stands.
    """
    names = df.columns
    kept = [c for c in names if c != out]
    numbered = with_positions(df.select(*kept), order, "_position")
    new_id = (F.col("_position") + F.lit(start)).alias(out)
    if out in names:
        return numbered.select(*[new_id if c == out else F.col(c) for c in names])
    return numbered.select(*kept, new_id)


def _expand_copies(df: DataFrame, block: int) -> DataFrame:
    """``_copies`` rows per row, ranked from ``_first`` on, made in spread-out blocks."""
    blocks = df.withColumn(
        "_block", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {block})"))
    ).repartition("_first", "_block")
    copy = F.expr(
        f"sequence(_block * {block}, least((_block + 1) * {block}, _copies) - 1)"
    )
    return blocks.withColumn("_copy", F.explode(copy)).withColumn(
        "_rank", F.col("_first") + F.col("_copy")
    )


def rank_in_group(
    df: DataFrame, key: str, value: str, out: str, block: int = 100_000
) -> DataFrame:
    """Row number per key, highest value first, nulls last; rows of a null key have no rank.

    No group has to fit into one task. Equal rows are counted first, the counted rows sorted
    over all tasks, and the running count less that of the group's start is the rank. The
    sort is run, and checkpointed, when this is called.
    """
    keyed = F.col(key).isNotNull()
    counted = df.where(keyed).groupBy(key, value).agg(F.count("*").alias("_copies"))
    rows = _sorted_rows(counted, [F.asc(key), F.desc_nulls_last(value)])
    offsets = _offsets(rows.groupBy("_part").agg(F.sum("_copies").alias("_n")))
    # Sorted rows of one partition only: their number is what one task sorted before.
    before = Window.partitionBy("_part").orderBy("_row").rowsBetween(
        Window.unboundedPreceding, -1
    )
    running = rows.withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    placed = running.join(
        F.broadcast(offsets), F.col("_part") == F.col("_offset_part")
    ).select(key, value, "_copies", (F.col("_offset") + F.col("_before")).alias("_position"))
    starts = placed.groupBy(key).agg(F.min("_position").alias("_start"))
    ranked = splittable_join(placed, starts, [key]).select(
        key,
        value,
        "_copies",
        (F.col("_position") - F.col("_start") + 1).alias("_first"),
    )
    ranks = _expand_copies(ranked, block).select(key, value, F.col("_rank").alias(out))
    unranked = df.where(~keyed).select(key, value, F.lit(None).cast("bigint").alias(out))
    return ranks.unionByName(unranked)
