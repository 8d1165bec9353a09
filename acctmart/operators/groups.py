"""Per-key totals, spans, latest ids and top-two spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctmart.operators.joins import splittable_join


def key_span(df: DataFrame, key: str, day: str, last: str, first: str) -> DataFrame:
    """Latest and earliest ``day`` per key."""
    return df.groupBy(key).agg(F.max(day).alias(last), F.min(day).alias(first))


def latest_per_key(df: DataFrame, key: str, id_name: str) -> DataFrame:
    """Highest id per key."""
    return df.groupBy(key).agg(F.max(id_name).alias(id_name))


def key_totals(
    df: DataFrame, key: str, member: str, amount: str, day: str
) -> DataFrame:
    """Distinct (key, member) pairs with the key's summed amount and latest day.

    The totals belong to ``key`` alone, whatever the member. They are aggregated from the
    pairs and joined back to them: a window over ``key`` would hold one key's rows in one
    task, while an aggregate combines map-side and a join can split a hot key. A key
    whose amounts are all null totals 0; a null key has null totals.
    """
    keyed = F.col(key).isNotNull()
    pairs = (
        df.where(keyed)
        .groupBy(key, member)
        .agg(F.sum(amount).alias("_own_amount"), F.max(day).alias("_own_day"))
    )
    totals = pairs.groupBy(key).agg(
        F.sum("_own_amount").alias("_amount"), F.max("_own_day").alias("_day")
    )
    # Every pair finds its totals. Naming the pair's own values as well keeps them in both
    # inputs of the join, so that one scan and one shuffle of the pairs serve the two.
    of_keys = splittable_join(pairs, totals, [key]).select(
        key,
        member,
        F.coalesce("_amount", "_own_amount", F.lit(0)).alias(amount),
        F.coalesce("_day", "_own_day").alias(day),
    )
    of_no_key = df.where(~keyed).select(key, member).distinct()
    return of_keys.unionByName(of_no_key, allowMissingColumns=True)


def top_two(df: DataFrame, key: str, value: str, first: str, second: str) -> DataFrame:
    """The two highest values per key side by side; repeated values count twice.

    The rank filter makes Spark keep two rows per key in each task before the shuffle.
    Null values rank last, and null keys are left out.
    """
    ranked = (
        df.where(F.col(key).isNotNull())
        .select(key, value)
        .withColumn("_rank", F.row_number().over(descending(key, value)))
        .where(F.col("_rank") <= 2)
    )
    return ranked.groupBy(key).agg(
        F.max(F.when(F.col("_rank") == 1, F.col(value))).alias(first),
        F.max(F.when(F.col("_rank") == 2, F.col(value))).alias(second),
    )


def descending(key: str, value: str) -> Window:
    """Window over ``key``, highest ``value`` first, nulls last."""
    return Window.partitionBy(key).orderBy(F.desc_nulls_last(value))


def above(df: DataFrame, value: Column, minimum: Column) -> DataFrame:
    """Rows whose value exceeds the minimum; a null on either side drops the row."""
    return df.where(value > minimum)
