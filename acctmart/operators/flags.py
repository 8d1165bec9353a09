"""Existence flags: does a row's key occur in another table?"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctmart.operators.joins import splittable_join


def key_flags(rows: DataFrame, key: str, conditions: Mapping[str, Column]) -> DataFrame:
    """One row per non-null key; each flag is 1 where any of the key's rows meets it.

    A max of 0/1 is combined map-side, so a key with very many rows stays cheap.
    """
    flags = [
        F.max(F.when(condition, 1).otherwise(0)).alias(name)
        for name, condition in conditions.items()
    ]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*flags)


def with_flags(
    df: DataFrame,
    key: str,
    flags: DataFrame,
    flags_key: str,
    names: list[str],
    repeated_keys: bool = True,
) -> DataFrame:
    """Left join flag columns, 0 where the key is missing. Rows are never repeated.

    ``flags`` has one row per key. Where ``df`` also has about one row per key, pass
    ``repeated_keys=False`` to join on the partitioning that ``df`` already has.
    """
    right = flags.select(F.col(flags_key).alias("_flag_key"), *names)
    if repeated_keys:
        joined = splittable_join(df, right, [key], "left", ["_flag_key"])
    else:
        joined = df.join(right, F.col(key) == F.col("_flag_key"), "left").drop("_flag_key")
    return joined.fillna(0, names)


def with_exists_flag(
    df: DataFrame,
    key: str,
    rows: DataFrame,
    rows_key: str,
    name: str,
    repeated_keys: bool = True,
) -> DataFrame:
    """Flag ``name``: 1 where the key occurs in ``rows``."""
    keys = rows.select(rows_key).where(F.col(rows_key).isNotNull()).distinct()
    return with_flags(
        df, key, keys.withColumn(name, F.lit(1)), rows_key, [name], repeated_keys
    )


# The insurance products behind the two product flags.
DENTAL_PRODUCTS = (3,)
GUARANTEED_INVOICE_PRODUCTS = (1, 2)


def coverage(insurance: DataFrame, any_name: str, dental_name: str, guaranteed_name: str) -> DataFrame:
    """Insurance flags per tax id (``cpf``), all from one pass over the enrolments."""
    product = F.col("id_produto").cast("int")
    return key_flags(
        insurance,
        "cpf",
        {
            any_name: F.lit(True),
            dental_name: product.isin(*DENTAL_PRODUCTS),
            guaranteed_name: product.isin(*GUARANTEED_INVOICE_PRODUCTS),
        },
    )
