"""Lookups: attribute by code, number in range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from acctmart.functions.clean import STRICT, text_to_long
from acctmart.operators.joins import splittable_join

_STEP = 4  # each level merges 2**4 neighbours of the level below
_TOP = 15  # its blocks have 2**60 codes, so that 16 of them are all 64-bit codes


def attribute_by_code(
    fields: DataFrame,
    answers: DataFrame,
    enrolments: DataFrame,
    code: str,
    statuses: Sequence[str],
    products: Sequence[str],
) -> DataFrame:
    """One attribute of an entity-attribute-value set, with the enrolment's product.

    Product ids are compared as text and turned into numbers after the filter.

    The selected field is one or a few rows of a catalogue. Nearly all answers kept share
    its id, so Spark should broadcast it, which it does by its size; past the threshold
    the skewed join is split by AQE.
    """
    field = fields.where(F.col("ds_codigo") == code).select("id_campo")
    accepted = enrolments.where(
        F.col("ds_status").isin(*statuses) & F.col("id_produto").isin(*products)
    ).select("id_adesao", F.col("id_produto").cast("int"))
    return (
        answers.join(field, "id_campo")
        .join(accepted, "id_adesao")
        .select(F.col("vl_resposta").alias("cpf"), "id_produto")
    )


def _blocks(ranges: DataFrame, low: str, high: str, value: str) -> DataFrame:
    """Each closed range as aligned blocks that tile it exactly, least value per block.

    A block is (level, number) and covers 16**level codes. On each level a range yields at
    most 30 blocks, however wide it is. Afterwards a block is a unique key. All bounds are
    inclusive, so that none overflows at either end of the 64-bit numbers.
    """
    bounded = ranges.where(F.col(low).isNotNull() & F.col(high).isNotNull())
    levels = bounded.select(
        F.col(low).cast("bigint").alias("lo"),
        F.col(high).cast("bigint").alias("hi"),
        F.col(value).alias("value"),
        F.explode(F.sequence(F.lit(0), F.lit(_TOP))).alias("level"),
    ).where("lo <= hi")

    def first(level: str) -> str:
        """The first block of the level that begins in the range."""
        rest = f"lo & (shiftleft(1L, {level} * {_STEP}) - 1)"
        return f"shiftright(lo, {level} * {_STEP}) + if(({rest}) = 0, 0, 1)"

    def last(level: str) -> str:
        """The last block of the level that ends in the range."""
        whole = f"shiftleft(1L, {level} * {_STEP}) - 1"
        return f"shiftright(hi, {level} * {_STEP}) - if((hi & ({whole})) = ({whole}), 0, 1)"

    # The level above; at the top there is none, and its columns are not looked at.
    above = f"least(level + 1, {_TOP})"
    bounds = levels.selectExpr(
        "value",
        "level",
        f"{first('level')} AS a",
        f"{last('level')} AS b",
        f"{first(above)} AS up_a",
        f"{last(above)} AS up_b",
    ).where("a <= b")
    fan = 1 << _STEP
    # What the level above covers is left out; it lies within the range, so only what may
    # stick out at its ends is computed after a comparison.
    numbers = f"""
        CASE WHEN level = {_TOP} OR up_a > up_b THEN sequence(a, b)
        ELSE concat(
            CASE WHEN a < {fan} * up_a THEN sequence(a, {fan} * up_a - 1)
                 ELSE array() END,
            CASE WHEN {fan} * up_b + {fan - 1} < b THEN sequence({fan} * up_b + {fan}, b)
                 ELSE array() END)
        END"""
    return (
        bounds.select("value", "level", F.explode(F.expr(numbers)).alias("block"))
        .groupBy("level", "block")
        .agg(F.min("value").alias("value"))
    )


def range_lookup(
    df: DataFrame,
    code: str,
    ranges: DataFrame,
    low: str,
    high: str,
    value: str,
    out: str | None = None,
    mode: str = STRICT,
) -> DataFrame:
    """Left join the least ``value`` of all ranges holding ``code``; null where none does.

    The distinct codes are looked up by equality on (level, block), at most once per
    level, then joined back to the rows. No pair of code and overlapping range is ever
    formed, so wide or heavily overlapping ranges cost nothing extra. A code given as text
    that is no number ends the job in strict mode and is in no range in lenient mode.
    """
    out = out or value
    blocks = _blocks(ranges, low, high, value)
    # At most one number per level.
    used_levels = blocks.agg(F.array_sort(F.collect_set("level"))).scalar()
    is_text = isinstance(df.schema[code].dataType, StringType)
    number = text_to_long(F.col(code), mode) if is_text else F.col(code).cast("bigint")
    probes = (
        df.select(number.alias("_code"))
        .where(F.col("_code").isNotNull())
        .distinct()
        .withColumn("level", F.explode(used_levels))
        .withColumn("block", F.expr(f"shiftright(_code, level * {_STEP})"))
    )
    found = (
        splittable_join(probes, blocks, ["level", "block"])
        .groupBy("_code")
        .agg(F.min("value").alias("_found"))
    )
    numbered = df.withColumn("_number", number)
    joined = splittable_join(numbered, found, ["_number"], "left", ["_code"])
    return joined.drop("_number").withColumnRenamed("_found", out)
