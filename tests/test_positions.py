from __future__ import annotations

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from acctmart.operators.positions import assign_dense_ids, rank_in_group


def test_dense_ids_follow_the_order(spark):
    df = spark.range(0, 5000, 1, 7).select(
        (F.col("id") * 7919 % 5000).alias("k"), F.col("id").alias("v")
    )
    got = assign_dense_ids(df, [F.asc("k")], 100, "n").orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(100, 5100))


def test_dense_ids_spread_ties_over_tasks(spark, settings):
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    df = spark.range(0, 8000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 100).alias("k"),
        F.col("id").alias("v"),
    )
    got = assign_dense_ids(df, [F.asc("k")], 0, "n")
    assert [r["n"] for r in got.orderBy("n").select("n").collect()] == list(range(8000))
    ordered = [r["k"] for r in got.orderBy("n").collect()]
    assert ordered == sorted(ordered)
    hot = got.where("k = 50").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1


def test_dense_ids_overwrite_in_place(spark):
    df = spark.createDataFrame([(1, None, "b"), (2, None, "a")], "i int, n bigint, s string")
    got = assign_dense_ids(df, [F.asc("s")], 7, "n")
    assert got.columns == ["i", "n", "s"]
    assert rows(got) == [(1, 8, "b"), (2, 7, "a")]


def test_dense_ids_of_nothing(spark):
    df = spark.createDataFrame([], "k bigint")
    got = assign_dense_ids(df, [F.asc("k")], 1, "n")
    assert got.columns == ["k", "n"] and got.count() == 0


def expected_ranks(values):
    groups = {}
    out = [(key, value, None) for key, value in values if key is None]
    for key, value in values:
        if key is not None:
            groups.setdefault(key, []).append(value)
    for key, members in groups.items():
        present = sorted((m for m in members if m is not None), reverse=True)
        ordered = present + [None] * (len(members) - len(present))
        out += [(key, m, i + 1) for i, m in enumerate(ordered)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [100_000, 20])
def test_ranks(spark, block):
    rng = random.Random(5)
    values = [(1, f"{rng.randrange(60):03d}") for _ in range(300)]  # a third of all rows
    values += [(1, None)] * 5 + [(1, "777")] * 150  # nulls and many copies
    values += [(rng.randrange(2, 40), f"{rng.randrange(1000):03d}") for _ in range(500)]
    values += [(None, "x"), (None, None)]
    df = spark.createDataFrame(values, "k bigint, v string").repartition(6)
    got = rank_in_group(df, "k", "v", "rank", block=block)
    assert rows(got) == expected_ranks(values)
    assert got.dtypes == [("k", "bigint"), ("v", "string"), ("rank", "bigint")]
