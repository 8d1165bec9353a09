from __future__ import annotations

import random

import pytest
from helpers import final_plan, rows, static_plan
from pyspark.errors import PySparkException

from acctmart.operators.lookup import _blocks, range_lookup


def look_up(spark, codes, ranges):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, cep bigint")
    rng = spark.createDataFrame(ranges, "lo bigint, hi bigint, seq bigint")
    return range_lookup(df, "cep", rng, "lo", "hi", "seq")


def brute_force(codes, ranges):
    out = []
    for i, code in enumerate(codes):
        held = [
            s for lo, hi, s in ranges
            if None not in (code, lo, hi) and lo <= code <= hi
        ]
        out.append((i, code, min(held) if held else None))
    return sorted(out, key=repr)


def test_overlaps_bounds_wide_ranges_and_gaps(spark):
    ranges = [
        (100, 199, 5), (150, 250, 3), (250, 250, 9), (0, 10**9, 50), (10**9 + 5, 10**9 + 5, 1),
        (300, 200, 2), (None, 5, 4), (7, None, 4), (16, 31, 40), (15, 32, 45),
    ]
    codes = [0, 15, 16, 31, 32, 99, 100, 149, 150, 199, 200, 250, 251, 10**9, 10**9 + 1,
             10**9 + 5, None, 150, 150, -1]
    assert rows(look_up(spark, codes, ranges)) == brute_force(codes, ranges)


def test_random_ranges_agree_with_brute_force(spark):
    rng = random.Random(11)
    ranges = []
    for seq in range(300):
        low = rng.randrange(-2000, 90_000)
        ranges.append((low, low + rng.choice([0, 1, 15, 16, 17, 255, 256, 5000, 70_000]), seq))
    rng.shuffle(ranges)
    codes = [rng.randrange(-3000, 170_000) for _ in range(1500)]
    assert rows(look_up(spark, codes, ranges)) == brute_force(codes, ranges)


def test_ranges_open_at_either_end(spark):
    top, bottom = 2**63 - 1, -(2**63)
    ranges = [(0, top, 9), (bottom, -5, 8), (2**61, top, 3), (bottom, top, 20)]
    codes = [0, -1, -5, -6, 2**60, 2**60 - 1, 2**61 - 1, 2**61, 2**62 - 1, 1 - 2**62]
    assert rows(look_up(spark, codes, ranges)) == brute_force(codes, ranges)


def test_codes_at_both_ends_of_the_numbers(spark):
    top, bottom = 2**63 - 1, -(2**63)
    ranges = [
        (top, top, 9), (bottom, bottom, 8), (top - 20, top, 12), (bottom, bottom + 33, 11),
        (bottom, top, 20), (2**62, top, 15), (bottom, -(2**62), 14), (5, 4, 1),
    ]
    codes = [top, top - 1, top - 20, top - 21, bottom, bottom + 1, bottom + 33, bottom + 34,
             2**62, 2**62 - 1, -(2**62), 1 - 2**62, 0]
    assert rows(look_up(spark, codes, ranges)) == brute_force(codes, ranges)


def test_codes_given_as_text(spark):
    df = spark.createDataFrame([("00000012",), ("x",), ("",), (None,)], "cep string")
    ranges = spark.createDataFrame([(10, 20, 3)], "lo bigint, hi bigint, seq bigint")
    got = range_lookup(df, "cep", ranges, "lo", "hi", "seq", mode="lenient")
    assert rows(got) == sorted([("00000012", 3), ("x", None), ("", None), (None, None)], key=repr)
    with pytest.raises(PySparkException, match="not a number"):
        range_lookup(df, "cep", ranges, "lo", "hi", "seq").collect()


def test_no_ranges_and_no_codes(spark):
    assert rows(look_up(spark, [1, None], [])) == [(0, 1, None), (1, None, None)]
    assert rows(look_up(spark, [], [(1, 2, 3)])) == []


def test_blocks_tile_a_range_exactly(spark):
    for low, high in [(0, 0), (5, 300), (16, 31), (1, 70_000), (4095, 4097), (-40, 20)]:
        ranges = spark.createDataFrame([(low, high, 1)], "lo bigint, hi bigint, v bigint")
        covered = []
        blocks = _blocks(ranges, "lo", "hi", "v").collect()
        for b in blocks:
            size = 16 ** b["level"]
            covered += range(b["block"] * size, (b["block"] + 1) * size)
        assert sorted(covered) == list(range(low, high + 1))
        assert len(blocks) <= 30 * 5


def test_plan_has_no_nested_loop(spark):
    df = look_up(spark, [1, 2, 3], [(0, 10, 1)])
    for plan in (static_plan(df), final_plan(df)):
        assert "NestedLoop" not in plan and "Cartesian" not in plan
