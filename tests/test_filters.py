from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import rows, static_plan
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from acctmart.operators import filters


def test_month_includes_its_first_and_last_instant(spark):
    stamps = [
        datetime(2024, 1, 31, 23, 59, 59, 999999),
        datetime(2024, 2, 1),
        datetime(2024, 2, 29, 23, 59, 59, 999999),
        datetime(2024, 3, 1),
        datetime(2023, 2, 10),
        None,
    ]
    df = spark.createDataFrame([(s,) for s in stamps], "d timestamp_ntz")
    kept = df.where(filters.in_month(F.col("d"), date(2024, 2, 15)))
    assert [r[0] for r in rows(kept)] == stamps[1:3]


def test_month_defaults_to_today(spark):
    df = spark.sql("SELECT current_date() AS d UNION ALL SELECT add_months(current_date(), -1)")
    assert df.where(filters.in_month(F.col("d"), None)).count() == 1


def test_month_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.sql("SELECT timestamp_ntz'2024-02-01' AS d, 1 AS x").write.parquet(path)
    df = spark.read.parquet(path).where(filters.in_month(F.col("d"), date(2024, 2, 1)))
    plan = static_plan(df)
    assert "GreaterThanOrEqual(d,2024-02-01T00:00)" in plan
    assert "LessThan(d,2024-03-01T00:00)" in plan


def test_look_back_includes_its_first_day(spark):
    days = [date(2024, 1, 27), date(2024, 1, 28), date(2024, 1, 30), date(2024, 2, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = df.where(filters.since_days(F.col("d"), date(2024, 1, 30), 2))
    assert [r[0] for r in rows(kept)] == days[1:4]


@pytest.mark.parametrize("first,width,count", [(0, 1, 1), (0, 10, 3), (5, 7, 10), (-3, 2, 4)])
def test_generated_ranges_share_nothing_and_miss_nothing(spark, first, width, count):
    ranges = filters.id_ranges(first, width, count)
    assert filters.complete(ranges) and not filters.overlapping(ranges)
    wanted = list(range(first - 2, first + width * (count + 1)))
    ids = spark.createDataFrame([(i,) for i in [None, *wanted]], "i bigint")
    got = filters.split_by_range(ids, "i", ranges)
    kept = {r["i"]: r["chunk"] for r in got.collect()}
    assert got.count() == len(kept) and set(kept) == {None, *wanted}
    assert kept[None] == kept[first - 1] == 1
    assert set(kept.values()) == set(range(1, count + 1))


def test_empty_ranges_are_refused():
    with pytest.raises(ValueError):
        filters.id_ranges(0, 0, 3)


def test_historical_bounds_repeat_two_ids(spark):
    ends = sorted(
        {r.first for r in filters.HISTORY_RANGES}
        | {r.last for r in filters.HISTORY_RANGES if r.last is not None}
        | {25_000_000}
    )
    ids = spark.createDataFrame([(i,) for i in ends], "i bigint")
    got = filters.split_by_range(ids, "i", filters.HISTORY_RANGES)
    counts = {r["i"]: r["count"] for r in got.groupBy("i").count().collect()}
    assert sorted(i for i, n in counts.items() if n == 2) == [2176917, 2176918]
    assert set(ends) == set(counts)
    assert {r["i"]: r["chunk"] for r in got.collect()}[25_000_000] == 10
    once = filters.split_by_range(ids, "i", filters.HISTORY_RANGES, repeat=False)
    assert once.count() == len(ends)


@pytest.mark.parametrize("bad", [None, -1])
@pytest.mark.parametrize("repeat", [True, False])
def test_an_id_in_no_range_ends_the_job(spark, bad, repeat):
    ids = spark.createDataFrame([(5,), (bad,)], "i bigint")
    with pytest.raises(PySparkException, match="id in no range"):
        filters.split_by_range(ids, "i", filters.HISTORY_RANGES, repeat=repeat).collect()
    gap = [filters.IdRange(1, None, 4), filters.IdRange(2, 6, None)]
    assert not filters.complete(gap)
    with pytest.raises(PySparkException, match="id in no range: 5"):
        filters.split_by_range(ids, "i", gap, repeat=repeat).collect()


def test_range_texts_for_a_database():
    assert filters.jdbc_predicates("id", filters.id_ranges(0, 10, 3)) == [
        "(id <= 9 OR id IS NULL)", "id >= 10 AND id <= 19", "id >= 20",
    ]
    assert filters.jdbc_predicates("id", filters.id_ranges(0, 10, 1)) == ["1 = 1"]
