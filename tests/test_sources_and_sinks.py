from __future__ import annotations

from datetime import date

import pytest
from helpers import rows, static_plan, table
from pyspark.sql import Observation
from pyspark.sql import functions as F

from acctmart import sinks
from acctmart.checks.domain import domain_tables
from acctmart.operators.filters import HISTORY_RANGES, id_ranges
from acctmart.plans import history
from acctmart.plans.account_mart import account_mart, account_mart_from_tables
from acctmart.schemas import TABLES
from acctmart.session import recommended_conf, shuffle_partitions_for
from acctmart.sources import catalog
from acctmart.sources.extracts import ACCOUNT_MART_EXTRACTS
from acctmart.sources.zones import Zones


def test_zones_differ_by_environment():
    live, dev = Zones.under("s3a://base/"), Zones.under("s3a://base", "TEST")
    assert live.lake == "s3a://base/lake" and dev.lake == "s3a://base/lake-dev"
    assert len({live.landing, live.lake, live.processing, live.curated}) == 4
    assert Zones.dataset(live.lake, "crm", "sales") == "s3a://base/lake/crm/sales.parquet"


def test_written_parquet_is_gzip_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert sinks.write_parquet(spark.range(10), path) == 10
    assert sinks.write_parquet(spark.range(3), path, files=1) == 3
    assert spark.read.parquet(path).count() == 3
    names = [f.name for f in (tmp_path / "t.parquet").glob("part-*")]
    assert len(names) == 1 and names[0].endswith(".gz.parquet")


def test_history_is_written_by_chunk(spark, tmp_path):
    invoices = table(spark, "invoice", *[dict(id_fatura=i) for i in (1, 2176917, 2176918, 9**9)])
    path = str(tmp_path / "history.parquet")
    chunks = history.invoice_chunks({"invoice": invoices}, HISTORY_RANGES)
    assert sinks.write_parquet(chunks, path, partition_by=["chunk"]) == 6
    assert sorted(f.name for f in (tmp_path / "history.parquet").glob("chunk=*")) == [
        "chunk=1", "chunk=10", "chunk=2",
    ]
    union = history.invoice_union({"invoice": invoices}, HISTORY_RANGES, one_per_invoice=True)
    assert union.count() == 4 and "chunk" not in union.columns


def test_catalog_lists_and_types_a_folder(spark, tmp_path):
    base = str(tmp_path)
    spark.sql("SELECT '5' AS ID_CONTA, 7L AS id_fatura").write.parquet(f"{base}/latest_invoice.parquet")
    spark.sql("SELECT 1 AS Other").write.parquet(f"{base}/notes.parquet")
    (tmp_path / "readme.txt").write_text("not a dataset")
    assert catalog.list_datasets(spark, base) == ["latest_invoice", "notes"]
    tables = catalog.load_parquet(spark, base)
    assert tables["latest_invoice"].dtypes == [("id_conta", "bigint"), ("id_fatura", "bigint")]
    assert tables["notes"].columns == ["other"]
    tables.create_views()
    assert rows(catalog.query_catalog(spark, "SELECT id_conta AS CONTA FROM latest_invoice")) == [(5,)]
    assert len(tables) == 2 and set(tables) == {"latest_invoice", "notes"}


def test_tables_of_the_session_catalog(spark):
    spark.sql("SELECT 1L AS ID_CONTA, 'A' AS FL_STATUS").createOrReplaceTempView("some_plans")
    tables = catalog.load_catalog(spark, {"instalment": "some_plans"})
    assert rows(tables["instalment"]) == [(1, "A")]
    assert "sale" not in tables


def test_rename_by_position(spark):
    df = spark.sql("SELECT 1 AS `0`, 2 AS `1`")
    assert catalog.rename_by_position(df, ["First", "SECOND"]).columns == ["first", "second"]
    with pytest.raises(ValueError):
        catalog.rename_by_position(df, ["one"])


def test_plan_runs_from_landed_extracts(spark, tmp_path):
    as_of = date(1998, 10, 15)
    tables = domain_tables(spark, "/root/testdata/sf0.001")
    landed = ACCOUNT_MART_EXTRACTS.run(tables, as_of)
    counts = sinks.land(landed, ACCOUNT_MART_EXTRACTS.names(), str(tmp_path))
    assert counts["invoices"] == 13 and set(counts) == set(landed)
    again = catalog.load_parquet(spark, str(tmp_path))
    assert rows(account_mart(again)) == rows(account_mart_from_tables(tables, as_of))


def test_only_new_makes_a_repeated_load_add_nothing(spark):
    queue = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, k string")
    target = spark.createDataFrame([(9, "a"), (9, "a")], "i int, k string")
    assert rows(sinks.only_new(queue, target, ["k"]).select("i")) == [(2,), (3,)]
    with_null = target.union(spark.createDataFrame([(9, None)], "i int, k string"))
    assert rows(sinks.only_new(queue, with_null, ["k"]).select("i")) == [(2,)]
    assert sinks.only_new(queue, queue, ["i", "k"]).isEmpty()
    assert sinks.only_new(queue.where("k = 'a'"), target, ["k"]).isEmpty()


def test_counts_are_observed_during_the_run(spark):
    seen, rejects = Observation(), Observation()
    df = sinks.with_row_count(spark.range(7), seen)
    sinks.with_reject_count(df, rejects, F.col("id") > 4).collect()
    assert seen.get == {"rows": 7}
    assert rejects.get == {"rejects": 2, "rows": 7}


class RecordingWriter:
    """Stands in for a DataFrameWriter: no database is started for tests."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **values):
        self.calls["options"] = values
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def save(self):
        self.calls["saved"] = True


class FakeFrame:
    def __init__(self, empty):
        self.write, self._empty = RecordingWriter(), empty

    def isEmpty(self):
        return self._empty


def test_appending_load():
    df = FakeFrame(empty=False)
    assert sinks.load_jdbc(df, "jdbc:x", "t", connections=4, properties={"user": "u"})
    assert df.write.calls == {
        "format": "jdbc",
        "options": {
            "user": "u", "url": "jdbc:x", "dbtable": "t", "batchsize": 10000, "numPartitions": 4,
        },
        "mode": "append",
        "saved": True,
    }


def test_replacing_load_truncates_even_when_empty():
    df = FakeFrame(empty=True)
    assert sinks.load_jdbc(df, "jdbc:x", "t", replace=True)
    assert df.write.calls["mode"] == "overwrite" and df.write.calls["options"]["truncate"] is True


def test_empty_result_appends_nothing():
    df = FakeFrame(empty=True)
    assert not sinks.load_jdbc(df, "jdbc:x", "t")
    assert df.write.calls == {}


def test_database_reads_refuse_overlapping_ranges(spark):
    with pytest.raises(ValueError, match="overlap"):
        catalog.read_database_table(
            spark, "jdbc:x", "t", id_name="i", ranges=HISTORY_RANGES
        )
    with pytest.raises(ValueError, match="leave ids out"):
        catalog.read_database_table(spark, "jdbc:x", "t", id_name="i", ranges=HISTORY_RANGES[2:])
    with pytest.raises(ValueError, match="id column"):
        catalog.read_database_table(spark, "jdbc:x", "t", ranges=id_ranges(0, 5, 2))


class FakeSession:
    """Stands in for a session with a database driver; records what is asked of it."""

    def __init__(self, result):
        self.result, self.asked = result, {}
        self.read = self

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **values):
        self.asked["options"] = values
        return self

    def load(self):
        return self.result

    def jdbc(self, url, table, **values):
        self.asked["jdbc"] = (url, table, values)
        return self.result


def test_database_queries_and_tables(spark):
    fake = FakeSession(spark.sql("SELECT 1 AS SeqCidade"))
    got = catalog.query_database(fake, "jdbc:x", "select 1", {"user": "u"})
    assert got.columns == ["seqcidade"]
    assert fake.asked == {
        "format": "jdbc", "options": {"url": "jdbc:x", "query": "select 1", "user": "u"},
    }
    assert catalog.read_database_table(fake, "jdbc:x", "towns@link").columns == ["seqcidade"]
    assert fake.asked["jdbc"] == ("jdbc:x", "towns@link", {"properties": {}})
    catalog.read_database_table(
        fake, "jdbc:x", "t", id_name="i", ranges=id_ranges(0, 5, 2)
    )
    assert fake.asked["jdbc"][2]["predicates"] == ["(i <= 4 OR i IS NULL)", "i >= 5"]
    catalog.query_database(fake, "jdbc:x", "select 1 i", id_name="i", ranges=id_ranges(0, 5, 2))
    assert fake.asked["jdbc"][:2] == ("jdbc:x", "(select 1 i) ranged")
    assert len(fake.asked["jdbc"][2]["predicates"]) == 2


def test_preview_prints_rows(spark, capsys):
    sinks.preview(spark.range(100), 2)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_scans_read_only_the_columns_of_the_query(spark, tmp_path):
    spark.createDataFrame([], TABLES["invoice"]).write.parquet(str(tmp_path / "invoice.parquet"))
    tables = catalog.load_parquet(spark, str(tmp_path), ["invoice"])
    from acctmart.sources.extracts import month_invoices

    plan = static_plan(month_invoices(tables, date(2024, 2, 1)))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PushedFilters: [IsNotNull(dt_vencimento), GreaterThanOrEqual(dt_vencimento" in scan
    assert "vl_pagamento_minimo" not in scan and "id_ciclo" not in scan


def test_session_settings_follow_the_data():
    assert shuffle_partitions_for(0, 16) == 16
    assert shuffle_partitions_for(10 * 2**40, 8000) == 81920
    assert recommended_conf(2**30, 4)["spark.sql.shuffle.partitions"] == "8"
