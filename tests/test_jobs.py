from __future__ import annotations

import os
from datetime import date

import pytest
from helpers import rows

from acctmart import jobs
from acctmart.checks.domain import domain_tables
from acctmart.checks.registry import MART_DAY, QUEUE_DAY
from acctmart.plans.account_mart import account_mart_from_tables
from acctmart.sources.zones import Zones

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def zones(tmp_path):
    return Zones.under(str(tmp_path), "TEST")


@pytest.fixture
def tables(spark):
    return domain_tables(spark, FOLDER)


class RecordingTarget(jobs.Target):
    def load(self, df, replace):
        self.properties["loads"] = [*self.properties.get("loads", []), (df.count(), replace)]
        return True


def test_account_mart_job(spark, tables, zones):
    target = RecordingTarget("jdbc:x", "t", properties={})
    assert jobs.run_account_mart(spark, tables, zones, target, MART_DAY) == 13
    assert target.properties["loads"] == [(13, True)]
    written = spark.read.parquet(Zones.dataset(zones.processing, "account_mart"))
    assert rows(written) == rows(account_mart_from_tables(tables, MART_DAY))


def test_billed_mart_job(spark, tables, zones):
    assert jobs.run_billed_mart(spark, tables, zones, as_of=MART_DAY) == 10


def test_queue_job_run_twice(spark, tables, zones, tmp_path):
    target = RecordingTarget("jdbc:x", "t", properties={})
    assert jobs.run_customer_queue(spark, tables, zones, 1, target, QUEUE_DAY) == 17
    assert target.properties["loads"] == [(17, False)]
    queued = spark.read.parquet(Zones.dataset(zones.processing, "customer_queue"))
    kept = str(tmp_path / "queued.parquet")
    queued.write.parquet(kept)
    again = jobs.run_customer_queue(
        spark, tables, zones, 18, as_of=date(2024, 1, 31),
        already_queued=spark.read.parquet(kept),
    )
    assert again == 0


def test_bulk_jobs(spark, tables, zones):
    assert jobs.run_invoice_history(tables, zones) == 1500
    assert jobs.run_sale_span(tables, zones) == 145
    history = spark.read.parquet(Zones.dataset(zones.landing, "invoice_history"))
    assert history.select("id_processamento").distinct().count() == history.count() == 1500
    assert history.select("chunk").distinct().count() == 10
    folder = Zones.dataset(zones.landing, "invoice_history")
    files = [f for f in os.listdir(f"{folder}/chunk=5") if f.startswith("part-")]
    assert len(files) <= 2
