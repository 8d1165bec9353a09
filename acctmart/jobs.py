"""The daily jobs: land the extracts, build the table, write it, load it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctmart.functions.clean import STRICT
from acctmart.operators.filters import IdRange, id_ranges
from acctmart.plans.account_mart import account_mart
from acctmart.plans.billed_mart import billed_mart
from acctmart.plans.customer_queue import customer_queue
from acctmart.plans.history import invoice_chunks, sale_span
from acctmart.sinks import land, load_jdbc, write_parquet
from acctmart.sources.catalog import Tables, load_parquet
from acctmart.sources.extracts import (
    ACCOUNT_MART_EXTRACTS,
    BILLED_MART_EXTRACTS,
    CUSTOMER_QUEUE_EXTRACTS,
    ExtractSet,
    TableMap,
)
from acctmart.sources.zones import Zones


@dataclass(frozen=True)
class Target:
    """A database table to load."""

    url: str
    table: str
    connections: int = 16
    properties: Mapping[str, str] = field(default_factory=dict)

    def load(self, df: DataFrame, replace: bool) -> bool:
        return load_jdbc(
            df, self.url, self.table, replace, self.connections, properties=self.properties
        )


def _landed(
    spark: SparkSession,
    extracts: ExtractSet,
    tables: TableMap,
    as_of: date | None,
    folder: str,
) -> Tables:
    """The extracts written to ``folder`` and read back, so that a retry starts there."""
    land(extracts.run(tables, as_of), extracts.names(), folder)
    return load_parquet(spark, folder, extracts.names())


def _publish(
    spark: SparkSession, df: DataFrame, path: str, target: Target | None, replace: bool
) -> int:
    """Write ``df`` and load the database from what was written."""
    written = write_parquet(df, path)
    if target is not None:
        target.load(spark.read.parquet(path), replace)
    return written


def run_account_mart(
    spark: SparkSession,
    tables: TableMap,
    zones: Zones,
    target: Target | None = None,
    as_of: date | None = None,
) -> int:
    """This month's account mart; the target is truncated first. Returns its rows."""
    landed = _landed(spark, ACCOUNT_MART_EXTRACTS, tables, as_of, f"{zones.lake}/account_mart")
    path = Zones.dataset(zones.processing, "account_mart")
    return _publish(spark, account_mart(landed), path, target, replace=True)


def run_billed_mart(
    spark: SparkSession,
    tables: TableMap,
    zones: Zones,
    target: Target | None = None,
    as_of: date | None = None,
    salt: str = "",
) -> int:
    """This month's billed mart; the target is truncated first. Returns its rows."""
    landed = _landed(spark, BILLED_MART_EXTRACTS, tables, as_of, f"{zones.lake}/billed_mart")
    path = Zones.dataset(zones.processing, "billed_mart")
    return _publish(spark, billed_mart(landed, salt), path, target, replace=True)


def run_customer_queue(
    spark: SparkSession,
    tables: TableMap,
    zones: Zones,
    start_id: int,
    target: Target | None = None,
    as_of: date | None = None,
    mode: str = STRICT,
    already_queued: DataFrame | None = None,
) -> int:
    """Newly registered customers, appended to the target. Returns the queued rows.

    Pass the rows already queued to leave those customers out.
    """
    landed = _landed(spark, CUSTOMER_QUEUE_EXTRACTS, tables, as_of, f"{zones.lake}/customer_queue")
    queue = customer_queue(landed, as_of, start_id, mode, already_queued)
    path = Zones.dataset(zones.processing, "customer_queue")
    return _publish(spark, queue, path, target, replace=False)


def ranges_of(df: DataFrame, id_name: str, count: int) -> list[IdRange]:
    """``count`` disjoint ranges of equal width between the table's least and greatest id."""
    found = df.agg(F.min(id_name).alias("least"), F.max(id_name).alias("most")).first()
    least, most = (found["least"] or 0), (found["most"] or 0)
    return id_ranges(least, (most - least) // count + 1, count)


def run_invoice_history(
    tables: TableMap, zones: Zones, ranges: Sequence[IdRange] | None = None, count: int = 10
) -> int:
    """Invoice history in the landing zone, one folder per id range.

    Unless given, the ranges divide the ids that the table has, so that every invoice is in
    one of them. Rows are sorted into tasks by id, so that a folder gets few files.
    """
    path = Zones.dataset(zones.landing, "invoice_history")
    ranges = ranges_of(tables["invoice"], "id_fatura", count) if ranges is None else ranges
    chunks = invoice_chunks(tables, ranges).repartitionByRange("chunk", "id_fatura")
    return write_parquet(chunks, path, partition_by=["chunk"])


def run_sale_span(tables: TableMap, zones: Zones) -> int:
    """Last and first active sale per account in the lake."""
    return write_parquet(sale_span(tables), Zones.dataset(zones.lake, "sale_span"))
