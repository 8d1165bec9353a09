"""Bulk tables: invoice history by id range, and the sale span per account."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from acctmart.operators.filters import IdRange, split_by_range
from acctmart.sources.extracts import TableMap, invoice_history, sale_spans


def invoice_chunks(tables: TableMap, ranges: Sequence[IdRange]) -> DataFrame:
    """Invoice history from one scan, with the number of the id range in ``chunk``.

    Write it partitioned by ``chunk`` to get one folder per range.
    """
    return split_by_range(invoice_history(tables), "id_fatura", ranges)


def invoice_union(
    tables: TableMap, ranges: Sequence[IdRange], one_per_invoice: bool = False
) -> DataFrame:
    """All ranges together. Ids in two ranges come twice unless ``one_per_invoice``."""
    rows = split_by_range(
        invoice_history(tables), "id_fatura", ranges, repeat=not one_per_invoice
    )
    return rows.drop("chunk")


def sale_span(tables: TableMap) -> DataFrame:
    """Last and first active sale per account, under the bulk load's names."""
    return sale_spans(tables).withColumnsRenamed(
        {"dt_ultima_compra": "dt_venda_max", "dt_primeira_compra": "dt_venda_min"}
    )
