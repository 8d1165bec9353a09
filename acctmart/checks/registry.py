"""One query per operator, each over the whole of the tables it reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from acctmart import sinks
from acctmart.checks.domain import domain_tables, read_given
from acctmart.functions import clean
from acctmart.operators import filters, flags, groups, lookup, positions
from acctmart.plans import account_mart, billed_mart, customer_queue, history
from acctmart.sources import catalog, extracts
from acctmart.sources.extracts import TableMap

MART_DAY = date(1998, 10, 15)
QUEUE_DAY = date(2024, 1, 30)
QUEUE_START = 5000
CHUNK_WIDTH = 2000


def _plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form the results are compared in."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in decimals})


def _coverage_flags(t: TableMap) -> DataFrame:
    names = ["fl_possui_seguros", "fl_possui_odonto", "fl_possui_fatura_garantida"]
    covered = flags.coverage(extracts.insurance(t), *names)
    accounts = t["account"].select("id_conta", "nu_cpf_cnpj")
    return flags.with_flags(accounts, "nu_cpf_cnpj", covered, "cpf", names)


def _instalment_flag(t: TableMap) -> DataFrame:
    invoices = t["invoice"].select("id_fatura", "id_conta")
    return flags.with_exists_flag(
        invoices, "id_conta", extracts.instalments(t), "id_conta", "fl_possui_parcelamento_fatura"
    )


def _payment_totals(t: TableMap) -> DataFrame:
    return groups.key_totals(t["payment"], "id_fatura", "id_conta", "vl_pagamento", "dt_pagamento")


def _invoice_payments_left(t: TableMap) -> DataFrame:
    invoices = t["invoice"].select("id_fatura", "id_conta", "vl_fatura")
    return invoices.join(_payment_totals(t), ["id_fatura", "id_conta"], "left")


def _invoice_account_product(t: TableMap) -> DataFrame:
    return (
        t["invoice"]
        .select("id_fatura", "id_conta", "vl_fatura")
        .join(t["account"].select("id_conta", "id_produto", "nu_cpf_cnpj"), "id_conta")
        .join(extracts.products(t), "id_produto")
    )


def _invoices_above_minimum(t: TableMap) -> DataFrame:
    return groups.above(
        _invoice_account_product(t), F.col("vl_fatura"), F.col("vl_faturamento_minimo")
    ).select("id_fatura", "id_conta", "vl_fatura", "vl_faturamento_minimo")


def _account_sale_left(t: TableMap) -> DataFrame:
    accounts = t["account"].select("id_conta", "nu_cpf_cnpj")
    return accounts.join(extracts.sale_spans(t), "id_conta", "left")


def _account_status_left(t: TableMap) -> DataFrame:
    accounts = t["account"].select("id_conta", "nu_cpf_cnpj")
    return accounts.join(extracts.client_statuses(t), ["id_conta", "nu_cpf_cnpj"], "left")


def _phones_top2(t: TableMap) -> DataFrame:
    return groups.top_two(
        extracts.phones(t), "id_conta", "fone_celular", "fone_celular_1", "fone_celular_2"
    )


def _phone_split(t: TableMap) -> DataFrame:
    phone = F.col("fone_celular")
    return extracts.phones(t).select(
        "id_conta",
        "fone_celular",
        clean.area_code(phone).alias("foneddd"),
        clean.local_number(phone).alias("fonenro"),
    )


def _tax_id_split(t: TableMap) -> DataFrame:
    tax_id = F.col("nu_cpf_cnpj")
    return t["customer"].select(
        "id_conta",
        clean.check_digits(tax_id).alias("digcgccpf"),
        clean.tax_id_root(tax_id).alias("nrocgccpf"),
    )


def _address_truncate(t: TableMap) -> DataFrame:
    address = extracts.customers(t).select("id_conta", *customer_queue.TEXT_WIDTHS)
    return clean.truncate_columns(address, customer_queue.TEXT_WIDTHS)


def _date_parse(t: TableMap) -> DataFrame:
    return t["customer"].select(
        "id_conta", clean.parse_date(F.col("dt_nascimento")).alias("dtanascfund")
    )


def _recent_registrations(t: TableMap) -> DataFrame:
    recent = customer_queue.recent_registrations(extracts.registrations(t), QUEUE_DAY)
    return recent.select("id_conta", F.col("_day").alias("dtainclusao"))


def _yes_no_flags(t: TableMap) -> DataFrame:
    return t["invoice"].select(
        "id_fatura",
        clean.yes_no(F.col("fl_envia_sms_directone")).alias("fl_servico_sms"),
        clean.yes_no(F.col("fl_ativa")).alias("fl_fatura_ativa_mes"),
    )


def _person_hash(t: TableMap) -> DataFrame:
    return t["account"].select(
        "id_conta", clean.person_hash(F.col("nu_cpf_cnpj")).alias("id_pessoa")
    )


def _month_key(t: TableMap) -> DataFrame:
    return t["invoice"].select(
        "id_fatura", clean.month_key(F.col("dt_vencimento")).alias("month_key")
    )


def _dense_ids(t: TableMap) -> DataFrame:
    invoices = t["invoice"].select("id_fatura", "dt_vencimento")
    order = [F.asc("dt_vencimento"), F.asc("id_fatura")]
    return positions.assign_dense_ids(invoices, order, 1000, "id_fila")


def _postal_lookup(t: TableMap) -> DataFrame:
    accounts = t["customer"].select("id_conta", clean.text_to_long(F.col("nu_cep")).alias("cep"))
    return lookup.range_lookup(
        accounts, "cep", extracts.postal_ranges(t), "cepinicial", "cepfinal", "seqcidade"
    )


def _active_instalments(t: TableMap) -> DataFrame:
    return extracts.instalments(t).distinct()


def _distinct_rows(t: TableMap) -> DataFrame:
    return t["payment"].select("id_fatura", "id_conta").distinct()


def _chunks() -> list[filters.IdRange]:
    return filters.id_ranges(0, CHUNK_WIDTH, 10)


def _overlapping_chunks() -> list[filters.IdRange]:
    """Like the historical bounds: the first range ends on the second id of the next."""
    first, second, *rest = _chunks()
    return [replace(first, last=second.first + 1), second, *rest]


_CHUNK_COLUMNS = ["id_fatura", "id_conta", "dt_vencimento", "fl_ativa", "vl_fatura"]


def _invoice_chunks(t: TableMap) -> DataFrame:
    return history.invoice_chunks(t, _chunks())


def _chunk_overlap_union(t: TableMap) -> DataFrame:
    return history.invoice_union(t, _overlapping_chunks()).select(*_CHUNK_COLUMNS)


def _chunk_union_once(t: TableMap) -> DataFrame:
    whole = history.invoice_union(t, _overlapping_chunks(), one_per_invoice=True)
    return whole.select(*_CHUNK_COLUMNS)


def _rejected_registrations(t: TableMap) -> DataFrame:
    """Of the registrations some texts are taken away or made no date."""
    account = F.col("id_conta") % 5
    text = F.when(account == 0, None).when(account == 1, "sem data").otherwise(F.col("dtainclusao"))
    dirty = extracts.registrations(t).withColumn("dtainclusao", text)
    return customer_queue.rejected_registrations(dirty).select("id_conta", "dtainclusao")


def _rejected_values(t: TableMap) -> DataFrame:
    """Of the customers some birth dates and tax ids are made unreadable."""
    account = F.col("id_conta") % 7
    tax_id = F.col("cpf_cnpj")
    dirty = extracts.customers(t, QUEUE_DAY).withColumns(
        {
            "dtanascfund": F.when(account == 0, "?").otherwise(F.col("dtanascfund")),
            "cpf_cnpj": F.when(account == 1, "sem cpf")
            .when(account == 2, F.concat(tax_id, F.lit("-x")))
            .otherwise(tax_id),
        }
    )
    rejected = F.concat_ws(",", "rejected").alias("rejected")
    return customer_queue.rejected_values(dirty).select("id_conta", rejected)


def _only_new(t: TableMap) -> DataFrame:
    """Accounts whose tax id, at times null, is not among those of every third account."""
    tax_id = F.when(F.col("id_conta") % 4 != 0, F.col("nu_cpf_cnpj")).alias("cpf_cnpj")
    rows = t["account"].select("id_conta", tax_id)
    return sinks.only_new(rows, rows.where("id_conta % 3 = 0").select("cpf_cnpj"), ["cpf_cnpj"])


def _rename_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_given(spark, sf_dir, "supplier").toDF("0", "1", "2", "3")
    return catalog.rename_by_position(rows, ["Seqcidade", "Cidade", "Codmunicipio", "Saldo"])


_OVER_TABLES: dict[str, Callable[[TableMap], DataFrame]] = {
    "account_mart": lambda t: account_mart.account_mart_from_tables(t, MART_DAY),
    "account_mart_billed": lambda t: billed_mart.billed_mart_from_tables(t, MART_DAY),
    "customer_queue": lambda t: customer_queue.customer_queue_from_tables(
        t, QUEUE_DAY, QUEUE_START
    ),
    "sale_span": history.sale_span,
    "invoice_chunks": _invoice_chunks,
    "chunk_overlap_union": _chunk_overlap_union,
    "chunk_union_once": _chunk_union_once,
    "rejected_registrations": _rejected_registrations,
    "rejected_values": _rejected_values,
    "only_new": _only_new,
    "month_invoices": lambda t: extracts.month_invoices(t, MART_DAY),
    "month_payments": lambda t: extracts.month_payments(t, MART_DAY),
    "active_instalments": _active_instalments,
    "yes_no_flags": _yes_no_flags,
    "instalment_flag": _instalment_flag,
    "active_enrolments": extracts.insurance,
    "coverage_flags": _coverage_flags,
    "payment_totals": _payment_totals,
    "invoice_payments_left": _invoice_payments_left,
    "invoice_account_product": _invoice_account_product,
    "account_sale_left": _account_sale_left,
    "latest_invoice": extracts.latest_invoices,
    "invoices_above_minimum": _invoices_above_minimum,
    "latest_invoice_above_minimum": extracts.latest_invoices_above_minimum,
    "payments_of_latest_invoice": extracts.payments_of_latest_invoice,
    "account_status_left": _account_status_left,
    "distinct_rows": _distinct_rows,
    "person_hash": _person_hash,
    "phone_rank": lambda t: positions.rank_in_group(
        extracts.phones(t), "id_conta", "fone_celular", "rank"
    ),
    "phones_top2": _phones_top2,
    "phone_split": _phone_split,
    "tax_id_split": _tax_id_split,
    "address_truncate": _address_truncate,
    "date_parse": _date_parse,
    "recent_registrations": _recent_registrations,
    "customer_base": lambda t: extracts.customers(t, QUEUE_DAY),
    "account_profile": extracts.accounts,
    "month_key": _month_key,
    "dense_ids": _dense_ids,
    "postal_ranges": extracts.postal_ranges,
    "postal_lookup": _postal_lookup,
    "dependents": extracts.dependents,
}


def _over_tables(build: Callable[[TableMap], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain_numbers(build(domain_tables(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _over_tables(build) for name, build in _OVER_TABLES.items()} | {
        "rename_by_position": _rename_by_position
    }
