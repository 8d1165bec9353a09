"""Named extracts: what each plan takes from the source tables.

An extract is a function of the tables and the processing date. Every filter is written
so that it reaches the scan, and only the listed columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.operators.filters import as_of_column, in_month
from acctmart.operators.groups import above, key_span, latest_per_key
from acctmart.operators.joins import splittable_join
from acctmart.operators.lookup import attribute_by_code
from acctmart.schemas import typed_null
from acctmart.sources.catalog import Tables

TableMap = Mapping[str, DataFrame]
Extract = Callable[[TableMap, "date | None"], DataFrame]

# Which insurance enrolments count.
TAX_ID_FIELD = "contratante.dadosPessoais.cpf"
ENROLMENT_STATUSES = ("ATIVA", "PENDENTE_CONFIRMACAO_PROVEDOR", "INCONSISTENTE")
INSURANCE_PRODUCTS = ("1", "2", "3", "4", "5")
ACTIVE = "A"

# Invoice history columns, in order.
HISTORY_COLUMNS = [
    "id_fatura", "id_processamento", "id_conta", "id_ciclo", "id_fatura_anterior",
    "dt_processamento", "dt_vencimento", "fl_ativa", "fl_envia_email",
    "fl_realiza_impressao", "fl_envia_sms_directone", "vl_fatura",
    "vl_pagamento_minimo", "vl_total_pago", "dt_inclusao",
]


def products(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return tables["product"].select("ds_produto", "id_produto", "vl_faturamento_minimo")


def month_invoices(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Invoices due in the month of ``as_of``."""
    return (
        tables["invoice"]
        .where(in_month(F.col("dt_vencimento"), as_of))
        .select(
            "id_fatura",
            "id_conta",
            F.col("dt_vencimento").alias("dt_vencimento_fatura"),
            "fl_ativa",
            F.col("fl_envia_sms_directone").alias("fl_servico_sms"),
            F.col("vl_fatura").alias("vlr_fatura"),
        )
    )


def month_payments(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Payments made in the month of ``as_of``."""
    return (
        tables["payment"]
        .where(in_month(F.col("dt_pagamento"), as_of))
        .select(
            "id_fatura",
            "id_conta",
            F.col("dt_pagamento").alias("dt_pagamento_ult_fatura"),
            F.col("vl_pagamento").alias("vlr_pago"),
        )
    )


def latest_invoices_above_minimum(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Each account's latest invoice among those above its product's billing minimum."""
    minimums = (
        tables["account"]
        .select("id_conta", "id_produto")
        .join(tables["product"].select("id_produto", "vl_faturamento_minimo"), "id_produto")
    )
    invoices = tables["invoice"].select("id_fatura", "id_conta", "vl_fatura")
    billed = splittable_join(invoices, minimums, ["id_conta"])
    qualifying = above(billed, F.col("vl_fatura"), F.col("vl_faturamento_minimo"))
    return latest_per_key(qualifying, "id_conta", "id_fatura")


def _payments_of(tables: TableMap, invoices: DataFrame) -> DataFrame:
    """Payments of the given invoice ids."""
    return splittable_join(tables["payment"], invoices, ["id_fatura"]).select(
        "id_fatura",
        "id_conta",
        F.col("dt_pagamento").alias("dt_pagamento_ult_fatura"),
        F.col("vl_pagamento").alias("vlr_pago"),
    )


def payments_of_latest_invoice(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Payments of each account's latest qualifying invoice, matched by invoice id."""
    return _payments_of(tables, latest_invoices_above_minimum(tables).select("id_fatura"))


def payments_of_month_invoices(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Of ``payments_of_latest_invoice`` those for invoices due in the month of ``as_of``.

    The billed mart joins no others, so only one month's payments are totalled.
    """
    latest = latest_invoices_above_minimum(tables).select("id_fatura")
    due = month_invoices(tables, as_of).select("id_fatura").distinct()
    return _payments_of(tables, splittable_join(latest, due, ["id_fatura"], "left_semi"))


def of_month_accounts(df: DataFrame, tables: TableMap, as_of: date | None) -> DataFrame:
    """Rows of ``df`` whose account has an invoice due in the month of ``as_of``."""
    due = month_invoices(tables, as_of).select("id_conta").distinct()
    return splittable_join(df, due, ["id_conta"], "left_semi")


def month_sale_spans(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Last and first active sale of the month's accounts, over their whole history."""
    sales = of_month_accounts(tables["sale"].select("id_conta", "dt_venda", "fl_status"), tables, as_of)
    return sale_spans({"sale": sales})


def month_clients(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return of_month_accounts(clients(tables), tables, as_of)


def month_instalments(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return of_month_accounts(instalments(tables), tables, as_of)


def latest_invoices(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Highest invoice id per account, from the source's own view where it has one."""
    if "latest_invoice" in tables:
        return tables["latest_invoice"].select("id_conta", "id_fatura")
    return latest_per_key(tables["invoice"], "id_conta", "id_fatura")


def insurance(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Tax id and product of every counted enrolment."""
    return attribute_by_code(
        tables["form_field"],
        tables["form_answer"],
        tables["enrolment"],
        TAX_ID_FIELD,
        ENROLMENT_STATUSES,
        INSURANCE_PRODUCTS,
    )


def dependents(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return tables["dependent"].select("id_adesao_titular", "id_adesao_dependente")


def sale_spans(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Last and first active sale per account."""
    sales = tables["sale"].where(F.col("fl_status") == ACTIVE)
    return key_span(sales, "id_conta", "dt_venda", "dt_ultima_compra", "dt_primeira_compra")


def accounts(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return tables["account"].select(
        "id_conta",
        "nu_cpf_cnpj",
        F.col("ds_status_conta").alias("tx_status_conta"),
        F.col("nm_origem_comercial").alias("tx_loja_origem"),
        F.col("ds_status_cartao").alias("tx_status_cartao"),
        F.col("ds_motivo_bloqueio_cartao").alias("tx_motivo_bloqueio"),
        "id_produto",
        F.col("nm_produto").alias("tx_descricao_produto"),
        F.col("nu_dias_atraso").alias("qtd_dias_atraso"),
    )


def clients(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return tables["client"].select("id_conta", "dt_cadastro")


def client_statuses(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return tables["client"].select("id_conta", "nu_cpf_cnpj", "fl_status_conta")


def instalments(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Active instalment plans."""
    return tables["instalment"].where(F.col("fl_status") == ACTIVE).select("id_conta", "fl_status")


@dataclass(frozen=True)
class QueueLabels:
    """Constant columns of the customer queue. The two source labels name the card brand."""

    edi_source: str = "CARTAO"
    origem: str = "CARTAO"
    palavrachave: str = "CLIENTE"
    pais: str = "BRASIL"
    usuinclusao: str = "HIVE"
    tipo_integracao: str = "I"
    status_integracao: str = "F"


def customers(
    tables: TableMap, as_of: date | None = None, labels: QueueLabels = QueueLabels()
) -> DataFrame:
    """Customers in the queue's layout, before cleaning."""
    return tables["customer"].select(
        typed_null("bigint").alias("id_pessoa_fila"),
        F.lit(labels.edi_source).alias("edi_source"),
        F.col("nm_cliente").alias("nomerazao"),
        F.col("nm_cliente").alias("fantasia"),
        F.col("ds_email").alias("email"),
        F.lit(labels.palavrachave).alias("palavrachave"),
        F.lit(labels.pais).alias("pais"),
        F.col("cd_uf").alias("uf"),
        F.col("nm_bairro").alias("bairro"),
        F.col("nm_logradouro").alias("logradouro"),
        F.col("nu_cep").alias("cep"),
        F.col("nu_endereco").alias("nrologradouro"),
        F.col("nu_cpf_cnpj").alias("cpf_cnpj"),
        typed_null("bigint").alias("digcgccpf"),
        F.col("dt_nascimento").alias("dtanascfund"),
        F.lit(labels.origem).alias("origem"),
        F.lit(labels.usuinclusao).alias("usuinclusao"),
        F.col("fl_sexo").alias("sexo"),
        F.col("nm_cidade").alias("cidade"),
        F.col("fl_tipo_pessoa").alias("fisicajuridica"),
        F.col("nu_rg").alias("inscricaorg"),
        as_of_column(as_of).alias("data_selecao"),
        "id_conta",
        F.lit(labels.tipo_integracao).alias("tipo_integracao"),
        F.lit(labels.status_integracao).alias("status_integracao"),
    )


def registrations(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return tables["registration"].select(F.col("dt_cadastro").alias("dtainclusao"), "id_conta")


def phones(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return tables["phone"].select("id_conta", F.col("telefone_celular").alias("fone_celular"))


def postal_ranges(tables: TableMap, as_of: date | None = None) -> DataFrame:
    """Postal code ranges of towns that have a municipality code."""
    return (
        tables["postal_range"]
        .where(F.col("codmunicipio").isNotNull())
        .select("seqcidade", "cepinicial", "cepfinal", "cidade")
    )


def invoice_history(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return tables["invoice"].select(*HISTORY_COLUMNS)


@dataclass(frozen=True)
class ExtractSet:
    """The extracts of one plan, by name."""

    extracts: Mapping[str, Extract] = field(default_factory=dict)

    def run(self, tables: TableMap, as_of: date | None = None) -> Tables:
        """All extracts over the tables, opened when asked for."""
        return Tables(
            {n: lambda make=make: make(tables, as_of) for n, make in self.extracts.items()}
        )

    def names(self) -> Iterable[str]:
        return self.extracts.keys()


ACCOUNT_MART_EXTRACTS = ExtractSet(
    {
        "products": products,
        "invoices": month_invoices,
        "insurance": insurance,
        "sale_spans": month_sale_spans,
        "payments": month_payments,
        "accounts": accounts,
        "clients": month_clients,
        "instalments": month_instalments,
    }
)

BILLED_MART_EXTRACTS = ExtractSet(
    {
        "products": products,
        "invoices": month_invoices,
        "insurance": insurance,
        "payments": payments_of_month_invoices,
        "accounts": accounts,
        "client_statuses": client_statuses,
        "instalments": month_instalments,
    }
)

CUSTOMER_QUEUE_EXTRACTS = ExtractSet(
    {
        "customers": customers,
        "registrations": registrations,
        "phones": phones,
    }
)
