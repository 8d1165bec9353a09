"""Account mart: this month's invoices with payments, account, coverage and sale data."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.functions.clean import yes_no
from acctmart.operators.flags import coverage, with_exists_flag, with_flags
from acctmart.operators.groups import key_totals
from acctmart.schemas import ACCOUNT_MART, publish
from acctmart.sources.extracts import ACCOUNT_MART_EXTRACTS, TableMap


def with_payments(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Invoices left-joined with the payment totals of their id and account.

    Null accounts match each other here, which the marts' account join undoes. A plain
    comparison would have the optimizer drop them from the pairs but not from the totals,
    and so read the payments once for each.
    """
    paid = key_totals(
        payments, "id_fatura", "id_conta", "vlr_pago", "dt_pagamento_ult_fatura"
    ).withColumnsRenamed({"id_fatura": "_paid_fatura", "id_conta": "_paid_conta"})
    same = (F.col("id_fatura") == F.col("_paid_fatura")) & F.col("id_conta").eqNullSafe(
        F.col("_paid_conta")
    )
    return invoices.join(paid, same, "left").drop("_paid_fatura", "_paid_conta")


def invoice_lines(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct invoice facts per account, without the invoice id.

    The distinct is taken here, on the narrow rows and over all columns, so that one
    account's many invoices spread out and the wide result needs no distinct of its own.
    """
    return (
        with_payments(invoices, payments)
        .select(
            "id_conta",
            F.to_date("dt_vencimento_fatura").alias("dt_vencimento_fatura"),
            yes_no(F.col("fl_servico_sms")).alias("fl_servico_sms"),
            yes_no(F.col("fl_ativa")).alias("fl_fatura_ativa_mes"),
            "vlr_fatura",
            "vlr_pago",
            F.to_date("dt_pagamento_ult_fatura").alias("dt_pagamento_ult_fatura"),
        )
        .distinct()
    )


def account_profiles(extracts: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct account rows with everything that does not depend on the invoice.

    Joining per account first means the invoice rows are shuffled once for all of it. Every
    input is distinct before it is joined, hence so is the result. The billing minimum is
    not published but keeps rows apart, as two minimums of one product would.
    """
    minimums = extracts["products"].select("id_produto", "vl_faturamento_minimo").distinct()
    clients = (
        extracts["clients"]
        .select("id_conta", F.to_date("dt_cadastro").alias("dt_cadastro"))
        .distinct()
    )
    profiles = (
        extracts["accounts"]
        .distinct()
        .join(clients, "id_conta", "left")
        .join(extracts["sale_spans"], "id_conta", "left")
    )
    profiles = with_exists_flag(
        profiles,
        "id_conta",
        extracts["instalments"],
        "id_conta",
        "fl_possui_parcelamento_fatura",
        repeated_keys=False,
    )
    names = ["fl_possui_seguros", "fl_possui_odonto", "fl_possui_fatura_garantida"]
    covered = coverage(extracts["insurance"], *names)
    return with_flags(
        profiles.join(minimums, "id_produto"), "nu_cpf_cnpj", covered, "cpf", names
    ).withColumnRenamed("nu_cpf_cnpj", "id_pessoa")


def account_mart(extracts: Mapping[str, DataFrame]) -> DataFrame:
    """The 22-column mart from its extracts."""
    lines = invoice_lines(extracts["invoices"], extracts["payments"])
    return publish(lines.join(account_profiles(extracts), "id_conta"), ACCOUNT_MART)


def account_mart_from_tables(tables: TableMap, as_of: date | None = None) -> DataFrame:
    return account_mart(ACCOUNT_MART_EXTRACTS.run(tables, as_of))
