"""Billed mart: invoices above the billing minimum, with a hashed person id."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.functions.clean import person_hash, yes_no
from acctmart.operators.flags import coverage, with_exists_flag, with_flags
from acctmart.operators.groups import above
from acctmart.operators.joins import splittable_join
from acctmart.plans.account_mart import with_payments
from acctmart.schemas import BILLED_MART, publish
from acctmart.sources.extracts import BILLED_MART_EXTRACTS, TableMap


def billed_lines(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct invoices with their payment totals."""
    return (
        with_payments(invoices, payments)
        .select(
            "id_fatura",
            "id_conta",
            F.to_date("dt_vencimento_fatura").alias("dt_vencto"),
            F.col("vlr_fatura").alias("vl_fatura"),
            F.col("vlr_pago").alias("total_pago"),
            F.to_date("dt_pagamento_ult_fatura").alias("dt_ult_pagto"),
            yes_no(F.col("fl_servico_sms")).alias("fl_envia_sms_directone"),
            "fl_ativa",
        )
        .distinct()
    )


def billed_profiles(extracts: Mapping[str, DataFrame]) -> DataFrame:
    """Accounts with coverage, status and the lowest billing minimum that applies.

    An invoice above any of several minimums passes the filter, and equal rows are
    published once, so only the lowest minimum matters.
    """
    minimums = extracts["products"].groupBy("id_produto").agg(
        F.min("vl_faturamento_minimo").alias("vl_faturamento_minimo")
    )
    accounts = extracts["accounts"].select(
        "id_conta", "id_produto", "nu_cpf_cnpj", F.col("qtd_dias_atraso").alias("qtddiasatraso")
    )
    profiles = (
        splittable_join(accounts, minimums, ["id_produto"])
        .groupBy("id_conta", "nu_cpf_cnpj", "qtddiasatraso")
        .agg(F.min("vl_faturamento_minimo").alias("vl_faturamento_minimo"))
        .join(extracts["client_statuses"].distinct(), ["id_conta", "nu_cpf_cnpj"], "left")
    )
    profiles = with_exists_flag(
        profiles,
        "id_conta",
        extracts["instalments"],
        "id_conta",
        "fl_possui_parcelamento_fatura",
        repeated_keys=False,
    )
    names = ["flgPossuiSeguros", "flgPossuiOdonto", "flgPossuiFaturaGarantida"]
    covered = coverage(extracts["insurance"], *names)
    return with_flags(profiles, "nu_cpf_cnpj", covered, "cpf", names)


def billed_mart(extracts: Mapping[str, DataFrame], salt: str = "") -> DataFrame:
    """The 15-column mart from its extracts."""
    lines = billed_lines(extracts["invoices"], extracts["payments"])
    joined = lines.join(billed_profiles(extracts), "id_conta")
    billed = above(joined, F.col("vl_fatura"), F.col("vl_faturamento_minimo"))
    hashed = billed.withColumn("id_pessoa", person_hash(F.col("nu_cpf_cnpj"), salt))
    return publish(hashed, BILLED_MART)


def billed_mart_from_tables(
    tables: TableMap, as_of: date | None = None, salt: str = ""
) -> DataFrame:
    return billed_mart(BILLED_MART_EXTRACTS.run(tables, as_of), salt)
