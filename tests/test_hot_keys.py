"""One key holding a third of all rows is split over several tasks."""

from __future__ import annotations

import pytest
from helpers import final_plan, most_rows_of_a_task, table
from pyspark.sql import functions as F

from acctmart.operators import flags, groups, lookup, positions
from acctmart.operators.joins import splittable_join
from acctmart.plans.account_mart import account_mart
from acctmart.plans.customer_queue import new_customers
from acctmart.sources import extracts

ROWS = 120_000


@pytest.fixture
def hot(settings):
    """Thresholds scaled down to the test's data; no broadcast hides the shuffle."""
    settings(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.3",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.shuffle.partitions": "8",
        }
    )


def keyed(spark, rows=ROWS):
    """k = 7 in a third of the rows."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2000).alias("k"),
        F.col("id"),
        F.xxhash64("id").alias("payload"),
    )


def invoices(spark):
    return keyed(spark).selectExpr(
        "id AS id_fatura", "k AS id_conta", "timestamp'2024-02-03' AS dt_vencimento",
        "'S' AS fl_ativa", "'N' AS fl_envia_sms_directone",
        "CAST(abs(xxhash64(id) % 1000000000000000) + 1 AS DECIMAL(18,2)) AS vl_fatura",
    )


def accounts(spark):
    return spark.range(2000).selectExpr(
        "id AS id_conta", "string(id) AS nu_cpf_cnpj", "'A' AS ds_status_conta",
        "'L' AS nm_origem_comercial", "'C' AS ds_status_cartao",
        "'M' AS ds_motivo_bloqueio_cartao", "int(id % 20) AS id_produto",
        "'P' AS nm_produto", "0 AS nu_dias_atraso",
    )


def products(spark):
    return spark.range(20).selectExpr(
        "int(id) AS id_produto", "'P' AS ds_produto", "CAST(0 AS DECIMAL(18,2)) AS vl_faturamento_minimo"
    )


def test_join_to_a_grouped_side(spark, hot):
    right = spark.range(4000).selectExpr("id % 2000 AS k", "id AS v").groupBy("k").agg(F.max("v"))
    assert "skew=true" in final_plan(splittable_join(keyed(spark), right, ["k"], "left"))


def test_join_grouped_afterwards(spark, hot):
    right = spark.range(2000).selectExpr("id AS k", "id AS v")
    joined = splittable_join(keyed(spark), right, ["k"])
    assert "skew=true" in final_plan(joined.groupBy("k").agg(F.max("v")))


def test_key_types_must_agree(spark):
    right = spark.range(3).selectExpr("int(id) AS k")
    with pytest.raises(TypeError, match="differ"):
        splittable_join(keyed(spark, 10), right, ["k"])


def test_exists_flag(spark, hot):
    plans = spark.range(1000).withColumnRenamed("id", "k")
    df = flags.with_exists_flag(keyed(spark), "k", plans, "k", "flag")
    assert "skew=true" in final_plan(df)


def test_coverage_flags(spark, hot):
    people = keyed(spark).select(F.col("k").cast("string").alias("cpf"), "id", "payload")
    insured = spark.range(1000).selectExpr("string(id) AS cpf", "int(id % 5) AS id_produto")
    names = ["a", "b", "c"]
    df = flags.with_flags(people, "cpf", flags.coverage(insured, *names), "cpf", names)
    assert "skew=true" in final_plan(df)


def test_payment_totals_of_one_invoice_paid_from_many_accounts(spark, hot):
    payments = keyed(spark).select(
        F.col("k").alias("id_fatura"), F.col("id").alias("id_conta"),
        F.lit(1).alias("v"), F.current_date().alias("d"),
    )
    df = groups.key_totals(payments, "id_fatura", "id_conta", "v", "d")
    assert "skew=true" in final_plan(df)
    expected = sum(i % 3 == 0 or i % 2000 == 7 for i in range(ROWS))
    assert df.where("id_fatura = 7").agg(F.min("v"), F.count("*")).first() == (expected, expected)


def test_latest_invoice_above_minimum(spark, hot):
    tables = {
        "invoice": invoices(spark), "account": accounts(spark), "product": products(spark)
    }
    assert "skew=true" in final_plan(extracts.latest_invoices_above_minimum(tables))


def test_range_lookup_of_one_code(spark, hot):
    ranges = spark.range(100).selectExpr("id * 20 AS lo", "id * 20 + 24 AS hi", "id AS seq")
    df = lookup.range_lookup(keyed(spark), "k", ranges, "lo", "hi", "seq")
    assert "skew=true" in final_plan(df)


def test_ranks_of_one_group(spark, hot, settings):
    """No task of any stage, also before the checkpoint, has the group's 40,000 rows."""
    settings(
        {
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "32",
        }
    )
    got = []

    def work():
        ranked = positions.rank_in_group(keyed(spark), "k", "payload", "rank")
        got.append(ranked.where("k = 7").agg(F.count("*"), F.max("rank")).first())

    most = most_rows_of_a_task(spark, work)
    expected = sum(i % 3 == 0 or i % 2000 == 7 for i in range(ROWS))
    assert tuple(got[0]) == (expected, expected)
    assert 0 < most < expected * 0.75


def test_queue_of_one_account_registered_very_often(spark, hot):
    extracts_ = {
        "registrations": keyed(spark).selectExpr(
            "k AS id_conta", "'2024-01-30 ' || payload AS dtainclusao"
        ),
        "customers": accounts(spark).selectExpr("id_conta", "nu_cpf_cnpj AS cpf_cnpj"),
        "phones": accounts(spark).selectExpr("id_conta", "'11987654321' AS fone_celular"),
    }
    from datetime import date

    df = new_customers(extracts_, date(2024, 1, 30))
    plan = final_plan(df)
    assert plan.count("SortMergeJoin(skew=true)") >= 2
    assert "Broadcast" not in plan
    assert df.count() == ROWS


def test_account_mart(spark, hot):
    from datetime import date

    tables = {
        "invoice": invoices(spark),
        "account": accounts(spark),
        "product": products(spark),
        "payment": invoices(spark).selectExpr(
            "id_fatura", "id_conta", "dt_vencimento AS dt_pagamento", "vl_fatura AS vl_pagamento"
        ),
        "sale": invoices(spark).selectExpr("id_conta", "dt_vencimento AS dt_venda", "'A' AS fl_status"),
        "client": accounts(spark).selectExpr("id_conta", "'2020-01-01' AS dt_cadastro"),
        "instalment": accounts(spark).selectExpr("id_conta", "'A' AS fl_status"),
        "form_field": table(
            spark, "form_field", dict(id_campo=1, ds_codigo=extracts.TAX_ID_FIELD)
        ),
        "form_answer": accounts(spark).selectExpr(
            "1L AS id_campo", "id_conta AS id_adesao", "nu_cpf_cnpj AS vl_resposta"
        ),
        "enrolment": accounts(spark).selectExpr(
            "id_conta AS id_adesao", "'1' AS id_produto", "'ATIVA' AS ds_status"
        ),
    }
    df = account_mart(extracts.ACCOUNT_MART_EXTRACTS.run(tables, date(2024, 2, 1)))
    plan = final_plan(df)
    top = plan[: plan.index("SortMergeJoin") + 40]
    assert "SortMergeJoin(skew=true)" in top
    assert df.count() == ROWS
