"""Names, order and types of the published tables, also from empty inputs."""

from __future__ import annotations

import pytest
from helpers import rows, table
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from acctmart import schemas
from acctmart.checks.domain import domain_tables
from acctmart.checks.registry import MART_DAY, QUEUE_DAY
from acctmart.operators.filters import HISTORY_RANGES
from acctmart.plans import account_mart, billed_mart, customer_queue, history
from acctmart.plans.customer_queue import clean_customers, recent_registrations
from acctmart.sources import extracts
from acctmart.sources.extracts import HISTORY_COLUMNS

FOLDER = "/root/testdata/sf0.001"

PLANS = {
    "account_mart": (
        lambda t: account_mart.account_mart_from_tables(t, MART_DAY), schemas.ACCOUNT_MART, 22
    ),
    "billed_mart": (
        lambda t: billed_mart.billed_mart_from_tables(t, MART_DAY), schemas.BILLED_MART, 15
    ),
    "customer_queue": (
        lambda t: customer_queue.customer_queue_from_tables(t, QUEUE_DAY, 1),
        schemas.CUSTOMER_QUEUE,
        30,
    ),
}


def kinds(schema):
    return [(f.name, f.dataType.simpleString().replace("_ntz", "")) for f in schema]


@pytest.fixture(scope="module")
def empty_tables(spark):
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.TABLES.items()}


def test_domain_tables_have_the_fixed_types(spark):
    tables = domain_tables(spark, FOLDER)
    for name in tables:
        assert kinds(tables[name].schema) == kinds(schemas.TABLES[name])


@pytest.mark.parametrize("name", PLANS)
def test_contract(spark, empty_tables, name):
    build, schema, width = PLANS[name]
    assert len(schema) == width
    for tables in (empty_tables, domain_tables(spark, FOLDER)):
        assert kinds(build(tables).schema) == kinds(schema)


@pytest.mark.parametrize("name", PLANS)
def test_empty_inputs_give_empty_outputs(empty_tables, name):
    assert PLANS[name][0](empty_tables).count() == 0


def test_flags_are_zero_or_one(spark):
    mart = account_mart.account_mart_from_tables(domain_tables(spark, FOLDER), MART_DAY)
    names = [c for c in mart.columns if c.startswith("fl_")]
    assert len(names) == 6
    for name in names:
        assert mart.where(f"{name} IS NULL OR {name} NOT IN (0, 1)").count() == 0


def test_sale_span_and_history_columns(empty_tables):
    assert history.sale_span(empty_tables).columns == ["id_conta", "dt_venda_max", "dt_venda_min"]
    chunks = history.invoice_chunks(empty_tables, HISTORY_RANGES)
    assert chunks.columns == [*HISTORY_COLUMNS, "chunk"]
    assert len(HISTORY_COLUMNS) == 15


def test_customer_extract_has_25_columns_and_typed_nulls(empty_tables):
    got = extracts.customers(empty_tables, QUEUE_DAY)
    assert len(got.columns) == 25
    kept = dict(got.dtypes)
    assert kept["id_pessoa_fila"] == kept["digcgccpf"] == "bigint"
    assert kept["data_selecao"] == "date"


def test_source_labels_are_settings(empty_tables, spark):
    one = {"customer": table(spark, "customer", dict(id_conta=1, nm_cliente="N"))}
    labels = extracts.QueueLabels(edi_source="ABC", origem="ABC")
    row = extracts.customers(one, QUEUE_DAY, labels).first()
    assert (row["edi_source"], row["origem"], row["nomerazao"], row["fantasia"]) == (
        "ABC", "ABC", "N", "N",
    )


def test_lenient_queue_keeps_rows_with_bad_values(spark):
    tables = {
        "customer": table(
            spark, "customer",
            dict(id_conta=1, nu_cpf_cnpj="12X45678901", dt_nascimento="1980-99-01"),
            dict(id_conta=2, nu_cpf_cnpj="", dt_nascimento=None),
        ),
        "registration": table(
            spark, "registration",
            dict(id_conta=1, dt_cadastro="2024-01-30"), dict(id_conta=2, dt_cadastro="2024-01-29"),
            dict(id_conta=1, dt_cadastro="yesterday"), dict(id_conta=1, dt_cadastro=None),
        ),
        "phone": table(spark, "phone", dict(id_conta=1), dict(id_conta=2, telefone_celular="11987654321")),
    }
    queue = customer_queue.customer_queue_from_tables(tables, QUEUE_DAY, 1, mode="lenient")
    got = rows(queue.select("id_pessoa_fila", "digcgccpf", "nrocgccpf", "dtanascfund", "foneddd1"))
    assert got == [(1, 1, None, None, ""), (2, None, None, None, "11")]

    extracts_ = customer_queue.CUSTOMER_QUEUE_EXTRACTS.run(tables, QUEUE_DAY)
    rejected = customer_queue.rejected_registrations(extracts_["registrations"])
    assert rows(rejected) == [("yesterday", 1), (None, 1)]
    found = customer_queue.rejected_values(extracts_["customers"])
    assert rows(found.select("id_conta", "rejected")) == [(1, ["dtanascfund", "nrocgccpf"])]


def test_two_registrations_on_one_day_both_stay(spark):
    tables = {
        "customer": table(
            spark, "customer", dict(id_conta=1, nu_cpf_cnpj="12345678901", dt_nascimento="1980-01-01")
        ),
        "registration": table(
            spark, "registration",
            dict(id_conta=1, dt_cadastro="2024-01-30 08:00:00"),
            dict(id_conta=1, dt_cadastro="2024-01-30 09:00:00"),
            dict(id_conta=1, dt_cadastro="2024-01-30 09:00:00"),
        ),
        "phone": table(spark, "phone", dict(id_conta=1, telefone_celular="11987654321")),
    }
    queue = customer_queue.customer_queue_from_tables(tables, QUEUE_DAY, 10)
    assert [r["id_pessoa_fila"] for r in queue.orderBy("id_pessoa_fila").collect()] == [10, 11]


def test_texts_are_cut_to_the_target_widths(spark):
    df = spark.createDataFrame(
        [("b" * 99, "c" * 99, "l" * 99)], "bairro string, cidade string, logradouro string"
    )
    base = df.select(
        "*",
        *[F.lit(None).cast("string").alias(c) for c in
          ("dtainclusao", "dtanascfund", "cpf_cnpj", "fone_celular_1", "fone_celular_2")],
        F.lit(None).cast("date").alias("_day"),
    )
    row = clean_customers(base).first()
    assert [len(row[c]) for c in ("bairro", "cidade", "logradouro")] == [50, 30, 80]


def test_recency_includes_the_second_day_back(spark):
    registered = spark.createDataFrame(
        [(1, "2024-01-27 23:59:59"), (2, "2024-01-28 00:00:00"), (3, "2024-02-05")],
        "id_conta bigint, dtainclusao string",
    )
    got = recent_registrations(registered, QUEUE_DAY)
    assert [r["id_conta"] for r in got.orderBy("id_conta").collect()] == [2, 3]


@pytest.mark.parametrize("text", [None, "yesterday", ""])
def test_strict_mode_stops_at_a_registration_without_a_date(spark, text):
    rows_ = spark.createDataFrame([(1, text), (2, "2024-01-30")], "id_conta bigint, dtainclusao string")
    with pytest.raises(PySparkException):
        recent_registrations(rows_, QUEUE_DAY).collect()
    assert recent_registrations(rows_, QUEUE_DAY, "lenient").count() == 1
    assert customer_queue.rejected_registrations(rows_).count() == 1


def test_published_timestamps_have_one_kind(spark):
    for kind in ("timestamp", "timestamp_ntz"):
        span = spark.sql(f"SELECT CAST('2024-01-30 10:00:00' AS {kind}) AS t")
        schema = schemas._struct(t=schemas.WALL_CLOCK)
        assert schemas.publish(span, schema).dtypes == [("t", "timestamp_ntz")]


def test_conform_accepts_any_case_and_reports_missing_columns(spark):
    df = spark.createDataFrame([("1", 2)], "ID_CONTA string, Id_Fatura bigint")
    got = schemas.conform(df, schemas.TABLES["latest_invoice"])
    assert got.dtypes == [("id_conta", "bigint"), ("id_fatura", "bigint")]
    with pytest.raises(ValueError, match="vl_pagamento"):
        schemas.conform(df, schemas.TABLES["payment"])
