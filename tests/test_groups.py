from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from helpers import rows, static_plan, table
from pyspark.sql import functions as F

from acctmart.operators import flags, groups
from acctmart.sources import extracts

JAN, FEB = datetime(2024, 1, 5), datetime(2024, 2, 5)


def totals(df):
    return groups.key_totals(df, "id_fatura", "id_conta", "vl_pagamento", "dt_pagamento")


def test_totals_belong_to_the_invoice(spark):
    payments = table(
        spark,
        "payment",
        dict(id_fatura=1, id_conta=10, vl_pagamento=Decimal("1.50"), dt_pagamento=JAN),
        dict(id_fatura=1, id_conta=10, vl_pagamento=Decimal("2.25"), dt_pagamento=FEB),
        dict(id_fatura=1, id_conta=11, vl_pagamento=Decimal("0.25")),
        dict(id_fatura=2, id_conta=10),
        dict(id_fatura=None, id_conta=10, vl_pagamento=Decimal("9.00"), dt_pagamento=JAN),
        dict(id_fatura=3, id_conta=None, vl_pagamento=Decimal("5.00"), dt_pagamento=JAN),
    )
    assert rows(totals(payments)) == sorted(
        [
            (1, 10, Decimal("4.00"), FEB),
            (1, 11, Decimal("4.00"), FEB),
            (2, 10, Decimal("0.00"), None),
            (None, 10, None, None),
            (3, None, Decimal("5.00"), JAN),
        ],
        key=repr,
    )


def test_top_two_keeps_repeats_and_drops_null_keys(spark):
    phones = spark.createDataFrame(
        [(1, "a"), (1, "c"), (1, "b"), (2, "x"), (2, "x"), (3, "y"), (4, None), (4, "z"),
         (5, None), (None, "q"), (None, "r")],
        "k bigint, v string",
    )
    assert rows(groups.top_two(phones, "k", "v", "first", "second")) == [
        (1, "c", "b"), (2, "x", "x"), (3, "y", None), (4, "z", None), (5, None, None),
    ]


def test_top_two_limits_each_task_before_the_shuffle(spark):
    phones = spark.range(100).selectExpr("id % 5 AS k", "string(id) AS v")
    plan = static_plan(groups.top_two(phones, "k", "v", "a", "b"))
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.index("WindowGroupLimit") < exchange < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan[exchange:]


def test_exists_flag_neither_repeats_nor_drops_rows(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    right = spark.createDataFrame([(1,), (1,), (None,), (3,)], "k bigint")
    got = flags.with_exists_flag(left, "k", right, "k", "flag")
    assert rows(got) == sorted([(1, 1), (1, 1), (2, 0), (None, 0)], key=repr)


def test_coverage_in_one_pass(spark):
    insured = spark.createDataFrame(
        [("a", 3), ("a", 1), ("b", 2), ("c", 5), (None, 3)], "cpf string, id_produto int"
    )
    people = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "cpf string")
    names = ["some", "dental", "guaranteed"]
    got = flags.with_flags(people, "cpf", flags.coverage(insured, *names), "cpf", names)
    assert rows(got) == sorted(
        [("a", 1, 1, 1), ("b", 1, 0, 1), ("c", 1, 0, 0), ("d", 0, 0, 0), (None, 0, 0, 0)],
        key=repr,
    )


def test_product_text_is_compared_as_text_and_given_as_number(spark):
    tables = {
        "form_field": table(spark, "form_field", dict(id_campo=1, ds_codigo=extracts.TAX_ID_FIELD),
                            dict(id_campo=2, ds_codigo="other")),
        "form_answer": table(
            spark, "form_answer",
            dict(id_campo=1, id_adesao=7, vl_resposta="111"),
            dict(id_campo=2, id_adesao=7, vl_resposta="not a tax id"),
            dict(id_campo=1, id_adesao=8, vl_resposta="222"),
            dict(id_campo=1, id_adesao=9, vl_resposta="333"),
        ),
        "enrolment": table(
            spark, "enrolment",
            dict(id_adesao=7, id_produto="3", ds_status="ATIVA"),
            dict(id_adesao=8, id_produto="9", ds_status="ATIVA"),
            dict(id_adesao=9, id_produto="three", ds_status="ATIVA"),
            dict(id_adesao=8, id_produto="1", ds_status="CANCELADA"),
        ),
    }
    got = extracts.insurance(tables)
    assert rows(got) == [("111", 3)]
    assert dict(got.dtypes)["id_produto"] == "int"


def test_minimum_must_be_exceeded(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (3, None)], "v int, m int")
    assert rows(groups.above(df, F.col("v"), F.col("m"))) == [(2, 1)]


def test_span_and_latest(spark):
    df = spark.createDataFrame([(1, JAN), (1, FEB), (2, JAN)], "k int, d timestamp_ntz")
    assert rows(groups.key_span(df, "k", "d", "last", "first")) == [(1, FEB, JAN), (2, JAN, JAN)]
    ids = spark.createDataFrame([(1, 5), (1, 9), (2, 3)], "k int, i int")
    assert rows(groups.latest_per_key(ids, "k", "i")) == [(1, 9), (2, 3)]


def test_given_latest_invoices_are_preferred(spark):
    view = table(spark, "latest_invoice", dict(id_conta=1, id_fatura=4))
    invoices = table(spark, "invoice", dict(id_conta=1, id_fatura=9))
    assert rows(extracts.latest_invoices({"latest_invoice": view, "invoice": invoices})) == [(1, 4)]
    assert rows(extracts.latest_invoices({"invoice": invoices})) == [(1, 9)]
