"""The plans against their step-by-step SQL on small random tables.

The tables repeat keys and whole rows, leave values null and miss join partners, which
the clean test data never does.
"""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from helpers import table

from acctmart.checks import oracle
from acctmart.checks.registry import MART_DAY, QUEUE_DAY
from acctmart.plans import account_mart, billed_mart, customer_queue
from acctmart.schemas import TABLES
from acctmart.sources.extracts import TAX_ID_FIELD

# Name of the SQL view that stands for each table, where it differs.
VIEW = {"customer": "client_row", "postal_range": "postal"}
DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "decimal(18,2)": "DECIMAL(18,2)",
}


def random_tables(rng: random.Random) -> dict[str, list[dict]]:
    def maybe(value, share=0.1):
        return None if rng.random() < share else value

    def account_id():
        return maybe(rng.randrange(8), 0.05)

    def money():
        return maybe(Decimal(rng.randrange(0, 400)) / 4)

    def moment(first, days):
        start = datetime.fromisoformat(first)
        return maybe(start + timedelta(days=rng.randrange(days), hours=rng.choice([0, 0, 9])))

    def tax_id():
        return maybe(f"{rng.randrange(6):011d}")

    def repeat(make, n):
        made = [make() for _ in range(n)]
        return made + [dict(rng.choice(made)) for _ in range(n // 4)]

    return {
        "invoice": repeat(lambda: dict(
            id_fatura=maybe(rng.randrange(25)), id_conta=account_id(),
            dt_vencimento=moment("1998-09-25", 45), fl_ativa=maybe(rng.choice("SN")),
            fl_envia_sms_directone=maybe(rng.choice("SN")), vl_fatura=money()), 60),
        "payment": repeat(lambda: dict(
            id_fatura=maybe(rng.randrange(25)), id_conta=account_id(),
            dt_pagamento=moment("1998-09-25", 45), vl_pagamento=maybe(money(), 0.3)), 60),
        "account": repeat(lambda: dict(
            id_conta=account_id(), nu_cpf_cnpj=tax_id(), ds_status_conta=maybe("A"),
            nm_origem_comercial="L", ds_status_cartao=maybe(rng.choice("XY")),
            ds_motivo_bloqueio_cartao=maybe("M", 0.5), id_produto=maybe(rng.randrange(4)),
            nm_produto="P", nu_dias_atraso=maybe(rng.randrange(2))), 12),
        "product": repeat(lambda: dict(
            id_produto=maybe(rng.randrange(4)), ds_produto="P",
            vl_faturamento_minimo=maybe(Decimal(rng.randrange(80)))), 6),
        "sale": repeat(lambda: dict(
            id_conta=account_id(), dt_venda=moment("1998-01-01", 300),
            fl_status=rng.choice("AC")), 20),
        "instalment": repeat(lambda: dict(
            id_conta=account_id(), fl_status=rng.choice("AQ")), 8),
        "client": repeat(lambda: dict(
            id_conta=account_id(), dt_cadastro=maybe(f"2001-02-{rng.randrange(1, 4):02d}"),
            nu_cpf_cnpj=tax_id(), fl_status_conta=maybe(rng.choice("AB"))), 8),
        "form_field": [
            dict(id_campo=1, ds_codigo=TAX_ID_FIELD), dict(id_campo=2, ds_codigo="x"),
            dict(id_campo=3, ds_codigo=TAX_ID_FIELD),
        ],
        "form_answer": repeat(lambda: dict(
            id_campo=rng.randrange(1, 4), id_adesao=maybe(rng.randrange(10)),
            vl_resposta=tax_id()), 15),
        "enrolment": repeat(lambda: dict(
            id_adesao=maybe(rng.randrange(10)), id_produto=maybe(str(rng.randrange(1, 8))),
            ds_status=rng.choice(["ATIVA", "INCONSISTENTE", "CANCELADA"])), 10),
        "customer": repeat(lambda: dict(
            id_conta=account_id(), nm_cliente=maybe("nome"), ds_email="e", cd_uf="SP",
            nm_bairro=maybe("b" * rng.choice([3, 50, 60])),
            nm_logradouro="l" * rng.choice([80, 90]), nu_cep="01000000", nu_endereco="1",
            nu_cpf_cnpj=tax_id(), dt_nascimento="1980-02-03", fl_sexo="F",
            nm_cidade="c" * rng.choice([29, 31]), fl_tipo_pessoa="F", nu_rg="0"), 12),
        "registration": repeat(lambda: dict(
            id_conta=account_id(),
            dt_cadastro=f"2024-01-{rng.randrange(25, 31)} {rng.randrange(10, 13)}:00:00"), 25),
        "phone": repeat(lambda: dict(
            id_conta=account_id(),
            telefone_celular=maybe("1" * rng.randrange(1, 3) + str(rng.randrange(10**8, 10**9)))),
            14),
    }


@pytest.fixture(params=range(4))
def both(request, spark):
    """The same random tables in both engines."""
    data = random_tables(random.Random(request.param))
    con = duckdb.connect()
    for name, values in data.items():
        columns = {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in TABLES[name]}
        view = VIEW.get(name, name)
        if name == "phone":
            columns["fone_celular"] = columns.pop("telefone_celular")
            values = [
                {"id_conta": v["id_conta"], "fone_celular": v["telefone_celular"]} for v in values
            ]
        listed = ", ".join(f"{c} {t}" for c, t in columns.items())
        con.execute(f"CREATE TABLE {view} ({listed})")
        marks = ", ".join("?" for _ in columns)
        con.executemany(
            f"INSERT INTO {view} VALUES ({marks})",
            [[v.get(c) for c in columns] for v in values],
        )
    tables = {name: table(spark, name, *values) for name, values in data.items()}
    return tables, con


def sql_rows(con, name: str) -> tuple[list[str], list[tuple]]:
    given = {VIEW.get(t, t) for t in TABLES}
    body = oracle._QUERIES[name]
    views = ",\n".join(
        f"{v} AS ({oracle._VIEWS[v]})" for v in oracle._needed(body) if v not in given
    )
    cursor = con.execute(f"WITH {views}\n{body}")
    return [d[0] for d in cursor.description], cursor.fetchall()


def comparable(columns, values, leave_out=()):
    def plain(v):
        return float(v) if isinstance(v, Decimal) else v

    chosen = [c for c in sorted(columns) if c not in leave_out]
    index = [list(columns).index(c) for c in chosen]
    return chosen, sorted(repr(tuple(plain(row[i]) for i in index)) for row in values)


def assert_same(df, con, name, leave_out=()):
    ours = comparable(df.columns, [tuple(r) for r in df.collect()], leave_out)
    theirs = comparable(*sql_rows(con, name), leave_out)
    assert ours == theirs
    return ours[1]


def test_account_mart(both):
    tables, con = both
    got = assert_same(
        account_mart.account_mart_from_tables(tables, MART_DAY), con, "account_mart"
    )
    assert got


def test_billed_mart(both):
    tables, con = both
    df = billed_mart.billed_mart_from_tables(tables, MART_DAY)
    assert assert_same(df, con, "account_mart_billed")


def test_customer_queue(both):
    tables, con = both
    extracts = customer_queue.CUSTOMER_QUEUE_EXTRACTS.run(tables, QUEUE_DAY)
    found = customer_queue.new_customers(extracts, QUEUE_DAY)
    queue = customer_queue.customer_queue(extracts, QUEUE_DAY, 5000)
    rows = assert_same(queue, con, "customer_queue", leave_out=("id_pessoa_fila",))
    assert rows
    ids = sorted(r["id_pessoa_fila"] for r in queue.select("id_pessoa_fila").collect())
    assert ids == list(range(5000, 5000 + len(rows)))
    assert found.count() == len(rows)


