"""The domain tables as views over the star-schema test tables."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctmart.operators.joins import splittable_join
from acctmart.sources.catalog import Tables

# Declared, so that opening a table runs no job to find its columns.
_GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def read_given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def domain_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Every input table of the plans, derived row by row from the given tables."""

    @cache
    def read(name: str) -> DataFrame:
        return read_given(spark, sf_dir, name)

    def product() -> DataFrame:
        return read("nation").selectExpr(
            "n_nationkey AS id_produto",
            "n_name AS ds_produto",
            "CAST(n_nationkey * 10000 AS DECIMAL(18,2)) AS vl_faturamento_minimo",
        )

    def account() -> DataFrame:
        return read("customer").selectExpr(
            "c_custkey AS id_conta",
            "lpad(string(c_custkey), 11, '0') AS nu_cpf_cnpj",
            "c_mktsegment AS ds_status_conta",
            "'LOJA ' || c_mktsegment AS nm_origem_comercial",
            "if(c_acctbal < 0, 'BLOQUEADO', 'ATIVO') AS ds_status_cartao",
            "if(c_acctbal < 0, 'SALDO', NULL) AS ds_motivo_bloqueio_cartao",
            "c_nationkey AS id_produto",
            "'PRODUTO ' || string(c_nationkey) AS nm_produto",
            "c_nationkey + 1 AS nu_dias_atraso",
        )

    def invoice() -> DataFrame:
        return read("orders").selectExpr(
            "nullif(o_orderkey, 5) AS id_fatura",
            "o_orderkey AS id_processamento",
            "o_custkey AS id_conta",
            "dayofmonth(o_orderdate) AS id_ciclo",
            "o_orderkey - 1 AS id_fatura_anterior",
            "o_orderdate AS dt_processamento",
            "o_orderdate AS dt_vencimento",
            "if(o_orderstatus = 'F', 'S', 'N') AS fl_ativa",
            "if(o_orderstatus = 'O', 'S', 'N') AS fl_envia_email",
            "'N' AS fl_realiza_impressao",
            "if(o_orderpriority IN ('1-URGENT', '2-HIGH'), 'S', 'N') AS fl_envia_sms_directone",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS vl_fatura",
            "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.1 AS DECIMAL(18,2)) "
            "AS vl_pagamento_minimo",
            "CAST(0 AS DECIMAL(18,2)) AS vl_total_pago",
            "o_orderdate AS dt_inclusao",
        )

    def payment() -> DataFrame:
        owner = read("orders").select("o_orderkey", "o_custkey")
        lines = splittable_join(read("lineitem"), owner, ["l_orderkey"], right_on=["o_orderkey"])
        return lines.selectExpr(
            "l_orderkey AS id_fatura",
            "o_custkey AS id_conta",
            "l_shipdate AS dt_pagamento",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS vl_pagamento",
        )

    def sale() -> DataFrame:
        return read("orders").selectExpr(
            "o_custkey AS id_conta",
            "o_orderdate AS dt_venda",
            "if(o_orderstatus = 'F', 'A', 'C') AS fl_status",
        )

    def instalment() -> DataFrame:
        return read("orders").selectExpr(
            "o_custkey AS id_conta",
            "if(o_orderpriority = '5-LOW' AND o_orderstatus = 'P', 'A', 'Q') AS fl_status",
        )

    def client() -> DataFrame:
        return read("customer").where("c_acctbal >= 0").selectExpr(
            "c_custkey AS id_conta",
            "string(date_add(DATE '2000-01-01', int(c_custkey % 20000))) AS dt_cadastro",
            "lpad(string(c_custkey), 11, '0') AS nu_cpf_cnpj",
            "left(c_mktsegment, 1) AS fl_status_conta",
        )

    def form_field() -> DataFrame:
        return read("region").selectExpr(
            "bigint(r_regionkey) AS id_campo",
            "if(r_name IN ('AFRICA', 'AMERICA', 'ASIA'), 'contratante.dadosPessoais.cpf', r_name) "
            "AS ds_codigo",
        )

    def form_answer() -> DataFrame:
        nations = read("nation").select("n_nationkey", "n_regionkey")
        located = read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        return located.selectExpr(
            "bigint(n_regionkey) AS id_campo",
            "c_custkey AS id_adesao",
            "lpad(string(c_custkey), 11, '0') AS vl_resposta",
        )

    def enrolment() -> DataFrame:
        return read("customer").selectExpr(
            "c_custkey AS id_adesao",
            "string(c_custkey % 7 + 1) AS id_produto",
            "CASE c_mktsegment WHEN 'BUILDING' THEN 'ATIVA' "
            "WHEN 'MACHINERY' THEN 'PENDENTE_CONFIRMACAO_PROVEDOR' "
            "WHEN 'HOUSEHOLD' THEN 'INCONSISTENTE' ELSE 'CANCELADA' END AS ds_status",
        )

    def dependent() -> DataFrame:
        return read("customer").selectExpr(
            "c_custkey AS id_adesao_titular", "c_custkey + 1 AS id_adesao_dependente"
        )

    def customer() -> DataFrame:
        nations = read("nation").select("n_nationkey", "n_name")
        located = read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        return located.selectExpr(
            "c_custkey AS id_conta",
            "c_name AS nm_cliente",
            "lower(c_name) || '@example.com' AS ds_email",
            "n_name AS cd_uf",
            "repeat(c_mktsegment, 7) AS nm_bairro",
            "repeat(c_name, 5) AS nm_logradouro",
            "lpad(string(c_custkey), 8, '0') AS nu_cep",
            "'10' AS nu_endereco",
            "lpad(string(c_custkey), 11, '0') AS nu_cpf_cnpj",
            "string(date_add(DATE '1950-01-01', int(c_custkey % 20000))) AS dt_nascimento",
            "'F' AS fl_sexo",
            "repeat(n_name, 5) AS nm_cidade",
            "'F' AS fl_tipo_pessoa",
            "'0' AS nu_rg",
        )

    def registration() -> DataFrame:
        return read("events").where("event_type = 'signup'").selectExpr(
            "user_id AS id_conta", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS dt_cadastro"
        )

    def phone() -> DataFrame:
        return read("events").selectExpr(
            "if(event_id % 50 = 7, NULL, user_id) AS id_conta",
            "string(11 + event_id % 80) || "
            "lpad(string(event_id), if(event_type = 'error', 8, 9), '0') AS telefone_celular",
        )

    def postal_range() -> DataFrame:
        return read("supplier").selectExpr(
            "s_suppkey AS seqcidade",
            "s_suppkey * 20 AS cepinicial",
            "s_suppkey * 20 + 24 AS cepfinal",
            "s_name AS cidade",
            "bigint(if(s_acctbal >= 0, s_nationkey, NULL)) AS codmunicipio",
        )

    builders = [
        product, account, invoice, payment, sale, instalment, client, form_field,
        form_answer, enrolment, dependent, customer, registration, phone, postal_range,
    ]
    return Tables({b.__name__: b for b in builders})
