"""Input tables and output contracts.

Column names are those of the card-account source tables and of the load targets, in
lower case. Types are fixed here so that an empty table keeps its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

LONG, INT, TEXT = LongType(), IntegerType(), StringType()
DATE, TIMESTAMP = DateType(), TimestampType()
#: Published timestamps: wall-clock time, whatever kind the source has.
WALL_CLOCK = TimestampNTZType()
MONEY, TOTAL = DecimalType(18, 2), DecimalType(28, 2)


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


TABLES: dict[str, StructType] = {
    "invoice": _struct(
        id_fatura=LONG, id_processamento=LONG, id_conta=LONG, id_ciclo=INT,
        id_fatura_anterior=LONG, dt_processamento=TIMESTAMP, dt_vencimento=TIMESTAMP,
        fl_ativa=TEXT, fl_envia_email=TEXT, fl_realiza_impressao=TEXT,
        fl_envia_sms_directone=TEXT, vl_fatura=MONEY, vl_pagamento_minimo=MONEY,
        vl_total_pago=MONEY, dt_inclusao=TIMESTAMP,
    ),
    "payment": _struct(
        id_fatura=LONG, id_conta=LONG, dt_pagamento=TIMESTAMP, vl_pagamento=MONEY,
    ),
    "account": _struct(
        id_conta=LONG, nu_cpf_cnpj=TEXT, ds_status_conta=TEXT, nm_origem_comercial=TEXT,
        ds_status_cartao=TEXT, ds_motivo_bloqueio_cartao=TEXT, id_produto=INT,
        nm_produto=TEXT, nu_dias_atraso=INT,
    ),
    "product": _struct(
        id_produto=INT, ds_produto=TEXT, vl_faturamento_minimo=MONEY,
    ),
    "sale": _struct(
        id_conta=LONG, dt_venda=TIMESTAMP, fl_status=TEXT,
    ),
    "instalment": _struct(
        id_conta=LONG, fl_status=TEXT,
    ),
    "latest_invoice": _struct(
        id_conta=LONG, id_fatura=LONG,
    ),
    "client": _struct(
        id_conta=LONG, dt_cadastro=TEXT, nu_cpf_cnpj=TEXT, fl_status_conta=TEXT,
    ),
    "form_field": _struct(
        id_campo=LONG, ds_codigo=TEXT,
    ),
    "form_answer": _struct(
        id_campo=LONG, id_adesao=LONG, vl_resposta=TEXT,
    ),
    "enrolment": _struct(
        id_adesao=LONG, id_produto=TEXT, ds_status=TEXT,
    ),
    "dependent": _struct(
        id_adesao_titular=LONG, id_adesao_dependente=LONG,
    ),
    "customer": _struct(
        id_conta=LONG, nm_cliente=TEXT, ds_email=TEXT, cd_uf=TEXT, nm_bairro=TEXT,
        nm_logradouro=TEXT, nu_cep=TEXT, nu_endereco=TEXT, nu_cpf_cnpj=TEXT,
        dt_nascimento=TEXT, fl_sexo=TEXT, nm_cidade=TEXT, fl_tipo_pessoa=TEXT, nu_rg=TEXT,
    ),
    "registration": _struct(
        id_conta=LONG, dt_cadastro=TEXT,
    ),
    "phone": _struct(
        id_conta=LONG, telefone_celular=TEXT,
    ),
    "postal_range": _struct(
        seqcidade=LONG, cepinicial=LONG, cepfinal=LONG, cidade=TEXT, codmunicipio=LONG,
    ),
}

# Names, order and types of the published tables.
ACCOUNT_MART = _struct(
    id_pessoa=TEXT, tx_status_cartao=TEXT, tx_motivo_bloqueio=TEXT,
    fl_possui_seguros=INT, fl_possui_odonto=INT, fl_possui_parcelamento_fatura=INT,
    fl_possui_fatura_garantida=INT, dt_ultima_compra=WALL_CLOCK,
    dt_primeira_compra=WALL_CLOCK, dt_cadastro=DATE, qtd_dias_atraso=INT,
    tx_loja_origem=TEXT, vlr_fatura=MONEY, vlr_pago=TOTAL, tx_status_conta=TEXT,
    id_produto=INT, tx_descricao_produto=TEXT, id_conta=LONG,
    dt_vencimento_fatura=DATE, fl_servico_sms=INT, fl_fatura_ativa_mes=INT,
    dt_pagamento_ult_fatura=DATE,
)

BILLED_MART = _struct(
    id_fatura=LONG, id_conta=LONG, dt_vencto=DATE, vl_fatura=MONEY, total_pago=TOTAL,
    dt_ult_pagto=DATE, qtddiasatraso=INT, fl_ativa=TEXT, fl_envia_sms_directone=INT,
    fl_possui_parcelamento_fatura=INT, flgPossuiSeguros=INT, flgPossuiOdonto=INT,
    fl_status_conta=TEXT, flgPossuiFaturaGarantida=INT, id_pessoa=TEXT,
)

CUSTOMER_QUEUE = _struct(
    id_pessoa_fila=LONG, edi_source=TEXT, nomerazao=TEXT, fantasia=TEXT, email=TEXT,
    palavrachave=TEXT, pais=TEXT, uf=TEXT, bairro=TEXT, logradouro=TEXT, cep=TEXT,
    nrologradouro=TEXT, cpf_cnpj=TEXT, digcgccpf=LONG, dtanascfund=DATE, origem=TEXT,
    usuinclusao=TEXT, sexo=TEXT, cidade=TEXT, fisicajuridica=TEXT, inscricaorg=TEXT,
    data_selecao=DATE, tipo_integracao=TEXT, status_integracao=TEXT, dtainclusao=DATE,
    nrocgccpf=LONG, foneddd1=TEXT, fonenro1=TEXT, foneddd2=TEXT, fonenro2=TEXT,
)


_TIMESTAMPS = (TimestampType, TimestampNTZType)


def _same_kind(have: DataType, want: DataType) -> bool:
    """Equal types; timestamps with and without zone both pass as they are.

    Leaving such a column uncast keeps filters on it pushed down to the scan.
    """
    return have == want or (isinstance(have, _TIMESTAMPS) and isinstance(want, _TIMESTAMPS))


def publish(df: DataFrame, schema: StructType) -> DataFrame:
    """``conform`` for a published table: timestamps get the schema's kind as well."""
    rows = conform(df, schema)
    kinds = {
        f.name: F.col(f.name).cast(f.dataType)
        for f in schema
        if rows.schema[f.name].dataType != f.dataType
    }
    return rows.withColumns(kinds) if kinds else rows


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns by name (any case), in its order and types."""
    present = {field.name.lower(): field for field in df.schema}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")

    def typed(want: StructField) -> Column | str:
        have = present[want.name.lower()]
        if have.name == want.name and _same_kind(have.dataType, want.dataType):
            return have.name
        column = F.col(have.name)
        if not _same_kind(have.dataType, want.dataType):
            column = column.cast(want.dataType)
        return column.alias(want.name)

    columns = [typed(f) for f in schema]
    as_is = all(isinstance(c, str) for c in columns) and columns == df.columns
    return df if as_is else df.select(*columns)


def typed_null(data_type: str) -> Column:
    """A null column that has a type."""
    return F.lit(None).cast(data_type)
