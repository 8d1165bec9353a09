"""SQL equivalents of the registered queries, for a comparison in another engine.

The plans are written here step by step (row windows, fan-out joins, distincts in their
original places), not in the rearranged form the Spark plans use.
"""

from __future__ import annotations

# Each domain table over the given tables; the same mapping as in domain.py. Fixed values:
# column names, code texts, status and product values are those of the source tables.
_VIEWS = {
    "product": """
        SELECT n_nationkey AS id_produto, n_name AS ds_produto,
               CAST(n_nationkey * 10000 AS DECIMAL(18,2)) AS vl_faturamento_minimo
        FROM nation""",
    "account": """
        SELECT c_custkey AS id_conta, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS nu_cpf_cnpj,
               c_mktsegment AS ds_status_conta, 'LOJA ' || c_mktsegment AS nm_origem_comercial,
               CASE WHEN c_acctbal < 0 THEN 'BLOQUEADO' ELSE 'ATIVO' END AS ds_status_cartao,
               CASE WHEN c_acctbal < 0 THEN 'SALDO' END AS ds_motivo_bloqueio_cartao,
               c_nationkey AS id_produto,
               'PRODUTO ' || CAST(c_nationkey AS VARCHAR) AS nm_produto,
               c_nationkey + 1 AS nu_dias_atraso
        FROM customer""",
    "invoice": """
        SELECT nullif(o_orderkey, 5) AS id_fatura, o_orderkey AS id_processamento,
               o_custkey AS id_conta,
               CAST(day(o_orderdate) AS INTEGER) AS id_ciclo,
               o_orderkey - 1 AS id_fatura_anterior,
               o_orderdate AS dt_processamento, o_orderdate AS dt_vencimento,
               CASE WHEN o_orderstatus = 'F' THEN 'S' ELSE 'N' END AS fl_ativa,
               CASE WHEN o_orderstatus = 'O' THEN 'S' ELSE 'N' END AS fl_envia_email,
               'N' AS fl_realiza_impressao,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'S' ELSE 'N' END
                   AS fl_envia_sms_directone,
               CAST(o_totalprice AS DECIMAL(18,2)) AS vl_fatura,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.1 AS DECIMAL(2,1))
                   AS DECIMAL(18,2)) AS vl_pagamento_minimo,
               CAST(0 AS DECIMAL(18,2)) AS vl_total_pago,
               o_orderdate AS dt_inclusao
        FROM orders""",
    "payment": """
        SELECT l_orderkey AS id_fatura, o_custkey AS id_conta, l_shipdate AS dt_pagamento,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS vl_pagamento
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "sale": """
        SELECT o_custkey AS id_conta, o_orderdate AS dt_venda,
               CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE 'C' END AS fl_status
        FROM orders""",
    "instalment": """
        SELECT o_custkey AS id_conta,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'A' ELSE 'Q' END
                   AS fl_status
        FROM orders""",
    "client": """
        SELECT c_custkey AS id_conta,
               strftime(DATE '2000-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d')
                   AS dt_cadastro,
               lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS nu_cpf_cnpj,
               left(c_mktsegment, 1) AS fl_status_conta
        FROM customer WHERE c_acctbal >= 0""",
    "form_field": """
        SELECT r_regionkey AS id_campo,
               CASE WHEN r_name IN ('AFRICA', 'AMERICA', 'ASIA')
                   THEN 'contratante.dadosPessoais.cpf' ELSE r_name END AS ds_codigo
        FROM region""",
    "form_answer": """
        SELECT n_regionkey AS id_campo, c_custkey AS id_adesao,
               lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS vl_resposta
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "enrolment": """
        SELECT c_custkey AS id_adesao, CAST(c_custkey % 7 + 1 AS VARCHAR) AS id_produto,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'ATIVA'
                   WHEN 'MACHINERY' THEN 'PENDENTE_CONFIRMACAO_PROVEDOR'
                   WHEN 'HOUSEHOLD' THEN 'INCONSISTENTE' ELSE 'CANCELADA' END AS ds_status
        FROM customer""",
    "client_row": """
        SELECT c_custkey AS id_conta, c_name AS nm_cliente,
               lower(c_name) || '@example.com' AS ds_email, n_name AS cd_uf,
               repeat(c_mktsegment, 7) AS nm_bairro, repeat(c_name, 5) AS nm_logradouro,
               lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS nu_cep, '10' AS nu_endereco,
               lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS nu_cpf_cnpj,
               strftime(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d')
                   AS dt_nascimento,
               'F' AS fl_sexo, repeat(n_name, 5) AS nm_cidade, 'F' AS fl_tipo_pessoa,
               '0' AS nu_rg
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "registration": """
        SELECT user_id AS id_conta, strftime(ts, '%Y-%m-%d %H:%M:%S') AS dt_cadastro
        FROM events WHERE event_type = 'signup'""",
    "phone": """
        SELECT CASE WHEN event_id % 50 <> 7 THEN user_id END AS id_conta,
               CAST(11 + event_id % 80 AS VARCHAR) || lpad(CAST(event_id AS VARCHAR),
                   CASE WHEN event_type = 'error' THEN 8 ELSE 9 END, '0') AS fone_celular
        FROM events""",
    "postal": """
        SELECT s_suppkey AS seqcidade, s_suppkey * 20 AS cepinicial,
               s_suppkey * 20 + 24 AS cepfinal, s_name AS cidade
        FROM supplier WHERE s_acctbal >= 0""",
    "month_invoice": """
        SELECT id_fatura, id_conta, dt_vencimento AS dt_vencimento_fatura, fl_ativa,
               fl_envia_sms_directone AS fl_servico_sms, vl_fatura AS vlr_fatura
        FROM invoice WHERE year(dt_vencimento) = 1998 AND month(dt_vencimento) = 10""",
    "month_payment": """
        SELECT id_fatura, id_conta, dt_pagamento AS dt_pagamento_ult_fatura,
               vl_pagamento AS vlr_pago
        FROM payment WHERE year(dt_pagamento) = 1998 AND month(dt_pagamento) = 10""",
    "insured": """
        SELECT owner.cpf, counted.id_produto
        FROM (SELECT id_adesao, CAST(id_produto AS INTEGER) AS id_produto
              FROM enrolment
              WHERE id_produto BETWEEN '1' AND '5' AND length(id_produto) = 1
                AND ds_status IN ('INCONSISTENTE', 'PENDENTE_CONFIRMACAO_PROVEDOR', 'ATIVA')
             ) AS counted
        INNER JOIN (
              SELECT id_adesao, vl_resposta AS cpf
              FROM form_answer INNER JOIN form_field USING (id_campo)
              WHERE ds_codigo = 'contratante.dadosPessoais.cpf'
             ) AS owner USING (id_adesao)""",
    "span": """
        SELECT id_conta, max(dt_venda) AS dt_ultima_compra, min(dt_venda) AS dt_primeira_compra
        FROM sale WHERE fl_status = 'A' GROUP BY id_conta""",
    "active_instalment": """
        SELECT DISTINCT id_conta, fl_status FROM instalment WHERE fl_status = 'A'""",
    "latest_above": """
        WITH qualified AS (
            SELECT id_conta, id_fatura
            FROM invoice INNER JOIN account USING (id_conta)
                 INNER JOIN product USING (id_produto)
            WHERE vl_fatura - vl_faturamento_minimo > 0)
        SELECT id_conta, max(id_fatura) AS id_fatura FROM qualified GROUP BY id_conta""",
    "latest_payment": """
        SELECT p.id_fatura, p.id_conta, p.dt_pagamento AS dt_pagamento_ult_fatura,
               p.vl_pagamento AS vlr_pago
        FROM payment p JOIN latest_above v ON p.id_fatura = v.id_fatura""",
    "total": """
        SELECT DISTINCT id_fatura, id_conta,
               CASE WHEN id_fatura IS NOT NULL THEN
                   coalesce(sum(vl_pagamento) OVER (PARTITION BY id_fatura), 0) END
                   AS vl_pagamento,
               max(dt_pagamento) OVER (PARTITION BY id_fatura) AS dt_pagamento
        FROM payment""",
    "month_total": """
        SELECT DISTINCT id_fatura, id_conta,
               coalesce(sum(vlr_pago) OVER (PARTITION BY id_fatura), 0) AS vlr_pago,
               max(dt_pagamento_ult_fatura) OVER (PARTITION BY id_fatura)
                   AS dt_pagamento_ult_fatura
        FROM month_payment""",
    "latest_total": """
        SELECT DISTINCT id_fatura, id_conta,
               coalesce(sum(vlr_pago) OVER (PARTITION BY id_fatura), 0) AS total_pago,
               max(dt_pagamento_ult_fatura) OVER (PARTITION BY id_fatura) AS dt_ultimo_pagto
        FROM latest_payment""",
    "ranked": """
        SELECT id_conta, fone_celular, CASE WHEN id_conta IS NOT NULL THEN row_number() OVER (
                   PARTITION BY id_conta ORDER BY fone_celular DESC NULLS LAST) END AS "rank"
        FROM phone""",
    "two_phone": """
        SELECT a.id_conta, a.fone_celular AS fone_celular_1, b.fone_celular AS fone_celular_2
        FROM (SELECT * FROM ranked WHERE "rank" = 1) a
             LEFT JOIN (SELECT * FROM ranked WHERE "rank" = 2) b ON a.id_conta = b.id_conta""",
    "queue_row": """
        SELECT CAST(NULL AS BIGINT) AS id_pessoa_fila, 'CARTAO' AS edi_source,
               nm_cliente AS nomerazao, nm_cliente AS fantasia, ds_email AS email,
               'CLIENTE' AS palavrachave, 'BRASIL' AS pais, cd_uf AS uf, nm_bairro AS bairro,
               nm_logradouro AS logradouro, nu_cep AS cep, nu_endereco AS nrologradouro,
               nu_cpf_cnpj AS cpf_cnpj, CAST(NULL AS BIGINT) AS digcgccpf,
               dt_nascimento AS dtanascfund, 'CARTAO' AS origem, 'HIVE' AS usuinclusao,
               fl_sexo AS sexo, nm_cidade AS cidade, fl_tipo_pessoa AS fisicajuridica,
               nu_rg AS inscricaorg, DATE '2024-01-30' AS data_selecao, id_conta,
               'I' AS tipo_integracao, 'F' AS status_integracao
        FROM client_row""",
}

# The views each query needs beyond those its own text names are found by name.
_QUERIES = {
    "sale_span": """
        SELECT id_conta, dt_ultima_compra AS dt_venda_max, dt_primeira_compra AS dt_venda_min
        FROM span""",
    "month_invoices": """
        SELECT id_fatura, id_conta, dt_vencimento_fatura, fl_ativa, fl_servico_sms,
               CAST(vlr_fatura AS DOUBLE) AS vlr_fatura
        FROM month_invoice""",
    "month_payments": """
        SELECT id_fatura, id_conta, dt_pagamento_ult_fatura,
               CAST(vlr_pago AS DOUBLE) AS vlr_pago
        FROM month_payment""",
    "active_instalments": "SELECT id_conta, fl_status FROM active_instalment",
    "yes_no_flags": """
        SELECT id_fatura,
               CAST(CASE WHEN fl_envia_sms_directone = 'S' THEN 1 ELSE 0 END AS INTEGER)
                   AS fl_servico_sms,
               CAST(CASE WHEN fl_ativa = 'S' THEN 1 ELSE 0 END AS INTEGER)
                   AS fl_fatura_ativa_mes
        FROM invoice""",
    "instalment_flag": """
        SELECT i.id_fatura, i.id_conta,
               CAST(CASE WHEN p.id_conta IS NOT NULL THEN 1 ELSE 0 END AS INTEGER)
                   AS fl_possui_parcelamento_fatura
        FROM invoice i LEFT JOIN active_instalment p ON i.id_conta = p.id_conta""",
    "active_enrolments": "SELECT cpf, id_produto FROM insured",
    "coverage_flags": """
        SELECT id_conta, nu_cpf_cnpj,
               CAST(CASE WHEN EXISTS (SELECT 1 FROM insured s WHERE s.cpf = nu_cpf_cnpj)
                   THEN 1 ELSE 0 END AS INTEGER) AS fl_possui_seguros,
               CAST(CASE WHEN EXISTS (SELECT 1 FROM insured s WHERE s.cpf = nu_cpf_cnpj
                   AND s.id_produto = 3) THEN 1 ELSE 0 END AS INTEGER) AS fl_possui_odonto,
               CAST(CASE WHEN EXISTS (SELECT 1 FROM insured s WHERE s.cpf = nu_cpf_cnpj
                   AND s.id_produto IN (1, 2)) THEN 1 ELSE 0 END AS INTEGER)
                   AS fl_possui_fatura_garantida
        FROM account""",
    "payment_totals": """
        SELECT id_fatura, id_conta, CAST(vl_pagamento AS DOUBLE) AS vl_pagamento, dt_pagamento
        FROM total""",
    "invoice_payments_left": """
        SELECT i.id_fatura, i.id_conta, CAST(i.vl_fatura AS DOUBLE) AS vl_fatura,
               CAST(t.vl_pagamento AS DOUBLE) AS vl_pagamento, t.dt_pagamento
        FROM invoice i LEFT JOIN total t
             ON i.id_fatura = t.id_fatura AND i.id_conta = t.id_conta""",
    "invoice_account_product": """
        SELECT i.id_fatura, i.id_conta, CAST(i.vl_fatura AS DOUBLE) AS vl_fatura,
               c.id_produto, c.nu_cpf_cnpj, p.ds_produto,
               CAST(p.vl_faturamento_minimo AS DOUBLE) AS vl_faturamento_minimo
        FROM invoice i JOIN account c ON i.id_conta = c.id_conta
             JOIN product p ON c.id_produto = p.id_produto""",
    "account_sale_left": """
        SELECT a.id_conta, a.nu_cpf_cnpj, s.dt_ultima_compra, s.dt_primeira_compra
        FROM account a LEFT JOIN span s ON a.id_conta = s.id_conta""",
    "latest_invoice": """
        SELECT id_conta, max(id_fatura) AS id_fatura FROM invoice GROUP BY id_conta""",
    "invoices_above_minimum": """
        SELECT i.id_fatura, i.id_conta, CAST(i.vl_fatura AS DOUBLE) AS vl_fatura,
               CAST(p.vl_faturamento_minimo AS DOUBLE) AS vl_faturamento_minimo
        FROM invoice i JOIN account c ON i.id_conta = c.id_conta
             JOIN product p ON c.id_produto = p.id_produto
        WHERE i.vl_fatura > p.vl_faturamento_minimo""",
    "latest_invoice_above_minimum": "SELECT id_conta, id_fatura FROM latest_above",
    "payments_of_latest_invoice": """
        SELECT id_fatura, id_conta, dt_pagamento_ult_fatura,
               CAST(vlr_pago AS DOUBLE) AS vlr_pago
        FROM latest_payment""",
    "account_status_left": """
        SELECT a.id_conta, a.nu_cpf_cnpj, c.fl_status_conta
        FROM account a LEFT JOIN client c
             ON a.id_conta = c.id_conta AND a.nu_cpf_cnpj = c.nu_cpf_cnpj""",
    "distinct_rows": "SELECT DISTINCT id_fatura, id_conta FROM payment",
    "person_hash": "SELECT id_conta, upper(md5(nu_cpf_cnpj)) AS id_pessoa FROM account",
    "phone_rank": 'SELECT id_conta, fone_celular, "rank" FROM ranked',
    "phones_top2": "SELECT id_conta, fone_celular_1, fone_celular_2 FROM two_phone",
    "phone_split": """
        SELECT id_conta, fone_celular,
               CASE WHEN length(fone_celular) >= 11 THEN left(fone_celular, 2) ELSE '' END
                   AS foneddd,
               CASE WHEN length(fone_celular) >= 11 THEN substr(fone_celular, 3) ELSE '' END
                   AS fonenro
        FROM phone""",
    "tax_id_split": """
        SELECT id_conta, CAST(right(nu_cpf_cnpj, 2) AS BIGINT) AS digcgccpf,
               CAST(left(nu_cpf_cnpj, length(nu_cpf_cnpj) - 2) AS BIGINT) AS nrocgccpf
        FROM client_row""",
    "address_truncate": """
        SELECT id_conta, left(nm_bairro, 50) AS bairro, left(nm_cidade, 30) AS cidade,
               left(nm_logradouro, 80) AS logradouro
        FROM client_row""",
    "date_parse": """
        SELECT id_conta, CAST(dt_nascimento AS DATE) AS dtanascfund FROM client_row""",
    "recent_registrations": """
        SELECT id_conta, CAST(left(dt_cadastro, 10) AS DATE) AS dtainclusao
        FROM registration WHERE CAST(left(dt_cadastro, 10) AS DATE) >= DATE '2024-01-28'""",
    "customer_base": "SELECT * FROM queue_row",
    "account_profile": """
        SELECT id_conta, nu_cpf_cnpj, ds_status_conta AS tx_status_conta,
               nm_origem_comercial AS tx_loja_origem, ds_status_cartao AS tx_status_cartao,
               ds_motivo_bloqueio_cartao AS tx_motivo_bloqueio, id_produto,
               nm_produto AS tx_descricao_produto, nu_dias_atraso AS qtd_dias_atraso
        FROM account""",
    "dependents": """
        SELECT c_custkey AS id_adesao_titular, c_custkey + 1 AS id_adesao_dependente
        FROM customer""",
    "month_key": """
        SELECT id_fatura, CAST(year(dt_vencimento) AS VARCHAR)
               || CAST(month(dt_vencimento) AS VARCHAR) AS month_key
        FROM invoice""",
    "dense_ids": """
        SELECT id_fatura, dt_vencimento,
               999 + row_number() OVER (ORDER BY dt_vencimento, id_fatura NULLS FIRST) AS id_fila
        FROM invoice""",
    "postal_ranges": "SELECT seqcidade, cepinicial, cepfinal, cidade FROM postal",
    "postal_lookup": """
        SELECT id_conta, CAST(nu_cep AS BIGINT) AS cep,
               (SELECT min(p.seqcidade) FROM postal p
                WHERE CAST(nu_cep AS BIGINT) BETWEEN p.cepinicial AND p.cepfinal) AS seqcidade
        FROM client_row""",
    "rename_by_position": """
        SELECT s_suppkey AS seqcidade, s_name AS cidade, s_nationkey AS codmunicipio,
               s_acctbal AS saldo
        FROM supplier""",
    "invoice_chunks": """
        SELECT id_fatura, id_processamento, id_conta, id_ciclo, id_fatura_anterior,
               dt_processamento, dt_vencimento, fl_ativa, fl_envia_email,
               fl_realiza_impressao, fl_envia_sms_directone,
               CAST(vl_fatura AS DOUBLE) AS vl_fatura,
               CAST(vl_pagamento_minimo AS DOUBLE) AS vl_pagamento_minimo,
               CAST(vl_total_pago AS DOUBLE) AS vl_total_pago, dt_inclusao,
               CASE WHEN id_fatura IS NULL THEN 1
                    ELSE CAST(least(id_fatura // 2000 + 1, 10) AS INTEGER) END AS chunk
        FROM invoice""",
    "chunk_overlap_union": """
        SELECT id_fatura, id_conta, dt_vencimento, fl_ativa,
               CAST(vl_fatura AS DOUBLE) AS vl_fatura
        FROM invoice WHERE id_fatura <= 2001 OR id_fatura IS NULL
        UNION ALL
        SELECT id_fatura, id_conta, dt_vencimento, fl_ativa,
               CAST(vl_fatura AS DOUBLE) AS vl_fatura
        FROM invoice WHERE id_fatura >= 2000""",
    "chunk_union_once": """
        SELECT id_fatura, id_conta, dt_vencimento, fl_ativa,
               CAST(vl_fatura AS DOUBLE) AS vl_fatura
        FROM invoice""",
    "rejected_registrations": """
        SELECT id_conta, dtainclusao
        FROM (SELECT id_conta, CASE WHEN id_conta % 5 = 0 THEN NULL
                         WHEN id_conta % 5 = 1 THEN 'sem data' ELSE dt_cadastro END AS dtainclusao
              FROM registration)
        WHERE dtainclusao IS NULL OR try_cast(left(dtainclusao, 10) AS DATE) IS NULL""",
    "rejected_values": """
        SELECT id_conta, CASE id_conta % 7 WHEN 0 THEN 'dtanascfund'
                             WHEN 1 THEN 'digcgccpf,nrocgccpf' ELSE 'digcgccpf' END AS rejected
        FROM client_row WHERE id_conta % 7 < 3""",
    "only_new": """
        SELECT id_conta, cpf_cnpj
        FROM (SELECT id_conta, CASE WHEN id_conta % 4 <> 0 THEN nu_cpf_cnpj END AS cpf_cnpj
              FROM account) c
        WHERE NOT EXISTS (
            SELECT 1
            FROM (SELECT CASE WHEN id_conta % 4 <> 0 THEN nu_cpf_cnpj END AS queued
                  FROM account WHERE id_conta % 3 = 0) q
            WHERE q.queued IS NOT DISTINCT FROM c.cpf_cnpj)""",
    "account_mart": """
        , with_payment AS (
            SELECT DISTINCT i.*, t.vlr_pago, t.dt_pagamento_ult_fatura
            FROM month_invoice i LEFT JOIN month_total t
                 ON i.id_fatura = t.id_fatura AND i.id_conta = t.id_conta),
        with_account AS (
            SELECT DISTINCT w.*, a.nu_cpf_cnpj, a.ds_status_conta AS tx_status_conta,
                   a.nm_origem_comercial AS tx_loja_origem,
                   a.ds_status_cartao AS tx_status_cartao,
                   a.ds_motivo_bloqueio_cartao AS tx_motivo_bloqueio, a.id_produto,
                   a.nm_produto AS tx_descricao_produto, a.nu_dias_atraso AS qtd_dias_atraso,
                   p.vl_faturamento_minimo, c.dt_cadastro
            FROM with_payment w JOIN account a ON w.id_conta = a.id_conta
                 JOIN product p ON a.id_produto = p.id_produto
                 LEFT JOIN client c ON w.id_conta = c.id_conta),
        with_flags AS (
            SELECT DISTINCT w.* EXCLUDE (id_fatura, fl_ativa, fl_servico_sms, dt_cadastro,
                                         dt_vencimento_fatura, dt_pagamento_ult_fatura),
                   s.dt_ultima_compra, s.dt_primeira_compra,
                   CAST(w.dt_cadastro AS DATE) AS dt_cadastro,
                   CAST(w.dt_vencimento_fatura AS DATE) AS dt_vencimento_fatura,
                   CAST(w.dt_pagamento_ult_fatura AS DATE) AS dt_pagamento_ult_fatura,
                   CASE WHEN w.fl_servico_sms = 'S' THEN 1 ELSE 0 END AS fl_servico_sms,
                   CASE WHEN w.fl_ativa = 'S' THEN 1 ELSE 0 END AS fl_fatura_ativa_mes,
                   CASE WHEN q.fl_status IS NOT NULL THEN 1 ELSE 0 END
                       AS fl_possui_parcelamento_fatura,
                   CASE WHEN k.cpf IS NOT NULL THEN 1 ELSE 0 END AS fl_possui_seguros,
                   CASE WHEN d.cpf IS NOT NULL THEN 1 ELSE 0 END AS fl_possui_odonto,
                   CASE WHEN g.cpf IS NOT NULL THEN 1 ELSE 0 END AS fl_possui_fatura_garantida
            FROM with_account w LEFT JOIN span s ON w.id_conta = s.id_conta
                 LEFT JOIN active_instalment q ON w.id_conta = q.id_conta
                 LEFT JOIN insured k ON w.nu_cpf_cnpj = k.cpf
                 LEFT JOIN (SELECT cpf FROM insured WHERE id_produto = 3) d
                      ON w.nu_cpf_cnpj = d.cpf
                 LEFT JOIN (SELECT cpf FROM insured WHERE id_produto IN (1, 2)) g
                      ON w.nu_cpf_cnpj = g.cpf)
        SELECT nu_cpf_cnpj AS id_pessoa, tx_status_cartao, tx_motivo_bloqueio,
               fl_possui_seguros, fl_possui_odonto, fl_possui_parcelamento_fatura,
               fl_possui_fatura_garantida, dt_ultima_compra, dt_primeira_compra, dt_cadastro,
               qtd_dias_atraso, tx_loja_origem, CAST(vlr_fatura AS DOUBLE) AS vlr_fatura,
               CAST(vlr_pago AS DOUBLE) AS vlr_pago, tx_status_conta, id_produto,
               tx_descricao_produto, id_conta, dt_vencimento_fatura, fl_servico_sms,
               fl_fatura_ativa_mes, dt_pagamento_ult_fatura
        FROM with_flags""",
    "account_mart_billed": """
        , with_payment AS (
            SELECT DISTINCT i.*, t.total_pago, t.dt_ultimo_pagto
            FROM month_invoice i LEFT JOIN latest_total t
                 ON i.id_fatura = t.id_fatura AND i.id_conta = t.id_conta),
        billed AS (
            SELECT w.*, a.nu_cpf_cnpj, a.nu_dias_atraso AS qtddiasatraso
            FROM with_payment w JOIN account a ON w.id_conta = a.id_conta
                 JOIN product p ON a.id_produto = p.id_produto
            WHERE w.vlr_fatura > p.vl_faturamento_minimo),
        with_flags AS (
            SELECT DISTINCT b.id_fatura, b.id_conta, b.nu_cpf_cnpj, b.vlr_fatura,
                   CAST(b.dt_vencimento_fatura AS DATE) AS dt_vencto, b.total_pago,
                   CAST(b.dt_ultimo_pagto AS DATE) AS dt_ult_pagto, b.qtddiasatraso,
                   b.fl_ativa, b.fl_servico_sms, c.fl_status_conta,
                   q.fl_status AS parcela, k.cpf AS seguro, d.cpf AS odonto, g.cpf AS garantia
            FROM billed b LEFT JOIN active_instalment q ON b.id_conta = q.id_conta
                 LEFT JOIN insured k ON b.nu_cpf_cnpj = k.cpf
                 LEFT JOIN (SELECT cpf FROM insured WHERE id_produto = 3) d
                      ON b.nu_cpf_cnpj = d.cpf
                 LEFT JOIN client c
                      ON b.id_conta = c.id_conta AND b.nu_cpf_cnpj = c.nu_cpf_cnpj
                 LEFT JOIN (SELECT cpf FROM insured WHERE id_produto IN (1, 2)) g
                      ON b.nu_cpf_cnpj = g.cpf)
        SELECT id_fatura, id_conta, dt_vencto, CAST(vlr_fatura AS DOUBLE) AS vl_fatura,
               CAST(total_pago AS DOUBLE) AS total_pago, dt_ult_pagto, qtddiasatraso, fl_ativa,
               CASE WHEN fl_servico_sms = 'S' THEN 1 ELSE 0 END AS fl_envia_sms_directone,
               CASE WHEN parcela IS NOT NULL THEN 1 ELSE 0 END
                   AS fl_possui_parcelamento_fatura,
               CASE WHEN seguro IS NOT NULL THEN 1 ELSE 0 END AS "flgPossuiSeguros",
               CASE WHEN odonto IS NOT NULL THEN 1 ELSE 0 END AS "flgPossuiOdonto",
               fl_status_conta,
               CASE WHEN garantia IS NOT NULL THEN 1 ELSE 0 END AS "flgPossuiFaturaGarantida",
               upper(md5(nu_cpf_cnpj)) AS id_pessoa
        FROM with_flags""",
    "customer_queue": """
        , raw_queue AS (
            SELECT DISTINCT g.*, r.dt_cadastro AS dtainclusao, p.fone_celular_1,
                   p.fone_celular_2
            FROM queue_row g JOIN registration r ON g.id_conta = r.id_conta
                 JOIN two_phone p ON g.id_conta = p.id_conta),
        recent AS (
            SELECT * FROM raw_queue
            WHERE CAST(left(dtainclusao, 10) AS DATE) >= DATE '2024-01-28')
        SELECT 4999 + row_number() OVER (ORDER BY id_conta, dtainclusao) AS id_pessoa_fila,
               edi_source, nomerazao, fantasia, email, palavrachave, pais, uf,
               left(bairro, 50) AS bairro, left(logradouro, 80) AS logradouro, cep,
               nrologradouro, cpf_cnpj, CAST(right(cpf_cnpj, 2) AS BIGINT) AS digcgccpf,
               CAST(dtanascfund AS DATE) AS dtanascfund, origem, usuinclusao, sexo,
               left(cidade, 30) AS cidade, fisicajuridica, inscricaorg, data_selecao,
               tipo_integracao, status_integracao,
               CAST(left(dtainclusao, 10) AS DATE) AS dtainclusao,
               CAST(left(cpf_cnpj, length(cpf_cnpj) - 2) AS BIGINT) AS nrocgccpf,
               CASE WHEN length(fone_celular_1) >= 11 THEN left(fone_celular_1, 2) ELSE '' END
                   AS foneddd1,
               CASE WHEN length(fone_celular_1) >= 11 THEN substr(fone_celular_1, 3) ELSE '' END
                   AS fonenro1,
               CASE WHEN length(fone_celular_2) >= 11 THEN left(fone_celular_2, 2) ELSE '' END
                   AS foneddd2,
               CASE WHEN length(fone_celular_2) >= 11 THEN substr(fone_celular_2, 3) ELSE '' END
                   AS fonenro2
        FROM recent""",
}


def _needed(text: str) -> list[str]:
    """Views the text names, and those they name in turn, in definition order."""
    wanted: set[str] = set()
    pending = [text]
    while pending:
        words = set(pending.pop().replace(",", " ").replace("(", " ").replace(")", " ").split())
        for name in _VIEWS.keys() & (words - wanted):
            wanted.add(name)
            pending.append(_VIEWS[name])
    return [name for name in _VIEWS if name in wanted]


def oracle_sql() -> dict[str, str]:
    texts = {}
    for name, body in _QUERIES.items():
        views = ",\n".join(f"{v} AS ({_VIEWS[v]})" for v in _needed(body))
        texts[name] = f"WITH {views}\n{body}" if views else body
    return texts
