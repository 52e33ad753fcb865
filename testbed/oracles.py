"""The same results in DuckDB SQL, written independently of the Spark code.

Each oracle is ``WITH <the sources it needs> SELECT …``.
"""

from __future__ import annotations

import hashlib

SOURCES = {
    "associado": """
        SELECT c_custkey AS id, substr(c_name, 1, 8) AS nome, c_mktsegment AS sobrenome,
               CAST(18 + c_custkey % 63 AS INTEGER) AS idade,
               lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@x.test' AS email,
               regexp_replace(lpad(CAST(c_custkey AS VARCHAR), 11, '0'),
                              '(\\d{3})(\\d{3})(\\d{3})(\\d{2})', '\\1.\\2.\\3-\\4') AS cpf
        FROM customer""",
    "conta": """
        SELECT c_custkey AS id,
               CASE WHEN c_nationkey % 2 = 0 THEN 'corrente' ELSE 'poupanca' END AS tipo,
               TIMESTAMP '2020-01-01 00:00:00' AS data_criacao, c_custkey AS id_associado
        FROM customer""",
    "cartao": """
        SELECT o_orderkey AS id, lpad(CAST(o_orderkey AS VARCHAR), 16, '4') AS num_cartao,
               'CARD ' || CAST(o_orderkey AS VARCHAR) AS nom_impresso,
               o_orderpriority AS bandeira, o_orderdate AS data_criacao,
               o_custkey AS id_conta, o_custkey AS id_associado
        FROM orders""",
    "mov_original": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' ||
               CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
               CASE WHEN l_partkey % 97 = 3 THEN NULL
                    WHEN l_partkey % 25 = 0 THEN -CAST(l_extendedprice AS DECIMAL(15,2))
                    ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS vlr_transacao,
               CASE WHEN l_suppkey % 14 = 0 THEN NULL ELSE l_returnflag END AS des_transacao,
               l_shipdate AS data_movimentacao, l_orderkey AS id_cartao,
               l_partkey % 50 = 1 AS copiada
        FROM lineitem""",
    "movimentacao": """
        SELECT id, vlr_transacao, des_transacao, data_movimentacao, id_cartao FROM mov_original
        UNION ALL
        SELECT id || '-d', vlr_transacao, des_transacao, data_movimentacao, id_cartao
        FROM mov_original WHERE copiada""",
    "historico": """
        SELECT user_id AS associado_id, event_type AS canal, ts AS data_interacao,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "valida": "SELECT * FROM movimentacao WHERE vlr_transacao > 0",
    "contagem": """
        SELECT associado_id, count(*) AS qtd FROM historico GROUP BY associado_id""",
    "flat": """
        SELECT a.id AS id_associado, a.nome, substr(a.sobrenome, 1, 1) || '.' AS sobrenome,
               '***.***.**-' || right(a.cpf, 2) AS cpf, a.idade AS idade_associado,
               m.vlr_transacao AS vlr_transacao_movimento,
               m.des_transacao AS des_transacao_movimento, m.data_movimentacao,
               c.num_cartao AS numero_cartao, c.nom_impresso AS nome_impresso_cartao,
               c.bandeira AS bandeira_cartao, t.tipo AS tipo_conta,
               h.qtd AS qtd_interacoes_historico
        FROM valida m JOIN cartao c ON m.id_cartao = c.id
             JOIN conta t ON c.id_conta = t.id
             JOIN associado a ON c.id_associado = a.id
             LEFT JOIN contagem h ON a.id = h.associado_id""",
    "chaves": """
        SELECT DISTINCT id_cartao, vlr_transacao, des_transacao, data_movimentacao
        FROM movimentacao""",
    "medida": """
        SELECT m.total, m.invalidas, m.validas, m.sem_valor, m.sem_descricao,
               m.total - k.n AS copias,
               CASE WHEN m.total > 0 THEN round(CAST(m.invalidas AS DOUBLE) / m.total * 100, 2)
                    ELSE 0.0 END AS pct_invalidas,
               CASE WHEN m.total > 0 THEN round(CAST(m.total - k.n AS DOUBLE) / m.total * 100, 2)
                    ELSE 0.0 END AS pct_copias
        FROM (SELECT count(*) AS total,
                     count(CASE WHEN vlr_transacao <= 0 THEN 1 END) AS invalidas,
                     count(CASE WHEN vlr_transacao > 0 THEN 1 END) AS validas,
                     count(*) - count(vlr_transacao) AS sem_valor,
                     count(*) - count(des_transacao) AS sem_descricao
              FROM movimentacao) m,
             (SELECT count(*) AS n FROM chaves) k""",
    "nulos": """
        SELECT p.posicao, p.coluna, p.nulos,
               round(CAST(p.nulos AS DOUBLE) / t.total * 100, 2) AS percentual_nulos
        FROM (SELECT count(*) AS total FROM movimentacao) t,
             (SELECT 0 AS posicao, 'id' AS coluna, count(*) - count(id) AS nulos FROM movimentacao
              UNION ALL
              SELECT 1, 'vlr_transacao', count(*) - count(vlr_transacao) FROM movimentacao
              UNION ALL
              SELECT 2, 'des_transacao', count(*) - count(des_transacao) FROM movimentacao
              UNION ALL
              SELECT 3, 'data_movimentacao', count(*) - count(data_movimentacao) FROM movimentacao
              UNION ALL
              SELECT 4, 'id_cartao', count(*) - count(id_cartao) FROM movimentacao) p""",
    "bandeiras": """
        SELECT bandeira_cartao, count(*) AS qtd_movimentacoes,
               CAST(sum(vlr_transacao_movimento) AS DOUBLE) AS valor_total
        FROM flat GROUP BY bandeira_cartao""",
    "kpis": """
        SELECT count(*) AS total_registros,
               CAST(sum(vlr_transacao_movimento) AS DOUBLE) AS valor_total,
               CAST(sum(vlr_transacao_movimento) AS DOUBLE) / count(*) AS ticket_medio,
               count(DISTINCT id_associado) AS associados_distintos,
               count(DISTINCT numero_cartao) AS cartoes_distintos
        FROM flat""",
    "amostra": """
        SELECT nome, sobrenome, bandeira_cartao, tipo_conta, vlr_transacao_movimento,
               data_movimentacao
        FROM flat
        ORDER BY data_movimentacao DESC, numero_cartao, vlr_transacao_movimento, nome,
                 sobrenome, bandeira_cartao, tipo_conta
        LIMIT 8""",
    "fato": """
        SELECT m.id AS id_movimentacao, m.id_cartao, c.id_conta, c.id_associado,
               m.vlr_transacao, m.des_transacao, m.data_movimentacao
        FROM valida m JOIN cartao c ON m.id_cartao = c.id""",
    "dim_membro": """
        SELECT a.id AS id_associado, a.nome, substr(a.sobrenome, 1, 1) || '.' AS sobrenome,
               a.idade AS idade_associado, a.email, '***.***.**-' || right(a.cpf, 2) AS cpf,
               h.qtd AS qtd_interacoes_historico
        FROM associado a LEFT JOIN contagem h ON a.id = h.associado_id""",
    # the tables with broken constraints
    "x_associado": """
        SELECT id, nome, sobrenome, idade, email,
               CASE WHEN id % 40 = 8 THEN 'dup-' || CAST(id % 3 AS VARCHAR) ELSE cpf END AS cpf
        FROM associado""",
    "x_cartao": """
        SELECT id, num_cartao,
               CASE WHEN id % 200 = 0 THEN repeat('X', 120) ELSE nom_impresso END AS nom_impresso,
               bandeira, data_criacao,
               CASE WHEN id % 333 = 0 THEN -1 ELSE id_conta END AS id_conta,
               CASE WHEN id % 150 = 0 THEN (id_associado + 1) % 100 ELSE id_associado END
                   AS id_associado
        FROM cartao""",
    "x_movimentacao": """
        SELECT id, vlr_transacao, des_transacao, data_movimentacao,
               CASE WHEN id_cartao % 101 = 5 THEN -1 ELSE id_cartao END AS id_cartao
        FROM mov_original
        UNION ALL
        SELECT id, vlr_transacao, des_transacao, data_movimentacao, id_cartao
        FROM mov_original WHERE id_cartao % 500 = 1""",
    "x_historico": """
        SELECT CASE WHEN event_id % 97 = 0 THEN -1 ELSE user_id END AS associado_id FROM events""",
}

NEEDS = {
    "movimentacao": ("mov_original",),
    "valida": ("movimentacao",),
    "contagem": ("historico",),
    "flat": ("valida", "cartao", "conta", "associado", "contagem"),
    "chaves": ("movimentacao",),
    "medida": ("movimentacao", "chaves"),
    "nulos": ("movimentacao",),
    "bandeiras": ("flat",),
    "kpis": ("flat",),
    "amostra": ("flat",),
    "fato": ("valida", "cartao"),
    "dim_membro": ("associado", "contagem"),
    "x_associado": ("associado",),
    "x_cartao": ("cartao",),
    "x_movimentacao": ("mov_original",),
}


def _needed(names: tuple[str, ...]) -> set[str]:
    found: set[str] = set()
    for name in names:
        found |= {name} | _needed(NEEDS.get(name, ()))
    return found


def _with(names: str, body: str) -> str:
    wanted = _needed(tuple(names.split()))
    clauses = [f"{name} AS ({sql})" for name, sql in SOURCES.items() if name in wanted]
    return f"WITH {', '.join(clauses)} {body}"


def _severity(share: str) -> str:
    return f"CASE WHEN {share} < 5 THEN 'OK' WHEN {share} < 15 THEN 'ATENÇÃO' ELSE 'CRÍTICO' END"


def _colour(share: str) -> str:
    return f"CASE WHEN {share} < 5 THEN '#1F4D3A' WHEN {share} < 15 THEN '#B8862C' ELSE '#B23A2E' END"


def _brl(value: str) -> str:
    return f"'R$ ' || translate(format('{{:,.2f}}', {value}), ',.', '.,')"


def _thousands(value: str) -> str:
    return f"format('{{:,}}', {value})"


def _repeats(table: str, source: str, column: str) -> str:
    return f"""
        SELECT '{table}' AS tabela, '{column}' AS coluna,
               count(CASE WHEN n > 1 THEN 1 END) AS chaves_repetidas,
               CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS linhas_excedentes
        FROM (SELECT {column}, count(*) AS n FROM {source}
              WHERE {column} IS NOT NULL GROUP BY {column})"""


def _nulls(table: str, source: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS tabela, '{c}' AS coluna, count(*) - count({c}) AS nulos FROM {source}"
        for c in columns.split()
    )


def _orphans(child: str, source: str, column: str, parent: str, parent_source: str) -> str:
    return f"""
        SELECT '{child}' AS tabela, '{column}' AS coluna, '{parent}' AS referencia,
               count(*) AS orfas
        FROM {source} s
        WHERE s.{column} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM {parent_source} p WHERE p.id = s.{column})"""


def _too_long(table: str, source: str, limits: dict[str, int]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS tabela, '{c}' AS coluna, {n} AS limite, "
        f"count(CASE WHEN length({c}) > {n} THEN 1 END) AS excedentes FROM {source}"
        for c, n in limits.items()
    )


FLAT_TEXT = """
    SELECT id_associado, nome, sobrenome, cpf,
           CAST(idade_associado AS VARCHAR) AS idade_associado,
           CAST(vlr_transacao_movimento AS VARCHAR) AS vlr_transacao_movimento,
           des_transacao_movimento, CAST(data_movimentacao AS VARCHAR) AS data_movimentacao,
           numero_cartao, nome_impresso_cartao, bandeira_cartao, tipo_conta,
           qtd_interacoes_historico
    FROM flat"""

UPSERTED = """
    , lote AS (
        SELECT * FROM cartao WHERE data_criacao >= TIMESTAMP '1998-01-01'
        UNION ALL
        SELECT id, num_cartao, lower(nom_impresso), bandeira, data_criacao + INTERVAL 1 DAY,
               id_conta, id_associado
        FROM cartao WHERE data_criacao >= TIMESTAMP '1998-01-01'),
    ultimo AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY data_criacao DESC) AS rn
            FROM lote)
        WHERE rn = 1)
    SELECT * FROM ultimo
    UNION ALL
    SELECT * FROM cartao c WHERE NOT EXISTS (SELECT 1 FROM ultimo u WHERE u.id = c.id)"""

HISTORY = """
    , limpa AS (
        SELECT id_cartao, vlr_transacao, des_transacao, data_movimentacao, min(id) AS id
        FROM movimentacao
        GROUP BY id_cartao, vlr_transacao, des_transacao, data_movimentacao),
    corridas AS (
        SELECT 'bruto' AS run_id, id, id_cartao, vlr_transacao, des_transacao, data_movimentacao
        FROM movimentacao
        UNION ALL
        SELECT 'sem_copias', id, id_cartao, vlr_transacao, des_transacao, data_movimentacao
        FROM limpa),
    distintas AS (
        SELECT run_id, count(*) AS n
        FROM (SELECT DISTINCT run_id, id_cartao, vlr_transacao, des_transacao, data_movimentacao
              FROM corridas)
        GROUP BY run_id),
    base AS (
        SELECT c.run_id, count(*) AS total, any_value(d.n) AS n,
               count(CASE WHEN vlr_transacao <= 0 THEN 1 END) AS invalidas,
               count(*) - count(id) AS n0, count(*) - count(vlr_transacao) AS n1,
               count(*) - count(des_transacao) AS n2,
               count(*) - count(data_movimentacao) AS n3, count(*) - count(id_cartao) AS n4
        FROM corridas c JOIN distintas d ON c.run_id = d.run_id
        GROUP BY c.run_id)
    SELECT run_id, 'total_registros' AS metrica, CAST(NULL AS VARCHAR) AS coluna,
           CAST(total AS DOUBLE) AS valor FROM base
    UNION ALL
    SELECT run_id, 'movimentacoes_invalidas_descartadas_pct', NULL,
           round(CAST(invalidas AS DOUBLE) / total * 100, 2) FROM base
    UNION ALL
    SELECT run_id, 'total_duplicados', NULL, CAST(total - n AS DOUBLE) FROM base
    UNION ALL
    SELECT run_id, 'percentual_duplicados', NULL,
           round(CAST(total - n AS DOUBLE) / total * 100, 2) FROM base
    UNION ALL
    SELECT run_id, 'percentual_nulos', 'id', round(CAST(n0 AS DOUBLE) / total * 100, 2) FROM base
    UNION ALL
    SELECT run_id, 'percentual_nulos', 'vlr_transacao',
           round(CAST(n1 AS DOUBLE) / total * 100, 2) FROM base
    UNION ALL
    SELECT run_id, 'percentual_nulos', 'des_transacao',
           round(CAST(n2 AS DOUBLE) / total * 100, 2) FROM base
    UNION ALL
    SELECT run_id, 'percentual_nulos', 'data_movimentacao',
           round(CAST(n3 AS DOUBLE) / total * 100, 2) FROM base
    UNION ALL
    SELECT run_id, 'percentual_nulos', 'id_cartao',
           round(CAST(n4 AS DOUBLE) / total * 100, 2) FROM base"""

BROKEN_VIEWS = """
    SELECT 'fato_movimentacao' AS tabela, count(*) AS linhas
    FROM x_movimentacao m JOIN x_cartao c ON m.id_cartao = c.id
    WHERE m.vlr_transacao > 0
    UNION ALL
    SELECT 'movimento_flat', count(*)
    FROM x_movimentacao m JOIN x_cartao c ON m.id_cartao = c.id
         JOIN conta t ON c.id_conta = t.id JOIN x_associado a ON c.id_associado = a.id
    WHERE m.vlr_transacao > 0"""

BROKEN = "x_associado conta x_cartao x_movimentacao"

PRIMARY_KEYS = " UNION ALL ".join(
    [
        _repeats("associado", "x_associado", "id"),
        _repeats("conta", "conta", "id"),
        _repeats("cartao", "x_cartao", "id"),
        _repeats("movimentacao", "x_movimentacao", "id"),
    ]
)

NOT_NULL = " UNION ALL ".join(
    [
        _nulls("associado", "x_associado", "id nome sobrenome idade email cpf"),
        _nulls("conta", "conta", "id tipo data_criacao id_associado"),
        _nulls(
            "cartao",
            "x_cartao",
            "id num_cartao nom_impresso bandeira data_criacao id_conta id_associado",
        ),
        _nulls(
            "movimentacao", "x_movimentacao", "id vlr_transacao data_movimentacao id_cartao"
        ),
    ]
)

REFERENCES = " UNION ALL ".join(
    [
        _orphans("conta", "conta", "id_associado", "associado", "x_associado"),
        _orphans("cartao", "x_cartao", "id_conta", "conta", "conta"),
        _orphans("cartao", "x_cartao", "id_associado", "associado", "x_associado"),
        _orphans("movimentacao", "x_movimentacao", "id_cartao", "cartao", "x_cartao"),
        _orphans(
            "historico_interacoes",
            "x_historico",
            "associado_id",
            "associado",
            "x_associado",
        ),
    ]
)

LENGTHS = " UNION ALL ".join(
    [
        _too_long(
            "associado",
            "x_associado",
            {"nome": 100, "sobrenome": 100, "email": 150, "cpf": 14},
        ),
        _too_long("conta", "conta", {"tipo": 50}),
        _too_long(
            "cartao", "x_cartao", {"num_cartao": 20, "nom_impresso": 100, "bandeira": 20}
        ),
        _too_long("movimentacao", "x_movimentacao", {"des_transacao": 200}),
    ]
)

CPF_UNIQUE = _repeats("associado", "x_associado", "cpf")

ALL_RULES = f"""
    SELECT 'not_null' AS regra, tabela, coluna, nulos AS violacoes FROM ({NOT_NULL})
    UNION ALL SELECT 'length', tabela, coluna, excedentes FROM ({LENGTHS})
    UNION ALL SELECT 'primary_key', tabela, coluna, linhas_excedentes FROM ({PRIMARY_KEYS})
    UNION ALL SELECT 'unique', tabela, coluna, linhas_excedentes FROM ({CPF_UNIQUE})
    UNION ALL SELECT 'foreign_key', tabela, coluna, orfas FROM ({REFERENCES})
    UNION ALL SELECT 'same_member', 'cartao', 'id_associado', count(*)
    FROM x_cartao c JOIN conta t ON c.id_conta = t.id
    WHERE c.id_associado IS DISTINCT FROM t.id_associado"""

CHART_POINTS = f"""
    SELECT 'bandeiras' AS grafico, CAST(NULL AS INTEGER) AS posicao, bandeira_cartao AS rotulo,
           CAST(valor_total AS DECIMAL(38,2)) AS valor, qtd_movimentacoes AS quantidade,
           CAST(NULL AS VARCHAR) AS cor
    FROM bandeiras
    UNION ALL
    SELECT 'nulos', CAST(posicao AS INTEGER), coluna, CAST(percentual_nulos AS DECIMAL(38,2)), NULL,
           {_colour("percentual_nulos")}
    FROM nulos"""



def _pseudonym(column: str, kind: str) -> str:
    """HMAC-SHA-256 under the key of a kind, written out."""
    own = hashlib.sha256(kind.encode() + b"\0known to the oracle").digest().ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in own).hex() for pad in (0x36, 0x5C))
    return (
        f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({column}))))"
    )


ORACLES: dict[str, str] = {
    "scan_interactions": _with("historico", "SELECT * FROM historico"),
    "parquet_roundtrip": _with("flat", FLAT_TEXT),
    "csv_roundtrip": _with("flat", "SELECT * FROM flat"),
    "report_scan": _with(
        "medida nulos",
        """SELECT pct_invalidas AS movimentacoes_invalidas_descartadas_pct,
                  total AS total_registros, pct_copias AS percentual_duplicados,
                  copias AS total_duplicados, coluna, percentual_nulos
           FROM medida, nulos""",
    ),
    "star_roundtrip": _with(
        "associado conta cartao fato",
        """SELECT 'dim_associado' AS tabela, count(*) AS linhas,
                  CAST(sum(id) AS BIGINT) AS soma_chaves FROM associado
           UNION ALL SELECT 'dim_conta', count(*), CAST(sum(id) AS BIGINT) FROM conta
           UNION ALL SELECT 'dim_cartao', count(*), CAST(sum(id) AS BIGINT) FROM cartao
           UNION ALL SELECT 'fato_movimentacao', count(*), CAST(sum(id_cartao) AS BIGINT)
           FROM fato""",
    ),
    "dashboard_sample": _with("amostra", "SELECT * FROM amostra"),
    "defect_overlay": _with("movimentacao", "SELECT * FROM movimentacao"),
    "valid_rows": _with("valida", "SELECT * FROM valida"),
    "invalid_rows": _with(
        "movimentacao", "SELECT * FROM movimentacao WHERE vlr_transacao <= 0"
    ),
    "validity_summary": _with(
        "medida",
        """SELECT total AS total_registros, validas, invalidas, sem_valor,
                  pct_invalidas AS percentual_invalidas FROM medida""",
    ),
    "null_profile": _with("nulos", "SELECT * FROM nulos"),
    "duplicate_profile": _with(
        "medida",
        """SELECT total AS total_registros, copias AS total_duplicados,
                  pct_copias AS percentual_duplicados FROM medida""",
    ),
    "distinct_business_keys": _with("chaves", "SELECT * FROM chaves"),
    "quality_report": _with(
        "medida nulos",
        """SELECT total AS total_registros, validas, invalidas, sem_valor,
                  pct_invalidas AS movimentacoes_invalidas_descartadas_pct,
                  copias AS total_duplicados, pct_copias AS percentual_duplicados,
                  (SELECT percentual_nulos FROM nulos WHERE coluna = 'id') AS pct_nulos_id,
                  (SELECT percentual_nulos FROM nulos WHERE coluna = 'vlr_transacao')
                      AS pct_nulos_vlr_transacao,
                  (SELECT percentual_nulos FROM nulos WHERE coluna = 'des_transacao')
                      AS pct_nulos_des_transacao,
                  (SELECT percentual_nulos FROM nulos WHERE coluna = 'data_movimentacao')
                      AS pct_nulos_data_movimentacao,
                  (SELECT percentual_nulos FROM nulos WHERE coluna = 'id_cartao')
                      AS pct_nulos_id_cartao
           FROM medida""",
    ),
    "max_null_pct": _with(
        "nulos", "SELECT max(percentual_nulos) AS maior_percentual_nulos FROM nulos"
    ),
    "worst_column": _with(
        "nulos",
        """SELECT coluna, percentual_nulos FROM nulos
           ORDER BY percentual_nulos DESC, posicao LIMIT 1""",
    ),
    "interactions_per_member": _with(
        "historico",
        "SELECT associado_id, count(*) AS qtd_interacoes FROM historico GROUP BY associado_id",
    ),
    "flat_view": _with("flat", "SELECT * FROM flat"),
    "flat_contract_strings": _with("flat", FLAT_TEXT),
    "dim_associado": _with("dim_membro", "SELECT * FROM dim_membro"),
    "dim_conta": _with(
        "conta",
        """SELECT id AS id_conta, tipo AS tipo_conta, data_criacao AS data_criacao_conta
           FROM conta""",
    ),
    "dim_cartao": _with(
        "cartao",
        """SELECT id AS id_cartao, num_cartao, nom_impresso AS nome_impresso_cartao, bandeira,
                  data_criacao AS data_criacao_cartao
           FROM cartao""",
    ),
    "fato_movimentacao": _with("fato", "SELECT * FROM fato"),
    "dim_bandeira": _with(
        "cartao", "SELECT DISTINCT md5(bandeira) AS id_bandeira, bandeira FROM cartao"
    ),
    "fato_com_data": _with(
        "fato cartao",
        """SELECT f.id_movimentacao, f.id_cartao, md5(c.bandeira) AS id_bandeira,
                  CAST(year(f.data_movimentacao) * 10000 + month(f.data_movimentacao) * 100
                       + day(f.data_movimentacao) AS INTEGER) AS id_data
           FROM fato f JOIN cartao c ON f.id_cartao = c.id""",
    ),
    "dim_tempo": _with(
        "valida",
        """SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS id_data,
                  CAST(d AS DATE) AS data, CAST(year(d) AS INTEGER) AS ano,
                  CAST(quarter(d) AS INTEGER) AS trimestre, CAST(month(d) AS INTEGER) AS mes,
                  CAST(day(d) AS INTEGER) AS dia, CAST(isodow(d) AS INTEGER) AS dia_semana
           FROM (SELECT unnest(generate_series(
                     (SELECT date_trunc('day', min(data_movimentacao)) FROM valida),
                     (SELECT date_trunc('day', max(data_movimentacao)) FROM valida),
                     INTERVAL 1 DAY)) AS d)""",
    ),
    "brand_mart": _with(
        "bandeiras", "SELECT * FROM bandeiras ORDER BY valor_total DESC, bandeira_cartao"
    ),
    "brand_mart_from_flat": _with("bandeiras", "SELECT * FROM bandeiras"),
    "kpi_summary": _with("kpis", "SELECT * FROM kpis"),
    "kpi_summary_from_flat": _with("kpis", "SELECT * FROM kpis"),
    "kpi_labels": _with(
        "kpis",
        f"""SELECT {_thousands("total_registros")} AS total_registros,
                   {_brl("valor_total")} AS valor_total, {_brl("ticket_medio")} AS ticket_medio,
                   {_thousands("associados_distintos")} AS associados_distintos,
                   {_thousands("cartoes_distintos")} AS cartoes_distintos
            FROM kpis""",
    ),
    "sample_rows": _with("amostra", "SELECT * FROM amostra"),
    "null_ranking": _with(
        "nulos",
        f"""SELECT posicao, coluna, percentual_nulos,
                   {_severity("percentual_nulos")} AS severidade,
                   {_colour("percentual_nulos")} AS cor
            FROM nulos ORDER BY percentual_nulos DESC, posicao""",
    ),
    "quality_headline": _with(
        "medida nulos",
        f"""SELECT total AS total_registros, pct_invalidas AS percentual_invalidas,
                   {_severity("pct_invalidas")} AS severidade_invalidas,
                   {_colour("pct_invalidas")} AS cor_invalidas,
                   copias AS total_duplicados, pct_copias AS percentual_duplicados,
                   {_severity("pct_copias")} AS severidade_duplicados,
                   {_colour("pct_copias")} AS cor_duplicados,
                   p.coluna AS pior_coluna, p.percentual_nulos AS percentual_pior_coluna
            FROM medida, (SELECT coluna, percentual_nulos FROM nulos
                          ORDER BY percentual_nulos DESC, posicao LIMIT 1) p""",
    ),
    "quality_bars": _with(
        "medida nulos",
        """SELECT indicador, percentual, least(percentual * 4, 100.0) AS largura
           FROM (SELECT 'movimentacoes_invalidas' AS indicador, pct_invalidas AS percentual
                 FROM medida
                 UNION ALL SELECT 'registros_duplicados', pct_copias FROM medida
                 UNION ALL SELECT 'maior_percentual_nulos', max(percentual_nulos) FROM nulos)""",
    ),
    "chart_series": _with("bandeiras nulos", CHART_POINTS),
    "null_series": _with(
        "nulos",
        f"""SELECT 'nulos' AS grafico,
                   '[' || string_agg('"' || coluna || '"', ','
                          ORDER BY percentual_nulos DESC, posicao) || ']' AS rotulos,
                   '[' || string_agg(CAST(CAST(percentual_nulos AS DECIMAL(38,2)) AS VARCHAR), ','
                          ORDER BY percentual_nulos DESC, posicao) || ']' AS valores,
                   '[' || string_agg('"' || {_colour("percentual_nulos")} || '"', ','
                          ORDER BY percentual_nulos DESC, posicao) || ']' AS cores
            FROM nulos""",
    ),
    "severity_bands": _with(
        "movimentacao",
        f"""SELECT id_cartao, percentual, {_severity("percentual")} AS severidade,
                   {_colour("percentual")} AS cor
            FROM (SELECT id_cartao,
                         round(CAST(count(CASE WHEN vlr_transacao <= 0 THEN 1 END) AS DOUBLE)
                               / count(*) * 100, 2) AS percentual
                  FROM movimentacao GROUP BY id_cartao)""",
    ),
    "mask_cpf": _with("associado", "SELECT id, '***.***.**-' || right(cpf, 2) AS cpf FROM associado"),
    "mask_surname": _with(
        "associado",
        "SELECT id, nome, substr(sobrenome, 1, 1) || '.' AS sobrenome FROM associado",
    ),
    "mask_strict": _with(
        "cartao associado",
        """SELECT c.id, repeat('*', length(c.num_cartao) - 4) || right(c.num_cartao, 4)
                      AS num_cartao,
                  regexp_replace(c.nom_impresso, '(\\S)\\S*', '\\1.', 'g') AS nom_impresso,
                  substr(a.email, 1, 1) || '***' || substr(a.email, strpos(a.email, '@')) AS email
           FROM cartao c JOIN associado a ON c.id_associado = a.id""",
    ),
    "mask_keyed": _with(
        "associado",
        f"""SELECT id, nome, {_pseudonym("email", "email")} AS email, {_pseudonym("cpf", "cpf")} AS cpf
            FROM associado""",
    ),
    "format_brl": _with(
        "movimentacao",
        f"SELECT id, {_brl('vlr_transacao')} AS valor_formatado FROM movimentacao",
    ),
    "check_pk": _with(BROKEN, PRIMARY_KEYS),
    "check_cpf_unique": _with("x_associado", CPF_UNIQUE),
    "check_not_null": _with(BROKEN, NOT_NULL),
    "check_fk": _with(f"{BROKEN} x_historico", REFERENCES),
    "check_lengths": _with(BROKEN, LENGTHS),
    "check_member_consistency": _with(
        "x_cartao conta",
        """SELECT c.id AS id_cartao, c.id_conta, c.id_associado,
                  t.id_associado AS id_associado_conta
           FROM x_cartao c JOIN conta t ON c.id_conta = t.id
           WHERE c.id_associado IS DISTINCT FROM t.id_associado""",
    ),
    "check_all": _with(f"{BROKEN} x_historico", ALL_RULES),
    "broken_star_and_flat": _with(BROKEN, BROKEN_VIEWS),
    "dedup_movements": _with(
        "movimentacao",
        """SELECT min(id) AS id, vlr_transacao, des_transacao, data_movimentacao, id_cartao
           FROM movimentacao
           GROUP BY vlr_transacao, des_transacao, data_movimentacao, id_cartao""",
    ),
    "idempotent_merge": _with("cartao", UPSERTED),
    "insert_new_members": _with(
        "associado cartao",
        """SELECT id, nome, sobrenome,
                  CAST(CASE WHEN id IN (SELECT id_associado FROM cartao) THEN idade
                            ELSE idade + 100 END AS INTEGER) AS idade, email, cpf
           FROM associado""",
    ),
    "quality_history": _with("movimentacao", HISTORY),
}

# A written table has the rows of the lazy one.
ORACLES |= {
    "run_dim_associado": ORACLES["dim_associado"],
    "run_dim_conta": ORACLES["dim_conta"],
    "run_dim_cartao": ORACLES["dim_cartao"],
    "run_fato_movimentacao": ORACLES["fato_movimentacao"],
    "run_movimento_flat": ORACLES["flat_contract_strings"],
    "run_brand_csv": ORACLES["brand_mart"],
    "run_chart_points": ORACLES["chart_series"],
    "run_rules": ORACLES["check_all"],
    "check_all_by_load": ORACLES["check_all"],
    "flat_view_bucketed": ORACLES["flat_view"],
    "merge_touched_buckets": ORACLES["idempotent_merge"],
    "dedup_by_load": ORACLES["dedup_movements"],
    "quality_report_by_load": ORACLES["quality_report"],
    "run_dropped_rows": _with(
        BROKEN,
        """SELECT tabela, validas AS linhas_validas, linhas, validas - linhas AS descartadas
           FROM (SELECT 'fato_movimentacao' AS tabela, count(*) AS linhas
                 FROM x_movimentacao m JOIN x_cartao c ON m.id_cartao = c.id
                 WHERE m.vlr_transacao > 0
                 UNION ALL
                 SELECT 'movimento_flat', count(*)
                 FROM x_movimentacao m JOIN x_cartao c ON m.id_cartao = c.id
                      JOIN conta t ON c.id_conta = t.id
                      JOIN x_associado a ON c.id_associado = a.id
                 WHERE m.vlr_transacao > 0),
                (SELECT count(*) AS validas FROM x_movimentacao WHERE vlr_transacao > 0)""",
    ),
    "offending_rows": _with(
        BROKEN,
        """SELECT 'primary_key' AS regra, id, 'id' AS coluna FROM x_movimentacao
           WHERE id IN (SELECT id FROM x_movimentacao GROUP BY id HAVING count(*) > 1)
           UNION ALL
           SELECT 'unique', CAST(id AS VARCHAR), 'cpf' FROM x_associado
           WHERE cpf IN (SELECT cpf FROM x_associado GROUP BY cpf HAVING count(*) > 1)
           UNION ALL
           SELECT 'not_null', id, 'vlr_transacao' FROM x_movimentacao WHERE vlr_transacao IS NULL
           UNION ALL
           SELECT 'foreign_key', id, 'id_cartao' FROM x_movimentacao
           WHERE id_cartao IS NOT NULL AND id_cartao NOT IN (SELECT id FROM x_cartao)
           UNION ALL
           SELECT 'length', CAST(id AS VARCHAR), 'nom_impresso' FROM x_cartao
           WHERE length(nom_impresso) > 100""",
    ),
}
