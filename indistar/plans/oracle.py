"""DuckDB SQL equivalents of ``testdata.QUERIES`` (same column names/types).

Used by the driver's correctness gate and by ``tests/test_oracle.py``.
"""

_NUM = r"'^[-+]?\d+(?:[.,]\d+)?$'"


def _parse_number_sql(x: str) -> str:
    return (f"CASE WHEN regexp_matches(trim({x}), {_NUM}) "
            f"THEN TRY_CAST(replace(trim({x}), ',', '.') AS DOUBLE) END")


_ACCTBAL_TEXT = """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '...'
            WHEN c_mktsegment = 'MACHINERY' THEN translate(format('{:,.2f}', c_acctbal), ',.', '.,')
            ELSE replace(printf('%.2f', c_acctbal), '.', ',') END AS texto
FROM customer"""

_GEO = """
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

_LAG = """
WITH c AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS n_pedidos
           FROM orders GROUP BY 1, 2),
l AS (SELECT *, lag(ano) OVER w AS pa, lag(n_pedidos) OVER w AS pv
      FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY ano)),
p AS (SELECT o_custkey, ano, n_pedidos, CASE WHEN pa = ano - 1 THEN pv END AS valor_anterior FROM l),
g AS (SELECT o_custkey, ano, n_pedidos, valor_anterior,
             n_pedidos - valor_anterior AS variacao_absoluta,
             CASE WHEN valor_anterior <> 0
                  THEN round(100.0::DOUBLE * (n_pedidos - valor_anterior) / valor_anterior, 2) END AS crescimento_pct
      FROM p)"""

_PIVOT = """
SELECT user_id, CAST(ts AS DATE) AS dia,
       max(value) FILTER (WHERE event_type = 'click') AS click_max,
       max(value) FILTER (WHERE event_type = 'purchase') AS purchase_max,
       max(value) FILTER (WHERE event_type = 'view') AS view_max,
       max(value) FILTER (WHERE event_type = 'signup') AS signup_max
FROM events GROUP BY 1, 2"""

_NESTED_BASE = """
WITH o AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'),
x AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y%m') AS periodo,
             printf('%.2f', o_totalprice) AS valor_original FROM o
      UNION ALL
      SELECT o_orderkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y') AS periodo,
             '...' AS valor_original FROM o)"""

_WINDOWS = """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
a AS (SELECT s, e, CASE WHEN month(s) = 2 AND day(s) = 29 THEN CAST(s - INTERVAL 1 DAY AS DATE) ELSE s END AS an
      FROM b WHERE s <= e),
i AS (SELECT s, e, an, CAST(unnest(generate_series(0, (year(e) - year(an)) // 3 + 1)) AS INTEGER) AS janela FROM a),
w AS (SELECT janela,
             CAST(CASE WHEN janela = 0 THEN s ELSE an + to_months(36 * janela) END AS DATE) AS janela_inicio,
             CAST(least(CAST(an + to_months(36 * (janela + 1)) - INTERVAL 1 DAY AS DATE), e) AS DATE) AS janela_fim
      FROM i)"""

_REGION_COLOR = """CASE {x} WHEN 'Norte' THEN '#eb6834' WHEN 'Nordeste' THEN '#e87ba4'
 WHEN 'Centro-Oeste' THEN '#eda100' WHEN 'Sudeste' THEN '#2a78d6' WHEN 'Sul' THEN '#1baf7a'
 ELSE '#898781' END"""

_AGE = r"""
WITH c AS (SELECT n.n_nationkey AS uf_id, o.o_orderstatus AS st, substr(o.o_orderpriority, 1, 1) AS prio,
                  CAST(year(o.o_orderdate) AS INTEGER) AS ano, count(*) AS n
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
           JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
           GROUP BY 1, 2, 3, 4),
s AS (SELECT uf_id, CASE st WHEN 'F' THEN 4 ELSE 5 END AS sexo_id, CASE st WHEN 'F' THEN 'Homens' ELSE 'Mulheres' END AS sexo,
             prio, ano, n FROM c WHERE st IN ('F', 'O')
      UNION ALL
      SELECT uf_id, 6794, 'Total', prio, ano, sum(n) FROM c GROUP BY uf_id, prio, ano),
a AS (SELECT make_date(ano, 1, 1) AS data_referencia, ano, uf_id, sexo_id, sexo,
             CASE prio WHEN '1' THEN 93070 WHEN '2' THEN 93087 WHEN '3' THEN 93091 WHEN '4' THEN 93096 ELSE 60040 END
               AS faixa_etaria_id,
             CASE prio WHEN '1' THEN '0 a 4 anos' WHEN '2' THEN '15 a 19 anos' WHEN '3' THEN '35 a 39 anos'
                       WHEN '4' THEN '60 a 64 anos' ELSE 'Menos de 1 ano' END AS faixa_etaria,
             CAST(n AS BIGINT) AS populacao FROM s),
b AS (SELECT *, TRY_CAST(regexp_extract(faixa_etaria, '^\d+') AS INTEGER) AS faixa_etaria_ordem FROM a)
"""

_NATIONAL = """
WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS n, sum(o_totalprice) AS total,
                  sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS faturado,
                  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS u
           FROM orders GROUP BY 1),
v AS (SELECT 93 AS variavel_id, 'Pedidos' AS variavel_nome, 'Mil pedidos' AS unidade, ano, CAST(n AS DOUBLE) AS valor FROM y
      UNION ALL SELECT 9808, 'Valor total', 'USD', ano, round(total, 2) FROM y
      UNION ALL SELECT 9809, 'Valor faturado', 'USD', ano, round(faturado, 2) FROM y
      UNION ALL SELECT 9810, 'Pedidos urgentes', '%', ano, CAST(u AS DOUBLE) FROM y)
"""

ORACLE_SQL = {
    "avg_of_avgs": """
SELECT o_orderpriority, round(avg(m), 2) AS media FROM (
  SELECT o_orderpriority, CAST(quarter(o_orderdate) AS VARCHAR) || 'º trimestre' AS trimestre,
         avg(o_totalprice) AS m
  FROM orders GROUP BY 1, 2) t
GROUP BY o_orderpriority ORDER BY media DESC, o_orderpriority""",

    "avg_of_avgs_by_year": """
SELECT ano, o_orderpriority, round(avg(m), 2) AS media FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderpriority,
         CAST(quarter(o_orderdate) AS VARCHAR) || 'º trimestre' AS trimestre, avg(o_totalprice) AS m
  FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998, 1999, 2000) GROUP BY 1, 2, 3) t
GROUP BY ano, o_orderpriority ORDER BY ano, o_orderpriority""",

    "parse_number": f"""
WITH t AS ({_ACCTBAL_TEXT})
SELECT c_custkey, texto, {_parse_number_sql('texto')} AS valor FROM t""",

    "parse_decimal": f"""
WITH t AS ({_ACCTBAL_TEXT}),
v AS (SELECT c_custkey, TRY_CAST(replace(texto, ',', '.') AS DECIMAL(20,8)) AS valor FROM t)
SELECT c_custkey, valor FROM v WHERE valor IS NOT NULL""",

    "parse_day": """
WITH t AS (SELECT o_orderkey,
                  CASE WHEN o_orderstatus = 'P' THEN '31/02/' || CAST(year(o_orderdate) AS VARCHAR)
                       ELSE strftime(o_orderdate, '%d/%m/%Y') END AS txt FROM orders),
d AS (SELECT o_orderkey, CAST(try_strptime(txt, '%d/%m/%Y') AS DATE) AS data_referencia FROM t)
SELECT o_orderkey, data_referencia, CAST(year(data_referencia) AS SMALLINT) AS ano,
       CAST(month(data_referencia) AS SMALLINT) AS mes
FROM d WHERE data_referencia IS NOT NULL""",

    "period_year": """
SELECT make_date(y, 1, 1) AS data_referencia, y AS ano, count(*) AS n_pedidos,
       round(sum(o_totalprice), 2) AS total
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_totalprice FROM orders) t GROUP BY y""",

    "period_month": """
SELECT make_date(y, m, 1) AS data_referencia, y AS ano, m AS mes, count(*) AS n_pedidos,
       round(sum(o_totalprice), 2) AS total
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, o_totalprice
      FROM orders) t GROUP BY y, m""",

    "period_quarter": """
SELECT make_date(y, (q - 1) * 3 + 1, 1) AS data_referencia, y AS ano, q AS trimestre_num,
       CAST(q AS VARCHAR) || 'º trimestre' AS trimestre, count(*) AS n_pedidos,
       round(sum(o_totalprice), 2) AS total
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q, o_totalprice
      FROM orders) t GROUP BY y, q""",

    "strip_suffix": r"""
SELECT c_custkey,
       regexp_replace(c_name || ' - ' || upper(substr(c_mktsegment, 1, 2)), '\s*-\s*[A-Z]{2}$', '') AS municipio_nome,
       TRY_CAST(substr(CAST(c_custkey AS VARCHAR), 1, 2) AS INTEGER) AS uf_id
FROM customer""",

    "group_label": r"""
WITH g AS (SELECT replace(o_orderpriority, '-', '.') AS rotulo FROM orders),
h AS (SELECT 7168 + TRY_CAST(regexp_extract(rotulo, '^\d+') AS INTEGER) AS grupo_id, rotulo, count(*) AS n
      FROM g GROUP BY 1, 2)
SELECT grupo_id,
       CASE WHEN grupo_id = 7169 THEN 'Índice geral' ELSE regexp_replace(rotulo, '^\d+\.\s*', '') END AS grupo,
       CASE WHEN grupo_id = 7169 THEN 0 ELSE TRY_CAST(regexp_extract(rotulo, '^\d+') AS INTEGER) END AS grupo_ordem,
       n
FROM h""",

    "macro_band": r"""
WITH f AS (SELECT CASE WHEN p_size < 5 THEN 'Menos de ' || CAST(p_size AS VARCHAR) || ' anos'
                       ELSE CAST(p_size AS VARCHAR) || ' a ' || CAST(p_size + 4 AS VARCHAR) || ' anos' END
                  AS faixa_etaria FROM part),
g AS (SELECT faixa_etaria, TRY_CAST(regexp_extract(faixa_etaria, '^\d+') AS INTEGER) AS faixa_etaria_ordem FROM f)
SELECT faixa_etaria, faixa_etaria_ordem,
       CASE WHEN faixa_etaria_ordem <= 14 THEN '0 a 14 anos' WHEN faixa_etaria_ordem <= 29 THEN '15 a 29 anos'
            WHEN faixa_etaria_ordem <= 59 THEN '30 a 59 anos' ELSE '60 anos ou mais' END AS faixa_macro,
       count(*) AS n_partes
FROM g GROUP BY 1, 2, 3""",

    "nested_flatten": _NESTED_BASE + f"""
SELECT CAST(ascii(o_orderstatus) AS INTEGER) AS variavel_id, 'status ' || o_orderstatus AS variavel_nome,
       'USD' AS unidade, CAST(o_orderkey AS VARCHAR) AS localidade_id,
       'Pedido ' || CAST(o_orderkey AS VARCHAR) AS localidade_nome, 'N9' AS nivel_id, 'Pedido' AS nivel_nome,
       periodo, valor_original, {_parse_number_sql('valor_original')} AS valor,
       substr(o_orderpriority, 1, 1) AS prio_chave, o_orderpriority AS prio_nome,
       CAST(NULL AS VARCHAR) AS sem_chave
FROM x""",

    "category_lookup": _NESTED_BASE + """
SELECT CAST(x.o_orderkey AS VARCHAR) AS localidade_id, x.periodo, CAST(o.o_custkey AS VARCHAR) AS cliente_id,
       'cliente' AS cliente_nome, substr(x.o_orderpriority, 1, 1) AS prio_id, CAST(NULL AS VARCHAR) AS sem_valor
FROM x JOIN orders o ON x.o_orderkey = o.o_orderkey""",

    "catalog_profile": """
WITH o AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT CAST(ascii(o_orderstatus) AS INTEGER) AS variavel_id, 'status ' || o_orderstatus AS variavel_nome,
       'USD' AS unidade, 'N9' AS nivel_id, 'Pedido' AS nivel_nome, 'prio' AS classificacao_id,
       'prioridade' AS classificacao_nome, substr(o_orderpriority, 1, 1) AS categoria_id,
       o_orderpriority AS categoria_nome FROM o
UNION
SELECT CAST(ascii(o_orderstatus) AS INTEGER), 'status ' || o_orderstatus, 'USD', 'N9', 'Pedido', 'cli',
       'cliente', CAST(o_custkey AS VARCHAR), 'cliente' FROM o""",

    "map_flatten": f"""
WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS chave FROM events),
v AS (SELECT event_id, chave, json_extract_string(props, '$."' || chave || '"') AS valor_original FROM k)
SELECT event_id, chave, valor_original, {_parse_number_sql('valor_original')} AS valor FROM v""",

    "split_persons": """
SELECT event_id, event_type AS variavel, CAST(ts AS DATE) AS data_referencia,
       CAST(trunc(value) AS BIGINT) AS valor_pessoas
FROM events WHERE event_type IN ('signup', 'click')""",

    "split_money": """
SELECT event_id, event_type AS variavel, CAST(ts AS DATE) AS data_referencia,
       CAST(value AS DECIMAL(20,2)) AS valor_financeiro
FROM events WHERE event_type IN ('purchase')""",

    "split_percent": """
SELECT event_id, event_type AS variavel, CAST(ts AS DATE) AS data_referencia,
       CAST(value AS DECIMAL(10,2)) AS valor_percentual
FROM events WHERE event_type IN ('view', 'error')""",

    "union_series": """
WITH cat(serie, serie_id, indicador, unidade, periodicidade) AS (VALUES
  ('click', 1, 'Cliques', 'eventos', 'diaria'),
  ('error', 2, 'Erros', 'eventos', 'diaria'),
  ('purchase', 3, 'Compras', 'USD', 'diaria'),
  ('signup', 4, 'Cadastros', 'eventos', 'diaria'),
  ('view', 5, 'Visualizacoes', 'eventos', 'diaria')),
e AS (SELECT event_type AS serie, CAST(ts AS DATE) AS data_referencia,
             CAST(printf('%.2f', value) AS DECIMAL(20,8)) AS valor, ts, event_id FROM events),
r AS (SELECT e.*, row_number() OVER (PARTITION BY serie, data_referencia ORDER BY ts DESC, event_id DESC) AS rn
      FROM e)
SELECT c.serie_id, c.serie, c.indicador, c.unidade, c.periodicidade, r.data_referencia,
       CAST(year(r.data_referencia) AS SMALLINT) AS ano, CAST(month(r.data_referencia) AS SMALLINT) AS mes, r.valor
FROM r JOIN cat c ON r.serie = c.serie WHERE r.rn = 1""",

    "constant_cols": """
WITH cat(serie, serie_id, indicador, unidade, periodicidade) AS (VALUES
  ('click', 1, 'Cliques', 'eventos', 'diaria'),
  ('error', 2, 'Erros', 'eventos', 'diaria'),
  ('purchase', 3, 'Compras', 'USD', 'diaria'),
  ('signup', 4, 'Cadastros', 'eventos', 'diaria'),
  ('view', 5, 'Visualizacoes', 'eventos', 'diaria'))
SELECT e.event_id, e.event_type AS serie, c.serie_id, c.indicador, c.unidade, c.periodicidade
FROM events e LEFT JOIN cat c ON e.event_type = c.serie""",

    "pivot_long_wide": _PIVOT,

    "dedup_last": """
SELECT user_id, dia, event_id, event_type, value FROM (
  SELECT user_id, CAST(ts AS DATE) AS dia, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn = 1""",

    "dup_key_report": """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS n_linhas, count(*) AS n_chaves, CAST(sum(n - 1) AS BIGINT) AS n_duplicadas,
       count(*) FILTER (WHERE n > 1) AS n_chaves_repetidas FROM k""",

    "null_profile": f"""
WITH p AS ({_PIVOT}),
c AS (SELECT CAST(count(*) FILTER (WHERE user_id IS NULL) AS BIGINT) AS user_id,
             CAST(count(*) FILTER (WHERE dia IS NULL) AS BIGINT) AS dia,
             CAST(count(*) FILTER (WHERE click_max IS NULL) AS BIGINT) AS click_max,
             CAST(count(*) FILTER (WHERE purchase_max IS NULL) AS BIGINT) AS purchase_max,
             CAST(count(*) FILTER (WHERE view_max IS NULL) AS BIGINT) AS view_max,
             CAST(count(*) FILTER (WHERE signup_max IS NULL) AS BIGINT) AS signup_max FROM p)
SELECT *, user_id + dia + click_max + purchase_max + view_max + signup_max AS total_nulos FROM c""",

    "range_summary": """
SELECT event_type, min(CAST(ts AS DATE)) AS data_inicial, max(CAST(ts AS DATE)) AS data_final,
       count(*) AS registros
FROM events GROUP BY 1""",

    "value_list": "SELECT DISTINCT r_name FROM region ORDER BY r_name",

    "value_list_year": "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders ORDER BY ano",

    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, count(*) AS linhas FROM {t}"
        for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]),

    "file_profile": """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n,
                  sum(CAST(l_orderkey IS NULL AS INTEGER) + CAST(l_linenumber IS NULL AS INTEGER)
                      + CAST(l_quantity IS NULL AS INTEGER) + CAST(l_returnflag IS NULL AS INTEGER)) AS nulos
           FROM lineitem GROUP BY 1, 2)
SELECT 'lineitem.parquet' AS arquivo, CAST(sum(n) AS BIGINT) AS linhas,
       CAST(sum(n - 1) AS BIGINT) AS chaves_duplicadas, CAST(sum(nulos) AS BIGINT) AS celulas_nulas FROM k""",

    "contract_checks": """
WITH f AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS data_referencia,
                  CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
                  o_orderpriority, o_totalprice FROM orders)
SELECT 'pedidos' AS tabela, 'not_null' AS regra, 'o_orderkey' AS coluna,
       count(*) FILTER (WHERE o_orderkey IS NULL) AS violacoes FROM f
UNION ALL SELECT 'pedidos', 'not_null', 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM f
UNION ALL SELECT 'pedidos', 'not_null', 'data_referencia', count(*) FILTER (WHERE data_referencia IS NULL) FROM f
UNION ALL SELECT 'pedidos', 'not_null', 'ano', count(*) FILTER (WHERE ano IS NULL) FROM f
UNION ALL SELECT 'pedidos', 'not_null', 'mes', count(*) FILTER (WHERE mes IS NULL) FROM f
UNION ALL SELECT 'pedidos', 'not_null', 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM f
UNION ALL SELECT 'pedidos', 'ano_da_data', 'ano', count(*) FILTER (WHERE ano <> year(data_referencia)) FROM f
UNION ALL SELECT 'pedidos', 'faixa', 'mes', count(*) FILTER (WHERE NOT (mes BETWEEN 1 AND 12)) FROM f
UNION ALL SELECT 'pedidos', 'tamanho', 'o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 8) FROM f
UNION ALL SELECT 'pedidos', 'precisao', 'o_totalprice',
       count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL) FROM f
UNION ALL SELECT 'pedidos', 'chave_primaria', 'o_orderkey', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
       FROM (SELECT o_orderkey, count(*) AS n FROM f GROUP BY 1) k
UNION ALL SELECT 'pedidos', 'chave_estrangeira', 'o_custkey->customer', count(*)
       FROM f WHERE o_custkey IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = f.o_custkey)""",

    "star_region_sum": f"""
SELECT r.r_name, round(sum(o.o_totalprice), 2) AS total {_GEO}
GROUP BY r.r_name ORDER BY total DESC, r_name""",

    "avg_by_group": """
WITH pc AS (SELECT o_custkey, count(*) AS n_pedidos FROM orders GROUP BY 1)
SELECT n.n_name, round(avg(pc.n_pedidos), 4) AS media_pedidos
FROM pc JOIN customer c ON pc.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY n.n_name ORDER BY media_pedidos DESC, n_name""",

    "count_nonnull": f"""
SELECT n.n_name, count(year(o.o_orderdate)) AS n_anos {_GEO}
GROUP BY n.n_name ORDER BY n_anos DESC, n_name""",

    "two_key_count": f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS ano, r.r_name, count(c.c_nationkey) AS n_estados {_GEO}
GROUP BY 1, 2 ORDER BY ano, r_name""",

    "filter_propagation": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (
        SELECT n_nationkey FROM nation WHERE n_regionkey IN (
          SELECT r_regionkey FROM region WHERE r_name = 'AMERICA')))""",

    "lag_growth": _LAG + """
SELECT o_custkey, ano, n_pedidos, valor_anterior, variacao_absoluta, crescimento_pct FROM g""",

    "year_summary": _LAG + """
SELECT ano, CAST(sum(n_pedidos) AS BIGINT) AS total, count(o_custkey) AS qtd_entidades,
       round(avg(crescimento_pct), 4) AS crescimento_medio_pct,
       CAST(sum(variacao_absoluta) AS BIGINT) AS variacao_absoluta_total
FROM g GROUP BY ano""",

    "report_cards": _LAG + """
SELECT round(avg(crescimento_pct), 4) AS crescimento_medio_pct,
       CAST(sum(variacao_absoluta) AS BIGINT) AS variacao_absoluta_total,
       CAST(sum(n_pedidos) AS BIGINT) AS total, count(DISTINCT o_custkey) AS qtd_entidades FROM g""",

    "share_of_total": f"""
WITH cells AS (SELECT n.n_name, o.o_orderpriority, count(*) AS n_pedidos {_GEO} GROUP BY 1, 2)
SELECT n_name, o_orderpriority, n_pedidos,
       round(100.0::DOUBLE * n_pedidos / sum(n_pedidos) OVER (PARTITION BY n_name), 2) AS participacao_pct
FROM cells""",

    "matrix_rollup": f"""
WITH b AS (SELECT r.r_name, n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS ano, o.o_totalprice {_GEO}),
cells AS (SELECT GROUPING(r_name, n_name) AS nivel, r_name, n_name, ano, min(o_totalprice) AS v
          FROM b GROUP BY GROUPING SETS ((r_name, n_name, ano), (r_name, ano), (ano)))
SELECT nivel, r_name, n_name, """ + ", ".join(
        f"max(v) FILTER (WHERE ano = {y}) AS v_{y}" for y in range(1995, 2002)) + """
FROM cells GROUP BY nivel, r_name, n_name""",

    "date_drill": """
SELECT ano, trimestre, mes, count(*) AS n_pedidos, round(sum(o_totalprice), 2) AS total,
       CAST(bit_count(GROUPING(ano, trimestre, mes)) AS INTEGER) AS nivel
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
             CAST(month(o_orderdate) AS INTEGER) AS mes, o_totalprice FROM orders) t
GROUP BY ROLLUP (ano, trimestre, mes)""",

    "date_drill_day": """
SELECT ano, trimestre, mes, dia, count(*) AS n_pedidos, round(sum(o_totalprice), 2) AS total,
       CAST(bit_count(GROUPING(ano, trimestre, mes, dia)) AS INTEGER) AS nivel
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
             CAST(month(o_orderdate) AS INTEGER) AS mes, CAST(day(o_orderdate) AS INTEGER) AS dia, o_totalprice
      FROM orders) t
GROUP BY ROLLUP (ano, trimestre, mes, dia)""",

    "single_value": f"""
WITH b AS (SELECT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS ano, r.r_name {_GEO}),
s AS (SELECT n_name, ano, CASE WHEN count(DISTINCT r_name) = 1 THEN max(r_name) END AS regiao,
             GROUPING(n_name, ano) AS nivel
      FROM b GROUP BY GROUPING SETS ((n_name), (ano)))
SELECT n_name, ano, regiao, nivel, {_REGION_COLOR.format(x='regiao')} AS cor FROM s""",

    "calendar": """
WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(CAST(make_date(CAST(year(lo) AS INTEGER), 1, 1) AS TIMESTAMP),
                                         CAST(make_date(CAST(year(hi) AS INTEGER), 12, 31) AS TIMESTAMP),
                                         INTERVAL 1 DAY)) AS DATE) AS data FROM b)
SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS month_no, monthname(data) AS mes,
       CAST(floor((month(data) + 2) / 3) AS INTEGER) AS quarter_no,
       'Qtr ' || CAST(CAST(floor((month(data) + 2) / 3) AS INTEGER) AS VARCHAR) AS trimestre,
       CAST(day(data) AS INTEGER) AS dia
FROM d""",

    "date_part_join": """
SELECT CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS month_no, monthname(ts) AS mes,
       'Qtr ' || CAST(quarter(ts) AS VARCHAR) AS trimestre, count(*) AS n_eventos,
       round(sum(value), 2) AS soma_valor
FROM events GROUP BY 1, 2, 3, 4""",

    "window_table": _WINDOWS + """
SELECT janela, janela_inicio, janela_fim FROM w WHERE janela_inicio <= janela_fim""",

    "window_coverage": _WINDOWS + """
SELECT w.janela, w.janela_inicio, w.janela_fim, count(*) AS n_pedidos
FROM orders o JOIN w ON CAST(o.o_orderdate AS DATE) BETWEEN w.janela_inicio AND w.janela_fim
WHERE w.janela_inicio <= w.janela_fim
GROUP BY 1, 2, 3""",

    "date_range_filter": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data_referencia, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-06-30'""",

    "population_recipe": r"""
SELECT make_date(CAST(year(o.o_orderdate) AS INTEGER), 1, 1) AS data_referencia,
       CAST(year(o.o_orderdate) AS INTEGER) AS ano, CAST(o.o_custkey AS INTEGER) AS municipio_id,
       c.c_name AS municipio_nome, TRY_CAST(substr(CAST(o.o_custkey AS VARCHAR), 1, 2) AS INTEGER) AS uf_id,
       count(*) AS populacao
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1, 2, 3, 4, 5""",

    "resumo_ano_recipe": """
WITH c AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS pop
           FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1, 2),
l AS (SELECT *, lag(ano) OVER w AS pa, lag(pop) OVER w AS pv
      FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY ano)),
p AS (SELECT o_custkey, ano, pop, CASE WHEN pa = ano - 1 THEN pv END AS prev FROM l),
g AS (SELECT o_custkey, ano, pop, pop - prev AS variacao,
             CASE WHEN prev <> 0 THEN round(100.0::DOUBLE * (pop - prev) / prev, 2) END AS crescimento
      FROM p)
SELECT make_date(ano, 1, 1) AS ano, CAST(sum(pop) AS BIGINT) AS populacao_total, count(o_custkey) AS qtd_municipios,
       round(avg(crescimento), 2) AS crescimento_medio_pct,
       CAST(sum(variacao) AS DOUBLE) AS variacao_absoluta_total
FROM g GROUP BY ano""",

    "unemployment_recipe": f"""
WITH c AS (SELECT n.n_nationkey AS uf_id, CAST(year(o.o_orderdate) AS INTEGER) AS ano,
                  CAST(quarter(o.o_orderdate) AS INTEGER) AS q, count(*) AS n,
                  count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS u {_GEO} GROUP BY 1, 2, 3)
SELECT make_date(ano, (q - 1) * 3 + 1, 1) AS data_referencia, ano, q AS trimestre_num,
       CAST(q AS VARCHAR) || 'º trimestre' AS trimestre, uf_id, CAST(n AS DOUBLE) AS taxa_desocupacao_pct,
       CASE WHEN u = 0 THEN NULL ELSE CAST(u AS DOUBLE) END AS taxa_subutilizacao_pct
FROM c""",

    "unemployment_report_recipe": f"""
WITH c AS (SELECT n.n_nationkey AS uf_id, CAST(year(o.o_orderdate) AS INTEGER) AS ano,
                  CAST(quarter(o.o_orderdate) AS INTEGER) AS q, count(*) AS n,
                  count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS u {_GEO} GROUP BY 1, 2, 3)
SELECT ano, uf_id, round(avg(CAST(n AS DOUBLE)), 4) AS taxa_desemprego_media_anual,
       round(avg(CASE WHEN u = 0 THEN NULL ELSE CAST(u AS DOUBLE) END), 4) AS taxa_desocupacao_media_anual
FROM c GROUP BY ano, uf_id""",

    "cpi_recipe": r"""
WITH c AS (SELECT r.r_regionkey AS area_ipca_id, r.r_name AS area_ipca, o.o_orderpriority,
                  CAST(year(o.o_orderdate) AS INTEGER) AS ano, CAST(month(o.o_orderdate) AS INTEGER) AS mes,
                  count(*) AS n, count(*) FILTER (WHERE o.o_orderstatus = 'F') AS f,
                  count(*) FILTER (WHERE o.o_orderstatus = 'O') AS o_, count(*) FILTER (WHERE o.o_orderstatus = 'P') AS p
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
           JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
           GROUP BY 1, 2, 3, 4, 5),
g AS (SELECT *, 7168 + TRY_CAST(regexp_extract(o_orderpriority, '^\d+') AS INTEGER) AS grupo_ipca_id,
             replace(o_orderpriority, '-', '.') AS rotulo FROM c)
SELECT make_date(ano, mes, 1) AS data_referencia, ano, mes, area_ipca_id, area_ipca, 'N7' AS nivel_id,
       grupo_ipca_id,
       CASE WHEN grupo_ipca_id = 7169 THEN 'Índice geral' ELSE regexp_replace(rotulo, '^\d+\.\s*', '') END AS grupo_ipca,
       CASE WHEN grupo_ipca_id = 7169 THEN 0 ELSE TRY_CAST(regexp_extract(rotulo, '^\d+') AS INTEGER) END AS grupo_ipca_ordem,
       CAST(n AS DOUBLE) AS variacao_mensal_pct,
       CASE WHEN f = 0 THEN NULL ELSE CAST(f AS DOUBLE) END AS acumulado_ano_pct,
       CASE WHEN o_ = 0 THEN NULL ELSE CAST(o_ AS DOUBLE) END AS acumulado_12_meses_pct,
       CASE WHEN p = 0 THEN NULL ELSE CAST(p AS DOUBLE) END AS peso_mensal_pct
FROM g""",

    "age_band_recipe": _AGE + """
SELECT data_referencia, ano, uf_id, sexo_id, sexo, faixa_etaria_id, faixa_etaria, faixa_etaria_ordem,
       CASE WHEN faixa_etaria_ordem <= 14 THEN '0 a 14 anos' WHEN faixa_etaria_ordem <= 29 THEN '15 a 29 anos'
            WHEN faixa_etaria_ordem <= 59 THEN '30 a 59 anos' ELSE '60 anos ou mais' END AS faixa_macro,
       populacao
FROM b""",

    "age_share_recipe": _AGE + """
SELECT data_referencia, uf_id, sexo_id, faixa_etaria_id, populacao,
       round(100.0::DOUBLE * populacao / sum(populacao) OVER (PARTITION BY data_referencia, uf_id), 2)
         AS participacao_uf_pct
FROM b WHERE sexo <> 'Total'""",

    "pib_money_recipe": _NATIONAL + """
SELECT variavel_id, variavel_nome, unidade, make_date(ano, 1, 1) AS data_referencia, ano,
       CAST(valor AS DECIMAL(20,2)) AS valor_financeiro
FROM v WHERE variavel_id IN (9808, 9809, 9812, 9813)""",

    "pib_long_recipe": _NATIONAL + """
SELECT variavel_id, variavel_nome, unidade, 1 AS pais_id, 'Total' AS pais_nome, 'N1' AS nivel_id,
       'Total' AS nivel_nome, ano, make_date(ano, 1, 1) AS data_referencia, valor
FROM v""",

    "upsert_merge": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders t
WHERE o_orderdate < TIMESTAMP '1999-01-01'
  AND NOT EXISTS (SELECT 1 FROM orders u WHERE u.o_orderdate >= TIMESTAMP '1998-01-01'
                                           AND u.o_orderkey = t.o_orderkey)""",
}

# File round trips: the landed-and-read-back recipes equal their in-memory
# twins; the CSV import equals the source columns with the junk tokens nulled.
ORACLE_SQL["landed_nested_recipe"] = ORACLE_SQL["population_recipe"]
ORACLE_SQL["landed_series_recipe"] = ORACLE_SQL["union_series"]
ORACLE_SQL["per_series_csv"] = ORACLE_SQL["union_series"]
ORACLE_SQL["csv_typed_import"] = """
SELECT c_custkey, c_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_nationkey AS INTEGER) END AS c_nationkey,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE CAST(printf('%.2f', c_acctbal) AS DECIMAL(12,2)) END
         AS c_acctbal,
       c_mktsegment
FROM customer"""
ORACLE_SQL["csv_cast_failures"] = """
SELECT CAST(0 AS BIGINT) AS c_custkey, CAST(0 AS BIGINT) AS c_name,
       CAST(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS BIGINT) AS c_nationkey,
       CAST(count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') AS BIGINT) AS c_acctbal,
       CAST(0 AS BIGINT) AS c_mktsegment
FROM customer"""
ORACLE_SQL["full_refresh_counts"] = """
SELECT 'clientes' AS tabela, count(*) AS linhas FROM customer
UNION ALL
SELECT 'pedidos' AS tabela, count(*) AS linhas FROM orders"""
ORACLE_SQL["upsert_published"] = ORACLE_SQL["upsert_merge"]
ORACLE_SQL["cpi_matrix_report"] = """
WITH f AS (""" + ORACLE_SQL["cpi_recipe"] + """),
cells AS (
  SELECT CAST(grouping(area_ipca) * 2 + grouping(grupo_ipca) AS BIGINT) AS nivel, area_ipca, grupo_ipca, ano,
         min(acumulado_12_meses_pct) AS v
  FROM f GROUP BY GROUPING SETS ((area_ipca, grupo_ipca, ano), (area_ipca, ano), (ano)))
SELECT nivel, area_ipca, grupo_ipca,
       max(v) FILTER (WHERE ano = 1995) AS ano_1995,
       max(v) FILTER (WHERE ano = 1996) AS ano_1996,
       max(v) FILTER (WHERE ano = 1997) AS ano_1997,
       max(v) FILTER (WHERE ano = 1998) AS ano_1998,
       max(v) FILTER (WHERE ano = 1999) AS ano_1999,
       max(v) FILTER (WHERE ano = 2000) AS ano_2000,
       max(v) FILTER (WHERE ano = 2001) AS ano_2001
FROM cells GROUP BY nivel, area_ipca, grupo_ipca"""
ORACLE_SQL["document_problems_report"] = """
SELECT 'bons' AS lote, count(*) AS linhas, CAST(0 AS BIGINT) AS corrompidos, count(*) AS preenchidos
FROM (SELECT DISTINCT o.o_custkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) d
UNION ALL
SELECT 'corrompidos' AS lote, count(*) AS linhas, count(*) AS corrompidos, CAST(0 AS BIGINT) AS preenchidos
FROM customer WHERE c_mktsegment = 'HOUSEHOLD'"""
_UNEMPLOYMENT_CELLS = f"""
WITH c AS (SELECT n.n_name AS uf_sigla, CAST(year(o.o_orderdate) AS INTEGER) AS ano,
                  CAST(quarter(o.o_orderdate) AS INTEGER) AS q, CAST(count(*) AS DOUBLE) AS n {_GEO}
           GROUP BY 1, 2, 3)"""
ORACLE_SQL["unemployment_table_report"] = _UNEMPLOYMENT_CELLS + """
SELECT ano, uf_sigla, round(avg(n), 4) AS taxa_desemprego_media_anual
FROM c WHERE ano IN (1996, 1997, 1998, 1999, 2000) GROUP BY ano, uf_sigla"""
ORACLE_SQL["unemployment_by_state_report"] = _UNEMPLOYMENT_CELLS + """,
l AS (SELECT uf_sigla, q, avg(n) AS m FROM c GROUP BY uf_sigla, q)
SELECT uf_sigla, round(avg(m), 4) AS taxa_desemprego_media_anual FROM l GROUP BY uf_sigla"""
ORACLE_SQL["page_population_by_region"] = f"""
SELECT r.r_name AS regiao, CAST(count(*) AS BIGINT) AS populacao {_GEO}
WHERE year(o.o_orderdate) = 1998 GROUP BY r.r_name"""
ORACLE_SQL["page_cards"] = """
WITH c AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS pop
           FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1, 2),
l AS (SELECT *, lag(ano) OVER w AS pa, lag(pop) OVER w AS pv
      FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY ano)),
g AS (SELECT ano, pop, CASE WHEN pa = ano - 1 THEN pv END AS prev FROM l),
h AS (SELECT pop, pop - prev AS variacao,
             CASE WHEN prev <> 0 THEN round(100.0::DOUBLE * (pop - prev) / prev, 2) END AS crescimento
      FROM g WHERE ano = 1998)
SELECT 'crescimento_medio_pct' AS cartao, round(avg(crescimento), 4) AS valor FROM h
UNION ALL SELECT 'variacao_absoluta_total' AS cartao, round(CAST(sum(variacao) AS DOUBLE), 4) AS valor FROM h
UNION ALL SELECT 'populacao_total' AS cartao, round(CAST(sum(pop) AS DOUBLE), 4) AS valor FROM h
UNION ALL SELECT 'qtd_municipios' AS cartao, round(CAST(count(*) AS DOUBLE), 4) AS valor FROM h"""
_PAGE_ROWS = f"""
WITH p AS (SELECT n.n_name AS uf_sigla, r.r_name AS regiao, o.o_custkey, CAST(year(o.o_orderdate) AS INTEGER) AS ano,
                  count(*) AS pop {_GEO}
           WHERE year(o.o_orderdate) = 1998 GROUP BY 1, 2, 3, 4)"""
ORACLE_SQL["page_mean_population_by_state"] = _PAGE_ROWS + """
SELECT uf_sigla, round(avg(pop), 4) AS media_populacao FROM p GROUP BY uf_sigla"""
ORACLE_SQL["page_year_count_by_state"] = _PAGE_ROWS + """
SELECT uf_sigla, count(ano) AS contagem_ano FROM p GROUP BY uf_sigla"""
ORACLE_SQL["page_state_count_by_year_region"] = _PAGE_ROWS + """
SELECT ano, regiao, count(uf_sigla) AS contagem_uf FROM p GROUP BY ano, regiao"""

_BY_YEAR = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(o_totalprice AS DECIMAL(12,2)) AS valor FROM orders)"""
ORACLE_SQL["upsert_touched_partitions"] = _BY_YEAR + """
SELECT ano, count(*) AS linhas, round(CAST(sum(valor + CASE WHEN ano = 1997 THEN 1 ELSE 0 END) AS DOUBLE), 2) AS total,
       CAST(CASE WHEN ano = 1997 THEN 2 ELSE 1 END AS BIGINT) AS commit
FROM o GROUP BY ano"""
ORACLE_SQL["upsert_two_writers"] = _BY_YEAR + """
SELECT o_orderkey, o_custkey, ano, CAST(valor + CASE WHEN ano = 1998 THEN 2 WHEN ano <> 1997 THEN 0
       WHEN o_custkey % 2 = 1 THEN 1 ELSE 3 END AS DECIMAL(12,2)) AS valor FROM o"""
ORACLE_SQL["refresh_one_commit"] = """
WITH etapas(etapa, mais) AS (VALUES ('1 primeira', 0), ('2 contrato violado', 0), ('3 interrompida', 0), ('4 completa', 3))
SELECT etapa, 'clientes' AS tabela, count(*) AS linhas, CAST(sum(c_custkey) AS DOUBLE) AS total
FROM etapas, customer GROUP BY etapa
UNION ALL
SELECT etapa, 'pedidos' AS tabela, count(*) AS linhas,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2)) + mais) AS DOUBLE), 2) AS total
FROM etapas, orders GROUP BY etapa"""
ORACLE_SQL["landed_extractions"] = ORACLE_SQL["union_series"].replace(
    "CAST(printf('%.2f', value) AS DECIMAL(20,8)) AS valor",
    "CAST(printf('%.2f', value + CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-16' THEN 1 ELSE 0 END) AS DECIMAL(20,8)) AS valor")
ORACLE_SQL["intake_report"] = """
SELECT 'corrompido' AS problema, CAST(1 AS BIGINT) AS instantaneos, count(*) AS registros FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'sem_dados', 1, count(*) FROM events WHERE event_type = 'signup'
UNION ALL SELECT 'serie_desconhecida', 1, count(*) FROM orders
UNION ALL SELECT 'sem_registro', 1, 0
UNION ALL SELECT 'aproveitado', count(DISTINCT event_type), count(DISTINCT (event_type, CAST(ts AS DATE)))
FROM events WHERE event_type NOT IN ('purchase', 'signup')"""
ORACLE_SQL["window_coverage_series"] = """
WITH o AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS dia FROM orders),
b AS (SELECT o_orderpriority, min(dia) AS lo, max(dia) AS hi FROM o GROUP BY 1),
w AS (SELECT o_orderpriority, i AS janela, CAST(lo + to_years(2 * i) AS DATE) AS janela_inicio,
             least(CAST(lo + to_years(2 * i + 2) AS DATE) - 1, hi) AS janela_fim
      FROM (SELECT *, CAST(unnest(range(20)) AS INTEGER) AS i FROM b))
SELECT w.o_orderpriority, janela, janela_inicio, janela_fim, count(*) AS n_pedidos
FROM w JOIN o ON o.o_orderpriority = w.o_orderpriority AND dia BETWEEN janela_inicio AND janela_fim
GROUP BY ALL"""
