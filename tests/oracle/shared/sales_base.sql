WITH clean AS (          -- dimension rows: the first per id, names stripped of blanks and in upper case
  SELECT 'product' AS dim, id, names FROM (
    SELECT COALESCE(p.codprod, 0) AS id, [p.descricao, a.categoria, a.secao] AS names
    FROM pcprodut AS p LEFT JOIN product_area AS a USING (codprod) WHERE p.dtexclusao IS NULL)
  UNION ALL SELECT 'client', COALESCE(codcli, 0), [cliente] FROM pcclient
  UNION ALL SELECT 'rep', COALESCE(codusur, 0), [nome] FROM pcusuari),
named AS (
  SELECT dim, id, [upper(trim(COALESCE(x, 'N/I'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) FOR x IN first_names] AS names
  FROM (SELECT dim, id, arg_min(names, sort_key) AS first_names
        FROM (SELECT dim, id, names, row_number() OVER (PARTITION BY dim, id ORDER BY names[1], names[2], names[3]) AS sort_key FROM clean)
        GROUP BY dim, id)),
sales AS (
  SELECT COALESCE(cod_filial, 0) AS COD_FILIAL, data_movimentacao AS DATA_MOVIMENTACAO, COALESCE(num_pedido, 0) AS NUM_PEDIDO,
         COALESCE(cod_vendedor, 0) AS COD_VENDEDOR, COALESCE(cod_supervisor, 0) AS COD_SUPERVISOR, COALESCE(cod_cliente, 0) AS COD_CLIENTE,
         COALESCE(cod_produto, 0) AS COD_PRODUTO, COALESCE(qt_vendida, 0) AS QT_VENDIDA, COALESCE(valor_liquido, 0) AS VALOR_LIQUIDO,
         origem_pedido FROM sales_fact_x)
SELECT s.* EXCLUDE (origem_pedido), upper(COALESCE(s.origem_pedido, 'NAO CADASTRADO')) AS ORIGEM_PEDIDO,
       COALESCE(year(s.DATA_MOVIMENTACAO), 0) AS ANO, COALESCE(month(s.DATA_MOVIMENTACAO), 0) AS MES,
       COALESCE(p.names[1], 'NAO CADASTRADO') AS nm_produto, COALESCE(p.names[2], 'NAO CADASTRADO') AS categoria,
       COALESCE(p.names[3], 'NAO CADASTRADO') AS secao, COALESCE(c.names[1], 'NAO CADASTRADO') AS nm_cliente,
       COALESCE(r.names[1], 'NAO CADASTRADO') AS nm_vendedor
FROM sales AS s
LEFT JOIN named AS p ON p.dim = 'product' AND p.id = s.COD_PRODUTO
LEFT JOIN named AS c ON c.dim = 'client' AND c.id = s.COD_CLIENTE
LEFT JOIN named AS r ON r.dim = 'rep' AND r.id = s.COD_VENDEDOR
