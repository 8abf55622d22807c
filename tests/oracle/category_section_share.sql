WITH sums AS (
  SELECT nm_cliente, categoria, secao, SUM(VALOR_LIQUIDO) AS value, 2 - grouping_id(categoria, secao) % 2 - grouping_id(categoria, secao) // 2 AS nivel
  FROM sales_base WHERE VALOR_LIQUIDO > 0
  GROUP BY GROUPING SETS ((nm_cliente), (nm_cliente, categoria), (nm_cliente, categoria, secao)))
SELECT nm_cliente, categoria, secao, value::DOUBLE AS VALOR_LIQUIDO, nivel,
       value::DOUBLE * 100 / (max(value) FILTER (nivel = 0) OVER (PARTITION BY nm_cliente))::DOUBLE AS SHARE_PCT
FROM sums
