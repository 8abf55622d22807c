WITH i AS (
  SELECT nm_cliente, nm_produto, categoria, SUM(QT_VENDIDA) AS QTD, SUM(VALOR_LIQUIDO) AS TOTAL_RS,
         MAX(DATA_MOVIMENTACAO) AS ULTIMA_VEZ
  FROM sales_base GROUP BY nm_cliente, nm_produto, categoria),
r AS (
  SELECT *, row_number() OVER (PARTITION BY nm_cliente ORDER BY TOTAL_RS DESC, nm_produto, categoria) AS RANK FROM i)
SELECT nm_cliente, nm_produto, categoria, CAST(QTD AS DOUBLE) AS QTD, CAST(TOTAL_RS AS DOUBLE) AS TOTAL_RS, ULTIMA_VEZ,
       RANK, CASE WHEN year(ULTIMA_VEZ) = 2000 THEN 'ATIVO' ELSE 'CHURN' END AS STATUS
FROM r WHERE RANK <= 100
