WITH k AS (
  SELECT SUM(VALOR_LIQUIDO) AS FATURAMENTO_LIQUIDO, COUNT(DISTINCT COD_CLIENTE) AS CLIENTES_ATIVOS,
         COALESCE(SUM(CASE WHEN ANO = 2000 THEN VALOR_LIQUIDO ELSE 0 END), 0) AS FATURAMENTO_ANO,
         COALESCE(SUM(CASE WHEN ANO = 1999 THEN VALOR_LIQUIDO ELSE 0 END), 0) AS FATURAMENTO_ANO_ANTERIOR,
         COUNT(DISTINCT nm_produto) AS MIX_ATIVO
  FROM sales_base)
SELECT CAST(FATURAMENTO_LIQUIDO AS DOUBLE) AS FATURAMENTO_LIQUIDO, CLIENTES_ATIVOS,
       CAST(FATURAMENTO_ANO AS DOUBLE) AS FATURAMENTO_ANO, CAST(FATURAMENTO_ANO_ANTERIOR AS DOUBLE) AS FATURAMENTO_ANO_ANTERIOR,
       MIX_ATIVO,
       CASE WHEN CAST(FATURAMENTO_ANO_ANTERIOR AS DOUBLE) > 0
            THEN (CAST(FATURAMENTO_ANO AS DOUBLE) / CAST(FATURAMENTO_ANO_ANTERIOR AS DOUBLE) - 1) * 100 ELSE 0.0 END AS VARIACAO_PCT
FROM k
