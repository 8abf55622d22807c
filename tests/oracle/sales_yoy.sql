WITH y AS (SELECT ANO, SUM(VALOR_LIQUIDO) AS FATURAMENTO FROM sales_base GROUP BY ANO),
l AS (SELECT ANO, FATURAMENTO, LAG(FATURAMENTO) OVER (ORDER BY ANO) AS FATURAMENTO_ANTERIOR FROM y)
SELECT ANO, CAST(FATURAMENTO AS DOUBLE) AS FATURAMENTO, CAST(FATURAMENTO_ANTERIOR AS DOUBLE) AS FATURAMENTO_ANTERIOR,
       CASE WHEN CAST(FATURAMENTO_ANTERIOR AS DOUBLE) > 0
            THEN (CAST(FATURAMENTO AS DOUBLE) / CAST(FATURAMENTO_ANTERIOR AS DOUBLE) - 1) * 100 ELSE 0.0 END AS VARIACAO_PCT
FROM l
