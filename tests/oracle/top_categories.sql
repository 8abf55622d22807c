SELECT categoria, CAST(SUM(VALOR_LIQUIDO) AS DOUBLE) AS VALOR_LIQUIDO FROM sales_base
GROUP BY categoria ORDER BY SUM(VALOR_LIQUIDO) DESC, categoria LIMIT 10
