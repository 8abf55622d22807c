SELECT ORIGEM_PEDIDO, CAST(SUM(VALOR_LIQUIDO) AS DOUBLE) AS VALOR_LIQUIDO FROM sales_base GROUP BY ORIGEM_PEDIDO
