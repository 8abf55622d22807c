SELECT ANO, MES, ORIGEM_PEDIDO, SUM(VALOR_LIQUIDO)::DOUBLE AS VALOR_LIQUIDO, COUNT(DISTINCT NUM_PEDIDO) AS PEDIDOS
FROM sales_base
WHERE ANO * 12 + MES > (SELECT MAX(ANO * 12 + MES) - 12 FROM sales_base)
GROUP BY ANO, MES, ORIGEM_PEDIDO
